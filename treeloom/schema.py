"""Types of a file record."""

from __future__ import annotations

FUNCTION = "struct<name:string,params:array<string>,calls:array<string>>"

ENTITIES = "array<struct<text:string,label:string>>"

# Order matters: this is the field order of the `analysis` struct everywhere.
ANALYSIS_FIELDS = {
    "classes": f"array<struct<name:string,methods:array<{FUNCTION}>>>",
    "functions": f"array<{FUNCTION}>",
    "imports": "array<string>",
    "docstrings": "map<string,string>",
    "comments": "array<string>",
    "tags": "array<string>",
    "attributes": "map<string,map<string,string>>",
    "rules": "array<string>",
    "properties": "map<string,array<string>>",
    "headings": "array<struct<level:int,text:string>>",
    "links": "array<struct<text:string,target:string>>",
    "entities": ENTITIES,
    "complexity": "bigint",
    "lint_results": "variant",
    "function_count": "bigint",
    "comment_density": "double",
}

ANALYSIS = "struct<" + ",".join(f"{k}:{v}" for k, v in ANALYSIS_FIELDS.items()) + ">"

METADATA = "struct<loc:bigint,size:bigint,md5_hash:string>"

RECORD = (
    "file_path string, file_name string, extension string, module_path string, handler string, "
    f"language string, file_type string, content string, analysis {ANALYSIS}, data variant, "
    f"metadata {METADATA}, documentation string"
)

CACHE = f"file_path string, hash string, analysis {ANALYSIS}, data variant, function_count bigint, comment_density double"
