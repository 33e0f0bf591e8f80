"""Fixed lookup tables, and the small DataFrames made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# File extension -> handler.
HANDLERS = {
    ".py": "python",
    ".js": "javascript",
    ".html": "html",
    ".css": "css",
    ".json": "json",
    ".md": "markdown",
    ".txt": "text",
    ".pyi": "python",
    ".ts": "typescript",
    ".tsx": "typescript",
    ".jsx": "jsx",
    ".mjs": "javascript",
    ".cjs": "javascript",
    ".vue": "vue",
    ".yaml": "yaml",
    ".yml": "yaml",
    ".xml": "xml",
    ".png": "image",
    ".jpg": "image",
    ".jpeg": "image",
    ".gif": "image",
    ".bmp": "image",
    ".ico": "image",
    ".svg": "image",
    ".doc": "document",
    ".pdf": "document",
    ".odt": "document",
    ".docx": "document",
    ".xlsx": "document",
    ".ppt": "document",
    ".pptx": "document",
    ".scss": "css",
    ".sass": "css",
    ".node": "javascript",
    ".mts": "typescript",
    ".coffee": "javascript",
    ".applescript": "text",
    ".c": "text",
    ".jinja2": "text",
    ".h": "text",
    ".py-tpl": "python",
    ".cpp": "text",
    ".hpp": "text",
    ".asm": "text",
    ".pyx": "python",
    ".f": "text",
    ".template": "text",
    ".keep": "text",
    ".R": "text",
    ".go": "text",
    ".rs": "text",
    ".pyw": "python",
    ".misc": "text",
    ".message": "text",
    ".no_trailing_newline": "text",
    ".g": "text",
    ".csh": "text",
    ".asp": "text",
    ".htm": "html",
    ".in": "text",
}

# Languages whose name differs from their handler's.
LANGUAGES = {
    ".scss": "scss",
    ".sass": "sass",
    ".coffee": "coffeescript",
    ".applescript": "applescript",
    ".c": "c",
    ".h": "c",
    ".cpp": "c++",
    ".hpp": "c++",
    ".asm": "nasm",
    ".f": "fortran",
    ".R": "r",
    ".go": "go",
    ".rs": "rust",
    ".csh": "csh",
    ".jinja2": "jinja",
}

# Extensions that mean text.
TEXT_EXTENSIONS = [
    ".txt", ".md", ".html", ".htm", ".json", ".css", ".xml", ".yml", ".yaml", ".csv", ".ini", ".cfg",
    ".conf", ".py", ".js", ".ts", ".jsx", ".tsx", ".php", ".sh", ".bat", ".ps1", ".sql", ".log",
    ".gitignore", ".npmignore", ".jshintrc", ".eslintrc", ".babelrc", ".editorconfig", ".markdown",
    ".mdx", ".rst", ".asciidoc", ".vue", ".scss", ".sass", ".node", ".mts", ".coffee", ".applescript",
    ".c", ".jinja2", ".h", ".py-tpl", ".cpp", ".hpp", ".asm", ".pyx", ".f", ".template", ".keep", ".R",
    ".go", ".rs", ".pyw", ".misc", ".message", ".no_trailing_newline", ".g", ".csh", ".asp", ".htm", ".in",
]

# MIME types that mean text.
TEXT_TYPES = [
    "text/plain", "text/html", "text/css", "text/javascript", "application/json", "application/xml",
]

# Languages a record may carry.
RECORD_LANGUAGES = [
    "python", "javascript", "html", "css", "json", "markdown", "text", "yaml", "xml",
    "image", "document", "unknown", "typescript", "jsx", "vue",
]

# Extensions tried for an import, besides the importing file's own.
IMPORT_EXTENSIONS = [
    ".py", ".js", ".ts", ".jsx", ".vue", ".scss", ".css", ".sass", ".html", ".tsx", ".xml", ".php",
    ".c", ".cpp", ".hpp", ".go", ".rs",
]

IMPORT_LANGUAGES = ["python", "javascript", "typescript"]

# Handlers whose records are checked against the record schema before they are kept.
CHECKED_HANDLERS = ["python", "html", "css", "javascript", "typescript", "jsx", "vue"]

# Handlers that give no record for unreadable content.
CONTENT_HANDLERS = ["python", "html", "css", "javascript", "json", "markdown", "text", "yaml", "xml",
                    "typescript", "jsx", "vue"]

# First bytes (hex) -> MIME type.
SIGNATURES = [
    ("89504E470D0A1A0A", "image/png"),
    ("FFD8FF", "image/jpeg"),
    ("474946383761", "image/gif"),
    ("474946383961", "image/gif"),
    ("424D", "image/bmp"),
    ("00000100", "image/x-icon"),
    ("255044462D", "application/pdf"),
    ("504B0304", "application/zip"),
    ("D0CF11E0A1B11AE1", "application/x-ole-storage"),
    ("1F8B08", "application/gzip"),
    ("7F454C46", "application/x-executable"),
]

# MIME type of readable text by extension.
TEXT_TYPE_OF = {
    ".html": "text/html",
    ".htm": "text/html",
    ".css": "text/css",
    ".js": "text/javascript",
    ".mjs": "text/javascript",
    ".cjs": "text/javascript",
    ".json": "application/json",
    ".xml": "application/xml",
    ".svg": "image/svg+xml",
}

# Record schema: JSON path -> (required, allowed types).
RECORD_RULES = [
    ("file_path", True, ("string",)),
    ("language", True, ("string",)),
    ("content", True, ("string", "null")),
    ("analysis", True, ("object",)),
    ("analysis.classes", False, ("array",)),
    ("analysis.functions", False, ("array",)),
    ("analysis.imports", False, ("array",)),
    ("analysis.lint_results", False, ("object", "array", "null")),
    ("analysis.docstrings", False, ("object",)),
    ("analysis.comments", False, ("array",)),
    ("analysis.html", False, ("string",)),
    ("analysis.tags", False, ("array",)),
    ("analysis.attributes", False, ("object",)),
    ("analysis.entities", False, ("array",)),
    ("analysis.complexity", False, ("number",)),
    ("analysis.data", False, ("object",)),
    ("analysis.jsx_analysis", False, ("object",)),
    ("analysis.vue_analysis", False, ("object",)),
    ("metadata", True, ("object",)),
    ("metadata.loc", False, ("integer",)),
    ("metadata.size", True, ("integer",)),
    ("metadata.md5_hash", False, ("string",)),
]


def _quote(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "\\'") + "'"


def inline(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A fixed string table as an inline relation, so that its size is known when planning."""
    values = ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def ext_dim(spark: SparkSession) -> DataFrame:
    rows = [(ext, handler, LANGUAGES.get(ext, handler)) for ext, handler in HANDLERS.items()]
    return inline(spark, ["extension", "handler", "ext_language"], rows)
