import random

import pytest
from pyspark.sql import functions as F

from treeloom import dims
from treeloom.operators import graph
from treeloom.sources import corpora

FILES = [
    ("module1", "module1/file1.py", "python", ["module2.util"]),
    ("module1", "module1/main.js", "javascript", ["module2.feature", "module2.missing"]),
    ("module1", "module1/style.css", "css", []),
    ("module2", "module2/util.js", "javascript", []),
    ("module2", "module2/feature.ts", "typescript", []),
]


def frames(spark, rows):
    files = spark.createDataFrame(rows, "module_path string, file_path string, language string, imports array<string>")
    return files, files.select("file_path", "module_path", "language", F.explode("imports").alias("import_statement"))


def test_fixture(spark):
    files, imports = frames(spark, FILES)
    resolved = graph.resolve_imports(imports, files)
    assert {(r.import_statement, r.resolved) for r in resolved.collect()} == {
        ("module2.util", "module2/util.js"), ("module2.feature", "module2/feature.ts"), ("module2.missing", None)}
    assert {tuple(r) for r in graph.dependency_edges(resolved).collect()} == {
        ("module1/file1.py", "module2/util.js"), ("module1/main.js", "module2/feature.ts")}
    assert graph.dependency_nodes(files).count() == 5
    assert [r.import_statement for r in graph.unresolved(resolved).collect()] == ["module2.missing"]


def test_relative_and_own_extension(spark):
    files, imports = frames(spark, [
        ("a/b", "a/b/x.mjs", "javascript", ["./y", "../c/z", "../../top", "y"]),
        ("a/b", "a/b/y.mjs", "javascript", []),
        ("a/c", "a/c/z.ts", "typescript", ["y"]),
        (".", "top.js", "javascript", ["a.b.y"]),
        ("v1.2", "v1.2/m.py", "python", ["n"]),
        ("v1.2", "v1.2/n.py", "python", []),
        ("css", "css/s.css", "css", ["y"]),
    ])
    got = {(r.file_path, r.import_statement): r.resolved for r in graph.resolve_imports(imports, files).collect()}
    assert got == {
        ("a/b/x.mjs", "./y"): "a/b/y.mjs", ("a/b/x.mjs", "y"): "a/b/y.mjs", ("a/b/x.mjs", "../c/z"): "a/c/z.ts",
        ("a/b/x.mjs", "../../top"): "top.js", ("a/c/z.ts", "y"): None, ("top.js", "a.b.y"): None,
        ("v1.2/m.py", "n"): "v1.2/n.py", ("css/s.css", "y"): None}
    edges = graph.dependency_edges(graph.resolve_imports(imports, files))
    assert edges.where("src = 'css/s.css'").count() == 0


def brute_force(rows, statement, path, module, boundary):
    """The first file in module and file order whose path ends with the import."""
    extensions = dims.IMPORT_EXTENSIONS + [path[path.rindex("."):]]
    names = [statement.replace(".", "/") + e for e in extensions]
    order = sorted((m, p) for m, p, *_ in rows)

    def ends(p):
        return any(p == n or p.endswith("/" + n if boundary else n) for n in names)

    for only in (module, None):
        for m, p in order:
            if (only is None or m == only) and ends(p):
                return p
    return None


@pytest.mark.parametrize("boundary", [True, False])
def test_same_as_brute_force_with_hot_keys(spark, boundary):
    rng = random.Random(7)
    names = ["util", "til", "index", "x", "ex"]
    rows = {}
    for _ in range(400):
        module = "/".join(rng.choice(["a", "b", "ab"]) for _ in range(rng.randint(1, 3)))
        path = f"{module}/{rng.choice(names)}{rng.choice(['.py', '.js', '.mjs', '.css', '.lock'])}"
        # One import makes up half of all.
        statements = ["util"] * 2 + [rng.choice(["a.util", "b.index", "x", "til", "ab.ex", "none", "b.a.x"]) for _ in range(2)]
        rows[path] = (module, path, "javascript", statements)
    rows = list(rows.values())
    files, imports = frames(spark, rows)
    for r in graph.resolve_imports(imports.distinct(), files, boundary).collect():
        assert r.resolved == brute_force(rows, r.import_statement, r.file_path, r.module_path, boundary), r


def test_explicit_order(spark):
    files = spark.createDataFrame(
        [("m2", "m2/a.py", 0, 1), ("m1", "m1/a.py", 1, 0), ("m2", "m2/x/../a.py", 0, 0)],
        "module_path string, file_path string, module_ord int, file_ord int")
    imports = spark.createDataFrame([("z/f.py", "z", "a")], "file_path string, module_path string, import_statement string")
    assert graph.resolve_imports(imports, files).first().resolved == "m2/x/../a.py"


def test_null_imports_are_left_out(spark):
    files, _ = frames(spark, FILES)
    imports = spark.createDataFrame([("f.py", "m", None)], "file_path string, module_path string, import_statement string")
    assert graph.resolve_imports(imports, files).count() == 0


def test_relative_imports_are_exact(spark):
    """Each decoy ends with the same names as the file that is meant."""
    files, imports = frames(spark, [
        ("a/b", "a/b/x.js", "javascript", ["../c/z", "./q", "./y.js", "./foo.service", "../../../a/c/z", "./."]),
        ("a/b", "a/b/y.js", "javascript", []),
        ("a/b", "a/b/foo.service.ts", "typescript", []),
        ("a/a/c", "a/a/c/z.js", "javascript", []),
        ("0/a/c", "0/a/c/z.js", "javascript", []),
        ("a/c", "a/c/z.js", "javascript", []),
        ("other", "other/q.js", "javascript", []),
        ("other/a/b", "other/a/b/q.js", "javascript", []),
    ])
    for boundary in (True, False):
        got = {r.import_statement: r.resolved for r in graph.resolve_imports(imports, files, boundary).collect()}
        assert got == {"../c/z": "a/c/z.js", "./q": None, "./y.js": "a/b/y.js", "./foo.service": "a/b/foo.service.ts",
                       "../../../a/c/z": None, "./.": None}


def test_every_import_of_the_code_corpus(spark):
    assert corpora.part_imports(spark, "/root/testdata/sf0.01").count() == 16991
    assert corpora.code_files(spark, "/root/testdata/sf0.01").count() == 2000
