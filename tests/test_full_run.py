import json

import pytest
from pyspark.sql import functions as F

from treeloom import schema
from treeloom.operators import records, validate
from treeloom.plans import full_run, registry
from treeloom.sources import files, snapshots, tables
from treeloom.streaming import ingest

PNG = bytes.fromhex("89504E470D0A1A0A") + b"\x00" * 16

TREE = {
    "main.py": b'"""Main."""\nimport pkg.util\nfrom os import path\n\n\ndef run(a):\n    # go\n    return util.go(a)\n',
    "pkg/util.js": b"// util\nimport x from './deep/part';\nfunction go(a) { return a; }\r\n",
    "pkg/deep/part.ts": b"function part(b) { if (b) { return 1; } }\n",
    "pkg/page.html": b"<html><body class='c'><!-- n --><h1>Test</h1></body></html>",
    "pkg/style.css": b"body { color: red; }",
    "pkg/data.json": b'{"key": "value"}',
    "pkg/bad.json": b'{"key": value}',
    "pkg/readme.md": b"# Heading\n",
    "pkg/conf.yaml": b"key: value\n",
    "pkg/doc.xml": b"<root><element>value</element></root>",
    "pkg/logo.png": PNG,
    "pkg/manual.pdf": b"%PDF-1.4 \x00",
    "pkg/blob.bin": b"\x00\x01",
    "pkg/latin.py": b"x = '\xe9'\n",
    "pkg/notes": b"Plain notes by Ada Lovelace.\n",
    "pkg/empty.txt": b"",
    "pkg/__init__.py": b"",
    "pkg/.gitignore": b"*.pyc\n",
    "pkg/_private/.hidden/x.py": b"import pkg.util\n",
    "pkg/with space & more.txt": b"This is a plain text file.",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tree")
    for name, data in TREE.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(folder)


def test_listing_and_skips(spark, root):
    assert sorted(r.file_path for r in files.listing(spark, root).collect()) == sorted(TREE)
    rows = {r.file_path: r for r in files.read_records(spark, root).collect()}
    assert set(rows) == set(TREE)
    assert {p: r.skip_reason for p, r in rows.items() if r.skip_reason} == {
        "pkg/bad.json": "unparsable", "pkg/blob.bin": "binary", "pkg/latin.py": "undecodable"}
    assert (rows["main.py"].module_path, rows["pkg/deep/part.ts"].module_path) == (".", "pkg/deep")
    assert rows["pkg/util.js"].content.endswith("}\n") and "\r" not in rows["pkg/util.js"].content
    image = rows["pkg/logo.png"]
    assert (image.language, image.content, image.metadata.loc, image.metadata.size, image.file_type) == (
        "image", None, None, len(PNG), "image/png")
    assert rows["pkg/notes"].language == "unknown" and rows["pkg/notes"].metadata.loc == 2
    assert rows["pkg/empty.txt"].metadata.loc == 1
    assert rows["pkg/manual.pdf"].content is None


def test_large_files_are_listed_not_read(spark, root):
    rows = {r.file_path: r for r in files.read_records(spark, root, max_bytes=60).collect()}
    assert set(rows) == set(TREE)
    assert rows["main.py"].skip_reason == "too_large" and rows["main.py"].content is None


def test_image_scan(spark, root):
    images = files.image_records(spark, root)
    assert [(r.file_path, r.language, r.metadata.size) for r in images.collect()] == [("pkg/logo.png", "image", len(PNG))]


def test_files_that_go_and_links_that_loop(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.py").write_text("x = 1\n")
    (tmp_path / "gone.py").write_text("x = 2\n")
    (tmp_path / "sub/loop").symlink_to(tmp_path)
    (tmp_path / "link.py").symlink_to(tmp_path / "sub/a.py")
    found = files.listing(spark, str(tmp_path))
    assert sorted(r.file_path for r in found.collect()) == ["gone.py", "link.py", "sub/a.py"]
    (tmp_path / "gone.py").unlink()
    assert {(r.file_path, bytes(r.data)) for r in files.read_bytes(spark, str(tmp_path), found).collect()} == {
        ("link.py", b"x = 1\n"), ("sub/a.py", b"x = 1\n")}


@pytest.fixture(scope="module")
def result(spark, root, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    links = out / "links.csv"
    links.write_text("File,Documentation\nmain.py,old\npkg/util.js,u\nmain.py,new\n")
    reports = spark.createDataFrame(
        [("main.py", '[{"symbol": "unused"}]'), ("pkg/util.js", '[{"errorCount": 1, "warningCount": 2}]')],
        "file_path string, report string")
    def once():
        return full_run.run(spark, root, str(out / "run"), doc_links_csv=str(links), cache_path=str(out / "cache"), lint_reports=reports)
    return once(), once, out


def test_run(spark, result):
    tables_, _, out = result
    rows = {r.file_path: r for r in tables_["records"].collect()}
    assert set(rows) == set(TREE) - {"pkg/bad.json", "pkg/blob.bin", "pkg/latin.py"}
    main = rows["main.py"].analysis
    assert [(f.name, f.params, f.calls) for f in main.functions] == [("run", ["a"], ["go"])]
    assert (main.classes, main.imports, main.docstrings, main.comments) == ([], ["pkg.util", "os"], {"module": "Main."}, ["# go"])
    assert (main.complexity, main.function_count, round(main.comment_density, 4)) == (1, 1, round(1 / 9, 4))
    assert rows["main.py"].documentation == "new" and rows["pkg/style.css"].documentation is None
    assert rows["pkg/page.html"].analysis.tags == ["html", "body", "h1"]
    assert rows["pkg/page.html"].analysis.attributes["body"] == {"class": "c"}
    assert rows["pkg/style.css"].analysis.rules == ["body"] and rows["pkg/style.css"].analysis.properties == {"body": ["color"]}
    assert [h.text for h in rows["pkg/readme.md"].analysis.headings] == ["Heading"]
    assert rows["pkg/doc.xml"].analysis.tags == ["root", "element"]
    assert [e.text for e in rows["pkg/notes"].analysis.entities] == ["Ada Lovelace"]
    assert json.loads(rows["pkg/data.json"].data.toJson()) == {"key": "value"}
    assert json.loads(rows["pkg/conf.yaml"].data.toJson()) == {"key": "value"}
    assert rows["pkg/logo.png"].analysis.entities == []


def test_tables(result):
    tables_, *_ = result
    def got(name):
        return {tuple(r) for r in tables_[name].collect()}
    assert got("dependency_edges") == {
        ("main.py", "pkg/util.js"), ("pkg/util.js", "pkg/deep/part.ts"), ("pkg/_private/.hidden/x.py", "pkg/util.js")}
    assert tables_["dependency_nodes"].count() == len(TREE) - 3
    assert got("call_graph") == {("run", "go")}
    assert got("lint_stats") == {("unused", 1), ("error", 1), ("warning", 2)}
    assert {r.import_statement for r in tables_["unresolved_imports"].collect()} == {"os"}
    assert {r.skip_reason for r in tables_["skipped"].collect()} == {"binary", "undecodable", "unparsable"}
    totals = [r for r in tables_["codebase_stats"].collect() if r.scope == "total"]
    assert totals[0].files == len(TREE)


def test_jsonl_output_is_valid(spark, result):
    tables_, _, out = result
    path = snapshots.table_path(spark, str(out / "run"), "jsonl")
    assert tables.jsonl_is_valid(spark, path)
    checked = validate.schema_check(spark.read.text(path))
    assert checked.count() == tables_["records"].count()
    assert checked.where(F.size("violations") > 0).select("value", "violations").collect() == []
    back = tables.read_jsonl(spark, path, "file_path string, language string, module_path string")
    assert back.where("file_path = 'pkg/deep/part.ts'").first().module_path == "pkg/deep"


def test_second_run_takes_analyses_from_the_cache(spark, result):
    first, once, out = result
    before = {r.file_path: r.analysis for r in first["records"].collect()}
    cache = tables.read_cache(spark, str(out / "cache"))
    changed = cache.withColumn("analysis", F.col("analysis").withField("comments", F.array(F.lit("cached"))))
    tables.write_cache(changed, str(out / "cache"))
    again = {r.file_path: r.analysis for r in once()["records"].collect()}
    assert set(again) == set(before)
    assert again["main.py"].comments == ["cached"] and again["main.py"].functions == before["main.py"].functions
    # Null content is never taken from the cache.
    assert again["pkg/logo.png"].comments is None


def test_registered_extractor(spark):
    rows = spark.createDataFrame([("a.zz", "zz", "text", "body")], "file_path string, handler string, language string, content string")
    rows = rows.withColumns({
        "metadata": F.lit(None).cast(schema.METADATA), "analysis": F.lit(None).cast(schema.ANALYSIS),
        "data": F.lit(None).cast("variant"), "from_cache": F.lit(False)})
    def extract(records):
        return records.select("*", F.lit(None).cast(schema.ANALYSIS).alias("analysis"), F.parse_json(F.lit("1")).alias("data"))
    registry.register_extractor("zz", extract)
    try:
        got = full_run.analysed(rows).collect()
    finally:
        registry.unregister_extractor("zz")
    assert [(r.file_path, r.analysis, r.data.toJson()) for r in got] == [("a.zz", None, "1")]


def test_jsonl_verification(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"key": "value"}\n[1]\n')
    (tmp_path / "bad.jsonl").write_text('{"key": value}\n\n{"a": 1}\n')
    (tmp_path / "empty.jsonl").write_text("")
    rows = {r.file.rsplit("/", 1)[1]: (r.lines, r.bad_lines, r.valid) for r in tables.verify_jsonl(spark, str(tmp_path)).collect()}
    assert rows == {"good.jsonl": (2, 0, True), "bad.jsonl": (3, 2, False)}
    assert tables.jsonl_is_valid(spark, str(tmp_path / "good.jsonl"))
    assert not tables.jsonl_is_valid(spark, str(tmp_path / "bad.jsonl"))
    assert tables.jsonl_is_valid(spark, str(tmp_path / "empty.jsonl"))
    assert tables.jsonl_is_valid(spark, str(tmp_path / "none.jsonl"))


def test_cache_files(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert tables.read_cache(spark, path).count() == 0
    entry = "file_path string, content string, o int"
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", None, 1)], entry).withColumn(
        "analysis", F.lit(None).cast(schema.ANALYSIS))
    tables.write_cache(tables.cache_entries(rows, F.col("o")), path)
    got = {r.file_path: r.hash for r in tables.read_cache(spark, path).collect()}
    assert got == {"a": "c81e728d9d4c2f636f067f89cc14862c", "b": None}
    tables.write_cache(tables.read_cache(spark, path).where("file_path = 'a'"), path)
    assert [r.file_path for r in tables.read_cache(spark, path).collect()] == ["a"]
    (tmp_path / "old.json").write_text('{"file1.py": {"hash": "abc123"}}')
    assert [(r.file_path, r.hash) for r in tables.import_cache(spark, str(tmp_path / "old.json")).collect()] == [("file1.py", "abc123")]


def test_doc_links(spark, tmp_path):
    assert tables.read_doc_links(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "l.csv").write_text("File,Documentation\n" + "".join(f"f{i % 50},d{i}\n" for i in range(500)))
    got = {r.File: r.Documentation for r in tables.read_doc_links(spark, str(tmp_path / "l.csv")).collect()}
    assert got == {f"f{i}": f"d{450 + i}" for i in range(50)}


def test_stream(spark, root, tmp_path):
    out, checkpoint = str(tmp_path / "records"), str(tmp_path / "checkpoint")
    for _ in range(2):
        ingest.append_records(ingest.stream_records(spark, root), out, checkpoint).awaitTermination(120)
    rows = spark.read.parquet(out)
    batch = files.read_records(spark, root)
    assert rows.count() == len([p for p, data in TREE.items() if data and not any(s[0] in "._" for s in p.split("/"))])
    assert rows.select(batch.columns).exceptAll(batch).count() == 0


def test_merge_keeps_the_later_record_of_a_path(spark):
    parts = [spark.createDataFrame(rows, "file_path string, language string") for rows in (
        [("a", "x"), ("b", "x")], [("b", "y"), ("c", "y")], [("a", None)])]
    assert sorted(map(tuple, records.merge(parts).collect()), key=str) == [("a", None), ("b", "y"), ("c", "y")]


def test_doc_links_with_quotes_and_line_ends(spark, tmp_path):
    (tmp_path / "l.csv").write_text('File,Documentation\na.py,"say ""hi"" now"\nb.py,"two\nlines"\na2.py,x\na2.py,y\n')
    rows = tables.read_doc_links(spark, str(tmp_path / "l.csv")).collect()
    assert {tuple(r) for r in rows} == {("a.py", 'say "hi" now'), ("b.py", "two\nlines"), ("a2.py", "y")}


def test_type_and_language_after_many_blanks(spark):
    from treeloom.functions import text
    rows = spark.createDataFrame([(" " * 300 + "\n<html><p>",), (" " * 300 + "<?xml version='1.0'?>",), ("a\n<html>",)], "c string")
    got = rows.select(text.text_type(F.col("c"), F.lit("")), text.content_language(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("text/html", "html"), ("application/xml", "xml"), ("text/plain", None)]


def test_a_second_run_replaces_the_json_lines(spark, result, tmp_path):
    written = next(x for x in result if isinstance(x, dict))["records"]
    for _ in range(2):
        full_run.write_records(written, str(tmp_path / "jsonl"))
    assert spark.read.text(str(tmp_path / "jsonl")).count() == written.count()


def test_runs_are_generations(spark, result):
    _, once, out = result
    folder = str(out / "run")
    first = once()
    second = once()
    # the frames of the run before still read their own generation
    assert first["records"].count() == second["records"].count()
    third = once()
    assert second["records"].count() == third["records"].count()
    published = snapshots.manifests(spark, folder)
    assert len(published) == snapshots.RETAIN
    assert snapshots.latest(spark, folder)["tables"]["records"]["path"].startswith(folder + "/gen=")
    assert set(snapshots.read_latest(spark, folder)) >= {"records", "skipped", "codebase_stats"}
    gens = sorted(p.name for p in (out / "run").iterdir() if p.name.startswith("gen="))
    assert len(gens) == snapshots.RETAIN and not any((out / "run" / g / "_staged").exists() for g in gens)


def exchanged(df):
    """Names of the columns that the exchanges of a frame's physical plan carry."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.inputPlan()
    names, stack = set(), [plan]
    while stack:
        node = stack.pop()
        if "Exchange" in node.nodeName():
            out = node.output()
            names |= {out.apply(i).name() for i in range(out.size())}
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return names


def test_enrichment_moves_no_content(spark, root, tmp_path, monkeypatch):
    links = tmp_path / "links.csv"
    links.write_text("File,Documentation\nmain.py,doc\n")
    reports = spark.createDataFrame([("main.py", '[{"symbol": "unused"}]')], "file_path string, report string")
    staged = []
    original = snapshots.Generation.stage

    def stage(self, df, name, partition_by=None):
        staged.append((name, exchanged(df)))
        return original(self, df, name, partition_by)

    monkeypatch.setattr(snapshots.Generation, "stage", stage)
    full_run.run(spark, root, str(tmp_path / "out"), doc_links_csv=str(links), cache_path=str(tmp_path / "cache"), lint_reports=reports)
    again = full_run.run(spark, root, str(tmp_path / "out"), doc_links_csv=str(links), cache_path=str(tmp_path / "cache"), lint_reports=reports)
    first = dict(staged)["staged"]
    assert first and not first & {"content", "data"}
    rows = {r.file_path: r for r in again["records"].collect()}
    assert rows["main.py"].documentation == "doc" and rows["main.py"].analysis.functions[0].name == "run"


@pytest.mark.parametrize("range_bytes", [7, 50, 1 << 20])
def test_quoted_csv_by_byte_ranges(spark, tmp_path, range_bytes):
    import csv
    import io
    import random
    rng = random.Random(3)
    rows = [(f"f{rng.randint(0, 30)}.py", rng.choice(["plain", 'say "hi" now', "two\nlines", "a,b", "", "x\r\ny", '""']) + str(i))
            for i in range(300)]
    buf = io.StringIO(newline="")
    writer = csv.writer(buf, lineterminator="\n")
    writer.writerow(["File", "Documentation"])
    writer.writerows(rows)
    path = tmp_path / "links.csv"
    path.write_text(buf.getvalue(), newline="")
    got = sorted((r.offset, r.File, r.Documentation) for r in tables.read_csv_links(spark, str(path), range_bytes).collect())
    assert [(f, d) for _, f, d in got] == rows
    assert len({o for o, _, _ in got}) == len(rows)
