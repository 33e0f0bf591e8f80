import json

import pytest
from pyspark.sql import functions as F

from treeloom.operators import enrich, lint, stats, validate

BASE = {"file_path": "example.py", "language": "python", "content": "print('Hello, World!')", "analysis": {}, "metadata": {"size": 24}}


def check(spark, record):
    line = record if isinstance(record, str) else json.dumps(record)
    return validate.schema_check(spark.createDataFrame([(line,)], "value string")).first()


CASES = [
    ({}, [], None),
    ({"analysis": None, "metadata": None}, ["analysis", "metadata"], "metadata"),
    ({"file_path": ""}, [], "path"),
    ({"language": "invalid_language"}, [], "language"),
    ({"content": ""}, [], "content"),
    ({"content": None}, [], None),
    ({"content": 5}, ["content"], "schema"),
    ({"analysis": {"entities": []}}, [], None),
    ({"metadata": {"md5_hash": "abcdef"}}, ["metadata.size"], "metadata"),
    ({"metadata": {"size": -1}}, [], "metadata"),
    ({"metadata": {"size": 1.0, "loc": 2}}, [], None),
    ({"metadata": {"size": 1.5}}, ["metadata.size"], "schema"),
    ({"metadata": {"size": True}}, ["metadata.size"], "schema"),
    ({"analysis": {"classes": {}, "docstrings": [], "complexity": "1", "lint_results": None}},
     ["analysis.classes", "analysis.docstrings", "analysis.complexity"], "schema"),
    ({"analysis": {"lint_results": [], "complexity": 1.5, "extra": 1}}, [], None),
    ({"analysis": []}, ["analysis"], "schema"),
]


@pytest.mark.parametrize("change,violations,failure", CASES)
def test_record_lines(spark, change, violations, failure):
    row = check(spark, {**BASE, **change})
    assert (row.violations, row.first_failure) == (violations, failure)


def test_missing_keys_and_bad_lines(spark):
    bare = {k: v for k, v in BASE.items() if k not in ("analysis", "metadata")}
    assert check(spark, bare).violations == ["analysis", "metadata"]
    assert check(spark, {k: v for k, v in BASE.items() if k != "content"}).violations == ["content"]
    for line in ("{", "", "[1]", "null"):
        assert check(spark, line).violations == ["$"], line


def test_typed_records(spark):
    schema = "file_path string, language string, content string, metadata struct<size:bigint>, analysis struct<a:string>"
    rows = [("a.py", "python", None, (0,), ("x",)), ("", "python", "x", (1,), ("x",)), ("a.py", None, "x", (1,), ("x",)),
            ("a.py", "python", "", (1,), ("x",)), ("a.py", "python", "x", (-1,), ("x",)), ("a.py", "python", "x", None, ("x",)),
            ("a.py", "python", "x", (1,), None)]
    checked = validate.validated(spark.createDataFrame(rows, schema))
    assert [r.first_failure for r in checked.collect()] == [None, "path", "language", "content", "metadata", "metadata", "schema"]
    good, bad = validate.split(checked)
    assert (good.count(), bad.count()) == (1, 6)


def test_codebase_stats(spark):
    schema = "module_path string, language string, metadata struct<loc:bigint,size:bigint>"
    one = stats.codebase_stats(spark.createDataFrame([("module1", "python", (100, 1024))], schema))
    assert {tuple(r) for r in one.collect()} == {
        ("total", None, 1, 100, 1024), ("language", "python", 1, 100, 1024), ("module", "module1", 1, None, None)}
    rows = [("m", "python", (100, 1024)), ("m", None, (1, 1)), ("m", "image", (None, 7)), ("n", "python", (5, None)), ("n", None, None)]
    more = stats.codebase_stats(spark.createDataFrame(rows, schema))
    assert {tuple(r) for r in more.collect()} == {
        ("total", None, 5, 106, 1025), ("language", "python", 1, 100, 1024), ("language", None, 1, 1, 1),
        ("module", "m", 3, None, None), ("module", "n", 2, None, None)}
    none = stats.codebase_stats(spark.createDataFrame([], schema))
    assert [tuple(r) for r in none.collect()] == [("total", None, 0, 0, 0)]


def test_lint_stats(spark):
    reports = [
        ("a.py", "python", '[{"symbol": "s1"}, {"symbol": "s1"}, {"message": "x"}]'),
        ("a.css", "css", '[{"rule": "s1"}, {"source": "a.css", "warnings": [{"rule": "r2"}, {"rule": "r2"}]}]'),
        ("a.ts", "typescript", '[{"ruleName": "r3"}]'),
        ("a.js", "javascript", '[{"errorCount": 2, "warningCount": 0}, {"errorCount": 1}]'),
        ("b.html", "html", '[{"rule": "no"}]'), ("c.py", "python", None), ("d.py", "python", "not json"),
    ]
    events = lint.lint_events(spark.createDataFrame(reports, "file_path string, language string, report string"))
    assert {tuple(r) for r in lint.lint_stats(events).collect()} == {
        ("s1", 3), ("r2", 2), ("r3", 1), ("error", 3), ("warning", 0)}


def test_cache_join(spark):
    records = spark.createDataFrame([("a", "1", "new"), ("b", "2", "new"), ("c", "3", "new"), ("d", None, "new")],
                                    "file_path string, content string, analysis string")
    cache = spark.createDataFrame([("a", "1", None), ("b", "old", "kept")], "file_path string, text string, analysis string").select(
        "file_path", F.md5("text").alias("hash"), "analysis").unionByName(
        spark.createDataFrame([("d", None, "kept")], "file_path string, hash string, analysis string"))
    joined = enrich.with_cache(records, cache, ["analysis"])
    assert sorted((r.file_path, r.analysis, r.from_cache) for r in joined.collect()) == sorted([
        ("a", None, True), ("b", "new", False), ("c", "new", False), ("d", "new", False)], key=str)
    assert sorted(r.file_path for r in enrich.cache_delta(records, cache).collect()) == ["b", "c", "d"]


def test_skipped_files(spark):
    rows = spark.createDataFrame([("binary",), ("binary",), (None,)], "skip_reason string")
    assert [tuple(r) for r in stats.skipped_files(rows).collect()] == [("binary", 2)]
