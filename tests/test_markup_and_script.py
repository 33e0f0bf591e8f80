import time

from pyspark.sql import functions as F

from treeloom.functions import css, entities, markup, metrics, script, structured
from treeloom.functions.arrays import with_last_per_key


def C():
    return F.col("content")


def test_html_fixture(one):
    assert one("<html><body><h1>Test</h1></body></html>", markup.tags(markup.html_tokens(C()))) == ["html", "body", "h1"]


def test_html_hides_comments_and_raw_text(one):
    page = ('<!-- <b> --><P title="a>b"><script>var t="</p><i>";</script><STYLE>p>a{}</STYLE>'
            "<input disabled value='x' /><br></P><script src=x></script><!---->")
    assert one(page, markup.tags(markup.html_tokens(C()))) == ["p", "script", "style", "input", "br", "script"]
    assert one(page, markup.comments(markup.html_tokens(C()))) == [" <b> ", ""]
    assert one(page, markup.style_text(markup.html_tokens(C()))) == "p>a{}"


def test_attributes_last_element_and_last_name_win(spark):
    page = '<a href="1" class="x"></a><a HREF=2 data-k="&lt;&amp;" href="3"></a>'
    df = spark.createDataFrame([(page,)], "content string").select(markup.elements(markup.html_tokens(C())).alias("e"))
    row = with_last_per_key(df, "e", "tag").select(F.transform("e", lambda e: markup.attributes(e["raw"])).alias("a")).first()
    assert [[(x.name, x.value) for x in a] for a in row.a] == [[("data-k", "<&"), ("href", "3")]]


def test_xml_keeps_names_as_written(one):
    doc = '<?xml version="1.0"?><root><Element a="1">value</Element><![CDATA[<no>]]><!-- <no/> --></root>'
    assert one(doc, markup.tags(markup.xml_tokens(C()), lower=False)) == ["root", "Element"]


def test_css(one):
    sheet = ("@import url(x.css); body { color: red; Color: blue; background: url(data:a;b) }\n/* p { x: y } */\n"
             "@media print { h1, h2 { margin: 0 } }\n@keyframes k { from { a: b } to { a: c } }\n@font-face { src: x }\n"
             'a[href="{"] { content: "}"; }\nstray text')
    rules = [(r.selector, r.props) for r in one(sheet, css.rules(C()))]
    assert rules == [("body", ["color", "background"]), ("h1, h2", ["margin"]), ('a[href="{"]', ["content"])]


def test_javascript(one):
    code = ("import a from './a';\nimport {b,\n c} from \"b\"; import 'side';\n// import x from 'no';\n"
            "/* function no() {} */\nvar s = \"function no2() {}; import y from 'z'\", r = `// no`;\n"
            "function foo(a, b = f(1, 2), ...rest) { console.log('// no'); }\nexport default async function* bar() {}\n"
            "const baz = function named() {}; const q = () => 1;\nif (a && b) { function inner({d}, e) {} }\n")
    assert [(f.name, f.params) for f in one(code, script.functions(C()))] == [
        ("foo", ["a", "b"]), ("bar", []), ("inner", ["e"])]
    assert one(code, script.imports(C())) == ["./a", "b", "side"]
    assert one(code, script.comments(C())) == ["import x from 'no';", "function no() {}"]
    assert one("function f(a) { return a ? b : c || d?.e; }", script.complexity(C())) == 3


def test_import_forms(one):
    code = ("import{a}from'min';import { from } from \"rxjs\";\nimport * as n from 'ns'; import type {T} from './t'\n"
            "const p = import('dyn'); imports from 'no'; import d, {e as f} from 'both';")
    assert one(code, script.imports(C())) == ["min", "rxjs", "ns", "./t", "both"]


def test_broken_text_is_scanned_in_linear_time(one):
    start = time.monotonic()
    many = 20_000
    one("import a b c function " * many + "/* x " * many + "\n" * many, F.size(script.imports(C())))
    one("import a b c function " * many + "/* x " * many + "\n" * many, F.size(script.functions(C())))
    one("<a<a<a " * many + "<!--" * many, F.size(markup.html_tokens(C())))
    one("x y z " * many + "/* a " * many, F.size(css.rules(C())))
    one("a" * 10 * many + "@" * many, F.size(entities.entities(C())))
    one("[" * many + "# " * many + "```\n", F.size(structured.links(C())))
    assert time.monotonic() - start < 60


def test_typescript_fixture(one):
    assert one("let x = 10;", script.functions(C())) == []
    assert [(f.name, f.params) for f in one("function f<T>(a: Map<string, T>, b?: number): T {}", script.functions(C()))][0][0] == "f"


def test_json_and_yaml(spark, one):
    assert one('{"key": "value"}', F.to_json(structured.json_value(C()))) == '{"key":"value"}'
    assert one('{"key": value}', structured.json_value(C())) is None
    text = "key: value\nn: 12\nf: 1.5\nb: yes\nt: True\nnothing:\nq: 'a: b'\nm:\n  - x\n# c: d\nkey: last\n"
    df = structured.with_yaml_value(spark.createDataFrame([(text,)], "content string"))
    assert df.select(F.to_json("yaml")).first()[0] == '{"b":"yes","f":1.5,"key":"last","n":12,"q":"a: b","t":true}'


def test_markdown(one):
    text = "# Heading\n\n## Two ##\n```\n# code\n```\n#no\n[a](b.md) ![i](i.png) [c](<d> 't')\n"
    assert [(h.level, h.text) for h in one(text, structured.headings(C()))] == [(1, "Heading"), (2, "Two")]
    assert [(l.text, l.target) for l in one(text, structured.links(C()))] == [("a", "b.md"), ("c", "<d>")]


def test_entities(one):
    text = "Ask Ada Lovelace at ada.l@example.com or http://x.org/a?b on 2024-01-31 from 10.0.0.1 for $1,200.50."
    assert [(e.text, e.label) for e in one(text, entities.entities(C()))] == [
        ("Ask Ada Lovelace", "PROPER"), ("ada.l@example.com", "EMAIL"), ("http://x.org/a?b", "URL"),
        ("2024-01-31", "DATE"), ("10.0.0.1", "IP"), ("$1,200.50", "MONEY")]
    assert [e.label for e in one("ab 12", entities.entities(C(), [("NUM", r"\d+")]))] == ["NUM"]


def test_gazetteer(spark):
    texts = spark.createDataFrame([("a", "The New York office, in new york; York."), ("b", "none")], "file_path string, content string")
    terms = spark.createDataFrame([("new york", "PLACE"), ("office", "ORG")], "term string, label string")
    rows = entities.gazetteer_entities(texts, terms).collect()
    assert sorted((r.file_path, r.pos, r.text, r.label) for r in rows) == [
        ("a", 1, "New York", "PLACE"), ("a", 3, "office", "ORG"), ("a", 5, "new york", "PLACE")]


def test_metrics(one):
    functions = F.lit(None).cast("array<string>")
    assert one("", metrics.function_count(F.lit("Python"), F.array(F.lit("f"), F.lit("g")))) == 2
    assert one("", metrics.function_count(F.lit("html"), F.array(F.lit("f")))) == 0
    assert one("", metrics.function_count(F.lit("javascript"), functions)) == 0
    assert one("", metrics.comment_density(F.array(F.lit("a")), F.lit(4))) == 0.25
    assert one("", metrics.comment_density(F.array(F.lit("a")), F.lit(0))) == 0.0
    assert one("", metrics.comment_density(F.lit(None).cast("array<string>"), F.lit(4))) == 0.0


def test_yaml_files_of_one_file_are_parsed_by_several_tasks(spark, tmp_path):
    """A table of one file and one row group would be read and parsed by one task."""
    from treeloom.plans.queries import QUERIES
    from treeloom.sources import corpora
    spark.range(300_000).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("part "), F.sha1(F.col("id").cast("string"))).alias("p_name"),
        F.lit("b").alias("p_brand"), F.lit(1).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert corpora.yaml_files(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 2
    rows = QUERIES["yaml_data"](spark, str(tmp_path)).where("file_path in ('6.yaml', '7.yaml')").orderBy("file_path").collect()
    assert [(r.key, r.name[:5], r.ready) for r in rows] == [(7, "part ", True), (8, "part ", None)]
