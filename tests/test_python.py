"""Python extraction: fixtures, and a differential test against the `ast` module."""

import ast
import time

import pytest
from pyspark.sql import functions as F

from treeloom.functions import pycode
from treeloom.operators import definitions

SOURCES = {
    "fixture": 'def foo():\n    """This is a docstring."""\n    # This is a comment\n    pass\n',
    "calls": "def foo():\n    bar()\n    baz()\n",
    "one_line": "def foo(): pass\nclass A: pass\ndef one(): return two(three())\nfour()\n",
    "attribute": "def f(x):\n    foo.bar()\n    a.b.c(x)(1)\n    t[0](x)\n    'a'.join(x)\n    return (lambda: g())()\n",
    "module_code": "import os\n\ndef f():\n    g()\nh()\nif True:\n    def k():\n        m()\n    n()\n",
    "nested": (
        "class A(Base(), metaclass=M):\n    '''Doc of A.'''\n    x = make()\n\n    def first(self, a, b=(1, 2), *args, c=3, **kw):\n"
        "        \"\"\"First.\n\n            Indented.\n        Back.\n        \"\"\"\n        def inner(z: dict[str, int] = {}) -> int:\n"
        "            return z.get(a)\n        return inner(b)\n\n    class B:\n        def second(self): return third(self)\n\n"
        "    if flag:\n        def hidden(self):\n            return 1\n\n    def last(self, /, p, *, q): self.first(p)\n\ndef top(a):\n    return A().first(a)\n"
    ),
    "multi_line": (
        "def long(\n    a,\n    b=call_default(\n        1,\n    ),\n):\n    x = build(\na,\n    inner(b),\n)\n    y = {\n'k': other(x),\n}\n"
        "    return y\n\nz = long(\n  1, 2)\n\ndef after():\n    \\\n    pass\n    return a \\\n  + deep()\n"
    ),
    "strings": (
        "'''Module\n  doc'''\nS = \"\"\"\ndef fake():\n    not_called()\nclass Fake: pass\nimport nothing\n\"\"\"\n"
        "T = 'it\\'s (' + \"#\" # def comment(): call()\n\ndef real(a=')', b=\"(\"):\n    'Real.'\n    return use(a, '''x(\n)''')\n"
    ),
    "decorated": (
        "@dec\n@route('/a', opt=make())\ndef f(a, b):\n    return a if b else helper(a)\n\nclass C:\n    @property\n    def p(self):\n"
        "        return self._p()\n    @staticmethod\n    async def q(x):\n        await x.run()\n"
    ),
    "async": "async def main(a):\n    \"\"\"Main.\"\"\"\n    await go()\n    def sub(b):\n        return stop(b)\n    return sub\n",
    "tabs": "class T:\n\tdef a(self):\n\t\treturn b(self)\n\tdef c(self, d):\n\t\tfor e in d:\n\t\t\tif e:\n\t\t\t\tf(e)\n",
    "same_names": (
        "def foo():\n    'outer foo'\n\nclass K:\n    'K one'\n    def foo(self):\n        'inner foo'\n\ndef bar():\n    'bar one'\ndef bar():\n    'bar two'\n"
    ),
    "imports": (
        "import os, sys as system\nimport a.b.c\nfrom m import x\nfrom .pkg import y\nfrom . import z\nfrom ..up.two import (\n    p,\n    q,\n)\n"
        "def late():\n    import json\n    from late_mod import w\n"
    ),
    "comments": "# one\nx = 1  # not a whole line\n   # two  \n'''\n# in a string\n'''\nif x:\n# at the margin\n    y = f(x)\n",
    "try": "def t():\n    try:\n        a()\n    except (E, f()):\n        b()\n    finally:\n        c()\n    with d() as e, g():\n        pass\n    return not (e) and h (1)\n",
    "kwonly": "def k(*, a, b): pass\ndef l(a, *, b): pass\ndef m(a, /): pass\ndef n(a=lambda: 0, b=[1, (2, 3)], *c): pass\ndef o(): pass\n",
    "empty": "",
    "only_class": "class Only(Base):\n    x = 1\n",
}


def expected(source):
    tree = ast.parse(source)
    defs = [n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef)]
    classes = [n for n in ast.walk(tree) if isinstance(n, ast.ClassDef)]
    members = {id(f) for c in classes for f in c.body}

    def name(func):
        return func.id if isinstance(func, ast.Name) else func.attr if isinstance(func, ast.Attribute) else "unknown_function"

    return {
        "functions": sorted((f.name, tuple(a.arg for a in f.args.args)) for f in defs if id(f) not in members),
        "methods": sorted((c.name, f.name, tuple(a.arg for a in f.args.args))
                          for c in classes for f in c.body if isinstance(f, ast.FunctionDef)),
        "classes": sorted(c.name for c in classes),
        "edges": sorted({(f.name, name(n.func)) for f in defs for n in ast.walk(f) if isinstance(n, ast.Call)}),
        "docstrings": {
            getattr(n, "name", "module"): ast.get_docstring(n)
            for n in ast.walk(tree)
            if isinstance(n, (ast.FunctionDef, ast.ClassDef, ast.Module)) and ast.get_docstring(n)},
        "imports": [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
        + [n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom) if n.module],
        "comments": [l.strip() for l in source.splitlines() if l.strip().startswith("#")],
    }


@pytest.fixture(scope="module")
def found(spark):
    files = spark.createDataFrame(list(SOURCES.items()), "file_path string, content string")
    defs = definitions.definitions(files).collect()
    edges = definitions.call_edges(definitions.definitions(files)).collect()
    rows = pycode.with_docstrings(files).select(
        "file_path", "docstrings", pycode.imports(F.col("content")).alias("imports"),
        pycode.comments(F.col("content")).alias("comments")).collect()
    result = {}
    for r in rows:
        mine = [d for d in defs if d.file_path == r.file_path]
        plain = [d for d in mine if d.kind == "def" and not d.is_async]
        result[r.file_path] = {
            "functions": sorted((d.name, tuple(d.params)) for d in plain if d.class_pos is None),
            "methods": sorted((d.class_name, d.name, tuple(d.params)) for d in plain if d.class_pos is not None),
            "classes": sorted(d.name for d in mine if d.kind == "class"),
            "edges": sorted((e.caller, e.callee) for e in edges if e.file_path == r.file_path),
            "docstrings": {d.name: d.doc for d in r.docstrings},
            "imports": r.imports,
            "comments": r.comments,
        }
    return result


@pytest.mark.parametrize("name", list(SOURCES))
def test_same_as_ast(found, name):
    # The nested lambda of "attribute" and its call of a call are the same name to both sides.
    assert found[name] == expected(SOURCES[name])


def test_nested_form(spark):
    files = spark.createDataFrame([("a.py", SOURCES["nested"]), ("b.py", SOURCES["only_class"])], "file_path string, content string")
    rows = {r.file_path: r for r in definitions.nested(definitions.definitions(files)).collect()}
    assert [c.name for c in rows["a.py"].classes] == ["A", "B"]
    assert [m.name for m in rows["a.py"].classes[0].methods] == ["first", "last"]
    assert [f.name for f in rows["a.py"].functions] == ["inner", "hidden", "top"]
    assert rows["a.py"].functions[2].calls == ["A", "first"]
    assert rows["b.py"].classes[0].methods == []


def test_complexity_of_definitions(spark):
    source = "def f(a):\n    if a and b:\n        for x in a:\n            pass\n    def g():\n        while a: pass\n    return [i for i in a if i]\n\nif x: pass\n"
    rows = definitions.definitions(spark.createDataFrame([("a.py", source)], "file_path string, content string")).collect()
    assert {r.name: r.complexity for r in rows} == {"f": 7, "g": 2}


def test_file_complexity(one):
    assert one("def f(a):\n    return a or b  # if\n\nif x: pass\n", pycode.complexity(F.col("content"))) == 3


def test_async_docstrings_on_request(spark):
    df = spark.createDataFrame([(SOURCES["async"],)], "content string")
    docs = pycode.with_docstrings(df, include_async=True).first().docstrings
    assert [(d.name, d.doc) for d in docs] == [("main", "Main.")]


def test_long_strings_and_brackets_do_not_overflow(one):
    text = 'x = """' + "a\\n" * 200_000 + '"""\ny = (' + "1, " * 200_000 + ")\nimport os\n"
    assert one(text, pycode.imports(F.col("content"))) == ["os"]
    assert one("def f(" + ", ".join(f"a{i}" for i in range(5000)) + "): pass",
               F.size(pycode.params(F.col("content")))) == 5000


def test_broken_text_is_scanned_in_linear_time(spark):
    many = 20_000
    junk = ["def f(\n" * many, "class A(def f(" * many, "@a\n" * many, '"""\n' * (2 * many + 1), "'\n" * many,
            "x" * many * 10 + "(" * many, "import \n" * many + "from " * many, "# \n" * many + "def f():" + "\n" * many]
    files = spark.createDataFrame([(str(i), text) for i, text in enumerate(junk)], "file_path string, content string")
    start = time.monotonic()
    definitions.definitions(files).count()
    pycode.with_docstrings(files).select(F.sum(F.size("docstrings"))).collect()
    files.select(F.sum(F.size(pycode.imports(F.col("content")))), F.sum(pycode.complexity(F.col("content")))).collect()
    assert time.monotonic() - start < 60
