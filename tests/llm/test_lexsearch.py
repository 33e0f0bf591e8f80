"""op13: the FP-tree search against a brute-force scorer and against its DuckDB SQL."""

import collections
import math
import re

import duckdb
import numpy as np
import pytest

from conftest import SF_DIR
from treeloom.llm import lexsearch
from treeloom.llm import queries as q
from treeloom.llm.oracles import ORACLES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    if text is None:
        return []
    return TERM.findall(text.translate(str.maketrans(lexsearch.UPPER, lexsearch.LOWER)))


def brute(docs, items, k=10):
    terms = [(i, d, split(t)) for i, (d, t) in enumerate(docs)]
    held = [x for x in terms if x[2]]
    big_n, big_l = len(held), sum(len(t) for _, _, t in held)
    df = collections.Counter(term for _, _, t in held for term in set(t))
    out = []
    for item_id, text in items:
        wanted = split(text)
        if not wanted or not big_n:
            continue
        found = []
        for row, doc, t in held:
            tf = collections.Counter(t)
            m = 25 + (75 * len(t) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                        for w in wanted if tf[w])
            if score > 0:
                found.append((-score, doc is None, doc if doc is not None else 0, row, doc))
        for rank, (neg, _, _, _, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, doc, -neg))
    return sorted(out, key=lambda r: (r[0], r[1]))


def run(spark, docs, items, k=10):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in lexsearch.search(d, i, k).collect()), key=lambda r: (r[0], r[1]))


def test_against_brute_force_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(60)] + ["Über", "ABC", "x9"]
    docs = [(int(i), " ".join(rng.choice(words, size=int(rng.integers(0, 40))))) for i in range(300)]
    docs += [(5, docs[5][1]), (None, docs[7][1]), (400, None), (401, ""), (402, "!!! ..."), (403, "W1 w1 W1; w2," * 50)]
    items = [(j, " ".join(rng.choice(words, size=int(rng.integers(1, 8))))) for j in range(25)]
    items += [(90, None), (91, ""), (92, "w1 w1 w1"), (92, "w1 w1 w1"), (93, "nothing-here zz")]
    old = lexsearch.DOCS_PER_SHARD
    lexsearch.DOCS_PER_SHARD = 37        # many shards, so shard results are merged
    try:
        assert run(spark, docs, items) == brute(docs, items)
    finally:
        lexsearch.DOCS_PER_SHARD = old


def test_equal_scores_go_by_doc_id(spark):
    docs = [(9, "alpha beta"), (3, "alpha beta"), (7, "alpha beta"), (None, "alpha beta"), (1, "gamma")]
    got = run(spark, docs, [(1, "alpha")], k=3)
    assert [r[2] for r in got] == [3, 7, 9]
    assert len({r[3] for r in got}) == 1


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    d = spark.createDataFrame([(1, "red fox", 5, "x", 7)], "doc_id bigint, text string, rank int, term string, row bigint")
    i = spark.createDataFrame([(4, "fox", 1, "s")], "item_id bigint, text string, item bigint, shard string")
    assert [tuple(r) for r in lexsearch.search(d, i).collect()] == [(4, 1, 1, brute([(1, "red fox")], [(4, "fox")])[0][3])]


def test_long_text_is_whole(spark):
    long = " ".join(["filler"] * 50_000 + ["needle"])
    docs = [(1, long), (2, "filler filler"), (3, "other words")]
    got = run(spark, docs, [(1, "needle")])
    assert got == brute(docs, [(1, "needle")]) and got[0][2] == 1


def test_query_equals_sql(spark):
    got = sorted(tuple(r) for r in q.op13_fp_tree_search(spark, SF_DIR).collect())
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    want = sorted(tuple(r) for r in con.execute(ORACLES["op13_fp_tree_search"]).fetchall())
    assert got == want and len(got) > 0
