"""The operators against brute force, on small fixtures with the defined cases, and on the smallest tables."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from treeloom.llm import ctw, decontaminate, html, licences, lines, links, packing, paragraphs, quality, rules, setjoin
from treeloom.llm import queries as q
from treeloom.llm import textarrays as ta
from treeloom.llm.oracles import ORACLES

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen".split()


def tokenizer():
    from public_tokenizers import path
    return path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def cases(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns with names that operators use."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    base = " ".join(PROSE * 3)
    rows = [(1, base), (2, base), (3, base.replace("nine", "other")), (4, None), (5, ""), (6, "  \n\t "), (7, "a b"), (8, "A  B"),
            (None, base), (9, long), (10, long + " more"), (11, "x"), (11, "y z"), (12, base), (12, base), (13, "é" * 50)]
    return spark.createDataFrame([(i, t, None if i == 7 else "en", f"s{i}", 1, "n", 5) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def words(text):
    return (text or "").encode().translate(LOWER).split()


def components(n, pairs):
    union = links.Union(n)
    for a, b in pairs:
        union.join(a, b)
    return [union.root(i) for i in range(n)]


def brute_join(rows):
    sets = [frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for w in (words(t) for _, t in rows)]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots = components(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    return sorted((i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, roots, strict=True))


def test_words_and_hashes():
    texts = pa.array(["a bb  a\tbb", None, "", "bb\x0ba é", "x" * 3_000_000 + " a"])
    data, off = ta.buffers(texts)
    w = ta.words(data, off)
    assert np.diff(w.first).tolist() == [4, 0, 0, 3, 2]
    assert w.hash[0] == w.hash[2] == w.hash[5] == w.hash[8] and w.hash[1] == w.hash[3] == w.hash[4] and len(set(w.hash.tolist())) == 4


def test_join_is_exact(spark, docs, cases):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, setjoin.join(docs).collect())) == brute_join(rows)
    got = [tuple(r) for r in setjoin.join(cases).collect()]
    assert len(got) == 16 and (4, 0, 4) in got and (5, 0, 5) in got and (7, 1, 7) in got and (8, 1, 7) in got
    assert (2, 17, 1) in got
    assert [c for i, _, c in got if i is None] == [None] and (10, 29_997, 9) in got
    kept = setjoin.keep_one(cases)
    assert kept.columns == cases.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 1, 3, 4, 5, 6, 7, 9, 11, 13}
    assert setjoin.join(docs.limit(0)).count() == 0


def test_tree_join_connects_what_passes():
    random = np.random.RandomState(0)
    centres = random.poisson(0.6, (6, setjoin.GROUPS))
    points = np.array([c + random.binomial(1, 0.02, setjoin.GROUPS) for c in centres for _ in range(60)]).astype(np.int32)
    sizes = points.sum(1)
    passing = [(i, j) for i in range(len(points)) for j in range(i)
               if setjoin.enough(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j])]
    assert components(len(points), setjoin.tree_join(points, sizes)) == components(len(points), passing)


def test_components_and_blocks(spark, monkeypatch):
    random = np.random.RandomState(3)
    pairs = [(int(a), int(b)) for a, b in random.randint(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    frame = spark.createDataFrame(pairs, "u bigint, v bigint")
    roots = components(1100, pairs)
    expected = {n: roots[n] for p in pairs for n in p if any(a != b for a, b in pairs if n in (a, b))}
    assert {r["node"]: r["component"] for r in links.components(frame, "t").collect()} == expected
    monkeypatch.setattr(links, "FINISH", 0)
    assert {r["node"]: r["component"] for r in links.components(frame, "t").collect()} == expected
    monkeypatch.setattr(links, "BLOCK", 2)
    members = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9)], "coarse bigint, id bigint")
    dealt = collections.defaultdict(set)
    for r in links.parts(members).collect():
        dealt[r["part"]].add(r["id"])
    assert all(any({i, j} <= s for s in dealt.values()) for i in range(5) for j in range(5))


def test_lines_against_brute_force(docs):
    own = collections.defaultdict(list)
    for i, t in docs.select("doc_id", "text").collect():
        for n, x in enumerate((t or "").split("\n")):
            if x := b" ".join(words(x)).decode():
                own[x].append((i, n))
    texts = list(own)
    sets = [frozenset(x[k:k + 8] for k in range(max(1, len(x) - 7))) for x in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if min(len(sets[i]), len(sets[j])) * 5 >= 4 * max(len(sets[i]), len(sets[j]))
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    groups = collections.defaultdict(list)
    for x, r in zip(texts, components(len(texts), pairs), strict=True):
        groups[r] += own[x]
    expected = {p: min(g) for g in groups.values() if len(g) > 1 for p in g}
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in lines.groups(docs).collect()}
    assert got == expected


def test_lines_of_large_coarse_groups(spark, docs, monkeypatch):
    found = lambda: sorted(map(tuple, lines.groups(docs).collect()), key=repr)
    whole, handed, verified = found(), [], links.verified
    monkeypatch.setattr(links, "verified", lambda members, sets: handed.append(members.count()) or verified(members, sets))
    monkeypatch.setattr(links, "BLOCK", 2)
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    assert found() == whole
    # A chain of buckets of two lines each: one coarse group, whose lines must not meet in pairs of blocks.
    chain = spark.createDataFrame([(1, i) for i in range(60)], "coarse bigint, id bigint")
    buckets = spark.createDataFrame([(i + k, 1000 + i) for i in range(59) for k in (0, 1)], "id bigint, bucket bigint")
    dealt = collections.defaultdict(set)
    for r in links.parts(chain, buckets).collect():
        dealt[r["part"]].add(r["id"])
    assert sorted(map(sorted, dealt.values())) == [[i, i + 1] for i in range(59)]
    assert len(handed) == 1 and handed[0] > 0


def test_places_of_lines(spark):
    rows = [(7, "One\n\n two  Words \nx"), (-9, None), (8, "a\nb")]
    texts = spark.createDataFrame(rows, "row bigint, text string")
    places = spark.createDataFrame([(7, 2), (7, 0), (8, 1), (-9, 0), (-9, 3)], "row bigint, line_no int")
    found = {tuple(r) for r in texts.mapInArrow(lines._placed(lines._bitmap(places, 5)), "row bigint, line_no int, line string").collect()}
    own = {(7, 0, "one"), (7, 2, "two words"), (7, 3, "x"), (8, 0, "a"), (8, 1, "b")}
    assert {(7, 0, "one"), (7, 2, "two words"), (8, 1, "b")} <= found <= own
    # Other lines are left out before anything is exchanged.
    many = spark.createDataFrame([(i * 2654435761, "a\nb\nc\nd") for i in range(500)], "row bigint, text string")
    asked = spark.createDataFrame([(5 * 2654435761, 1)], "row bigint, line_no int")
    assert many.mapInArrow(lines._placed(lines._bitmap(asked, 1)), "row bigint, line_no int, line string").count() < 200


def test_lines_cases(spark, cases):
    left = lines.dedupe(cases)
    assert left.columns == cases.columns
    rows = collections.Counter(r["doc_id"] for r in left.collect())
    assert rows[None] == 1 and not rows[1] and not rows[2] and rows[4] == rows[5] == rows[6] == 1 and rows[7] == 1 and not rows[8]
    assert lines.dedupe(cases.limit(0)).count() == 0
    two = spark.createDataFrame([(1, "first line here\nshared line of words\nend"), (2, "SHARED  line of words\nother text")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in lines.dedupe(two).collect()} == {1: "first line here\nshared line of words\nend", 2: "other text"}


def test_paragraphs_find_long_passages(spark, docs, cases):
    rows = [(i, words(t)) for i, t in docs.select("doc_id", "text").collect()]
    long, short = (collections.defaultdict(set) for _ in range(2))
    for i, w in rows:
        for size, found in ((51, long), (16, short)):
            for k in range(len(w) - size + 1):
                found[tuple(w[k:k + size])].add(i)
    need, may = ({i for s in found.values() if len(s) > 1 for i in s} for found in (long, short))
    got = {r["doc_id"] for r in paragraphs.repeated(docs).select("doc_id").distinct().collect()}
    assert need <= got <= may
    assert {r["doc_id"] for r in paragraphs.repeated(cases).collect()} >= {1, 2, 9, 10, 12}
    assert paragraphs.repeated(cases.limit(0)).count() == 0


def test_rules(spark, cases):
    text = "a b c d e f g h a b c d e f g h x # \nline\nline\n \nx|y é"
    got = spark.createDataFrame([(text,)], "text string").select(rules.statistics("text").alias("s")).first()["s"]
    w = text.encode().split()
    hit = {k + j for k in range(len(w) - 7) for j in range(8) if sum(w[k:k + 8] == w[m:m + 8] for m in range(len(w) - 7)) > 1}
    assert got.asDict() == {"n_words": len(w), "word_chars": sum(len(x.decode()) for x in w), "n_symbols": 2, "n_dup_lines": 1,
                            "n_repeat_words": len(hit), "n_lines": 4}
    exact = sum(math.comb(60, i) * 0.05 ** i * 0.95 ** (60 - i) for i in range(4))
    assert abs(rules.chance(60, 3, 0.05) - exact) < 1e-12
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0), (3, 1)], "doc_id bigint, quality int")
    assert rules.judge(cases, labels).where("kept and base_failed").count() == 0
    kept = rules.keep(cases, labels)
    assert kept.columns == cases.columns and {r["doc_id"] for r in kept.collect()} <= {None, 1, 2, 3, 9, 10, 12}
    assert rules.judge(cases.limit(0), labels.limit(0)).count() == 0


def test_rule_limits_false_rejection(spark):
    rows = [(i, "en", " ".join(f"{w}{k}x{i}" for k in range(2) for w in PROSE) + " #" * (20 if i % 10 == 0 else i % 3 == 0), int(i % 10 != 0)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, quality int")
    got = rules.judge(frame, frame.select("doc_id", "quality")).join(frame.select("doc_id", "quality"), "doc_id")
    assert got.where("quality = 0 and kept").count() == 0 and got.where("quality = 1 and not kept").count() <= 0.05 * 1800


def test_html():
    page = ("<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><a>m</a></nav><div class='site-header'>h</div>"
            "<article><h1>A &amp; B</h1><p>one\n two<b>!</b></p><aside>s</aside><div class=\"ad\"><div>x</div></div><p>c<br>d</p></article>"
            "<div id=comments><p>r</p></div><footer>f</footer>")
    assert html.main_text(page) == "A & B\none two!\nc d"
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x") == "" and html.main_text("plain") == "plain"


def test_html_parts_without_closing_tags():
    for page, expected in [
            ("<article><p>a<p class=\"ad\">x<p>b</p><p>c</p></article>", "a\nb\nc"),
            ("<article><ul><li>a<li class=share>x<ul><li>y</ul><li>b</ul><p>c</article>", "a\nb\nc"),
            ("<html><head><title>t</title><meta charset=x><body><article><p>a</article>", "a"),
            ("<head><title>t</title><p>a<p>b", "a\nb"), ("<head><link rel=x>a", "a"),
            ("<article><div><div class=ad>x</article>y<article><p>b</article>", "b"),
            ("<article><section><div class=ad>x<p>y</section><p>b</article>", "b"),
            ("<article><table><tr><td class=ad>x<td>a<tr class=promo><td>y<tr><td>b</table><p>c</article>", "a\nb\nc"),
            ("<article><dl><dt>a<dd class=ad>x<dt>b</dl><p>c</article>", "a\nb\nc"),
            ("<article><p>a <select><option>x<option>y</select> b<p>c</article>", "a b\nc"),
            ("<article><p>a <select><option>x<option>y</p><p>c</article>", "a\nc"),
            ("<article><p class=ad>x<div>a</div><div class=ad>x<script>'</div>'</script>y</div>b</article>", "a\nb"),
            ("<article><div class=ad><table><tr><td>x</div>y</table></div>b</article>", "b"),
            ("<article><p>a <span class=ad>x<p>b</article>", "a\nb")]:
        assert html.main_text(page) == expected, page


def test_packing(spark, docs, cases):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(tokenizer())
    for frame in (docs, cases):
        expected = collections.Counter()
        for i, t in frame.select("doc_id", "text").collect():
            expected[(i, np.array([*reference.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())] += 1
        pieces = packing.pack(frame, tokenizer()).collect()
        sequences = collections.defaultdict(list)
        for p in pieces:
            sequences[p.sequence_id].append((p.offset, p.length))
        for own in sequences.values():
            own.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0 and sum(own[-1]) <= packing.SEQUENCE
        lengths = collections.Counter((i, len(b) // 4) for i, b in expected.elements())
        assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in lengths.items())
        by_doc = {i: b for i, b in expected}
        once = [i for i in by_doc if sum(k for (d, _), k in expected.items() if d == i) == 1]
        for i in once:
            own = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == i)
            assert sum(x[1] for x in own) == own[0][3] == len(by_doc[i]) // 4
            assert all(zlib.crc32(by_doc[i][4 * s:4 * (s + n)]) == c for s, n, c, _ in own)
    assert packing.pack(docs.limit(0), tokenizer()).count() == 0


def test_tokens_by_unit(monkeypatch):
    from tokenizers import Tokenizer
    texts = ["I'm it's <|endoftext|> x <|EndOfText|>", "don't. ABC, 12.5, é. É, Σ ΑΣ İstanbul x y a　b ﬁ é. '.', ... foo'S. a.b,c", "", " \x1c a\x85b "]
    own = Tokenizer.from_file(tokenizer())
    texts += [f"{w}{s}{v}" for w in ("abc", "é", "É", "×", "ß", "Ÿ", "e\u0301", "9", "'s", "") for s in (".", ",'s", "###", "'ll", "<|", "_", "\u0338", "$é")
              for v in ("", "t", "É", " q,")]
    rest = ["".join(chr(c) for c in random.Random(i).choices([*range(1, 0x250), *range(0x300, 0x340), 0x2019, 0x3000, 0x1F600], k=60)) for i in range(200)]
    rest += ["the <|startoftext|>a, THE<|endoftext|>. the,", "tHe, the", "the."]
    for slots, known in ((1 << 22, 1 << 24), (4, 64)):  # with room for all, and forgetting all the time
        monkeypatch.setattr(packing, "SLOTS", slots)
        monkeypatch.setattr(packing, "KNOWN_IDS", known)
        ids = packing.Ids(tokenizer())
        for some in (texts, [*texts[::-1], ""], *([r] for r in rest), [r.replace("<|", "< |") for r in rest], texts):
            found, _, row = ids.texts(*ta.buffers(pa.array(some)))
            for text, x in zip(some, found, strict=True):
                assert np.frombuffer(x, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text
            assert (np.diff(row) >= 0).all()


def test_bm25_prefers_shared_rare_words():
    rows = [np.array([1, 2, 3]), np.array([1, 9, 8]), np.array([1, 2, 7]), np.array([1, 2, 3])]
    index = packing.Index(np.concatenate(rows).astype(np.uint64), np.repeat(np.arange(4), 3), 4)
    assert index.neighbours(0, np.array([False, True, True, True])).tolist()[0] == 3


def test_context_tree_against_brute_force():
    """Estimates, weights and mixture by the recursive definition."""
    text = b"the cat the cot the cat "
    stream = np.frombuffer(ctw.PAD + text, np.uint8)
    grams, _ = ctw.strings(stream, np.array([0, len(stream)]))
    keys, counts = np.unique(grams, return_counts=True)
    sub = ctw.subtree(keys, counts)
    key, zeros, ones, children = sub[0].parents(2)
    levels = [*ctw.shallow({"key": key, "zeros": zeros, "ones": ones, "children": children}), *sub]
    full = ctw.PAD + text
    places = range(len(ctw.PAD), len(full))

    def counts_of(context, node):
        found = [0, 0]
        for i in places:
            if full[i - len(context):i] == context:
                for j in range(8):
                    if (1 << j | full[i] >> (8 - j)) == node:
                        found[full[i] >> (7 - j) & 1] += 1
        return found

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(context, node):
        own = kt(*counts_of(context, node))
        if len(context) == ctw.DEPTH:
            return own
        below = {full[i - len(context) - 1:i] for i in places if full[i - len(context):i] == context}
        return np.logaddexp(own, sum(weighted(c, node) for c in below if sum(counts_of(c, node)))) - math.log(2)

    def mixed(context, node):
        value = None
        for d in range(ctw.DEPTH, -1, -1):
            c = context[len(context) - d:]
            a, b = counts_of(c, node)
            if a + b:
                w = 1.0 if value is None else math.exp(kt(a, b) - math.log(2) - weighted(c, node))
                value = w * (b + .5) / (a + b + 1) + (0 if value is None else (1 - w) * value)
        return .5 if value is None else value

    for i in list(places)[3:9:2]:
        expected = 0.0
        for j in range(8):
            p = mixed(full[i - ctw.DEPTH:i], 1 << j | full[i] >> (8 - j))
            expected += math.log10(p if full[i] >> (7 - j) & 1 else 1 - p)
        assert abs(ctw.log10_of(grams[[i - len(ctw.PAD)]], levels)[0] - expected) < 1e-9


def test_context_tree_scores(spark, docs, cases):
    held = q.held_out(1)
    rows = ctw.score(docs, held).collect()
    assert len(rows) == docs.count()
    texts = dict(docs.select("doc_id", "text").collect())
    train = collections.Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            train.update([*words(t), None])
    n, v = sum(train.values()), len(train)
    for r in rows:
        tokens = [*words(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(train[x] > 0 for x in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((train[x] + .5) / (n + .5 * (v + 1))) for x in tokens), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0
    assert len(ctw.score(cases, held).collect()) == 16 and ctw.score(cases.limit(0), held).count() == 0


def test_quality_gradients_and_held_out_accuracy(spark, docs):
    random = np.random.RandomState(0)
    x, first, y = random.rand(7, quality.N_FEATURES), np.array([0, 2, 3, 7]), np.array([1.0, 0, 1])
    model = quality.train(x, first, y)
    grads = model.gradients(model.forward(x, first), first, y)
    loss = lambda: -np.mean(np.log(np.where(y > 0, (s := model.forward(x, first)["score"]), 1 - s)))
    for name in ("encode", "v", "u", "attend", "score"):
        at = tuple(0 for _ in grads[name].shape)
        for step in (1e-5,):
            model.weights[name][at] += step
            high = loss()
            model.weights[name][at] -= 2 * step
            low = loss()
            model.weights[name][at] += step
        assert abs((high - low) / 2e-5 - grads[name][at]) < 1e-5
    big = SF_DIR.replace("sf0.001", "sf0.01")
    rows = q.QUERIES["op1_attention_quality"](spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    empty = quality.fit(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"), F.lit(True))
    assert spark.createDataFrame([(None,), ("",)], "text string").select(quality.score("text", empty).alias("s")).where("s between 0 and 1").count() == 2


def test_licences(spark, docs, cases):
    found = collections.Counter(r["family"] for r in licences.scan(docs).collect())
    known = {"mit": "Released under the MIT License.", "apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0."}
    for family, text in known.items():
        assert found[family] == docs.select(F.explode(F.split("text", "\n")).alias("l")).where(F.col("l") == text).count()
    assert licences.scan(cases).where("family <> 'unknown'").count() == 0 and licences.scan(cases.limit(0)).count() == 0


def test_licences_learn_from_every_paragraph(spark):
    """50 of 6,050 paragraphs that name no licence are alike, and a sample of those with the smallest hashes has none of them."""
    rng = random.Random(3)
    plain = [" ".join(f"w{rng.randrange(10 ** 4)}" for _ in range(8)) for _ in range(6000)]
    alike = spark.range(2000).select(F.concat(
        F.lit("No part of this publication may be reproduced without the prior written permission of the publisher. "), "id").alias("text"))
    alike = [r["text"] for r in alike.where(F.xxhash64("text") > 1 << 62).limit(50).collect()]
    docs = spark.createDataFrame(list(enumerate(plain + alike)), "doc_id bigint, text string")
    assert len(alike) == 50 and licences.unnamed(licences.paragraphs(docs), licences._features(spark)).agg(F.sum("n")).first()[0] == 6050
    assert licences.scan(docs).where("family <> 'unknown'").count() <= 6


def test_licences_limit(spark):
    rows = spark.createDataFrame([(0.0, 2996), (0.61234, 1), (0.7, 2), (1.0, 1)], "probability double, n bigint")
    assert licences._limit(rows) == 0.6124 and licences._limit(rows.limit(0)) == 0.0


def test_containment(spark, cases):
    items = spark.createDataFrame([(1, " ".join(PROSE[:9])), (2, "A b"), (3, None), (4, ""), (5, "not in there at all nowhere"), (None, "y z"), (6, "a B")],
                                  "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(cases, items).collect()}
    assert got == {(i, 1) for i in (1, 2, 3, 12, None)} | {(7, 2), (8, 2), (11, None)}
    clean = decontaminate.clean(cases, items)
    assert clean.columns == cases.columns and sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 9, 10, 11, 13]
    assert decontaminate.contained(cases, items.limit(0)).count() == 0 and decontaminate.contained(cases.limit(0), items).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, name):
    import os

    import duckdb
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    df = q.QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLES[name])
    order = [[c[0] for c in result.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def test_native_plans(spark):
    for name in ("op3_licence_paragraphs", "op7_containment_search"):
        plan = q.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_pipeline(spark, docs):
    import corpus_pipeline
    frame, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF_DIR)
        assert frame.columns == docs.columns
        frame = frame.persist()
        seen.append(frame.count())
    assert sorted(seen, reverse=True) == seen and seen[-1] > 0
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {r["doc_id"] for r in frame.collect()}


def test_paragraphs_find_edited_passages(spark):
    """Passages of 50 to 100 words with one or two changed words, set in unlike text, against brute-force Jaccard."""
    rng, rows, sought = random.Random(5), [], []
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    shingles = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    for size, edits in [(50, 1), (52, 1), (60, 1), (75, 1), (100, 2), (60, 0), (29, 0)] * 20:
        passage = text(size)
        copy = list(passage)
        for e in range(edits):
            copy[(e + 1) * size // (edits + 1)] = "changed"
        a, b = shingles(passage), shingles(copy)
        assert 10 * len(a & b) >= 8 * len(a | b)
        i = len(rows)
        sought.append((i, i + 1))
        rows += [(i, " ".join(text(70) + passage + text(70)), size), (i + 1, " ".join(text(90) + copy + text(40)), size)]
    rows.append((len(rows), " ".join(text(300)), 0))
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    got = paragraphs.repeated(frame, "edited").collect()
    assert {(r.kept_doc_id, r.doc_id) for r in got if not r.kept and r.doc_id != r.kept_doc_id} == set(sought)
    for r in got:  # nothing outside the passage is to be removed
        start = 90 if r.doc_id % 2 else 70
        slack = 12 if r.n_words == 29 else 0
        assert start - slack <= r.first_word and r.first_word + r.n_words <= start + rows[r.doc_id][2] + slack


def test_paragraph_buckets_are_searched_together(monkeypatch):
    """Members of three buckets against all pairs; spans are sought for no pair that has none, though pairs share LEAST shingles."""
    rng, asked, span = np.random.RandomState(3), [], paragraphs._span
    e, width, rows = paragraphs.EXTEND, paragraphs.SHINGLE + 2 * paragraphs.EXTEND, []
    for part, n in ((5, 2), (7, 30), (9, 24)):
        base = rng.randint(1, 1 << 30, width)
        if part == 9:
            base = np.tile(base[:7], width)[:width]  # a text that repeats itself
        for k in range(n):
            x = base.copy()
            apart = rng.rand(width) < (k % 4) / 40
            if k % 6 == 1:
                apart[k % 8::8] = True  # shares 3 shingles of 8
            apart[e:e + paragraphs.SHINGLE] = False
            x[apart] = rng.randint(1, 1 << 30, int(apart.sum()))
            rows.append((part, len(rows), x))

    def linked(x, y):
        shingles = [[tuple(w[i:i + paragraphs.SHINGLE]) for i in range(2 * e + 1)] for w in (x.tolist(), y.tolist())]
        alike = lambda a, b, c, d: 10 * len(u := {*shingles[0][a + e:b + e + 1]} & {*shingles[1][c + e:d + e + 1]}) >= 8 * len(
            {*shingles[0][a + e:b + e + 1]} | {*shingles[1][c + e:d + e + 1]}) and len(u) > 0
        apart = np.flatnonzero(np.concatenate(([True], x != y, [True]))) - 1 - e  # words, from the anchor's first on
        run = apart[apart > 0].min() - apart[apart < 0].max() - paragraphs.SHINGLE
        if alike(-12, 12, -12, 12) or run >= paragraphs.LEAST:
            return True
        near = {a: min(same, key=lambda b: (abs(a - b), b)) for a in range(-e, e + 1) if (same := [
            b for b in range(-e, e + 1) if shingles[0][a + e] == shingles[1][b + e] and np.sign(a) == np.sign(b)])}
        found = len(near) >= paragraphs.LEAST and span(np.array([*near]), np.array([*near.values()]))
        return bool(found) and alike(*found)

    want = components(len(rows), [(i, j) for i, (p, _, x) in enumerate(rows) for j, (r, _, y) in enumerate(rows) if i != j and p == r and linked(x, y)])
    monkeypatch.setattr(paragraphs, "_span", lambda a, b: asked.append(span(a, b)) or asked[-1])
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(
        [np.append(e, r[2]).astype(np.int32) for r in rows], pa.list_(pa.int32()))], ["part", "id", "words"])
    found = [r for b in paragraphs._linked(iter([batch.slice(0, 13), batch.slice(13)])) for r in b.to_pylist()]
    assert components(len(rows), [(r["u"], r["v"]) for r in found]) == want and len({*want}) > 3
    assert asked and None not in asked


def test_context_counts_come_in_batches(monkeypatch):
    """A block is read and handed on in batches, whatever its size, and its counts are those of all its rows."""
    monkeypatch.setattr(ctw, "ROWS_OUT", 50)
    monkeypatch.setattr(ctw, "HELD_KEYS", 100)
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["ab", "cd", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(30))) for _ in range(60)]
    schema = pa.schema([("text", pa.string()), ("held_out", pa.bool_()), ("block", pa.int32())])
    batches = (pa.RecordBatch.from_pylist([{"text": t, "held_out": i % 3 == 0, "block": 7} for i, t in list(enumerate(texts))[a:a + 9]],
                                          schema) for a in range(0, 60, 9))
    found = list(ctw._reports(batches))
    assert len(found) > 3 and max(map(len, found)) <= 50
    rows = pa.Table.from_batches(found).to_pylist()
    assert {r["block"] for r in rows} == {7} and len({(r["kind"], r["key"]) for r in rows}) == len(rows)
    learnt = [t for i, t in enumerate(texts) if i % 3]
    assert sum(r["count"] for r in rows if r["kind"] == 1) == sum(len(t.split()) + 1 for t in learnt)
    assert sum(r["count"] for r in rows if r["kind"] == 0) == sum(len(t) + 1 + bool(t) for t in learnt)
    assert sum(r["kind"] for r in rows) == len({w for t in texts for w in t.split()}) + 1


def test_python_stages_give_memory_back(monkeypatch):
    """Before a task, after it, and when its reader stops early."""
    from treeloom.llm import textarrays
    calls = []
    monkeypatch.setattr(textarrays, "release", lambda: calls.append(1))
    work = textarrays.released(lambda batches: (b + 1 for b in batches))
    assert list(work(iter([1, 2]))) == [2, 3] and len(calls) == 2
    some = work(iter([1, 2]))
    assert next(some) == 2
    some.close()
    assert len(calls) == 4


def test_large_paragraph_buckets_are_searched_in_blocks(spark, monkeypatch):
    """Every two members of a bucket over BLOCK meet or are in one component, in rows that grow with the bucket;
    pairs of blocks would hold each of the 120 members 11 times. The documents found are those of whole buckets."""
    monkeypatch.setattr(paragraphs, "BLOCK", 10)
    places = spark.createDataFrame([(7, 1000 + i, i) for i in range(120)], "key bigint, place bigint, id bigint")
    blocks = paragraphs._blocks(places).collect()
    assert len(blocks) == len({r.place for r in blocks}) == 120 and 8 <= len({r.part for r in blocks}) <= 12
    named = {i: 0 if i < 100 else 100 if i < 103 else i for i in range(120)}
    component = spark.createDataFrame([(i, named[i]) for i in range(103)], "id bigint, component bigint")
    rows = paragraphs._across(places, component).collect()
    parts: dict = {}
    for r in rows:
        assert r.known == named[r.place - 1000]
        parts.setdefault(r.part, set()).add(r.place - 1000)
    met = {(i, j) for members in parts.values() for i in members for j in members}
    assert all((i, j) in met for i in range(120) for j in range(120) if named[i] != named[j])
    assert sum(r.place < 1100 for r in rows) == 100 * 2 and max(map(len, parts.values())) < 50
    rng, texts = random.Random(11), []
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    for _ in range(2):  # two passages over one common phrase, in copies with a changed word, and texts that share the phrase alone
        passage = text(40) + [f"phrase{k}" for k in range(5)] + text(40)
        for k in range(30):
            copy = list(passage)
            copy[(7 * k) % 40] = f"changed{k}"
            texts.append(text(30) + copy + text(30))
    texts += [text(40) + [f"phrase{k}" for k in range(5)] + text(40) for _ in range(5)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = lambda: {(r.doc_id, r.kept_doc_id) for r in paragraphs.repeated(frame, "large").collect()}
    small = found()
    monkeypatch.setattr(paragraphs, "BLOCK", 8192)
    assert small == found() and {i for i, _ in small} == set(range(60))


def test_second_paragraph_search_asks_for_many_members(monkeypatch):
    """96 members that share their anchor alone, 64 of them known to be one group: a few calls, not one for each member
    outside the group, and no pair's places are laid out."""
    rng, e, calls, laid = np.random.RandomState(2), paragraphs.EXTEND, [], []
    rows = rng.randint(1, 1 << 30, (96, paragraphs.SHINGLE + 2 * e))
    rows[:, e:e + paragraphs.SHINGLE] = rows[0, e:e + paragraphs.SHINGLE]
    rows[95, :e], rows[95, e + paragraphs.SHINGLE:e + 40] = rows[90, :e], rows[90, e + paragraphs.SHINGLE:e + 40]
    batch = pa.RecordBatch.from_arrays([pa.array(np.full(96, 7)), pa.array(np.arange(96)), pa.array([[e, *x] for x in rows.tolist()], pa.list_(pa.int32())),
                                        pa.array([0] * 64 + list(range(64, 96)))], ["part", "id", "words", "known"])
    near, spans = paragraphs.Shingles.near, paragraphs._spans
    monkeypatch.setattr(paragraphs.Shingles, "near", lambda self, *a: calls.append(1) or near(self, *a))
    monkeypatch.setattr(paragraphs, "_spans", lambda places: laid.append(len(places)) or spans(places))
    found = [r for b in paragraphs._linked(iter([batch]), True) for r in b.to_pylist()]
    assert [{r["u"], r["v"]} for r in found] == [{90, 95}]
    assert len(calls) < 20 and sum(laid) < 8


def test_paragraph_texts_and_components_are_moved_once(spark, monkeypatch):
    """The second search of large buckets reads no text again; buckets that are not large need no rounds for their components."""
    rng, texts = random.Random(13), []
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    for _ in range(2):
        passage = text(40) + [f"phrase{k}" for k in range(5)] + text(40)
        for k in range(20):
            copy = list(passage)
            copy[(7 * k) % 40] = f"changed{k}"
            texts.append(text(30) + copy + text(30))
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    kinds, scans, rounds = type(frame), [], []
    mapped, components_ = kinds.mapInArrow, links.components
    monkeypatch.setattr(kinds, "mapInArrow", lambda self, f, *a, **k: scans.append(f is paragraphs._members) or mapped(self, f, *a, **k))
    monkeypatch.setattr(links, "components", lambda *a: rounds.append(1) or components_(*a))
    small = {tuple(r) for r in paragraphs.repeated(frame, "once").select("doc_id", "kept_doc_id").collect()}
    assert sum(scans) == 1 and not rounds and {i for i, _ in small} == set(range(40))
    monkeypatch.setattr(paragraphs, "BLOCK", 10)
    scans.clear()
    large = {tuple(r) for r in paragraphs.repeated(frame, "twice").select("doc_id", "kept_doc_id").collect()}
    assert sum(scans) == 1 and rounds and large == small


def test_pairs_that_share_their_anchor_alone_are_not_looked_at():
    """No posting of the anchor, which all members of a bucket share, and so no work for each pair that has no more."""
    rng, e = np.random.RandomState(4), paragraphs.EXTEND
    rows = rng.randint(1, 1 << 30, (40, paragraphs.SHINGLE + 2 * e)).astype(np.int32)
    rows[:, e:e + paragraphs.SHINGLE] = rows[0, e:e + paragraphs.SHINGLE]
    values = np.concatenate((np.full((40, 1), e, np.int32), rows), 1)
    offsets = np.arange(41) * values.shape[1]
    shingles = paragraphs.Shingles(np.zeros(40, np.int64), np.arange(40), offsets, values.ravel())
    assert not len(shingles.term)
    assert shingles.near([(np.arange(3), np.arange(3, 40))]) == [[], [], []]


def test_members_of_texts():
    """The words around wanted places; a place past the text's end or with other words there is passed over."""
    texts = ["a b c d e f g h", "One two three four five six seven", "short", None]
    wanted = []
    for text, ats in zip(texts, ([0, 3, 4], [2], [0], []), strict=True):
        data, offsets = paragraphs.ta.buffers(pa.array([text]))
        w = paragraphs.ta.words(data, offsets, lower=True)
        wide = [int(paragraphs._around(w.hash, np.array([at]), np.zeros(1, np.int64), np.array([len(w.hash)]), paragraphs.EXTEND)[0])
                if at + paragraphs.SHINGLE <= len(w.hash) else 0 for at in ats]
        wanted.append([{"at": at, "wide": x, "part": at, "id": 10 * at, "place": None if at else 5} for at, x in zip(ats, wide, strict=True)])
    wanted[1].append({**wanted[1][0], "wide": wanted[1][0]["wide"] + 1})
    kind = pa.list_(pa.struct([("at", pa.int32()), ("wide", pa.int64()), ("part", pa.int64()), ("id", pa.int64()), ("place", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(wanted, kind)], ["text", "wanted"])
    found = [r for b in paragraphs._members(iter([batch.slice(0, 1), batch.slice(1)])) for r in b.to_pylist()]
    assert [(r["part"], r["id"], r["place"], r["words"][0], len(r["words"])) for r in found] == [(0, 0, 5, 0, 9), (3, 30, None, 3, 9), (2, 20, None, 2, 8)]
