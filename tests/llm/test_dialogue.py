"""op12: branch and bound against exhaustive enumeration, and the query against a plain Python version."""

import hashlib
import itertools
import re
import zlib

import duckdb
import pytest

from conftest import SF_DIR
from treeloom.llm import dialogue
from treeloom.llm import queries as q

PATTERN = re.compile(r"(s?(ua)+)?")


def exhaustive(rows, inserts=2):
    """All scripts with up to `inserts` inserted turns in each gap: the least (cost, audit)."""
    best = None
    n = len(rows)
    per_row = []
    for initial, fault in rows:
        options = [("D", 4, None)]
        if fault not in "bd" or not fault:
            if fault in ("", "t"):
                extra = 3 if fault == "t" else 0
                options += [("K", extra, initial), ("R", 3 + extra, "u"), ("R", 3 + extra, "a")]
        per_row.append(options)
    gaps = [["", "u", "a", "uu", "ua", "au", "aa"][: 1 + 2 + 4 * (inserts > 1)]] * (n + 1)
    for chosen in itertools.product(*per_row):
        for added in itertools.product(*gaps):
            roles, audit, cost = [], "", 0
            for i in range(n + 1):
                for r in added[i]:
                    roles.append(r)
                    audit += "I"
                    cost += 3
                if i < n:
                    letter, c, role = chosen[i]
                    if letter == "R" and role == rows[i][0]:
                        continue
                    audit += letter
                    cost += c
                    if role is not None:
                        roles.append(role)
            if len(audit) != n + sum(len(a) for a in added) or not PATTERN.fullmatch("".join(roles)):
                continue
            if best is None or (cost, audit) < best:
                best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_search_equals_exhaustive(seed):
    import random
    rng = random.Random(seed)
    rows = [(rng.choice("suax"), rng.choice(["", "", "t", "b", "d"])) for _ in range(rng.randint(0, 4))]
    assert dialogue.search(rows) == exhaustive(rows)


def test_known_repairs():
    assert dialogue.search([]) == (0, "")
    assert dialogue.search([("s", ""), ("u", ""), ("a", "")]) == (0, "KKK")
    cost, audit = dialogue.search([("u", ""), ("u", "")])
    assert cost == 3 and audit == "KR"
    assert dialogue.search([("a", "b")]) == (4, "D")
    assert dialogue.search([("u", "t"), ("a", "t")]) == (6, "KK")


def test_long_conversation_is_searched_whole():
    rows = [("u", ""), ("a", "")] * 300 + [("u", "t")]
    cost, audit = dialogue.search(rows)
    assert cost == 4 and audit == "K" * 600 + "D"


def plain(rows):
    """The contract in plain Python over (conv_id, turn, role, text) rows."""
    convs = {}
    for conv_id, turn, role, text in rows:
        convs.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        role = " " if role is None else role
        text = " " if text is None else text
        if d == 0:
            continue
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub(r"[.!?]", "", text)
        if d == 4:
            role = "user"
        convs[conv_id] += [(turn, role, text)] * (2 if d == 3 else 1)
    out = []
    for conv_id, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in got if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in got:
            stripped = re.sub(r"[\x20\x09-\x0D]", "", text)
            if not stripped:
                faults.append("b")
            elif (role, text) in seen:
                faults.append("d")
            elif stripped[-1] not in ".!?":
                faults.append("t")
            else:
                faults.append("")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in got]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = exhaustive_free(list(zip(initials, faults)))
        digest = dialogue.replay(audit, [r for _, r, _ in got], [t for _, _, t in got])
        out.append((conv_id, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def exhaustive_free(rows):
    """A plain dynamic program over (row, automaton state) with whole audits: the reference answer."""
    n = len(rows)
    # states after i rows; inserts are closed over by relaxing twice (an optimal script never needs more)
    layer = {0: (0, "")}
    for i in range(n + 1):
        for _ in range(3):
            for state, (c, a) in list(layer.items()):
                made = "a" if state == 2 else "u"
                nxt = dialogue.STEP.get((state, made))
                if nxt is not None:
                    cand = (c + 3, a + "I")
                    if nxt not in layer or cand < layer[nxt]:
                        layer[nxt] = cand
        if i == n:
            break
        initial, fault = rows[i]
        new = {}
        for state, (c, a) in layer.items():
            options = [(state, 4, "D")]
            if fault in ("", "t"):
                extra = 3 if fault == "t" else 0
                if (state, initial) in dialogue.STEP:
                    options.append((dialogue.STEP[(state, initial)], extra, "K"))
                made = "a" if state == 2 else "u"
                if made != initial and (state, made) in dialogue.STEP:
                    options.append((dialogue.STEP[(state, made)], 3 + extra, "R"))
            for nxt, add, letter in options:
                cand = (c + add, a + letter)
                if nxt not in new or cand < new[nxt]:
                    new[nxt] = cand
        layer = new
    return min(v for s, v in layer.items() if s in dialogue.ACCEPT)


def test_query_equals_plain_python(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF_DIR}/conversations.parquet'").fetchall()
    got = sorted((tuple(r) for r in q.op12_branch_bound_repair(spark, SF_DIR).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == plain(rows) and len(got) == len({r[0] for r in rows})


def test_defined_cases(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (7, 0, "system", "Be kind."), (7, 1, "user", "hello"),
            (7, 1, "user", "hello"), (7, 5, "assistant", "  "), (8, 2, "tool", "x" * 100_000 + "."), (9, 0, "user", "")]
    df = spark.createDataFrame([r + ("clash", 1) for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, fault string, pos int")
    got = sorted((tuple(r) for r in dialogue.repair(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == plain(rows)
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert dialogue.repair(empty).count() == 0


def test_conversation_without_rows_after_damage(spark):
    # find a (conv_id, turn) whose damage drops the row
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    assert [tuple(r) for r in dialogue.repair(df).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
