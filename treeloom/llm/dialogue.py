"""Conversation structure repair: the cheapest edits that make a conversation's roles well formed.

A repaired conversation has role initials of the form `(s?(ua)+)?`: an optional system turn, then pairs
of user and assistant turns. Edits per row: Keep (0), Rerole to user or assistant (3), Delete (4; the only
edit of a blank or duplicate row); Insert an empty user or assistant turn anywhere (3); a truncated row
that is not deleted adds 3. Of the cheapest edit scripts the one whose audit (edit initials in order) is
ASCII-least is taken.

Method: depth-first branch and bound. A node is (rows consumed, state of the role automaton, cost,
audit). An explicit stack holds open nodes, least cost plus bound on top; the incumbent starts as "delete
all" and is replaced by every cheaper (or equal and ASCII-lesser) complete script. A node is cut when its
cost plus the suffix lower bound exceeds the
incumbent, or equals it with an audit that already sorts after the incumbent's; the bound of (row, state)
is the least cost of the rest, from a backward pass over costs alone, so the first dive is already
cheapest and what follows only settles ties. Each (row, state) keeps a
dominance table of (cost, audit): a prefix is eliminated when another reached the same node cheaper, or
as cheap with an audit that sorts before it at a letter both have (a prefix of it does not dominate, as
longer continuations may sort differently). The stack empties only when optimality is proved.

How it runs on Spark: damage, order, faults, gaps and illegal pairs are DataFrame expressions and windows
partitioned by conversation; one aggregation per conversation gathers the counts and its turns in order,
and the search runs on those rows in Arrow batches (`mapInArrow`), as the repair of a conversation
depends on all of its rows.

Damage (contract): key `conv_id:turn` with a null written as one space; crc32(key) % 20 = 0 drops the row,
1 empties its text, 2 removes its `.!?`, 3 repeats it (same turn), 4 sets its role to user. A null role or
text is one space. Rows are ordered by turn with nulls first, then by role and text.

Defined cases: a null conv_id is one conversation; a conversation without rows after damage has zero
counts, an empty audit and the SHA-256 of the empty string, as has one whose rows are all deleted; a role
whose initial is not s, u or a can only be rerole'd or deleted; extra columns are ignored whatever their names;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the contract: space class, end marks, legal role pairs and edit costs.
SPACE = r"\x20\x09-\x0D"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
#: The role automaton of `(s?(ua)+)?`: states 0 (start) and 3 are accepting.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
_SEARCHED = "conv_id bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, in order, with their first fault: conv_id, turn, pos, role, text, initial, fault."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
                                (F.crc32(key) % 20).alias("damage"))
    rows = rows.where("damage <> 0").select(
        "conv_id", "turn",
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "copy")
    rows = rows.withColumn("pos", F.row_number().over(order))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    ended = F.col("text").rlike(f"[{ENDS}][{SPACE}]*\\z")
    rows = rows.withColumn("initial", F.substring("role", 1, 1)).withColumn(
        "fault", F.when(blank, "b").when(seen > 1, "d").when(~ended, "t").otherwise(""))
    return rows.drop("copy")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per original conversation: counts of faults, the cheapest repair's cost, audit and hash."""
    rows = damaged(conversations)
    previous = F.lag("initial").over(Window.partitionBy("conv_id").orderBy("pos"))
    rows = rows.withColumn("pair", F.concat(previous, F.col("initial")))
    grouped = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps"),
        F.count(F.when(F.col("fault") == "b", 1)).alias("blank"),
        F.count(F.when(F.col("fault") == "d", 1)).alias("duplicate"),
        F.count(F.when(F.col("fault") == "t", 1)).alias("truncated"),
        F.count(F.when(F.col("pair").isNotNull() & ~F.col("pair").isin(*LEGAL), 1)).alias("illegal"),
        F.array_sort(F.collect_list(F.struct("pos", "initial", "fault", "role", "text"))).alias("rows"))
    found = grouped.mapInArrow(_searched, RESULT)
    everyone = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    out = everyone.join(found, everyone.conv_id.eqNullSafe(found.conv_id), "left").drop(found.conv_id)
    zero = F.lit(0).cast("bigint")
    return out.select(
        "conv_id", *[F.coalesce(F.col(c).cast("bigint"), zero).alias(c)
                     for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))


def _searched(batches):
    """Each conversation row (its turns in order as an array): the search and the repaired hash."""
    for batch in batches:
        turns = batch.column("rows")
        offsets = turns.offsets.to_numpy()
        inner = turns.values
        initials, faults = inner.field("initial").to_pylist(), inner.field("fault").to_pylist()
        roles, texts = inner.field("role"), inner.field("text")
        costs, audits, digests = [], [], []
        for i in range(batch.num_rows):
            a, b = int(offsets[i]), int(offsets[i + 1])
            cost, audit = search(list(zip(initials[a:b], faults[a:b])))
            costs.append(cost)
            audits.append(audit)
            digests.append(replay(audit, roles.slice(a, b - a).to_pylist(), texts.slice(a, b - a).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[batch.column(c).cast(pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")],
             pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(digests, pa.string())],
            ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])


def cost_to_go(rows: list[tuple[str, str]]) -> list[list[float]]:
    """The least cost from (rows consumed, automaton state) to an accepted end: the suffix lower bounds,
    exact in cost (audits are left to the search)."""
    n, inf = len(rows), float("inf")
    h = [[inf] * 4 for _ in range(n + 1)]
    for state in ACCEPT:
        h[n][state] = 0
    for i in range(n, -1, -1):
        if i < n:
            initial, fault = rows[i]
            for state in range(4):
                best = DELETE + h[i + 1][state]
                if fault not in ("b", "d"):
                    extra = TRUNCATED if fault == "t" else 0
                    kept = STEP.get((state, initial))
                    if kept is not None:
                        best = min(best, KEEP + extra + h[i + 1][kept])
                    made = "a" if state == 2 else "u"
                    after = STEP.get((state, made))
                    if after is not None and made != initial:
                        best = min(best, REROLE + extra + h[i + 1][after])
                h[i][state] = best
        for _ in range(4):                      # inserts before row i, at most one per state
            for state in range(4):
                after = STEP.get((state, "a" if state == 2 else "u"))
                if after is not None:
                    h[i][state] = min(h[i][state], INSERT + h[i][after])
    return h


def _worse(bound: int, audit: str, best: tuple[int, str]) -> bool:
    """True when no completion of this prefix can beat the incumbent."""
    return bound > best[0] or (bound == best[0] and audit > best[1] and not best[1].startswith(audit))


def _dominated(table: list, cost: int, audit: str) -> bool:
    for c, a in table:
        if c < cost or (c == cost and (a == audit or (a < audit and not audit.startswith(a)))):
            return True
    return False


def search(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Least (cost, audit) for rows of (role initial, fault); fault is '', 'b', 'd' or 't'."""
    n = len(rows)
    bound = cost_to_go(rows)                    # suffix lower bounds per (row, state)
    best = (DELETE * n, "D" * n)                # incumbent: delete every row
    tables: dict[tuple[int, int], list] = {}
    stack = [(0, 0, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if _worse(cost + bound[i][state], audit, best):
            continue
        table = tables.setdefault((i, state), [])
        if _dominated(table, cost, audit):
            continue
        table[:] = [(c, a) for c, a in table if not _dominated([(cost, audit)], c, a)]
        table.append((cost, audit))
        if i == n and state in ACCEPT and (cost, audit) < best:
            best = (cost, audit)
        children = []
        made = "a" if state == 2 else "u"       # the only role an edit may give here
        after = STEP.get((state, made))
        if after is not None:
            children.append((i, after, cost + INSERT, audit + "I"))
        if i < n:
            initial, fault = rows[i]
            children.append((i + 1, state, cost + DELETE, audit + "D"))
            if fault not in ("b", "d"):
                extra = TRUNCATED if fault == "t" else 0
                kept = STEP.get((state, initial))
                if kept is not None:
                    children.append((i + 1, kept, cost + KEEP + extra, audit + "K"))
                if after is not None and made != initial:
                    children.append((i + 1, after, cost + REROLE + extra, audit + "R"))
        children.sort(key=lambda c: (c[2] + bound[c[0]][c[1]], c[3]), reverse=True)
        stack.extend(children)
    return best


def replay(audit: str, roles: list[str], texts: list[str]) -> str:
    """SHA-256 of the repaired conversation's `role:text` lines joined by newlines."""
    lines, state, i = [], 0, 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            role, text, step = roles[i], texts[i], roles[i][:1]
        else:
            step = "a" if state == 2 else "u"
            role, text = NAMES[step], (texts[i] if edit == "R" else "")
        lines.append(f"{role}:{text}")
        state = STEP[(state, step)]
        i += edit != "I"
    return hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()
