"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"


def _words(column: str) -> str:
    return f"list_filter(string_split_regex(lower({column}), '{_SPACE}'), lambda x: x <> '')"


def _runs(column: str, size: str) -> str:
    return (f"list_transform(range(0, greatest(0, len({column}) - {size} + 1)), "
            f"lambda i: array_to_string(list_slice({column}, i + 1, i + {size}), ' '))")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')"


ORACLES: dict[str, str] = {
    "op7_containment_search": f"""
with item_words as (select item_id, {_words('text')} w from benchmark where text is not null),
items as (select min(item_id) item_id, w, least(len(w), 5) k from item_words where len(w) > 0 group by w),
item_shingles as (select distinct item_id, k, unnest({_runs('w', 'k')}) s from items),
totals as (select item_id, count(*) total from item_shingles group by item_id),
doc_words as (select doc_id, {_words('text')} w from documents where text is not null),
doc_shingles as (
  select distinct doc_id, k, unnest({_runs('w', 'k')}) s from doc_words, (select distinct k from items) z),
found as (select doc_id, item_id, count(*) shared from doc_shingles join item_shingles using (k, s) group by doc_id, item_id)
select doc_id, item_id, shared, total, shared / total as containment
from found join totals using (item_id) where 100 * shared >= 80 * total""",
    "op13_fp_tree_search": f"""
with d as (select row_number() over () r, doc_id, {_terms('text')} t from documents),
dn as (select r, doc_id, t, len(t)::bigint n from d where len(t) > 0),
tot as (select count(*)::bigint big_n, sum(n)::bigint big_l from dn),
it as (select row_number() over () item, item_id, {_terms('text')} t from benchmark),
iq as (select item, item_id, term, count(*)::bigint q from (select item, item_id, unnest(t) term from it) group by all),
vocab as (select distinct term from iq),
post as (select r, doc_id, n, term, count(*)::bigint tf
         from (select r, doc_id, n, unnest(t) term from dn) join vocab using (term) group by all),
df as (select term, count(*)::bigint df from post group by term),
w as (select term, floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1)))::bigint w from df, tot),
sc as (select item, item_id, doc_id, r,
              sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::bigint score
       from iq join w using (term) join post using (term), tot group by all),
rk as (select item_id, row_number() over (partition by item order by score desc, doc_id asc nulls last, r) rank, doc_id, score
       from sc where score > 0)
select item_id, rank::int as rank, doc_id, score from rk where rank <= 10""",
}
