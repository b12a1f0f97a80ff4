"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from vaultmart.llm import conversation_sql, line_dedup
from vaultmart.llm import quality_rules as q

# The url rules of the contract, stated again.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _cell(v: str) -> str:
    shift = f"greatest(length(bin({v})) - {q.CELL_BITS}, 0)"
    return f"((((({v}) >> {shift}) + 1) << {shift}) - 1)"


def quality_sql(documents: str = "documents", extra: str = "") -> str:
    """`documents`: a table name; `extra`: more columns to carry, each followed by a comma."""
    ratio_rows = " union all ".join(
        f"select lang, source, '{name}' ratio, {_cell(expr.replace(' div ', ' // '))} as cell "
        "from counts where not base_failed" for name, (expr, _, _) in q.RATIOS.items())
    quart = lambda keys: (
        f"select {keys} ratio, max(total) docs, min(cell) filter (where 4 * upto >= total) q1, "
        f"min(cell) filter (where 4 * upto >= 3 * total) q3 from (select *, "
        f"sum(n) over (partition by {keys} ratio order by cell) upto, "
        f"sum(n) over (partition by {keys} ratio) total "
        f"from (select {keys} ratio, cell, sum(n) n from cells group by {keys} ratio, cell)) "
        f"group by {keys} ratio")
    pick = lambda c: (f"case when o.docs >= {q.MIN_GROUP} then o.{c} "  # noqa: E731
                      f"when l.docs >= {q.MIN_GROUP} then l.{c} else a.{c} end")
    limits, tests = [], []
    for name, (expr, floor, two) in q.RATIOS.items():
        spread = f"{q.SPREADS} * greatest(q3 - q1, {floor})"
        value = expr.replace(" div ", " // ")
        limits.append(f"max(q3 + {spread}) filter (where ratio = '{name}') {name}_high")
        tests.append(f"{value} <= {name}_high")
        if two:
            limits.append(f"max(q1 - {spread}) filter (where ratio = '{name}') {name}_low")
            tests.append(f"{value} >= {name}_low")
    return f"""
with split as (
  select doc_id, lang, source, {extra} coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) ls
  from {documents}
), rows_ as (select row_number() over () rid, * from split
), wins as (
  select rid, unnest(range(1, len(w) - 1)) i, w from rows_ where len(w) >= 3
), hits as (
  select rid, i from (select rid, i, count(*) over (partition by rid, w[i], w[i+1], w[i+2]) c from wins) where c > 1
), cover as (
  select rid, count(distinct i + k) n from hits, (values (0), (1), (2)) v(k) group by rid
), counts as (
  select doc_id, lang, source, {extra} cast(len(w) as bigint) n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         cast(len(ls) as bigint) n_lines,
         cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines,
         cast(coalesce(n, 0) as bigint) n_repeat_words,
         (len(w) < {q.MIN_WORDS} or 100 * coalesce(n, 0) > 50 * len(w)) base_failed
  from rows_ left join cover using (rid)
), cells as (
  select lang, source, ratio, cell, count(*) n from ({ratio_rows}) group by all
), fences as (
  select lang, source, {', '.join(limits)}
  from (select o.lang, o.source, o.ratio, {pick('q1')} q1, {pick('q3')} q3
        from ({quart('lang, source,')}) o
        join ({quart('lang,')}) l on o.lang is not distinct from l.lang and o.ratio = l.ratio
        join ({quart('')}) a on o.ratio = a.ratio)
  group by lang, source
)
select c.doc_id, c.lang, c.source, {extra} n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
       base_failed, case when base_failed then false else coalesce({' and '.join(tests)}, false) end kept
from counts c left join fences f on c.lang is not distinct from f.lang and c.source is not distinct from f.source
"""


def line_dedup_sql(documents: str = "documents") -> str:
    """Lines by their words; variants are the word lists themselves, so nothing here is hashed."""
    return f"""
with line as (
  select doc_id, no, ls[no] line, regexp_extract_all(ls[no], '[^\\x20\\x09-\\x0D]+') w
  from (select doc_id, string_split(text, chr(10)) ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) no
        from {documents} where text is not null)
), first_ as (
  select w, len(w) n, arg_min(line, (doc_id, no)) line, min((doc_id, no)) place from line where len(w) > 0 group by w
), cut as (
  select w, n, place, i, w[:i - 1] || w[i + 1:] v
  from (select *, unnest(range(1, n + 1)) i from first_ where n >= {line_dedup.MIN_WORDS})
), gone as (
  select a.w from cut a join cut b on a.n = b.n and a.i = b.i and a.v = b.v where b.place < a.place
  union select a.w from cut a join first_ b on a.v = b.w and b.n >= {line_dedup.MIN_WORDS} where b.place < a.place
  union select b.w from cut a join first_ b on a.v = b.w and b.n >= {line_dedup.MIN_WORDS} where a.place < b.place
), kept as (
  select place[1] doc_id, place[2] no, line from first_ where w not in (select w from gone)
  union all select doc_id, no, line from line where len(w) = 0
), text_ as (
  select doc_id, string_agg(line, chr(10) order by no) text, count(*) n_kept from kept group by doc_id
)
select d.doc_id, case when d.text is not null then coalesce(t.text, '') end as text,
       cast(case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as bigint) n_lines,
       cast(coalesce(n_kept, 0) as bigint) n_kept
from {documents} d left join text_ t using (doc_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": quality_sql(),
    "op5_line_dedup": line_dedup_sql(),
    "op11_prefix_trie": conversation_sql.prefix_trie_sql(),
    "op12_url_filter": conversation_sql.url_filter_sql(URL_RULES),
    "op13_conversation_repair": conversation_sql.repair_sql(),
}
