"""DuckDB statements for the operators on conversations and urls."""

from __future__ import annotations

WORDS = "[^\\x20\\x09-\\x0D]+"

# The standard reflected crc32 (polynomial 0xEDB88320) of an ASCII string, by its table of 256 steps.
_CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
  lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) t"""


def _crc(string: str) -> str:
    return (f"xor(list_reduce(list_concat([4294967295]::bigint[], list_transform(string_split({string}, ''), lambda c: ascii(c)::bigint)), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def prefix_trie_sql(conversations: str = "conversations") -> str:
    """Subtrees are listed pair by pair: every node with every node below it on some conversation's way."""
    return f"""
with tab as ({_CRC_TABLE}
), turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) k
  from {conversations} where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 20 base, {_crc('cast(conv_id as varchar)')} % 4 h
  from (select distinct conv_id from turns), tab
), taken as (
  select c.conv_id, c.base, c.h, least(c.h, count(t.k)) as take from convs c left join turns t on t.conv_id = c.base group by c.conv_id, c.base, c.h
), rebuilt as (
  select c.conv_id, t.k d, t.role, t.text from taken c join turns t on t.conv_id = c.base where t.k <= c.take
  union all select c.conv_id, t.k - c.h + c.take, t.role, t.text from taken c join turns t on t.conv_id = c.conv_id where t.k > c.h
), keyed as (
  select conv_id, d, len(regexp_extract_all(text, '{WORDS}')) w,
         md5(string_agg(md5(length(role) || ':' || role || text), '') over (partition by conv_id order by d)) node from rebuilt
), members as (
  select conv_id, d, node, w from keyed union all select conv_id, 0, '', 0 from convs
), placed as (
  select *, max(d) over (partition by conv_id) depth_, lag(node) over (partition by conv_id order by d) up from members
), nodes as (
  select d, node, min(up) up, min(conv_id) conv_id, count(*) n, max(w) w, max(depth_) deepest,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where d = depth_), '')) ends
  from placed group by d, node
), below as (
  select distinct a.node top, b.node from members a join members b on a.conv_id = b.conv_id and a.d <= b.d
), sums as (
  select top, count(*) filter (where d = deepest) leaves, sum((n - 1) * w) saved from below join nodes using (node) group by top
), kids as (select up, count(*) c from nodes where up is not null group by up)
select n.conv_id, cast(n.d as bigint) depth, p.conv_id parent_conv_id, cast(n.n as bigint) n_convs, cast(coalesce(c, 0) as bigint) n_children,
       cast(leaves as bigint) n_leaves, cast(saved as bigint) saved_tokens, n.ends ends_sha256
from nodes n join sums s on s.top = n.node left join kids k on k.up = n.node left join nodes p on p.node = n.up
"""


def url_filter_sql(rules: list[tuple[str, str, str]], pages: str = "pages") -> str:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in rules)
    return f"""
with cut as (
  select page_id, row_number() over () n, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest from {pages}
), parts as (
  select page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from cut
), hits as (
  select n, arg_max(r.host || r.path, length(r.host || r.path)) as rule, arg_max(action, length(r.host || r.path)) as verdict
  from parts p join (values {values}) r(host, path, action)
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path) group by n
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join hits using (n)
"""


def repair_sql(conversations: str = "conversations") -> str:
    """Costs and audits (whole strings) from the last turn to the first, then the audit is acted out."""
    def way(state: int, edit: str, cost: str) -> str:
        return f"{{'c': f[{state}].c + {cost}, 'a': '{edit}' || f[{state}].a}}"

    def kept(role: str, state: int) -> str:
        return f"case when not gone and r = '{role}' then {way(state, 'K', 'late')} end"

    # states 1 to 4: nothing yet, after system, after user, after assistant
    turn = {1: 3, 2: 3, 3: 4, 4: 3}
    keeps = {1: [kept("s", 2), kept("u", 3)], 2: [kept("u", 3)], 3: [kept("a", 4)], 4: [kept("u", 3)]}
    rowwise = ", ".join(
        f"list_min([{', '.join([way(s, 'D', '2'), f'case when not gone then {way(turn[s], "R", "1 + late")} end', *keeps[s]])}]) g{s}" for s in turn)
    ins = lambda g: f"{{'c': {g}.c + 5, 'a': 'I' || {g}.a}}"
    return f"""
with recursive tab as ({_CRC_TABLE}
), hit as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc("(cast(conv_id as varchar) || ':' || coalesce(cast(turn as varchar), ' '))")} % 20 z
  from {conversations}, tab where conv_id is not null
), damaged as (
  select conv_id, turn, role r0, text t0, case when z = 4 then 'user' else role end as role,
         case when z = 1 then '' when z = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when z = 3 then [0, 1] else [0] end) copy from hit where z <> 0
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, r0, t0, copy) k from damaged
), seen as (
  select *, regexp_matches(text, '[^\\x20\\x09-\\x0D]') word, regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') closed,
         row_number() over (partition by conv_id, role, text order by k) > 1 again,
         case when role = '' then ' ' else left(role, 1) end r, lag(case when role = '' then ' ' else left(role, 1) end) over (partition by conv_id order by k) before
  from numbered
), rows_ as (
  select conv_id, k, turn, role, text, r, not word as blank, word and again as duplicate, word and not again and not closed as truncated,
         not word or again as gone, case when word and not again and not closed then 5 else 0 end late,
         before is not null and before || r not in ('su', 'ua', 'au') illegal from seen
), sums as (
  select conv_id, max(k) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where blank) blank,
         count(*) filter (where duplicate) duplicate, count(*) filter (where truncated) truncated, count(*) filter (where illegal) illegal
  from rows_ group by conv_id
), go(conv_id, k, f) as (
  select conv_id, n + 1, [{{'c': 0, 'a': ''}}, {{'c': 10, 'a': 'II'}}, {{'c': 5, 'a': 'I'}}, {{'c': 0, 'a': ''}}] from sums
  union all
  select conv_id, k, [least(g1, {ins('h3')}), least(g2, {ins('h3')}), h3, least(g4, {ins('g3')})]
  from (select *, least(g3, {ins('g4')}) h3 from (
    select r_.conv_id, r_.k, {rowwise} from go join rows_ r_ on r_.conv_id = go.conv_id and r_.k = go.k - 1))
), best as (select conv_id, f[1].c as cost, f[1].a as audit from go where k = 1
), act(conv_id, i, k, state, out) as (
  select conv_id, 1, 1, 1, []::varchar[] from best
  union all
  select a.conv_id, i + 1, case when e = 'I' then a.k else a.k + 1 end,
         case when e = 'D' then state when e = 'K' then case r when 's' then 2 when 'u' then 3 else 4 end when state = 3 then 4 else 3 end,
         case when e = 'D' then out when e = 'K' then list_append(out, role || ':' || text)
              else list_append(out, case when state = 3 then 'assistant:' else 'user:' end || case when e = 'R' then text else '' end) end
  from (select act.*, audit[i] e from act join best using (conv_id) where i <= length(audit)) a
  left join rows_ r_ on r_.conv_id = a.conv_id and r_.k = a.k
), told as (select conv_id, arg_max(out, i) as out from act group by conv_id)
select c.conv_id, {', '.join(f'cast(coalesce({n}, 0) as bigint) {n}' for n in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal', 'cost'))},
       coalesce(audit, '') audit, sha256(coalesce(array_to_string(out, chr(10)), '')) repaired_sha256
from (select distinct conv_id from {conversations} where conv_id is not null) c left join sums using (conv_id) left join best using (conv_id) left join told using (conv_id)
"""
