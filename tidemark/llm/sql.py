"""DuckDB SQL of the operators' queries that SQL can state."""

from __future__ import annotations

from tidemark.llm import quality, secret_scan

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_mixing() -> str:
    return rf"""
with d as (select doc_id, source, len({WORDS}) as size,
                  coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '') as name from documents),
s as (select source, sum(size) as source_size,
             (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
      from d group by source),
f as (select *, 3 * source_size as cap, (select sum(size) from d) as budget from s),
-- fill the sources in order of cap / weight; the level is set by the first one that stays open
o as (select *, (budget - coalesce(sum(cap) over (order by cap / w, source nulls last
                  rows between unbounded preceding and 1 preceding), 0))
                / sum(w) over (order by cap / w, source nulls last
                  rows between current row and unbounded following) as level,
             row_number() over (order by cap / w, source nulls last) as i from f),
l as (select min_by(level, i) as level from o where cap / w > level),
t as (select o.source, source_size, budget,
             least(cap::double, coalesce(l.level * w, cap::double)) as target from o, l),
q as (select d.name, d.size, t.source, t.target, t.budget, e.turn, md5(d.name || ':' || e.turn) || d.name as key
      from d join t on d.source is not distinct from t.source, (select unnest([0, 1, 2]) as turn) e
      where d.size > 0),
v as (select *, sum(size) over (partition by source order by turn, key) / target as finish from q),
m as (select *, sum(size) over (order by finish) as merged from v),
k as (select name, turn, source from m where merged <= budget group by all),
c as (select name, source, count(*) as copies from k group by all)
select d.doc_id, d.size::bigint as size, t.source_size::bigint as source_size, t.target,
       (d.size * case when d.size > 0 then coalesce(c.copies, 0) else 0 end)::bigint as taken
from d join t on d.source is not distinct from t.source
left join c on c.name = d.name and c.source is not distinct from d.source
"""


def op2_chat_formatting() -> str:
    control = r"[<\[]\\*(?:\|[a-z_]+\|>|/?s>|/?INST\])"
    return rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, t, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(t, r)),
o as (select *, len(regexp_extract_all(role || chr(10) || text, '{control}')) as esc from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(len(role) + len(text) + esc + {len("<|im_start|>" + "<|im_end|>") + 2})::bigint as formatted_chars
from o group by conv_id
"""


def op3_quality_rules() -> str:
    stops = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    rules = " and ".join(
        f"{m.measure} {op} {bound} * {m.per} - {m.slack if op == '>=' else 0}"
        for m in quality.RULES
        for op, bound in ((">=", m.low), ("<=", m.high))
        if bound is not None
    )
    return rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {WORDS} as w from documents),
win as (select r, i, array_to_string(w[i:i + 4], ' ') as g
        from (select r, w, unnest(range(1, len(w) - 3)) as i from t where len(w) >= 5)),
twice as (select r, i from win qualify count(*) over (partition by r, g) > 1),
rep as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 5)) as p from twice) group by r),
ln as (select r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
m as (select doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
             len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
             len(regexp_extract_all(text, '!')) as n_exclaim,
             len(list_filter(w, lambda x: lower(x) in ({stops}))) as n_stop, len(l) as n_lines
      from t join ln using (r) left join rep using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and {rules} as kept
from b
"""


def _pieces(kind: str, pattern: str, value: str) -> str:
    """Spans of one kind: lengths of matches and of the gaps between them."""
    p = pattern.replace("'", "''")
    return rf"""
select r, '{kind}' as kind, s, s + len(m) as e, m, v from (
  select r, m, v, sum(len(g) + coalesce(len(p), 0)) over (partition by r order by i) as s from (
    select r, unnest(range(1, len(ms) + 1)) as i, unnest(ms) as m, unnest(vs) as v,
           unnest(gs[1:len(ms)]) as g, unnest(list_concat([null], ms[1:len(ms) - 1])) as p
    from (select r, regexp_extract_all(text, '{p}') as ms, {value.format(p=p)} as vs,
                 string_split_regex(text, '{p}') as gs from t where regexp_matches(text, '{p}'))))"""


def op5_secret_scans() -> str:
    # letters in either case spelled out: the engine's own folding goes beyond A-Z
    keys = "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
        for w in ("password", "passwd", "secret", "token", "api_?key")
    )
    assign = rf"""(?:{keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    whole = "regexp_extract_all(text, '{p}')"
    kinds = ", ".join(f"'{k}'" for k in secret_scan.KINDS)
    allowed = " or ".join(f"regexp_matches(m, '{p}')" for p in secret_scan.ALLOWED)
    bits = "case " + " ".join(f"when regexp_matches(m, '{p}') then {b}" for p, b in secret_scan.CLASSES) + " end"
    w = secret_scan.WINDOW
    return rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
assign as (select * from ({_pieces("assign", assign, "regexp_extract_all(text, '{p}', 1)")}) where len(v) >= {secret_scan.VALUE_MIN}),
access as ({_pieces("access", secret_scan.ACCESS, whole)}),
hex as ({_pieces("hex", secret_scan.HEX, whole)}),
base as (select r, kind, s, e from assign union all select r, kind, s, e from access
         union all select r, kind, s, e from hex),
runs as (select * from ({_pieces("entropy", secret_scan.CANDIDATE, whole)}) c where not ({allowed})
         and not exists (select 1 from base b where b.r = c.r and b.s <= c.s and b.e >= c.e)),
ent as (select r, kind, s, e from runs
        where list_max(list_transform(range(1, len(m) - {w - 2}),
              lambda i: list_aggregate(string_split(m[i:i + {w - 1}], ''), 'entropy'))) > {bits}),
every as (select * from base union all select * from ent),
named as (select r, s, list_position([{kinds}], kind) as k, kind, kind || ':' || s || ':' || e as x, e from every),
agg as (select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
               count(*) filter (kind = 'hex') as n_hex,
               string_agg(x, ',' order by s, k, e) filter (k < 4) as base, string_agg(x, ',' order by s, k, e) as spans
        from named group by r)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join agg using (r)
"""


def op9_url_filters() -> str:
    from tidemark.llm.queries import URL_RULES

    rules = ", ".join(str(r) for r in URL_RULES)
    return rf"""
with rules(action, h, p) as (values {rules}),
u as (select page_id, case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end as rest from pages),
x as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
d as (select distinct host, path from x),
best as (select host, path, max_by(struct_pack(rule := h || p, action := action), len(h || p)) as b
         from d join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by all)
select page_id, x.host, x.path, b.rule as rule, coalesce(b.action, 'allow') as verdict
from x left join best on x.host = best.host and x.path = best.path
"""


def oracle_sql() -> dict[str, str]:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f() for f in found}
