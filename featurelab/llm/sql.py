"""SQL of the queries that SQL can express, from the constants of the operators."""

from __future__ import annotations

from featurelab.llm import line_dedup, quality, url_filter

WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def op2() -> str:
    q = quality
    phrases = " or ".join(f"contains(lower(line), '{p}')" for p in q.BOILERPLATE)
    return f"""
with body as (select doc_id, row_number() over () as r, coalesce(text, '') as body from documents),
worded as (select *, {WORDS.format("body")} as words, string_split(body, chr(10)) as every from body),
lines as (select r, unnest(every) as line, unnest(generate_series(1, len(every))) as i from worded),
counted as (
  select r, line, {_count("line", q.WORD)} as w, {_count("line", q.MARKED)} as marked,
    {_count("line", q.SHOUTED)} as shouted, {_count("line", q.DIVIDED)} as bars
  from lines),
judged as (
  select r, line, w, (2 * marked > w or 2 * shouted > w
    or (bars >= {q.NAVIGATION_BARS} and 4 * bars > w) or (bars >= 1 and 3 * bars >= w)
    or {phrases}) and w > 0 as fails from counted),
by_line as (
  select r, count(*) filter (w > 0) - count(distinct line) filter (w > 0) as n_dup_lines,
    count(*) filter (fails) as n_lines_removed,
    coalesce(sum(w) filter (not fails), 0)::bigint as n_words_left from judged group by r),
starts as (
  select r, words, unnest(generate_series(1, len(words) - {q.WINDOW - 1})) as p from worded
  where len(words) >= {q.WINDOW}),
windows as (
  select r, p, array_to_string(list_slice(words, p, p + {q.WINDOW - 1}), ' ') as t from starts),
twice as (select r, p from windows qualify count(*) over (partition by r, t) > 1),
covered as (
  select r, least({q.WINDOW}, coalesce(lead(p) over (partition by r order by p) - p, {q.WINDOW})) as c
  from twice),
repeated as (select r, sum(c)::bigint as c from covered group by r),
counts as (
  select doc_id, len(words)::bigint as n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
    {_count("body", q.SYMBOL)}::bigint as n_symbols, n_dup_lines,
    coalesce(c, 0)::bigint as n_repeat_words, n_lines_removed, n_words_left
  from worded join by_line using (r) left join repeated using (r)),
based as (
  select *, n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEATED} * n_words
    as base_failed from counts)
select *, not base_failed and 100 * (n_words - n_words_left) <= {q.MAX_LOSS} * n_words as kept
from based
"""


def op10() -> str:
    u = url_filter
    rules = sorted(u.RULES, key=lambda r: -len(r[1] + r[2]))

    def fits(site: str, prefix: str) -> str:
        return f"((host = '{site}' or ends_with(host, '.{site}')) and starts_with(path, '{prefix}'))"

    name = " ".join(f"when {fits(s, p)} then '{s}{p}'" for _, s, p in rules)
    verdict = " ".join(f"when {fits(s, p)} then '{k}'" for k, s, p in rules)

    def strength(level: str) -> str:
        return f"""(select greatest({u.MIN_STRENGTH}, least({u.MAX_STRENGTH},
          case when r > 0 then 1 / r - 1 else {u.MAX_STRENGTH} end)) from (
          select (sq - c * k) / nullif(c * (n - k), 0) as r from (
            select sum(bad * bad / n::double) - sum(bad) ^ 2 / nullif(sum(n), 0)::double as sq,
              sum(n)::double as n, count(*)::double as k,
              sum(bad) / nullif(sum(n), 0)::double as p, p * (1 - p) as c
            from {level} where n >= 2)))"""

    return f"""
with rows as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      '{u.UPPER}', '{u.LOWER}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
hosts as (
  select host, count(quality) as n, coalesce(sum((quality = 0)::int), 0) as bad,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain,
    string_split(host, '.')[-1] as suffix
  from rows left join labels on page_id = doc_id group by host),
domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by all),
overall as (select coalesce(sum(bad) / nullif(sum(n), 0)::double, 0) as m0 from hosts),
s as (
  select suffix, (bad + {strength("suffixes")} * (select m0 from overall))
    / (n + {strength("suffixes")}) as m1 from suffixes),
d as (
  select domain, (bad + {strength("domains")} * m1) / (n + {strength("domains")}) as m2
  from domains join s using (suffix)),
h as (
  select host, (bad + {strength("hosts")} * m2) / (n + {strength("hosts")}) as mean,
    n + {strength("hosts")} as weight from hosts join d using (domain)),
bounds as (
  select host, mean, mean - {u.Z} * sqrt(mean * (1 - mean) / (weight + 1)) as bound from h)
select page_id, host, path, case {name} else null end as rule,
  case {verdict} when bound > {u.BLOCK_ABOVE} then 'block' else 'allow' end as verdict,
  round(mean, 6) as bad_share, round(bound, 6) as bad_bound
from rows left join bounds using (host)
"""


def op6() -> str:
    trimmed = "trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"
    return f"""
with docs as (select row_number() over () as r, doc_id, text from documents),
split as (select r, doc_id, unnest(string_split(text, chr(10))) as line,
    unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as i from docs),
held as (
  select r, doc_id, i, {trimmed} as l from split where regexp_matches(line, '{line_dedup.WORD}')),
windows as (
  select r, doc_id, i as s, lead(i, 2) over w as e,
    [l, lead(l, 1) over w, lead(l, 2) over w] as t
  from held window w as (partition by r order by i)
  qualify e is not null),
later as (
  select r, s, e from windows
  qualify row_number() over (partition by t order by doc_id, s) > 1),
gone as (select distinct r, unnest(generate_series(s, e)) as i from later),
kept as (
  select r, string_agg(line, chr(10) order by i) as text from split anti join gone using (r, i)
  group by r),
counts as (select r, count(*) as n_removed from gone group by r)
select doc_id, case when n_removed is null then docs.text else coalesce(kept.text, '') end as text,
  coalesce(n_removed, 0) as n_removed
from docs left join kept using (r) left join counts using (r)
"""


def op13() -> str:
    return """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (
  select anchor_id, id, score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score,
  s.score as negative_score,
  cast(row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as int) as rank
from p join s using (anchor_id)
where not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""


SQL = {
    "op2_quality_rules": op2(),
    "op6_line_dedup": op6(),
    "op10_url_filters": op10(),
    "op13_hard_negatives": op13(),
}
