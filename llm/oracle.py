"""SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_WORDS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = f"""
with docs as (select row_number() over () as d, doc_id, {WORDS} as words from documents),
places as (select d, words, unnest(range(1, len(words) - 33)) as i from docs where len(words) >= 35),
windows as (select d, i, array_to_string(words[i:i + 34], ' ') as w from places),
repeated as (select d, i from windows qualify count(*) over (partition by w) > 1),
covered as (select distinct d, unnest(range(i, i + 35)) as i from repeated),
gone as (select d, list(i) as gone from covered group by d)
select doc_id, len(words) as n_words, coalesce(len(gone), 0) as n_removed,
  sha256(array_to_string(case when gone is null then words
    else list_filter(words, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from docs left join gone using (d)"""

LM_SCORING = f"""
with docs as (select row_number() over () as d, doc_id, {LOWER_WORDS} as words from documents),
tokens as (select d, i, words[i] as w, case when i > 1 then words[i - 1] end as before
  from (select d, words, unnest(range(1, len(words) + 1)) as i from docs)),
ones as (select w, count(*) as n from tokens group by w),
twos as (select before, w, count(*) as n from tokens where before is not null group by all),
scored as (select d, case when twos.n is not null then ln(twos.n / earlier.n)
    else ln(ones.n / (select count(*) from tokens)) + case when i > 1 then ln(0.4) else 0 end end as s,
    twos.n is null and i > 1 as backed
  from tokens join ones using (w) left join twos on twos.before = tokens.before and twos.w = tokens.w
  left join ones as earlier on earlier.w = tokens.before),
sums as (select d, count(*) as n, sum(s) as s, count(*) filter (backed) as b from scored group by d)
select doc_id, coalesce(n, 0) as n_words, round(coalesce(s, 0), 4) as log_score,
  round(coalesce(s / n, 0), 6) as mean_log_score, coalesce(b, 0) as n_backed_off
from docs left join sums using (d)"""

NGRAM_JACCARD_JOIN = f"""
with recursive docs as (select row_number() over () as d, doc_id, {LOWER_WORDS} as words from documents),
places as (select d, words, unnest(range(1, greatest(len(words) - 2, 2))) as i from docs where len(words) > 0),
shingles as (select distinct d, array_to_string(words[i:i + 3], ' ') as s from places),
sizes as (select d, count(*) as n from shingles group by d),
common as (select a.d as x, b.d as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.d < b.d group by all),
links as (select x, y from common join sizes p on p.d = x join sizes q on q.d = y where 100 * c >= 85 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (select d as x, d as y from docs union select reach.x, both_ways.y from reach join both_ways on both_ways.x = reach.y)
select any_value(me.doc_id) as doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(other.doc_id) as component_id
from docs me join reach on reach.x = me.d join docs other on other.d = reach.y left join sizes on sizes.d = me.d
group by me.d"""

ORACLE: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op3_lm_scoring": LM_SCORING,
    "op5_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
}
