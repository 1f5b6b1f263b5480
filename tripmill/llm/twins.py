"""SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

from tripmill.llm import backoff_lm, license_scan, phrase_mining, poisson_mix

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    def places(phrase: str) -> str:
        words = phrase.split()
        same = " and ".join(f"words[i + {k + 1}] = {_quoted(w)}" for k, w in enumerate(words))
        return f"list_filter(range(len(words)), lambda i: {same})"

    rows = ", ".join(
        f"({_quoted(label)}, {sorted(set(text.split()))!r}::varchar[])" for label, text in license_scan.TEMPLATES
    )
    columns = ", ".join(f"{places(p)} as p{i}" for i, p in enumerate(license_scan.PHRASES))
    step = license_scan.run_step(license_scan.TEMPLATES)
    found = "list_concat(list_concat(p0, p1), p2)"
    labels = ", ".join(
        f"case when len(p{i}) > 0 then [{_quoted(x)}] else []::varchar[] end" for i, x in enumerate(license_scan.PHRASES.values())
    )
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with texts as (select row_number() over () as rid, doc_id, {lower} as t from documents),
worded as (select rid, doc_id, list_filter(regexp_split_to_array(t, '{_BREAK}'), lambda w: w <> '') as words from texts),
based as (select rid, doc_id, words, {columns} from worded),
labelled as (select *, {found} as found, flatten([{labels}]) as base from based),
templates(label, need) as (values {rows}),
blocks as (
  select rid, list_distinct(words[i + 1:i + {2 * step}]) as held
  from (select rid, words, unnest(range(0, greatest(1, (ceil(len(words) / {step}) - 1)::bigint * {step}), {step})) as i
    from worded)),
shares as (
  select rid, label, len(list_intersect(held, need)) as n, len(need) as size from blocks, templates where len(held) > 0),
met as (
  select rid, list(distinct label) as labels, max(n / size) as share
  from shares where n >= ceil({license_scan.CONTAINMENT} * size - 1e-9) group by rid)
select doc_id, len(words)::bigint as n_words, len(found)::bigint as n_base,
  list_min(found)::bigint as first_word, list_max(found)::bigint as last_word,
  array_to_string(list_sort(base), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(met.labels, []::varchar[])))), ',') as labels,
  case when len(base) > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from labelled left join met using (rid)"""


def _mix_sql(seed: int = 17) -> str:
    def u(*parts: str) -> str:
        text = ", ".join(f"coalesce(({p})::varchar, 'null')" for p in parts)
        return f"(('0x' || substr(md5(concat_ws('|', {text})), 1, 13))::bigint / 4503599627370496.0::double)"

    return f"""
with sizes as (
  select source, sum(coalesce(octet_length(encode(text)), 0) + 1)::bigint as source_bytes from documents group by source),
weighted as (select *, pow(source_bytes::double, {poisson_mix.TEMPERATURE}) as w from sizes),
rated as (
  select source, w / (select round(sum(w), 6) from weighted) * 1.0 * (select sum(source_bytes)::double from weighted)
    / source_bytes as rate from weighted),
laws as (
  select source, greatest(1, ceil(rate / {poisson_mix.DRAW_MEAN}))::int as draws,
    rate / greatest(1, ceil(rate / {poisson_mix.DRAW_MEAN})) as mean from rated),
cdf as (
  select source, k, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) over (partition by source order by k) as below
  from laws, range({poisson_mix.TERMS + 1}) r(k)),
listed as (select source, list(below) as below from cdf group by source),
counted as (
  select d.*, list_sum(list_transform(range(draws), lambda i:
      len(list_filter(below, lambda c: c <= {u(str(seed), "d.doc_id", "i")}))))::int as copies
  from documents d
  join laws on d.source is not distinct from laws.source join listed on d.source is not distinct from listed.source),
copied as (select *, unnest(range(copies))::int as copy from counted where copies > 0)
select *, {u(str(seed + 1), "doc_id", "copy")} as order_key from copied"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    byte = "list_reduce(list_concat([xor(c, b)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {codes}), lambda c, b: {byte}), 4294967295)"


def _lm_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(regexp_split_to_array({lower}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    mu = f"{backoff_lm.MU}::double"
    return f"""
with texts as (
  select row_number() over () as rid, doc_id,
    {_crc32("doc_id::varchar")} % {backoff_lm.MODULUS} = {backoff_lm.REMAINDER} as held,
    list_append(list_transform({words}, lambda w: 'w' || w), 'end') as ws
  from documents),
tokens as (select rid, held, generate_subscripts(ws, 1) as pos, unnest(ws) as w from texts),
read as (select *, coalesce(lag(w) over (partition by rid order by pos), 'start') as h from tokens),
words as (select w, count(*) as c from read where not held group by w),
pairs as (select h, w, count(*) as c from read where not held group by h, w),
states as (select w as h, c from words union all select 'start', count(*) from texts where not held),
size as (select sum(c) as n, count(*) as v, (sum(c) + count(*) + 1)::double as bins from words),
weighed as (
  select rid, coalesce(words.c, 0) as c, coalesce(pairs.c, 0) as arcs, coalesce(states.c, 0) as state
  from read left join words using (w) left join pairs on pairs.h = read.h and pairs.w = read.w
  left join states on states.h = read.h),
logs as (
  select rid, c, log10((c + 1) / bins) as plain,
    case when arcs > 0 then log10((arcs + {mu} * ((c + 1) / bins)) / (state + {mu}))
      else log10({mu} / (state + {mu})) + log10((c + 1) / bins) end as weight
  from weighed, size),
summed as (
  select rid, count(*) as n_tokens, count(*) filter (c > 0) as n_known,
    sum(round(plain * 1e9)::bigint)::bigint / 1e9 as base_score,
    sum(round(weight * 1e9)::bigint)::bigint / 1e9 as score
  from logs group by rid)
select doc_id, held as held_out, n_tokens, n_known, (select n::bigint from size) as train_tokens,
  base_score::double as base_score, score::double as score
from texts join summed using (rid)"""


def _phrase_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cuts = " union all ".join(
        f"select lang, phrase, a, {k} as k, array_to_string(w[1:{k}], ' ') as head, array_to_string(w[{k + 1}:], ' ') as tail "
        f"from candidates where len(w) > {k}"
        for k in range(1, phrase_mining.LONGEST)
    )
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
worded as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as ws from pieces),
totals as (select lang, sum(len(ws)) as n from worded group by lang),
placed as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded),
grams as (
  select lang, array_to_string(ws[i:i + m - 1], ' ') as phrase
  from placed, range(1, {phrase_mining.LONGEST + 1}) r(m) where i + m - 1 <= len(ws)),
frequent as (
  select lang, phrase, count(*) as a from grams group by lang, phrase having count(*) >= {phrase_mining.SUPPORT}),
candidates as (select *, string_split(phrase, ' ') as w from frequent where contains(phrase, ' ')),
cuts as ({cuts}),
scored as (
  select lang, c.phrase, c.a, k, l.a as l, r.a as r, n,
    (1000::hugeint * c.a::hugeint * n::hugeint) // (l.a::hugeint * r.a::hugeint) as score
  from cuts c join frequent l using (lang) join frequent r using (lang) join totals using (lang)
  where l.phrase = head and r.phrase = tail),
cheapest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
kept as (
  select * from cheapest c where not exists (
    select 1 from candidates o where o.lang = c.lang and len(o.w) > len(string_split(c.phrase, ' '))
      and contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ') and 100 * o.a >= 100 * c.a))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank,
  phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from kept qualify rank <= {phrase_mining.TOP}"""


ORACLE = {"op13_phrase_mining": _phrase_sql(), "op9_backoff_lm": _lm_sql(), "op4_license_scan": _license_sql(), "op10_poisson_mix": _mix_sql()}
