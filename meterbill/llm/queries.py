"""Query keys of the corpus operators: ``opN_<name>`` -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from meterbill.llm import (collocations, decontaminate, filter_audit, language_id, ngram_join, page_text, pieces, pseudonyms, quality,
                           secret_scan, sentence_spans, simhash, url_filter)
from meterbill.llm.common import table


def op1_benchmark_decontamination(spark, sf_dir):
    """Every (document, benchmark item) with a passage within 20 % word edits of the item."""
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark, sf_dir):
    """Every document's text without sentence spans that occur earlier in the corpus."""
    return sentence_spans.deduplicate(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark, sf_dir):
    """Ids of every document's best segmentation, and whether decoding gives the text back."""
    return pieces.encode(table(spark, sf_dir, "documents"))


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op4_url_filters(spark, sf_dir):
    """Rule and verdict of every page's url, blocks passed on to redirect and canonical aliases."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_ngram_jaccard_join(spark, sf_dir):
    """Component of every document under 3-word shingles and a similarity of 0.9."""
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages"))


def op7_language_id(spark, sf_dir):
    """Language of every document by the dictionary that compresses it best."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_secret_scans(spark, sf_dir):
    """Every secret candidate with the forest's probability and verdict."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


PII_KEY = b"a key for the test tables only"


def op9_pii(spark, sf_dir):
    """Every document with its validated personal values replaced by format-preserving pseudonyms."""
    return pseudonyms.findings(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_values", "kinds")


def op10_quality_rules(spark, sf_dir):
    """Base counts, base rule and the outlier verdict of every document."""
    out = quality.assess(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "lang", "source", "distance")


def op11_phrase_collocations(spark, sf_dir):
    """Each language's first 2,000 phrases by collocation score."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    """What every step of every order of five filters removes, per language, with the filters' Shapley values."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_simhash_near_duplicates(spark, sf_dir):
    """Fingerprint of every document and its component under at most four differing bits."""
    return simhash.components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination,
    op2_substring_dedup,
    op3_sentencepiece,
    op4_url_filters,
    op5_ngram_jaccard_join,
    op6_html_extraction,
    op7_language_id,
    op8_secret_scans,
    op9_pii,
    op10_quality_rules,
    op11_phrase_collocations,
    op12_filter_audit,
    op13_simhash_near_duplicates,
)}

_URL_PARTS = """
  translate(regexp_extract(coalesce(u, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(coalesce(u, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
  regexp_extract(coalesce(u, ''), '(?s)^.*?://[^/?#]*[^?#]*(\\?[^#]*)', 1) as query,
  regexp_extract(coalesce(u, ''), '(?s)^(.*?)://', 1) as scheme"""

_ATTRIBUTE = """'(?s)([^\\s="''/>]+)\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)'"""

_RESOLVED = """array_to_string(list_reduce(list_transform(string_split(y.path, '/'), lambda s: [s]),
           lambda kept, s: case s[1] when '..' then kept[1:greatest(len(kept) - 1, 1)] when '.' then kept else kept || s end)
           || case when regexp_matches(y.path, '/\\.{1,2}$') then [''] else [] end, '/')"""

ORACLE: dict[str, str] = {
    "op4_url_filters": f"""
with recursive
rules(h, p, act) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                            ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts as (select page_id, u, html, {_URL_PARTS} from (select page_id, url as u, html from pages)),
tags as (
  select u, scheme, host, path, list_transform(regexp_extract_all(tag, {_ATTRIBUTE}, 1), lambda x: lower(x)) as names,
         list_transform(regexp_extract_all(tag, {_ATTRIBUTE}, 2), lambda x: regexp_replace(x, '^["'']|["'']$', '', 'g')) as told
  from (select u, scheme, host, path,
               unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', ' ', 'g'),
                 '(?is)(<(?:link|meta)[\\s/][^<>]*>)', 1)) as tag
        from parts where html is not null)),
refs as (
  select *, replace(trim(case
      when list_contains(regexp_split_to_array(lower(told[list_position(names, 'rel')]), '\\s+'), 'canonical') then told[list_position(names, 'href')]
      when lower(told[list_position(names, 'http-equiv')]) = 'refresh'
        then regexp_extract(told[list_position(names, 'content')], '(?is)url\\s*=\\s*[''"]?([^''"]+)', 1) end), '&amp;', '&') as href
  from tags),
targets as (
  select u as a, case when regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') then href when href like '//%' then scheme || ':' || href
      when href like '/%' then scheme || '://' || host || href
      when href like '#%' or href like '?%' then scheme || '://' || host || path || href
      else scheme || '://' || host || regexp_replace(case when path = '' then '/' else path end, '[^/]*$', '') || href end as b
  from refs where href <> ''),
edges as (
  select x.host || case when x.path = '' then '/' else x.path end || x.query as a,
         y.host || case when y.path = '' then '/' when regexp_matches(y.path, '/\\.{{1,2}}(/|$)') then {_RESOLVED} else y.path end || y.query as b
  from (select u, {_URL_PARTS}, row_number() over (order by a, b) as k from (select a as u, a, b from targets)) x
  join (select u, {_URL_PARTS}, row_number() over (order by a, b) as k from (select b as u, a, b from targets)) y using (k)
  where contains(x.u, '://') and contains(y.u, '://')),
ways as (select a, b from edges union select b, a from edges),
reach(a, b) as (select a, a from ways union select r.a, w.b from reach r join ways w on r.b = w.a),
nodes as (select distinct a as node from ways),
node_rule as (
  select node, arg_max(act, length(h) + length(p) + case act when 'allow' then 0.5 else 0 end) as act
  from (select node, {_URL_PARTS} from (select node, 'x://' || node as u from nodes))
  join rules on (host = h or host like '%.' || h) and starts_with(path, p) group by node),
bad as (select distinct r.a as node from reach r join node_rule n on n.node = r.b where n.act = 'block'),
own as (
  select page_id, u, arg_max(h || p, length(h) + length(p)) as rule,
         arg_max(act, length(h) + length(p) + case act when 'allow' then 0.5 else 0 end) as act
  from (select distinct page_id, u, host, path from parts) join rules on (host = h or host like '%.' || h) and starts_with(path, p)
  group by page_id, u)
select t.page_id, t.host, t.path, o.rule, case when o.act is not null then o.act when b.node is not null then 'block' else 'allow' end as verdict
from parts t left join own o on o.page_id is not distinct from t.page_id and o.u is not distinct from t.u
left join bad b on contains(t.u, '://') and b.node = t.host || case when t.path = '' then '/' else t.path end || t.query
""",
    "op5_ngram_jaccard_join": """
with recursive
ws as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [w]
           else list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) end) as s
  from ws),
sizes as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 90 * (x.n + y.n - c)),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join both_ways l on r.b = l.a)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, r.component_id
from documents d left join sizes s using (doc_id)
join (select a as doc_id, min(b) as component_id from reach group by 1) r using (doc_id)
""",
    "op11_phrase_collocations": """
with recursive
ps as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
ws as (select lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda w: w <> '') as w from ps),
totals as (select lang, sum(len(w))::bigint as n from ws group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) as g
  from ws, (values (1), (2), (3), (4), (5)) ks(k) where len(w) >= k),
counts as (select lang, k, g, count(*)::bigint as f from grams group by lang, k, g having count(*) >= 100),
cuts as (
  select c.lang, c.g, c.f as a, x.k as cut, x.f as l, y.f as r, n, ((1000::hugeint * c.f * n) // (x.f::hugeint * y.f))::bigint as score
  from counts c join totals using (lang) join counts x on x.lang = c.lang and x.k < c.k and x.g = c.g[1:x.k]
  join counts y on y.lang = c.lang and y.k = c.k - x.k and y.g = c.g[x.k + 1:c.k]),
best as (select * from cuts qualify row_number() over (partition by lang, g order by score, cut) = 1),
inner_parts as (
  select lang, f, g[i:i + s - 1] as g
  from (select lang, f, g, k, s, unnest(range(1, k - s + 2)) as i from counts, (values (2), (3), (4)) ss(s) where s < k)),
kept as (
  select * from best b
  where not exists (select 1 from inner_parts p where p.lang = b.lang and p.g = b.g and 100 * p.f >= 100 * b.a)),
named as (select lang, array_to_string(g, ' ') as phrase, a, l, r, n, score from kept)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from named qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
""",
    "op12_filter_audit": """
with
ds as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents),
flags as (
  select part, doc_id, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
         coalesce(doc_id > min(doc_id) over (partition by t), false) as e
  from ds),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
docs as (
  select part, if(a, 'A', '') || if(b, 'B', '') || if(c, 'C', '') || if(d, 'D', '') || if(e, 'E', '') as fails,
         coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from flags left join marks using (doc_id) group by all),
letters(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select p.x || q.x || r.x || s.x || t.x as filter_order from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps as (select filter_order, step, substr(filter_order, step, 1) as letter, substr(filter_order, 1, step - 1) as before
          from orders, range(1, 6) g(step)),
seen as (
  select part, filter_order, step, letter, fails = letter as alone, good, toxic, n, contains(fails, letter) as now,
         translate(fails, before, '') <> fails as gone
  from docs, steps),
rows as (
  select part, filter_order, step, letter,
         coalesce(sum(n) filter (where not gone and not now), 0)::bigint as kept, coalesce(sum(n) filter (where now and not gone), 0)::bigint as removed,
         coalesce(sum(n) filter (where now and gone), 0)::bigint as redundant, coalesce(sum(n) filter (where alone), 0)::bigint as unique_fails,
         coalesce(sum(n) filter (where now and not gone and good), 0)::bigint as good_lost,
         coalesce(sum(n) filter (where now and not gone and toxic), 0)::bigint as toxic_lost
  from seen group by part, filter_order, step, letter)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, letter))::bigint as shapley
from rows
""",
}
