"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm import (
    ann, attention_lm, compression_bands, fuzzy_lines, lexical_search, mixing, packing, simhash_dedup, spelling, suffix_dedup,
    toxicity, url_filter, warc_index,
)
from critiq.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.quality_rules(read_table(spark, sf_dir, "documents"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = simhash_dedup.simhash_components(spark, read_table(spark, sf_dir, "documents"))
    return parts.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = fuzzy_lines.dedup_lines(spark, read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.archive_round_trip(spark, read_table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.dedup_substrings(spark, read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark, read_table(spark, sf_dir, "pages"))


def op9_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, read_table(spark, sf_dir, "embeddings"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(spark, read_table(spark, sf_dir, "documents"))


def op12_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: Sizes, targets and thresholds of the mix. A source's boundary document is the one in
#: which the running sum of words, by hash, passes what is left of its target.
MIX_SQL = r"""
with sized as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
  from documents),
ranked as (
  select source, sum(size)::bigint as source_size,
         ([3.0, 1.0, 2.0])[1 + (row_number() over (order by source nulls last) - 1) % 3]::double as w
  from sized group by source),
level as (
  select *, 2.0 * source_size as cap, 1.5 * sum(source_size) over () as words from ranked),
shared as (
  select *, (words - coalesce(sum(cap) over (order by cap / w, source nulls last
                                             rows between unbounded preceding and 1 preceding), 0))::double
            / sum(w) over (order by cap / w, source nulls last
                           rows between current row and unbounded following) as level
  from level),
targets as (
  select source, source_size,
         least(cap::double, coalesce(max(level) filter (where level * w <= cap) over () * w, cap::double)) as target
  from shared),
parts as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as epochs from targets),
by_hash as (
  select source, h, sum(size) as words, sum(sum(size)) over (partition by source order by h) as upto
  from sized group by source, h),
edge as (
  select p.source, min(h) as h, min_by(upto, h) as upto, min_by(words, h) as words,
         any_value(target - epochs * source_size) as rest
  from parts p join by_hash b on p.source is not distinct from b.source
  where target - epochs * source_size > 0 and upto > target - epochs * source_size group by p.source),
cuts as (
  select p.*, case when e.h is null then case when target - epochs * source_size > 0 then 1152921504606846976 else 0 end
                   when e.upto - rest < rest - (e.upto - e.words) then e.h + 1 else e.h end as below
  from parts p left join edge e on p.source is not distinct from e.source)
select s.doc_id, s.size, c.source_size, c.target, (s.size * (epochs + (s.h < below)::int))::bigint as taken, s.source,
       (epochs + (s.h < below)::int)::bigint as copies
from sized s join cuts c on s.source is not distinct from c.source
"""

URL_SQL = r"""
with parts as (
  select page_id, url,
         case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
placed as (
  select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
rules(verdict, rule) as (values SITE_RULES),
site as (
  select page_id, url, host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from (select distinct * from placed) p join rules
    on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
   and starts_with(path, substr(rule, strpos(rule, '/')))
  group by all),
patterns(verdict, pattern) as (values PATTERN_RULES),
hits as (
  select url, bool_or(verdict = 'allow') as let, bool_or(verdict = 'block') as hit, count(*) as n
  from (select distinct url from pages) join patterns on regexp_matches(url, pattern) group by url)
select p.page_id, p.host, p.path, s.rule,
       coalesce(s.verdict, case when hit and not let then 'block' else 'allow' end) as verdict,
       coalesce(n, 0)::bigint as pattern_hits
from placed p
left join site s on p.page_id is not distinct from s.page_id and p.url is not distinct from s.url
left join hits h on p.url = h.url
"""


WARC_SQL = r"""
with rows as (
  select page_id, url, encode(coalesce(html, '')) as payload, unhex(sha1(coalesce(html, ''))) as d from pages),
bits as (
  select d, string_agg(lpad(bin(('0x' || substr(hex(d), 1 + 2 * i, 2))::int), 8, '0'), '' order by i) as b
  from (select distinct d from rows), range(20) t(i) group by d),
digests as (
  select d, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(b, 1 + 5 * i, 5))::int, 1), '' order by i) as digest
  from bits, range(32) t(i) group by d),
held as (
  select *, min(page_id) over (partition by d) as holder from rows)
select page_id, octet_length(payload)::bigint as payload_bytes, digest as payload_digest,
       case when holder is null or page_id is not distinct from holder then 'response' else 'revisit' end as record_type,
       case when holder is null or page_id is not distinct from holder then null else holder end as refers_to, url
from held join digests using (d)
"""


SEARCH_SQL = r"""
with found as (
  select doc_id, row_number() over () as d,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
held as (select doc_id, d, len(terms)::bigint as size, terms from found where len(terms) > 0),
corpus as (select count(*)::bigint as n, sum(size)::bigint as l from held),
asked as (
  select item_id, term, count(*)::bigint as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select item_id, min(text) as text from benchmark where item_id is not null group by item_id))
  group by all),
counts as (
  select d, term, count(*)::bigint as tf from (select d, unnest(terms) as term from held)
  where term in (select term from asked) group by all),
weights as (
  select term, floor(1000 * ln((2 * n + 2)::double / (2 * count(*) + 1)))::bigint as w
  from counts, corpus group by term, n),
impacts as (
  select d, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * n) // l)) as impact
  from counts join held using (d), corpus),
scores as (
  select item_id, doc_id, sum(times * w * impact)::bigint as score
  from asked join weights using (term) join impacts using (term) join held using (d)
  group by item_id, d, doc_id),
ranked as (
  select *, (row_number() over (partition by item_id order by score desc, doc_id nulls last))::int as rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


def _values(rows) -> str:
    quoted = ["('{}', '{}')".format(*(x.replace("'", "''") for x in row[:2])) for row in rows]
    return ", ".join(quoted)


def oracle_sql() -> dict[str, str]:
    urls = URL_SQL.replace("SITE_RULES", _values(url_filter.SITE_RULES))
    return {
        "op4_warc_index": WARC_SQL,
        "op8_url_filter": urls.replace("PATTERN_RULES", _values(url_filter.PATTERN_RULES)),
        "op10_mix_sources": MIX_SQL,
        "op12_hybrid_search": SEARCH_SQL,
    }
