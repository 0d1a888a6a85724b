"""DuckDB statements of every registered query, for the oracle comparison.

Each query is stated again in plain SQL over the pre-registered test tables.
They share only the feed SQL (FIXTURES.md section 2) and the unified row; the
operator itself (dedup, checks, rollup, lexicon, casts, ...) is written out
independently here. DuckDB has no look-ahead, so the lexicon predicate is
spelled as "the suffix after the last listed word on some line holds no
negator", which is equivalent.
"""

from __future__ import annotations

from critiq.functions.text import DEFAULT_LEXICON, Lexicon
from critiq.sources.testbed import DATA_LEXICON

# -- feeds (FIXTURES.md section 2) -------------------------------------------
FEEDS = """
feed_a AS (
  select case when d.doc_id % 211 = 7 then null else cast(d.doc_id as varchar) end as id,
         case when d.doc_id % 59 = 8 then null else d.source || '_pf' end as app,
         case when d.doc_id % 43 = 9 then null else d.lang end as segmento,
         cast(1 + 3*l.quality + l.toxic as double) as rating,
         case when d.doc_id % 37 = 4 then null when d.doc_id % 41 = 6 then 'unknown date'
              else '2024-' || lpad(cast(1 + d.doc_id % 6 as varchar), 2, '0') || '-15T08:00:00Z' end as iso_date,
         'reader ' || cast(d.doc_id % 97 as varchar) as title,
         case when d.doc_id % 53 = 5 then null else d.text end as snippet
  from documents d left join labels l on d.doc_id = l.doc_id
),
feed_b AS (
  select 'c' || cast(conv_id as varchar) as id,
         'src' || cast(conv_id % 20 as varchar) || '_pj' as app,
         case when conv_id % 2 = 0 then 'pf' else 'pj' end as segmento,
         case when conv_id % 17 = 3 then 'n/a' else cast(1 + turn % 5 as varchar) || '.0' end as rating,
         '2024-' || lpad(cast(1 + conv_id % 6 as varchar), 2, '0') || '-03T10:20:30.123456' as "timestamp",
         text as comment
  from conversations
),
feed_c AS (
  select cast(event_id + 500 as varchar) as id,
         if(copy, 'src7', 'src' || cast(user_id % 20 as varchar)) as app, if(copy, 'view', event_type) as segmento,
         if(copy, '4', cast(1 + cast(floor(value) as bigint) % 5 as varchar)) as im_rating,
         if(copy, '2024-03-01T09:00:00' || if(event_id % 2 = 0, 'Z', '+00:00'),
            replace(substr(cast(ts as varchar), 1, 19), ' ', 'T') || '-0700') as updated,
         if(copy, 'again', event_type) as title, if(copy, 'the very same review', props) as content
  from (select *, event_id % 23 = 5 as copy from events)
)"""

LOAD_DATE = {
    "a": "case when iso_date like '2024%' then replace(substr(iso_date, 1, 10), '-', '') else '19700101' end",
    "b": "case when \"timestamp\" like '2024%' then replace(substr(\"timestamp\", 1, 10), '-', '') else '19700101' end",
    "c": "case when updated like '2024%' then replace(substr(updated, 1, 10), '-', '') else '19700101' end",
}

# -- unified rows ---------------------------------------------------------------
UNIFIED = """
h_a AS (
  select id, regexp_replace(app, '_pf|_pj', '', 'g') as app, segmento,
         cast(cast(trunc(rating) as integer) as varchar) as rating,
         iso_date, title, snippet, 'google_play' as app_source
  from feed_a
),
h_b AS (
  select id, regexp_replace(app, '_pf|_pj', '', 'g') as app, segmento,
         cast(rating as varchar) as rating, "timestamp" as iso_date,
         comment as title, comment as snippet, 'internal_database_mongodb' as app_source
  from feed_b
),
h_c AS (
  select id, regexp_replace(app, '_pf|_pj', '', 'g') as app, segmento,
         cast(im_rating as varchar) as rating, updated as iso_date,
         title, content as snippet, 'apple_store' as app_source
  from feed_c
),
unified AS (
  select * from h_a union all select * from h_b union all select * from h_c
)"""

DEDUPED = """
deduped AS (
  select * from unified
  qualify row_number() over (
    partition by id
    order by case app_source when 'google_play' then 0
                             when 'internal_database_mongodb' then 1
                             when 'apple_store' then 2 else 3 end,
             iso_date desc nulls last, app asc nulls last, segmento asc nulls last,
             rating asc nulls last, title asc nulls last, snippet asc nulls last) = 1
)"""

VALID_WHERE = (
    "id is not null and app is not null and iso_date is not null "
    "and snippet is not null and app_source is not null"
)
INVALID_WHERE = "id is null or app is null or iso_date is null or app_source is null"

VALID = f"""
valid AS (select * from deduped where {VALID_WHERE})"""

RUN_DATE = "20240501"
# The last load date of the first of two days.
FIRST_DAY = "20240315"

# -- scalar helpers -------------------------------------------------------------
# Word boundaries as Unicode-aware \b: letters, decimal digits and '_' are word
# characters, and so is a non-spacing mark resting on a letter or digit.
BEFORE_WORD = r"(?:^|[^\p{L}\p{Nd}\p{Mn}_]|(?:^|[^\p{L}\p{Nd}\p{Mn}])\p{Mn}+)"
AFTER_WORD = r"(?:[^\p{L}\p{Nd}\p{Mn}_]|$)"
LINE_BREAKS = r"[\n\r\x{85}\x{2028}\x{2029}]"


def legacy_int(x: str) -> str:
    """Legacy string-to-int cast: trim ASCII blanks/controls, truncate a
    fraction, NULL for anything else."""
    t = rf"regexp_replace({x}, '^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$', '', 'g')"
    return (
        f"(case when regexp_matches({t}, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*)$') then "
        f"coalesce(try_cast(nullif(regexp_extract({t}, '^([+-]?[0-9]*)', 1), '') as integer), "
        f"case when regexp_matches({t}, '^[+-]?[.]') then 0 end) end)"
    )


def lexicon_match(x: str, words: tuple[str, ...], negators: tuple[str, ...]) -> str:
    """Some line of ``x`` has a listed whole word with no negator after it."""
    w = "|".join(words)
    n = "|".join(negators)
    has = f"(?i){BEFORE_WORD}(?:{w}){AFTER_WORD}"
    tail = f"(?i)^.*{BEFORE_WORD}(?:{w})({AFTER_WORD}.*)$"
    neg = f"(?i){BEFORE_WORD}(?:{n}){AFTER_WORD}"
    return (
        f"coalesce(len(list_filter(regexp_split_to_array({x}, '{LINE_BREAKS}'), "
        f"lambda l: regexp_matches(l, '{has}') "
        f"and not regexp_matches(regexp_extract(l, '{tail}', 1), '{neg}'))) > 0, false)"
    )


def epoch_us(x: str) -> str:
    """Review timestamp text -> microseconds since the epoch (UTC)."""
    head = f"try_strptime(substr({x}, 1, 19), '%Y-%m-%dT%H:%M:%S')"
    return f"""(case
      when regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z$')
        then epoch_us({head})
      when regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}[+-]\\d{{2}}:?\\d{{2}}$')
        then epoch_us({head})
             - (case when substr({x}, 20, 1) = '-' then -1 else 1 end)
               * (cast(substr({x}, 21, 2) as bigint) * 3600 + cast(right({x}, 2) as bigint) * 60)
               * 1000000
      when regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}[.]\\d{{6}}$')
        then epoch_us(try_strptime({x}, '%Y-%m-%dT%H:%M:%S.%f'))
    end)"""


def java_upper(x: str) -> str:
    """Upper-case like Java (sharp s becomes SS)."""
    return f"upper(replace({x}, 'ß', 'SS'))"


def round_half_up(x: str, digits: int) -> str:
    """Round a double on its decimal text, half up, like Spark's round."""
    return f"cast(round(cast({x} as decimal(38, 10)), {digits}) as double)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _gold_body(lex: Lexicon, source: str, spread: bool = False, date: str = "iso_date") -> str:
    comment = "coalesce(snippet, title)"
    measures = [
        f"{round_half_up('avg(try_cast(rating as double))', 1)} as avg_rating",
        "count(*) as n_reviews",
        f"cast(count_if({lexicon_match(comment, lex.positive, lex.negators)}) as bigint) as n_positive",
        f"cast(count_if({lexicon_match(comment, lex.negative, lex.negators)}) as bigint) as n_negative",
    ]
    if spread:
        r = "try_cast(rating as double)"
        measures.append(
            f"{round_half_up(f'(max({r}) - min({r})) / nullif(max({r}), 0) * 100', 2)} as rating_spread_pct"
        )
    return f"""
select upper(app) as app_name, upper(app_source) as channel, substr({date}, 1, 7) as period,
       upper(segmento) as segment, {", ".join(measures)}
from {source}
group by 1, 2, 3, 4"""


GOLD = f"""
gold AS ({_gold_body(DATA_LEXICON, "valid")})"""

SUMMARY = f"""
per_key AS (
  select id, count(*) as n,
         count_if(id is null) as null_id, count_if(app is null) as null_app,
         count_if(iso_date is null) as null_iso_date, count_if(snippet is null) as null_snippet,
         count_if(app_source is null) as null_app_source,
         count_if({legacy_int("rating")} is null) as bad_rating,
         count_if({VALID_WHERE}) as n_valid,
         count_if({INVALID_WHERE}) as n_invalid_base
  from {{source}} group by id
),
summary AS (
  select cast(sum(n) as bigint) as total_records,
         cast(count_if(n > 1) as bigint) as dup_keys,
         cast(coalesce(sum(case when n > 1 and id is not null then n end), 0) as bigint) as dup_rows,
         cast(sum(null_id) as bigint) as null_id, cast(sum(null_app) as bigint) as null_app,
         cast(sum(null_iso_date) as bigint) as null_iso_date,
         cast(sum(null_snippet) as bigint) as null_snippet,
         cast(sum(null_app_source) as bigint) as null_app_source,
         cast(sum(bad_rating) as bigint) as bad_rating,
         cast(sum(n_valid) as bigint) as n_valid,
         cast(sum(n_invalid_base) as bigint) as n_invalid_base,
         (select count(*) from (
            select 1 from {{source}} where {INVALID_WHERE}
            union all
            select 1 from {{source}} where id in (select id from {{source}} group by id having count(*) > 1))) as n_invalid
  from per_key
)"""

VERDICTS_BODY = """
select 'duplicate_check' as "check", dup_keys = 0 as status,
       case when dup_keys = 0 then 200 else 409 end as code, dup_keys as n_bad,
       case when dup_keys = 0 then 'no duplicate records found'
            else 'duplicate records found: ' || dup_keys || ' ids repeat' end as message,
       total_records
from summary
union all
select 'null_check', (null_id + null_app + null_iso_date + null_snippet + null_app_source) = 0,
       case when (null_id + null_app + null_iso_date + null_snippet + null_app_source) = 0 then 200 else 400 end,
       null_id + null_app + null_iso_date + null_snippet + null_app_source,
       case when (null_id + null_app + null_iso_date + null_snippet + null_app_source) = 0
            then 'no null values in critical columns'
            else 'null values in critical columns: ' || concat_ws(', ',
                   case when null_id > 0 then 'id=' || null_id end,
                   case when null_app > 0 then 'app=' || null_app end,
                   case when null_iso_date > 0 then 'iso_date=' || null_iso_date end,
                   case when null_snippet > 0 then 'snippet=' || null_snippet end,
                   case when null_app_source > 0 then 'app_source=' || null_app_source end) end,
       total_records
from summary
union all
select 'type_consistency_check', bad_rating = 0, case when bad_rating = 0 then 200 else 400 end, bad_rating,
       case when bad_rating = 0 then 'rating values are numeric'
            else 'non-numeric values in column rating: ' || bad_rating || ' rows' end,
       total_records
from summary"""

TYPE_CLIENT = """
select case when count(*) = 0 then 'NA'
            else upper(string_agg(s, ',' order by s)) end as type_client
from (select distinct coalesce(segmento, 'UNKNOWN') as s from valid)"""

# The prose of the test tables has no word of the default lexicon: common words of it are
# read as the lexicon's, the same in the query.
DEFAULT_TEXT = """
select id, replace(replace(replace(coalesce(snippet, title), ' that ', ' ÓTIMO '), ' with ', ' não '),
                   ' this ', ' ruim ') as x from valid"""

GOLD_COLS = "app_name, channel, period, segment, avg_rating, n_reviews, n_positive, n_negative"
UNIFIED_COLS = "id, app, segmento, rating, iso_date, title, snippet, app_source"


def _json_field(name: str, expr: str, quoted: bool, first: bool = False) -> str:
    sep = "" if first else ","
    value = f"to_json({expr})" if quoted else f"cast({expr} as varchar)"
    return f"case when {expr} is null then '' else '{sep}\"{name}\":' || {value} end"


def _row_to_json() -> str:
    fields = [
        _json_field("app_name", "app_name", True, first=True),
        _json_field("channel", "channel", True),
        _json_field("period", "period", True),
        _json_field("segment", "segment", True),
        _json_field("avg_rating", "avg_rating", False),
        _json_field("n_reviews", "n_reviews", False),
        _json_field("n_positive", "n_positive", False),
        _json_field("n_negative", "n_negative", False),
    ]
    return "select '{' || " + " || ".join(fields) + " || '}' as json from gold"


def _consolidated(source: str, date: str = "iso_date") -> str:
    return f"""
select upper(app) as app_name, upper(app_source) as channel, upper(segmento) as segment,
       try_cast(rating as double) as rating, {date} as review_date,
       coalesce(snippet, title) as comment, cast(null as varchar) as app_version,
       case when snippet is not null then title end as client_name,
       substr({date}, 1, 7) as period
from {source}"""


FEED_TABLES = (
    ("google_play", "a", "feed_a"),
    ("internal_database_mongodb", "b", "feed_b"),
    ("apple_store", "c", "feed_c"),
)


def _feed_scan_union(cols) -> str:
    """One select per raw feed: ``feed, id, <cols(feed, key)>``, unioned."""
    return "\nunion all\n".join(
        f"select '{feed}' as feed, id, {cols(feed, key)} from {table_}" for feed, key, table_ in FEED_TABLES
    )


def oracle_sql() -> dict[str, str]:
    lex = DATA_LEXICON
    base = with_(FEEDS, UNIFIED)
    dedup = with_(FEEDS, UNIFIED, DEDUPED)
    valid = with_(FEEDS, UNIFIED, DEDUPED, VALID)
    gold = with_(FEEDS, UNIFIED, DEDUPED, VALID, GOLD)
    summary_u = with_(FEEDS, UNIFIED, SUMMARY.format(source="unified"))
    summary_d = with_(FEEDS, UNIFIED, DEDUPED, VALID, SUMMARY.format(source="deduped"))

    dup_keys = "select id, count(*) as n from unified group by id having count(*) > 1"
    q: dict[str, str] = {}

    q["scan_feeds"] = with_(FEEDS) + _feed_scan_union(lambda f, k: "app, segmento")
    q["scan_with_schema"] = with_(FEEDS) + "select id, coalesce(app, 'none') as app, segmento, rating, iso_date, title, snippet from feed_a"
    q["scan_provenance"] = with_(FEEDS) + _feed_scan_union(
        lambda f, k: f"'{f}/odate=' || {LOAD_DATE[k]} as source_file"
    )
    q["scan_load_date"] = with_(FEEDS) + _feed_scan_union(lambda f, k: f"{LOAD_DATE[k]} as odate")
    q["feed_row_counts"] = with_(FEEDS) + """
select 'google_play' as feed, (select count(*) from feed_a) as n_rows
union all select 'internal_database_mongodb', (select count(*) from feed_b)
union all select 'apple_store', (select count(*) from feed_c)"""

    q["harmonize_a"] = base + "select * from h_a"
    q["harmonize_b"] = base + "select * from h_b"
    q["harmonize_c"] = base + "select * from h_c"
    q["union_feeds"] = base + "select * from unified"
    q["dedup_by_key"] = dedup + "select * from deduped"
    q["rating_casts"] = base + (
        f"select id, app_source, rating, {legacy_int('rating')} as rating_int, "
        "try_cast(rating as double) as rating_double from unified"
    )

    q["valid_rows"] = valid + "select * from valid"
    q["invalid_rows"] = dedup + f"select * from deduped where {INVALID_WHERE}"
    q["stamp_run_date"] = valid + f"select *, '{RUN_DATE}' as odate from valid"
    q["consolidate"] = valid + _consolidated("valid")
    q["consolidate_date_fallback"] = dedup + _consolidated(
        f"(select *, '{RUN_DATE}' as odate from deduped)", date="coalesce(iso_date, odate)"
    )
    q["period_filter"] = valid + "select * from (" + _consolidated("valid") + ") where regexp_matches(period, '^\\d{4}-\\d{2}$')"
    q["lexicon_flags"] = valid + (
        f"select id, {lexicon_match('coalesce(snippet, title)', lex.positive, lex.negators)} as is_positive, "
        f"{lexicon_match('coalesce(snippet, title)', lex.negative, lex.negators)} as is_negative from valid"
    )
    default = DEFAULT_LEXICON
    q["lexicon_flags_default"] = valid + ", said as (" + DEFAULT_TEXT + ")" + (
        f"select id, {lexicon_match('x', default.positive, default.negators)} as is_positive, "
        f"{lexicon_match('x', default.negative, default.negators)} as is_negative from said"
    )
    q["gold_rollup"] = gold + "select * from gold"
    q["gold_rollup_spread"] = valid + _gold_body(
        lex,
        f"(select * from (select *, '{RUN_DATE}' as odate from valid) "
        "where regexp_matches(substr(coalesce(iso_date, odate), 1, 7), '^\\d{4}-\\d{2}$'))",
        spread=True,
        date="coalesce(iso_date, odate)",
    )
    q["preview_gold"] = gold + (
        "select * from gold order by period desc nulls last, app_name desc nulls last, "
        "channel asc nulls last, segment asc nulls last limit 20"
    )

    q["duplicate_keys"] = base + dup_keys
    q["duplicate_rows"] = base + f"select u.* from unified u where u.id in (select id from ({dup_keys}))"
    q["quality_nulls"] = base + (
        "select cast(count_if(id is null) as bigint) as id, cast(count_if(app is null) as bigint) as app, "
        "cast(count_if(iso_date is null) as bigint) as iso_date, cast(count_if(snippet is null) as bigint) as snippet, "
        "cast(count_if(app_source is null) as bigint) as app_source from unified"
    )
    q["quality_type"] = base + f"select id, app_source, rating from unified where {legacy_int('rating')} is null"
    q["quality_summary"] = summary_u + "select * from summary"
    q["quality_verdicts"] = summary_u + VERDICTS_BODY
    q["invalid_rows_with_dups"] = base + (
        f"select {UNIFIED_COLS}, '{RUN_DATE}' as odate from unified where {INVALID_WHERE}\n"
        f"union all\nselect {UNIFIED_COLS}, '{RUN_DATE}' as odate from unified "
        f"where id in (select id from ({dup_keys}))"
    )

    q["history_view"] = valid + f"""
select distinct {java_upper("title")} as title, {java_upper("snippet")} as snippet,
       upper(app_source) as app_source, {java_upper("app")} as app, segmento,
       {legacy_int("rating")} as rating, {epoch_us("iso_date")} as iso_date_us
from valid"""
    q["segment_list"] = valid + TYPE_CLIENT
    q["row_to_json"] = gold + _row_to_json()

    q["run_report"] = RUN_REPORT = summary_d + f""",
tc AS ({TYPE_CLIENT}),
checks AS (
  select count_if(status) as passed, count(*) as n from ({VERDICTS_BODY})
)
select 'run-0001' as application_id, 'data' as owner_team, 'reviews' as owner_project, 'gold' as owner_layer,
       n_valid as valid_count,
       case when n_valid + n_invalid > 0 then cast(n_valid as double) / cast(n_valid + n_invalid as double) * 100 else 0.0 end as valid_pct,
       n_invalid as invalid_count,
       case when n_valid + n_invalid > 0 then cast(n_invalid as double) / cast(n_valid + n_invalid as double) * 100 else 0.0 end as invalid_pct,
       n_valid + n_invalid as total_records, '3.50 min' as total_processing_time,
       case when dup_keys = 0 then 200 else 409 end as duplicate_code,
       case when (null_id + null_app + null_iso_date + null_snippet + null_app_source) = 0 then 200 else 400 end as null_code,
       case when bad_rating = 0 then 200 else 400 end as type_code,
       cast(checks.passed as integer) as success_count, cast(checks.n - checks.passed as integer) as error_count,
       tc.type_client, 'gold_aggregate' as source_app, 'all_sources' as source_search,
       '2024-05-01 06:00:00' as start_ts, '2024-05-01 06:03:30' as end_ts,
       '2024-05-01T06:03:30.000Z' as "timestamp"
from summary, tc, checks"""
    q["failure_report"] = valid + """
select '2024-05-01T06:03:30' as "timestamp", 'gold' as layer, 'reviews' as project, 'gold_aggregate' as job,
       '0' as priority, 'data' as tower,
       (select string_agg(s, ',' order by s) from (select distinct coalesce(segmento, 'UNKNOWN') as s from valid)) as client,
       'feed scan failed' as error"""

    q["sink_parquet_roundtrip"] = gold + f"select *, '{RUN_DATE}' as odate from gold"
    q["sink_invalid_roundtrip"] = dedup + f"select *, '{RUN_DATE}' as odate from deduped where {INVALID_WHERE}"
    q["sink_json_roundtrip"] = gold + "select * from gold"
    q["pipeline_gold"] = gold + f"select *, '{RUN_DATE}' as odate from gold"
    q["sink_report_roundtrip"] = f"select * from ({RUN_REPORT}) union all select * from ({RUN_REPORT})"
    q["sink_history_roundtrip"] = q["history_view"]
    q["sink_report_replay"] = (
        f"select * from ({RUN_REPORT}) union all select * replace ('run-0002' as application_id) from ({RUN_REPORT})"
    )
    month = "replace(regexp_extract(iso_date, '^[0-9]{4}-[0-9]{2}'), '-', '')"
    q["sink_dated_roundtrip"] = dedup + (
        "select id, app, app_source, iso_date, "
        f"case when coalesce({month}, '') = '' then '19700101' else {month} || '01' end as odate from deduped"
    )
    q["incremental_dedup"] = q["dedup_by_key"]
    q["incremental_changes"] = dedup + f""",
dated as (
  select id, case when iso_date like '2024%' then replace(substr(iso_date, 1, 10), '-', '') else '19700101' end > '{FIRST_DAY}' as later
  from unified),
keys as (select id, bool_or(not later) as before, bool_or(later) as after from dated group by id),
winners as (
  select id, case when iso_date like '2024%' then replace(substr(iso_date, 1, 10), '-', '') else '19700101' end > '{FIRST_DAY}' as later
  from deduped)
select case when not before then 'inserted' when later then 'replaced' else 'kept' end as change, count(*) as n_keys
from keys join winners on keys.id is not distinct from winners.id where after group by 1"""
    q["pipeline_incremental"] = q["pipeline_gold"]
    q["pipeline_report"] = q["run_report"]
    q["pipeline_invalid"] = q["sink_invalid_roundtrip"]
    q["pipeline_history"] = q["history_view"]
    q["pipeline_outputs"] = gold + f"""
select 'gold' as output, count(*) as n_rows from gold
union all select 'invalid', count(*) from deduped where {INVALID_WHERE}
union all select 'gold_documents', count(*) from gold
union all select 'history_documents', count(*) from ({q["history_view"]})
union all select 'report', 1"""
    return q
