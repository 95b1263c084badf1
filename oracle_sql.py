"""Plain SQL for every registered query, for checking results on another engine.

Common table expressions are kept in one dictionary; `sql` puts in those that a
query needs. Nothing here is used by the library.
"""

from __future__ import annotations

import re

from spendecho.plans import checks
from spendecho.plans.queries import (
    BATCH_DAY, BATCH_SIZE, FIRST_ROWS, HIGH_SPEND, RUNS, SLICE_FROM, SLICE_TO, TOP_THEMES,
)
from spendecho.schemas import WHITESPACE
from spendecho.sources.sample_tables import (
    ANSWER_CAMPAIGNS, ANSWER_CONFIDENCES, ANSWER_SENTIMENTS, AUTHORS, CAMPAIGNS, ENRICHED_AT,
    LOADED_AT, MODEL, OLD_MODEL, SOURCES,
)

# Fixed values, written out so that a wrong vocabulary in the library shows.
SENTIMENTS = ["positive", "negative", "neutral", "mixed"]
THEMES = [
    "shipping", "price", "product_quality", "customer_service",
    "sizing_fit", "website_app", "returns", "other",
]
OBJECTIVES = ["awareness", "traffic", "conversion"]
CHANNEL_LABELS = {
    "meta": ["fb", "facebook", "meta", "fb comment", "ig", "instagram", "insta"],
    "google_ads": ["google", "google reviews", "google play", "play store", "gmb"],
    "tiktok": ["tiktok", "tt", "tt comment"],
}
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
AD_TABLES = ["meta_ads", "google_ads", "tiktok_ads"]
FLAG_OF = {"meta_ads": "R", "google_ads": "A", "tiktok_ads": "N"}
CHANNEL_OF_FLAG = {"R": "meta", "A": "google_ads", "N": "tiktok"}
RECORD_COLUMNS = [
    "sentiment", "sentiment_confidence", "themes", "product_mentions", "competitor_mentions",
    "language", "campaign_reference", "resolved_campaign_id", "resolution_confidence",
]
SNAPSHOT_CHECKS = ["sentiment", "resolved_campaign_id", "themes", "model_version"]
# End of fixed values.


def text(value) -> str:
    return "null" if value is None else "'" + str(value).replace("'", "''") + "'"


def words(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def among(values) -> str:
    return "(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def rn(x: str, places: int) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e{places} + 0.5) / 1e{places} + 0.0)"


def div(a: str, b: str, places: int | None = None) -> str:
    x = f"(cast({a} as double) / nullif(cast({b} as double), 0))"
    return x if places is None else rn(x, places)


def key(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce(cast({c} as varchar), '{KEY_NULL_TOKEN}')" for c in columns)
    return f"md5({parts})"


def strip(c: str) -> str:
    return f"trim(coalesce({c}, ''), {text(WHITESPACE)})"


def exact(c: str, places: int) -> str:
    return div(f"sum(cast({c} as decimal(38,17)))", f"count({c})", places)


CTE: dict[str, str] = {}

CTE["ads"] = f"""
select day as date, channel,
  prefix || '-c' || (ad_no % 3 + 1) as campaign_id,
  channel || ' — campaign ' || (ad_no % 3 + 1) as campaign_name,
  {words(OBJECTIVES)}[ad_no % 3 + 1] as objective,
  prefix || '-set-' || lpad(cast(ad_no + 1 as varchar), 2, '0') as ad_set_id,
  'Audience & ' || (ad_no + 1) as ad_set_name,
  impressions, clicks, spend, conversions, conversion_value,
  cast({div('spend', 'clicks', 4)} as decimal(18,4)) as cpc,
  'USD' as currency, timestamp '{LOADED_AT}' as _loaded_at
from (
  select cast(l_shipdate as date) as day,
    case l_returnflag when 'R' then 'meta' when 'A' then 'google_ads' else 'tiktok' end as channel,
    case l_returnflag when 'R' then 'mt' when 'A' then 'gg' else 'tk' end as prefix,
    cast(l_suppkey % 12 as integer) as ad_no,
    cast(sum(cast(l_quantity as bigint) - 1) * 100 as bigint) as impressions,
    cast(sum(l_linenumber) as bigint) as clicks,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as spend,
    cast(sum(cast(round(l_tax * 100) as bigint)) as bigint) as conversions,
    cast(sum(cast(l_extendedprice as decimal(18,2)) * l_linenumber) as decimal(18,2)) as conversion_value
  from lineitem group by all)"""

CTE["ads_staged"] = f"""
select {key('date', 'ad_set_id')} as surrogate_key, date, channel, campaign_id, campaign_name,
  objective, ad_set_id, ad_set_name, impressions, clicks, spend, conversions, conversion_value,
  cpc, currency,
  {div('clicks', 'impressions', 6)} as click_through_rate,
  {div('spend', 'conversions', 4)} as cost_per_conversion,
  {div('conversion_value', 'spend', 4)} as roas,
  _loaded_at
from ads where impressions > 0"""

CTE["ad_spend"] = "select * exclude (cpc, currency, _loaded_at) from ads_staged"

TOTALS = f"""
  cast(sum(impressions) as bigint) as total_impressions,
  cast(sum(clicks) as bigint) as total_clicks,
  cast(sum(spend) as double) as total_spend,
  cast(sum(conversions) as bigint) as total_conversions,
  cast(sum(conversion_value) as double) as total_conversion_value,
  {div('sum(clicks)', 'sum(impressions)', 6)} as avg_ctr,
  {div('sum(spend)', 'sum(conversions)', 4)} as avg_cpa,
  {div('sum(conversion_value)', 'sum(spend)', 4)} as avg_roas"""

CTE["channel_daily"] = f"""
select {key('date', 'channel')} as surrogate_key, date, channel, {TOTALS}
from ad_spend group by date, channel"""

SUMMARY = f"""
select {key('channel', 'campaign_id')} as surrogate_key, channel, campaign_id, campaign_name, objective,
  count(distinct date) as total_days_active, {TOTALS}
from {{0}} group by channel, campaign_id, campaign_name, objective"""

CTE["campaign_summary"] = SUMMARY.format("ad_spend")

CTE["campaigns"] = f"""
select distinct {key('channel', 'campaign_id')} as surrogate_key, channel, campaign_id, campaign_name, objective
from ad_spend"""

CTE["catalog"] = "select distinct campaign_id, campaign_name, channel, objective from ads"

CTE["feedback"] = f"""
select 'FB_' || lpad(cast(doc_id as varchar), 12, '0') as feedback_id,
  case doc_id % 11
    when 0 then strftime(day, '%Y-%m-%d')
    when 1 then strftime(day, '%Y-%m-%d') || ' ' || lpad(cast(doc_id % 24 as varchar), 2, '0')
      || ':' || lpad(cast(doc_id % 60 as varchar), 2, '0') || ':' || lpad(cast(doc_id % 59 as varchar), 2, '0')
    when 2 then strftime(day, '%m/%d/%Y')
    when 3 then strftime(day, '%-m/%-d/%y')
    when 4 then strftime(day, '%B %-d, %Y')
    when 5 then strftime(day, '%Y.%m.%d')
    when 6 then '  ' || strftime(day, '%Y-%m-%d') || ' '
    when 7 then strftime(day, '%-d %b %Y')
    when 8 then 'soon'
    when 9 then '' end as posted_at,
  case when doc_id % 21 < 20 then {words(SOURCES)}[doc_id % 21 + 1] end as source,
  case doc_id % 8
    when 0 then score || '' when 1 then score || '/5' when 2 then score || '.0'
    when 3 then repeat('★', score) || repeat('☆', 5 - score)
    when 4 then score || ' stars' when 5 then 'good' when 6 then '' end as rating,
  review_text, {words(AUTHORS)}[doc_id % 6 + 1] as author,
  case when doc_id % 15 < 9 then {words(CAMPAIGNS)}[doc_id % 15 + 1] else '' end as true_campaign_id,
  timestamp '{LOADED_AT}' as _loaded_at
from (select doc_id, text as review_text, doc_id % 5 + 1 as score,
        date '2024-01-01' + cast(doc_id % 366 as integer) as day from documents)"""

CHANNEL_CASE = "case " + " ".join(
    f"when lower(trim(source)) in {among(labels)} then '{c}'" for c, labels in CHANNEL_LABELS.items()
) + " else 'other' end"
DATE_FORMATS = [
    "%m/%d/%y", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%B %d, %Y", "%Y.%m.%d", "%-d %b %Y",
]
DATE_CASE = "cast(coalesce(" + ", ".join(f"try_strptime(trim(posted_at), '{f}')" for f in DATE_FORMATS) + ") as date)"
RATING_CASE = """case when contains(rating, '★')
    then cast(length(rating) - length(replace(rating, '★', '')) as integer)
    else try_cast(regexp_extract(rating, '[0-9]+') as integer) end"""

CTE["feedback_staged"] = f"""
select feedback_id, review_text, nullif(trim(author), '') as author, source as source_raw,
  {CHANNEL_CASE} as source_channel, posted_at as posted_at_raw, {DATE_CASE} as posted_date,
  rating as rating_raw, {RATING_CASE} as rating_value,
  nullif(true_campaign_id, '') as true_campaign_id, _loaded_at
from feedback"""

CTE["hashes"] = f"""
select feedback_id, sha256({strip('review_text')} || '||' || {strip('source')}) as content_hash
from feedback"""

CTE["cache_keys"] = f"""
select doc_id as n, content_hash, model_version, quality, toxic, lang
from (select l.doc_id, h.content_hash, l.quality, l.toxic, d.lang,
        unnest(case l.doc_id % 4 when 0 then ['{OLD_MODEL}', '{MODEL}'] when 1 then ['{OLD_MODEL}']
               else ['{MODEL}'] end) as model_version
      from labels l
      join hashes h on h.feedback_id = 'FB_' || lpad(cast(l.doc_id as varchar), 12, '0')
      join documents d on d.doc_id = l.doc_id)
qualify row_number() over (partition by content_hash, model_version order by doc_id) = 1"""

CTE["cached"] = f"""
select content_hash, model_version,
  case when model_version = '{OLD_MODEL}' and n % 3 = 0 then 'neutral'
    when quality = 1 and toxic = 1 then 'mixed' when quality = 1 then 'positive'
    when toxic = 1 then 'negative' else 'neutral' end as sentiment,
  (case when model_version = '{OLD_MODEL}' then 40 else 50 end + n % 50) / 100.0::double as sentiment_confidence,
  case when n % 11 = 0 then []::varchar[]
    else list_sort(list_distinct([{words(THEMES)}[n % 8 + 1], {words(THEMES)}[(n // 8) % 8 + 1]])) end as themes,
  ['item ' || (n % 20)] as product_mentions,
  case when n % 5 = 0 then ['brand ' || (n % 7)] else []::varchar[] end as competitor_mentions,
  lang as language,
  case when rid <> '' then ' your ad ' else '' end as campaign_reference,
  rid as resolved_campaign_id,
  case when rid <> '' then (60 + n % 40) / 100.0::double else 0.0::double end as resolution_confidence
from (select *, case when n % 15 >= 9 or n % 13 = 0 then '' when n % 97 = 0 then 'mt-c99'
        when n % 10 = 0 then {words(CAMPAIGNS)}[(n % 15 + 1) % 9 + 1]
        else {words(CAMPAIGNS)}[n % 15 + 1] end as rid
      from cache_keys)"""


def best(cache: str, model: str) -> str:
    return f"""
select * from {cache} qualify row_number() over (
  partition by content_hash order by model_version = '{model}' desc, model_version desc) = 1"""


CTE["best"] = best("cached", MODEL)
CTE["best_old"] = best("cached", OLD_MODEL)


def assembled(records: str, model: str, ts: str) -> str:
    def js(c):
        return f"cast(to_json({c}) as varchar)"

    fallback = {
        "sentiment": "'neutral'", "sentiment_confidence": "0.0::double", "themes": "['other']",
        "product_mentions": "[]::varchar[]", "competitor_mentions": "[]::varchar[]",
        "language": "'und'", "campaign_reference": "''", "resolved_campaign_id": "''",
        "resolution_confidence": "0.0::double",
    }
    columns = []
    for c in RECORD_COLUMNS:
        value = f"case when b.content_hash is null then {fallback[c]} else b.{c} end"
        columns.append((js(value) if "[" in fallback[c] else value) + f" as {c}")
    return f"""
select h.feedback_id, {', '.join(columns)}, coalesce(b.model_version, '{model}') as model_version,
  h.content_hash, timestamp '{ts}' as _enriched_at
from hashes h left join {records} b on b.content_hash = h.content_hash"""


CTE["enriched"] = assembled("best", MODEL, ENRICHED_AT)
CTE["enriched_old"] = assembled("best_old", OLD_MODEL, ENRICHED_AT)

CTE["enriched_staged"] = """
select feedback_id, lower(trim(sentiment)) as sentiment, sentiment_confidence,
  themes as themes_json, product_mentions as product_mentions_json,
  competitor_mentions as competitor_mentions_json, lower(trim(language)) as language,
  nullif(trim(campaign_reference), '') as campaign_reference,
  nullif(trim(resolved_campaign_id), '') as resolved_campaign_id,
  resolution_confidence, model_version, content_hash, _enriched_at
from enriched"""

CTE["facts"] = """
select e.feedback_id, f.posted_date, f.source_channel, f.rating_value, e.sentiment,
  e.sentiment_confidence,
  case when e.sentiment = 'positive' then 1 when e.sentiment = 'negative' then -1 else 0 end as sentiment_score,
  e.language, e.resolved_campaign_id, e.resolution_confidence, e.campaign_reference,
  cast(json_array_length(e.themes_json) as integer) as theme_count, e.model_version, e._enriched_at
from enriched_staged e left join feedback_staged f on f.feedback_id = e.feedback_id"""

CTE["themes"] = f"""
select {key('feedback_id', 'theme')} as surrogate_key, feedback_id, theme
from (select feedback_id, unnest(from_json(themes_json, '["VARCHAR"]')) as theme from enriched_staged)"""

COUNTS = ", ".join(f"count(*) filter (where sentiment = '{s}') as {s}_count" for s in SENTIMENTS)
CTE["voice"] = f"""
select resolved_campaign_id as campaign_id, count(*) as feedback_count, {COUNTS},
  {div('sum(sentiment_score)', 'count(sentiment_score)', 4)} as net_sentiment_score,
  {exact('resolution_confidence', 4)} as avg_resolution_confidence
from facts where resolved_campaign_id is not null group by resolved_campaign_id"""

ZEROED = ", ".join(
    f"coalesce({c}, 0) as {c}" for c in ["feedback_count", *[f"{s}_count" for s in SENTIMENTS]]
)
CTE["performance"] = f"""
select campaign_id, channel, campaign_name, objective, total_spend, total_conversions,
  total_conversion_value, avg_roas, {ZEROED}, net_sentiment_score, avg_resolution_confidence
from campaign_summary left join voice using (campaign_id)"""

CTE["missing"] = f"""
select content_hash, max(feedback_id) as feedback_id, count(*) as copies from hashes
where content_hash not in (select content_hash from cached where model_version = '{MODEL}')
group by content_hash"""

CTE["answers"] = f"""
select feedback_id, {words(ANSWER_SENTIMENTS)}[n % 5 + 1] as sentiment, conf as sentiment_confidence,
  case when n % 7 = 0 then []::varchar[] else [{words(THEMES)}[n % 8 + 1], 'bogus',
    {words(THEMES)}[n % 3 + 1], {words(THEMES)}[n % 8 + 1]] end as themes,
  case when n % 2 = 0 then {words(f'p{i}' for i in range(1, 13))} else ['one'] end as product_mentions,
  []::varchar[] as competitor_mentions,
  case n % 4 when 0 then null when 1 then '' else ' EN-Latn-GBX ' end as language,
  case when n % 2 = 0 then '  ' || repeat('ref ', 60) end as campaign_reference,
  {words(ANSWER_CAMPAIGNS)}[n % 6 + 1] as resolved_campaign_id,
  conf as resolution_confidence, n
from (select feedback_id, length(review_text) as n,
        {words(ANSWER_CONFIDENCES)}[length(review_text) % 6 + 1] as conf from feedback)"""

CLAMPED = "greatest(0.0::double, least(1.0::double, coalesce(try_cast({0} as double), 0.0::double)))"
CTE["normalized"] = f"""
select feedback_id,
  case when sentiment in {among(SENTIMENTS)} then sentiment else 'neutral' end as sentiment,
  {CLAMPED.format('sentiment_confidence')} as sentiment_confidence,
  case when len(kept) = 0 then ['other'] else kept end as themes,
  product_mentions[1:10] as product_mentions, competitor_mentions[1:10] as competitor_mentions,
  left(lower({strip("coalesce(nullif(language, ''), 'und')")}), 10) as language,
  left({strip('campaign_reference')}, 200) as campaign_reference,
  case when known then rid else '' end as resolved_campaign_id,
  case when known then {CLAMPED.format('resolution_confidence')} else 0.0::double end as resolution_confidence,
  n
from (select *, {strip('resolved_campaign_id')} as rid,
        {strip('resolved_campaign_id')} in (select campaign_id from catalog) as known,
        list_sort(list_distinct([t for t in themes if t in {among(THEMES)}])) as kept
      from answers)"""

CTE["new_records"] = f"""
select m.content_hash, '{MODEL}' as model_version, a.* exclude (feedback_id, n),
from missing m join normalized a using (feedback_id) where a.n % 17 <> 0"""

CTE["updated"] = f"""
select c.* from cached c where not exists (
  select 1 from new_records r where r.content_hash = c.content_hash and r.model_version = c.model_version)
union all by name select * from new_records"""
CTE["best_updated"] = best("updated", MODEL)

DAY = "timestamp '2024-01-01' + to_days(cast(cast(feedback_id[4:] as bigint) % 28 as integer))"
CTE["daily_facts"] = f"select * replace ({DAY} as _enriched_at) from facts"
CTE["loaded"] = f"select * from daily_facts where _enriched_at < timestamp '{BATCH_DAY}' and language <> 'es'"
CTE["resent"] = """
select * replace (
  case when sentiment = 'mixed' then _enriched_at + interval 40 day else _enriched_at end as _enriched_at,
  case when sentiment = 'mixed' then 'positive' else sentiment end as sentiment)
from daily_facts"""
CTE["increment"] = "select * from resent where _enriched_at > (select max(_enriched_at) from loaded)"
CTE["merged"] = """
select * from loaded where feedback_id not in (select feedback_id from increment)
union all select * from increment"""

CTE["events_loaded"] = f"""
select event_id, ts, user_id, event_type, value from events
where ts < timestamp '{BATCH_DAY}' and event_type <> 'error'"""
CTE["events_increment"] = """
select * from (
  select event_id, case when event_type = 'view' then ts + interval 40 day else ts end as ts,
    user_id, event_type, case when event_type = 'view' then value + 1000.0 else value end as value
  from events)
where ts > (select max(ts) from events_loaded)"""

CHECKED = ", ".join(SNAPSHOT_CHECKS)
CTE["run_1"] = f"select feedback_id, {CHECKED} from enriched_old where language <> 'fr'"
CTE["run_2"] = f"select feedback_id, {CHECKED} from enriched where language <> 'de'"
SAME = " and ".join(f"r.{c} is not distinct from o.{c}" for c in SNAPSHOT_CHECKS)
CTE["opened"] = f"""
select r.* from run_2 r left join run_1 o using (feedback_id)
where o.feedback_id is null or not ({SAME})"""
CTE["history"] = f"""
select o.*, timestamp '{RUNS[0]}' as valid_from,
  case when n.feedback_id is null then null else timestamp '{RUNS[1]}' end as valid_to
from run_1 o left join opened n on n.feedback_id = o.feedback_id
union all
select *, timestamp '{RUNS[1]}', cast(null as timestamp) from opened"""
CTE["history_keyed"] = f"""
select *, {key('feedback_id', 'valid_from')} as version_key, valid_to is null as is_current from history"""


def sql(body: str) -> str:
    """The query with the expressions it needs, dependencies first."""
    needed: set[str] = set()

    def add(part: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b(from|join) {name}\b", part):
                needed.add(name)
                add(CTE[name])

    add(body)
    parts = [f"{name} as ({CTE[name]})" for name in CTE if name in needed]
    if parts and body.lstrip().startswith("with "):
        body = ", " + body.lstrip()[5:]
    return ("with " + ",\n".join(parts) if parts else "") + "\n" + body


def as_json(columns=("themes", "product_mentions", "competitor_mentions")) -> str:
    return "replace (" + ", ".join(f"cast(to_json({c}) as varchar) as {c}" for c in columns) + ")"


DOUBLES = "replace (cast(spend as double) as spend, cast(conversion_value as double) as conversion_value{0})"
CPC = ", cast(cpc as double) as cpc"

TABLE_SQL = {
    **{f"raw.{t}": f"ads where channel = '{CHANNEL_OF_FLAG[FLAG_OF[t]]}'" for t in AD_TABLES},
    "raw.customer_feedback": "feedback",
    "raw.feedback_enriched": "enriched",
    **{f"staging.stg_{t}": f"ads_staged where channel = '{CHANNEL_OF_FLAG[FLAG_OF[t]]}'" for t in AD_TABLES},
    "staging.stg_customer_feedback": "feedback_staged",
    "staging.stg_feedback_enriched": "enriched_staged",
    "marts.fct_ad_spend": "ad_spend",
    "marts.fct_channel_daily": "channel_daily",
    "marts.fct_campaign_summary": "campaign_summary",
    "marts.dim_campaigns": "campaigns",
    "marts.fct_feedback": "facts",
    "marts.fct_feedback_themes": "themes",
    "marts.fct_campaign_performance": "performance",
}


def check_sql(c) -> str:
    rows = f"(select * from {TABLE_SQL[c.table]})"
    col = c.column
    if c.kind == "not_null":
        count = f"(select count(*) from {rows} where {col} is null)"
    elif c.kind == "unique":
        count = (f"(select count(*) from (select {col} from {rows} where {col} is not null "
                 f"group by {col} having count(*) > 1))")
    elif c.kind == "accepted_values":
        count = f"(select count(*) from {rows} where {col} not in {among(c.values)})"
    elif c.kind == "between":
        count = f"(select count(*) from {rows} where {col} < {c.low} or {col} > {c.high})"
    elif c.kind == "length_between":
        count = f"(select count(*) from {rows} where length({col}) not between {c.low} and {c.high})"
    else:
        parent = f"(select {c.parent_column} from {TABLE_SQL[c.parent]})"
        count = f"(select count(*) from {rows} where {col} is not null and {col} not in {parent})"
    return (f"select '{c.table}' as table_name, '{c.column}' as column_name, "
            f"'{c.kind}' as check_name, {count} as n_failed")


SCORED = """(select f.resolved_campaign_id as rid, s.true_campaign_id as label
  from facts f join feedback_staged s on s.feedback_id = f.feedback_id)"""
PRECISION = f"""select {div('count(*) filter (where rid = label)', 'count(*)')} as precision
from {SCORED} where rid is not null"""
RESOLVED = "resolved_campaign_id is not null"
SLICE = f"date between date '{SLICE_FROM}' and date '{SLICE_TO}'"

DIGITS = f"(select greatest(1, cast(ceil(log(count(*) / {100.0 * BATCH_SIZE}) / log(16)) as integer)) from missing)"

ORACLE: dict[str, str] = {
    "bronze_ads": f"select * exclude (_loaded_at) {DOUBLES.format(CPC)} from ads",
    "bronze_feedback": """
select feedback_id, nullif(posted_at, '') as posted_at, nullif(source, '') as source,
  nullif(rating, '') as rating, nullif(nullif(review_text, ''), 'NULL') as review_text,
  nullif(author, '') as author, nullif(true_campaign_id, '') as true_campaign_id
from feedback""",
    "cache_files_round_trip": f"""
select * {as_json()[:-1]},
  case when model_version = '{OLD_MODEL}' then 'mixed' else sentiment end as sentiment)
from cached""",
    **{
        f"stg_{t}": f"select * {DOUBLES.format(CPC)} from ads_staged where channel = '{CHANNEL_OF_FLAG[FLAG_OF[t]]}'"
        for t in AD_TABLES
    },
    "bronze_mixed_headers": f"select * exclude (_loaded_at) {DOUBLES.format(CPC)} from ads where channel = 'google_ads'",
    "bronze_loads": """
select unnest([0, 1, 2]) as step, n as landed, unnest([n, 2 * n, n]) as there
from (select count(*) as n from documents)""",
    "mart_export": "select * from channel_daily",
    "staged_view": "select source_channel, rating_value, count(*) as n from feedback_staged group by all",
    "catalog_pages": """
select cast((n - 1) // 4 as integer) as page, count(*) as n_lines, string_agg(line, chr(10) order by n) as page_text
from (select line, row_number() over (order by campaign_id, line) as n from (
  select campaign_id, '  - ' || campaign_id || ' | ' || campaign_name || ' | ' || channel || ' | ' || objective as line
  from catalog)) group by page""",
    "enrich_rerun_duplicates": "select * from enriched",
    "enrich_resumed": f"select * {as_json()} from new_records",
    "precision_gate_strict": f"select precision from ({PRECISION}) where precision < 1.01",
    "dq_failures": """
with bad as (
  select * replace (case when language = 'fr' then 'angry' else sentiment end as sentiment,
                    resolution_confidence + case when language = 'de' then 150.0 else 0.0 end as resolution_confidence)
  from facts),
twice as (select * from bad union all select * from bad where language = 'es'),
failures as (
  select 'unique' as check_name, 'feedback_id' as column_name, count(*) as n_failed
  from (select feedback_id from twice group by feedback_id having count(*) > 1)
  union all select 'accepted_values', 'sentiment', count(*) from twice
    where sentiment not in ('positive', 'negative', 'neutral', 'mixed')
  union all select 'between', 'resolution_confidence', count(*) from twice where resolution_confidence not between 0 and 1)
select 'marts.fct_feedback' as table_name, column_name, check_name, n_failed from failures where n_failed > 0""",
    "sentiment_mix_sliced": """
select resolved_campaign_id, sentiment, count(*) as n_feedback from facts
where posted_date between date '2024-02-01' and date '2024-09-30' and source_channel in ('meta', 'tiktok') group by all""",
    "stg_customer_feedback": "select * from feedback_staged",
    "channel_map": "select feedback_id, source_channel from feedback_staged",
    "date_parse": "select feedback_id, posted_date from feedback_staged",
    "rating_parse": "select feedback_id, rating_value from feedback_staged",
    "stg_feedback_enriched": "select * from enriched_staged",
    "hash_keys": "select feedback_id, content_hash from hashes",
    "enricher_rows": "select feedback_id, posted_at, source, rating, review_text from feedback",
    "enricher_first_rows": f"""
select feedback_id, posted_at, source, rating, review_text from feedback
order by feedback_id limit {FIRST_ROWS}""",
    "output_sample": f"""
select feedback_id, sentiment, sentiment_confidence, themes, language, resolved_campaign_id, resolution_confidence
from enriched order by feedback_id limit {FIRST_ROWS}""",
    "campaign_catalog": "select * from catalog order by campaign_id",
    "catalog_lines": """
select campaign_id, '  - ' || campaign_id || ' | ' || campaign_name || ' | ' || channel || ' | ' || objective as line
from catalog""",
    "catalog_text": """
select string_agg('  - ' || campaign_id || ' | ' || campaign_name || ' | ' || channel || ' | ' || objective,
  chr(10) order by campaign_id) as catalog_text
from catalog""",
    "cache_lookup": f"select * {as_json()} from best",
    "cache_misses": f"""
select feedback_id, content_hash from hashes
where content_hash not in (select content_hash from cached where model_version = '{MODEL}')""",
    "texts_to_enrich": "select content_hash, feedback_id, copies from missing",
    "batch_payload": f"""
select bucket, batch_no, count(*) as n_items,
  cast(to_json(list({{'feedback_id': feedback_id, 'source': source, 'rating': rating,
    'review_text': review_text}} order by feedback_id)) as varchar) as payload
from (select *, cast((row_number() over (partition by bucket order by feedback_id) - 1) // {BATCH_SIZE}
        as integer) as batch_no
      from (select f.*, md5(f.feedback_id)[1:{DIGITS}] as bucket
            from feedback f join missing m on m.feedback_id = f.feedback_id))
group by bucket, batch_no""",
    "response_parse": f"select * exclude (n) {as_json()} from answers",
    "enrich_normalize": f"select * exclude (n) {as_json()} from normalized",
    "enrich_new_texts": f"select * {as_json()} from new_records",
    "enrich_live": assembled("best_updated", MODEL, ENRICHED_AT),
    "enrich_assemble": "select * from enriched",
    "enrich_carry_forward": f"""
select e.feedback_id, e.model_version, e.content_hash,
  case when {' and '.join(f'e.{c} is not distinct from o.{c}' for c in [*RECORD_COLUMNS, 'model_version'])}
    then o._enriched_at else timestamp '2025-01-03' end as _enriched_at
from enriched e join enriched_old o on o.feedback_id = e.feedback_id""",
    "enrich_summary": f"""
select count(*) as feedback_rows,
  count(*) filter (where b.model_version = '{MODEL}') as cache_hits,
  count(*) filter (where b.model_version is distinct from '{MODEL}') as to_enrich,
  count(*) filter (where b.resolved_campaign_id <> '') as resolved_rows,
  count(*) filter (where b.model_version is null) as fallback_rows
from hashes h left join best b on b.content_hash = h.content_hash""",
    "fct_ad_spend": f"select * {DOUBLES.format('')} from ad_spend",
    "ad_spend_union": f"select * {DOUBLES.format('')} from ad_spend",
    "fct_channel_daily": "select * from channel_daily",
    "fct_campaign_summary": "select * from campaign_summary",
    "dim_campaigns": "select * from campaigns",
    "fct_feedback": "select * from facts",
    "fct_feedback_themes": "select * from themes",
    "fct_campaign_performance": "select * from performance",
    "feedback_incremental": "select * from merged",
    "feedback_incremental_log": "select * from merged",
    "events_incremental": """
select * from events_loaded where event_id not in (select event_id from events_increment)
union all select * from events_increment""",
    "scd2_snapshot": "select * from history_keyed",
    "scd2_changes": f"""
select r.feedback_id, timestamp '{RUNS[1]}' as changed_at,
  {', '.join(f'o.{c} as old_{c}, r.{c} as new_{c}' for c in SNAPSHOT_CHECKS)}
from opened r join run_1 o on o.feedback_id = r.feedback_id""",
    "scd2_asof": f"""
select feedback_id, {CHECKED}, valid_from from history
where valid_from <= timestamp '2025-01-02 12:00:00'
  and (valid_to is null or valid_to > timestamp '2025-01-02 12:00:00')""",
    "dq_report": "\nunion all ".join(check_sql(c) for c in checks.DECLARED),
    "resolution_precision": PRECISION,
    "precision_gate": f"select precision from ({PRECISION}) where precision < 0.8",
    "resolution_quality": f"""
select count(*) as n_rows,
  {div('count(*) filter (where rid is not distinct from label)', 'count(*)', 6)} as exact_match,
  {div('count(*) filter (where rid = label)', 'count(rid)', 6)} as precision,
  {div('count(*) filter (where rid is null and label is null)', 'count(*) filter (where label is null)', 6)} as specificity,
  count(*) filter (where rid not in (select campaign_id from campaigns)) as hallucinated_ids
from {SCORED}""",
    "unknown_campaigns": """
select resolved_campaign_id, count(*) as n_rows from facts
where resolved_campaign_id not in (select campaign_id from campaigns)
group by resolved_campaign_id""",
    "duplicate_texts": """
select content_hash, count(*) as n_rows from hashes group by content_hash having count(*) > 1""",
    "duplicates_across_loads": """
with cut as (select content_hash, cast(substr(feedback_id, 4) as bigint) % 3 > 0 as early from hashes)
select content_hash, count(*) as n_rows, content_hash in (select content_hash from cut where early) as seen_before
from cut where not early group by content_hash
having count(*) > 1 or content_hash in (select content_hash from cut where early)""",
    "spend_vs_sentiment": f"""
select campaign_id, campaign_name, channel, total_spend, net_sentiment_score, feedback_count,
  coalesce(total_spend >= {HIGH_SPEND} and net_sentiment_score < 0, false) as costly_and_negative
from performance order by total_spend desc, campaign_id""",
    "sentiment_mix": f"""
select campaign_id, feedback_count,
  {', '.join(div(f'{s}_count', 'feedback_count', 6) + f' as {s}_share' for s in SENTIMENTS)}
from performance""",
    "theme_counts": """
select t.theme, f.resolved_campaign_id, f.sentiment, count(*) as n_feedback
from themes t join facts f on f.feedback_id = t.feedback_id
group by t.theme, f.resolved_campaign_id, f.sentiment""",
    "top_themes": f"""
select t.theme, count(*) as n_feedback
from themes t join facts f on f.feedback_id = t.feedback_id
where f.sentiment = 'negative' group by t.theme order by n_feedback desc, t.theme limit {TOP_THEMES}""",
    "language_split": f"""
select language, count(*) as n_feedback,
  {div('count(*)', '(select count(*) from facts)', 6)} as share
from facts group by language""",
    "resolution_confidence": f"""
select count(*) as n_resolved, {exact('resolution_confidence', 4)} as avg_confidence,
  min(resolution_confidence) as min_confidence, max(resolution_confidence) as max_confidence
from facts where {RESOLVED}""",
    "resolved_share": f"""
select count(*) as n_feedback, count(*) filter (where {RESOLVED}) as n_resolved,
  {div(f'count(*) filter (where {RESOLVED})', 'count(*)', 6)} as resolved_share,
  {exact(f'(case when {RESOLVED} then resolution_confidence end)', 4)} as avg_confidence
from facts""",
    "channel_trend_sliced": f"select * from channel_daily where {SLICE} and channel in ('meta', 'tiktok')",
    "ad_detail_sliced": f"""
select * {DOUBLES.format('')} from ad_spend where {SLICE} and channel = 'google_ads'""",
    "campaign_kpis_sliced": SUMMARY.format(
        f"(select * from ad_spend where {SLICE} and campaign_id in ('mt-c1', 'tk-c3'))"
    ),
}

IN_SLICE = "(select * from facts where posted_date between date '2024-02-01' and date '2024-09-30' and source_channel in ('meta', 'tiktok'))"
ORACLE |= {
    f"{name}_sliced": ORACLE[whole].replace("from facts", f"from {IN_SLICE}").replace("join facts", f"join {IN_SLICE}")
    for name, whole in {
        "language_split": "language_split", "theme_counts": "theme_counts", "confidence": "resolution_confidence",
    }.items()
}

# Kept by increments, equal to the rebuild.
ORACLE |= {
    "summary_after_increment": ORACLE["fct_campaign_summary"],
    "performance_after_increment": ORACLE["fct_campaign_performance"],
    "language_after_increment": ORACLE["language_split"],
    "resolved_share_after_increment": ORACLE["resolved_share"],
    "confidence_after_increment": ORACLE["resolution_confidence"],
    "themes_after_increment": ORACLE["theme_counts"],
    "scd2_by_log": ORACLE["scd2_snapshot"],
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in ORACLE.items()}
