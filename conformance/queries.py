"""Every query with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import adapter as A
from conformance import landing as L
from conformance.oracle import with_parts
from stratalake import Lake, run_folder, watermark
from stratalake import schemas as S
from stratalake.functions import safe_date, safe_decimal, safe_int, safe_timestamp
from stratalake.keyed import BUCKET, FOLDER
from stratalake.operators import (
    frequent_keys, insert_only, keys_to_spread, latest_by, page, pages, unmatched, upsert,
)
from stratalake.plans import (
    SILVER_MODELS, audit_frame, bronze_table, build_models, build_silver, claims_enriched, load_batch, load_changed_table,
    load_pharmacy_drops, member_360, publish_views, read_bronze, refresh, schema_versions,
)
from stratalake.session import empty_frame
from stratalake.sources import as_text, broken_pages, changed_since, event_pages, events_since, split_incomplete
from stratalake.streaming import follow_pharmacy_drops

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return register


# -- silver and gold ----------------------------------------------------------

BRONZE_OF = {
    "silver_medical_claims": A.dealt_medical_claims,
    "silver_members": A.bronze_members,
    "silver_providers": A.bronze_providers,
    "silver_pharmacy_claims": A.bronze_pharmacy_claims,
    "silver_enrollment_events": A.bronze_enrollment_events,
}
#: What bronze rows have been dealt out by, if all rows of a key share it.
DEALT_BY = {"silver_medical_claims": A.CLAIM_ORDER}


def silver(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(name, BRONZE_OF[name](spark, sf_dir), DEALT_BY.get(name))


for _name in SILVER_MODELS:
    QUERIES[_name] = lambda spark, sf_dir, _name=_name: silver(_name, spark, sf_dir)
    ORACLE[_name] = with_parts(f"select * from {_name}", _name)


@query(with_parts("select * from gold_claims_enriched", "gold_claims_enriched"))
def gold_claims_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = A.dealt_medical_claims(spark, sf_dir)
    members, providers = silver("silver_members", spark, sf_dir), silver("silver_providers", spark, sf_dir)
    frequent = keys_to_spread(bronze, {"member_id": members, "provider_id": providers})
    return claims_enriched(build_silver("silver_medical_claims", bronze, A.CLAIM_ORDER), members, providers, frequent)


_ONE_MEMBER = """
  select * replace (case when cast(split_part(claim_id, '-', 1) as bigint) %% 3 = 0 then '1' else member_id end as member_id)
  from (%s)"""


@query(with_parts(
    "select * from gold_claims_enriched", "gold_claims_enriched", replace={"bronze_medical_claims": _ONE_MEMBER},
))
def gold_claims_enriched_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the claims are one member's: their rows, and those of other frequent keys, are salted."""
    one = F.split("claim_id", "-")[0].cast("long") % 3 == 0
    bronze = A.dealt_medical_claims(spark, sf_dir).withColumn("member_id", F.when(one, "1").otherwise(F.col("member_id")))
    members, providers = silver("silver_members", spark, sf_dir), silver("silver_providers", spark, sf_dir)
    frequent = frequent_keys(bronze, ["member_id", "provider_id"])
    return claims_enriched(build_silver("silver_medical_claims", bronze, A.CLAIM_ORDER), members, providers, frequent)


@query(with_parts("select * from gold_member_360", "gold_member_360"))
def gold_member_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_360(
        silver("silver_members", spark, sf_dir), silver("silver_medical_claims", spark, sf_dir),
        silver("silver_pharmacy_claims", spark, sf_dir), silver("silver_enrollment_events", spark, sf_dir),
    )


@query(with_parts(
    """select case when pharmacy_npi is null then 'v1 (no npi)' else 'v2 (has npi)' end as schema_version,
         count(*) as row_count from bronze_pharmacy_claims group by 1""",
    "bronze_pharmacy_claims",
))
def schema_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_versions(A.bronze_pharmacy_claims(spark, sf_dir))


# -- casts --------------------------------------------------------------------

@query(r"""
  with raw as (
    select o_orderkey,
      case o_orderpriority when '1-URGENT' then '30.6' when '2-HIGH' then ' 45 ' when '3-MEDIUM' then '1e2'
        when '4-NOT SPECIFIED' then '' else cast(o_orderkey as varchar) || '.49999999' end as whole,
      case o_orderstatus when 'F' then cast(cast(o_totalprice as decimal(12,2)) as varchar) || '5'
        when 'P' then cast(o_custkey as varchar) || '00000000' else 'x' end as amount,
      case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y-%m')
        when '2-HIGH' then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.1234567'
        when '3-MEDIUM' then strftime(o_orderdate, '%Y-13-%d') when '5-LOW' then strftime(o_orderdate, '%Y%m%d')
        else case when o_orderkey % 9 < 7 then strftime(o_orderdate, '%Y-%m-%d') || [' garbage', 'Tgarbage', ' 25:99:99', 'T10:00:00Z',
          'T10:00:00+05:00', ' 10:00:00 x', 'x'][o_orderkey % 9 + 1]
        when o_orderkey % 9 = 7 then '1' || strftime(o_orderdate, '%Y-%m-%d')
        else strftime(o_orderdate, '%Y-%m-%d %H:%M') end end as moment
    from orders),
  -- a date, and a time if anything follows; what is written counts, whatever the zone
  parts as (
    select *, regexp_extract(moment, '^(\d{4}-\d{2}-\d{2})(?:[ T](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)(?:Z|[+-]\d{2}:\d{2})?)?$',
      ['day', 'time']) as p from raw),
  moments as (
    select *, try_cast(case when p.time = '' then p.day else p.day || ' ' || p.time end as timestamp) as seen from parts)
  select o_orderkey, try_cast(whole as bigint) as whole, try_cast(amount as decimal(10,2)) as amount,
    seen as moment, cast(seen as date) as day from moments
""")
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, status, day = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderdate")
    ninth = (F.col("o_orderkey") % 9).cast("int")
    raw = A.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", "30.6").when(priority == "2-HIGH", " 45 ").when(priority == "3-MEDIUM", "1e2")
        .when(priority == "4-NOT SPECIFIED", "").otherwise(F.concat("o_orderkey", F.lit(".49999999"))).alias("whole"),
        F.when(status == "F", F.concat(F.col("o_totalprice").cast("decimal(12,2)"), F.lit("5")))
        .when(status == "P", F.concat("o_custkey", F.lit("00000000"))).otherwise("x").alias("amount"),
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM"))
        .when(priority == "2-HIGH", F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".1234567")))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy-'13'-dd"))
        .when(priority == "5-LOW", F.date_format(day, "yyyyMMdd"))
        .when(ninth < 7, F.concat(F.date_format(day, "yyyy-MM-dd"), F.element_at(F.array(*[F.lit(x) for x in (
            " garbage", "Tgarbage", " 25:99:99", "T10:00:00Z", "T10:00:00+05:00", " 10:00:00 x", "x")]), ninth + 1)))
        .when(ninth == 7, F.date_format(day, "'1'yyyy-MM-dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm")).alias("moment"),
    )
    return raw.select(
        "o_orderkey", safe_int("whole").alias("whole"), safe_decimal("amount", 10, 2).alias("amount"),
        safe_timestamp("moment").alias("moment"), safe_date("moment").alias("day"),
    )


# -- one row per key ----------------------------------------------------------

_EVENT_TIES = "member_id nulls last, event_type nulls last, plan_code nulls last, event_time nulls last"
_DROP_TIES = (
    "member_id nulls last, ndc_code nulls last, drug_name nulls last, quantity nulls last, days_supply nulls last, "
    "ingredient_cost nulls last, copay_amount nulls last, pharmacy_npi nulls last"
)


@query(with_parts(
    f"""select event_id, member_id, event_type, plan_code, event_time, created_at from bronze_enrollment_events
        qualify row_number() over (partition by event_id order by created_at desc nulls first, {_EVENT_TIES}) = 1""",
    "bronze_enrollment_events",
))
def latest_by_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(L.event_feed(spark, sf_dir), ["event_id"], "created_at")


@query(with_parts(
    f"""select * exclude (_loaded_at) from bronze_pharmacy_claims
        qualify row_number() over (partition by claim_id, _source_file order by fill_time nulls last, {_DROP_TIES}) = 1""",
    "bronze_pharmacy_claims",
))
def latest_by_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(A.pharmacy_drop_rows(spark, sf_dir), S.PHARMACY_CLAIMS.key, "fill_time", newest=False)


# -- merges -------------------------------------------------------------------

#: The second run's time; the first saw what was recorded before it.
RUN_TIME = "2024-01-15T00:00:00"
SINCE = "2024-01-14T18:00:00"


def _first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    recorded = safe_timestamp("created_at") < F.lit(RUN_TIME).cast("timestamp_ntz")
    return latest_by(L.event_feed(spark, sf_dir).where(recorded), ["event_id"], "created_at")


def _second_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pulled with the lookback, so it overlaps the first run; marked to tell its rows apart."""
    marked = L.event_feed(spark, sf_dir).withColumn("plan_code", F.concat(F.lit("RUN2_"), F.col("plan_code")))
    return events_since(marked, SINCE)


_RUNS = f"""
  feed as (select event_id, member_id, event_type, plan_code, event_time, created_at from bronze_enrollment_events),
  target as (select * from feed where cast(created_at as timestamp) < timestamp '{RUN_TIME}'
    qualify row_number() over (partition by event_id order by created_at desc nulls first, {_EVENT_TIES}) = 1),
  pulled as (select * replace ('RUN2_' || plan_code as plan_code) from feed
    where cast(event_time as timestamp) >= timestamp '{SINCE}'),
  batch as (select * from pulled
    qualify row_number() over (partition by event_id order by created_at desc nulls first, {_EVENT_TIES}) = 1)"""


def _with_runs(body: str) -> str:
    return with_parts(f",{_RUNS}\n{body}", "bronze_enrollment_events")


_INSERTED = """select * from target union all
  select * from batch where event_id not in (select event_id from target)"""


@query(_with_runs(_INSERTED))
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = latest_by(_second_pull(spark, sf_dir), ["event_id"], "created_at")
    return insert_only(_first_run(spark, sf_dir), batch, ["event_id"])


@query(_with_runs(_INSERTED))
def merge_twice_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = latest_by(_second_pull(spark, sf_dir), ["event_id"], "created_at")
    once = insert_only(_first_run(spark, sf_dir), batch, ["event_id"])
    return insert_only(once, batch, ["event_id"])


@query(_with_runs("""
  select batch.*, cast(event_time as timestamp) < (select max(cast(event_time as timestamp)) from target) as late
  from batch where event_id not in (select event_id from target)"""))
def late_event_repull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second pull adds, and which of it happened before the first run's watermark."""
    target = _first_run(spark, sf_dir)
    mark = watermark.newest(target, "events", "event_time").first()["last_watermark"]
    batch = latest_by(_second_pull(spark, sf_dir), ["event_id"], "created_at")
    late = safe_timestamp("event_time") < F.lit(mark).cast("timestamp_ntz")
    return unmatched(batch, target, ["event_id"]).withColumn("late", late)


_RESENT_FROM, _LOADED_TO = "pharmacy_claims_19980101_00.csv", "pharmacy_claims_19990101_00.csv"


@query(with_parts(
    f"""select * from (select * exclude (_loaded_at) from bronze_pharmacy_claims where _source_file < '{_LOADED_TO}'
        qualify row_number() over (partition by claim_id, _source_file order by fill_time nulls last, {_DROP_TIES}) = 1)
      union all
      select * from (select * exclude (_loaded_at) replace ('9.9' as copay_amount) from bronze_pharmacy_claims
        where _source_file >= '{_RESENT_FROM}'
        qualify row_number() over (partition by claim_id, _source_file order by fill_time nulls last, {_DROP_TIES}) = 1)
      where (claim_id, _source_file) not in
        (select (claim_id, _source_file) from bronze_pharmacy_claims where _source_file < '{_LOADED_TO}')""",
    "bronze_pharmacy_claims",
))
def merge_insert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of drops arrives again with other copays: only claims new to their drop are added."""
    key = S.PHARMACY_CLAIMS.key
    rows = A.pharmacy_drop_rows(spark, sf_dir)
    target = latest_by(rows.where(F.col("_source_file") < _LOADED_TO), key, "fill_time", newest=False)
    again = rows.where(F.col("_source_file") >= _RESENT_FROM).withColumn("copay_amount", F.lit("9.9"))
    return insert_only(target, latest_by(again, key, "fill_time", newest=False), key)


@query(with_parts(
    """select f.member_id, f.first_name, f.last_name, f.date_of_birth, f.gender,
         coalesce(c.plan_code, f.plan_code) as plan_code, f.state_code, f.effective_date, f.created_at,
         coalesce(c.updated_at, f.updated_at) as updated_at,
         case when f.last_name = 'BUILDING' then timestamp '2026-07-02 00:00:00' else f._loaded_at end as _loaded_at
       from members_first f left join members_changed c using (member_id)""",
    "members_changed",
))
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One segment joins with the second load, which also brings plan changes; the first load time stays."""
    first, later = A.members_first(spark, sf_dir), F.lit(A.SECOND_LOAD).cast("timestamp_ntz")
    target = first.where("last_name <> 'BUILDING'")
    joining = first.where("last_name = 'BUILDING'").withColumn("_loaded_at", later)
    batch = latest_by(joining.unionByName(A.members_changed(spark, sf_dir)), ["member_id"], "updated_at")
    return upsert(target, batch, ["member_id"], keep=["_loaded_at"])


def _loaded_in_parts(lake: Lake, first: DataFrame, parts: int) -> None:
    """The first run as so many loads."""
    for part in range(parts):
        load_batch(lake, S.ENROLLMENT_EVENTS, first.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == part), f"run1-{part}")


@query(_with_runs(f"""
  select 'after' as seen, count(*) as n, count(distinct event_id) as keys, count(*) filter (plan_code like 'RUN2_%') as later from ({_INSERTED})
  union all select 'meanwhile', count(*), count(distinct event_id), 0 from target"""))
def merge_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load dies with half of its files written: readers see the rows before it, and the load that follows adds each row once."""
    lake, spec = Lake(spark, run_folder(spark, "merge_failure")), S.ENROLLMENT_EVENTS
    pulled = _second_pull(spark, sf_dir)
    _loaded_in_parts(lake, _first_run(spark, sf_dir), 1)
    table = bronze_table(lake, spec)
    half = pulled.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0).withColumn("_loaded_at", F.localtimestamp())
    half.withColumn(BUCKET, table.bucket(lake.buckets)).write.partitionBy(BUCKET).parquet(f"{table.data}/{FOLDER}=wdead")

    def seen(rows: DataFrame, when: str) -> DataFrame:
        return rows.agg(
            F.lit(when).alias("seen"), F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("keys"),
            F.count_if(F.col("plan_code").startswith("RUN2_")).alias("later"))

    meanwhile = seen(read_bronze(lake, spec), "meanwhile")
    load_batch(lake, spec, pulled, "run2")
    return meanwhile.union(seen(read_bronze(lake, spec), "after"))


@query(_with_runs(_INSERTED))
def merge_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run comes in four loads, which are put together, in more buckets too; the second pull merges into what that leaves."""
    lake, spec = Lake(spark, run_folder(spark, "merge_compaction")), S.ENROLLMENT_EVENTS
    _loaded_in_parts(lake, _first_run(spark, sf_dir), 4)
    table = bronze_table(lake, spec)
    if not (table.compact() and table.compact(buckets=24)) or len(table.snapshot().parts) != 1:
        raise RuntimeError("the loads are not one folder")
    load_batch(lake, spec, _second_pull(spark, sf_dir), "run2")
    return read_bronze(lake, spec).drop("_loaded_at")


# -- watermarks and incremental scans -------------------------------------------

@query(with_parts(
    f""", seen as (
         select 'enrollment_api' as source_name, try_cast(event_time as timestamp) as t from bronze_enrollment_events
           where cast(created_at as timestamp) < timestamp '{RUN_TIME}'
         union all select 'sqlserver_members', try_cast(updated_at as timestamp) from bronze_members
         union all select 'sqlserver_providers', try_cast(updated_at as timestamp) from bronze_providers
         union all select 'sqlserver_medical_claims', try_cast(updated_at as timestamp) from bronze_medical_claims)
       select source_name, strftime(max(t), '%Y-%m-%dT%H:%M:%S.%f') as last_watermark from seen group by 1""",
    "bronze_enrollment_events", "bronze_members", "bronze_providers", "bronze_medical_claims",
))
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: first loads, an older re-pull that must not move anything back, later loads."""
    feed = L.event_feed(spark, sf_dir)
    recorded = safe_timestamp("created_at") < F.lit(RUN_TIME).cast("timestamp_ntz")
    older = safe_timestamp("event_time") < F.lit("2024-01-10").cast("timestamp_ntz")
    api, sql = S.ENROLLMENT_EVENTS.source_name, "updated_at"

    def seen(*pulls):
        frames = [watermark.newest(df, source, column) for df, source, column in pulls]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    state = empty_frame(spark, S.WATERMARK_SCHEMA)
    for run in (
        seen((feed.where(recorded), api, "event_time"), (A.members_first(spark, sf_dir), S.MEMBERS.source_name, sql)),
        seen((feed.where(older), api, "event_time")),
        seen(
            (A.members_changed(spark, sf_dir), S.MEMBERS.source_name, sql),
            (A.bronze_providers(spark, sf_dir), S.PROVIDERS.source_name, sql),
            (A.bronze_medical_claims(spark, sf_dir), S.MEDICAL_CLAIMS.source_name, sql),
        ),
    ):
        state = watermark.advance(state, run)
    return state.drop("updated_at")


_CHANGED_AFTER = "1998-07-01T00:00:00"


@query(f"""
  select cast(l_suppkey as varchar) as provider_id, l_returnflag as provider_name, cast(l_partkey as varchar) as npi,
    l_linestatus as specialty, cast(l_linenumber as varchar) as state_code,
    cast(l_shipdate as varchar) as created_at, cast(l_shipdate as varchar) as updated_at
  from lineitem where l_shipdate > timestamp '{_CHANGED_AFTER}'
""")
def incremental_scan_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at the watermark itself are not pulled again; values become text."""
    source = A.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("provider_id"), F.col("l_returnflag").alias("provider_name"),
        F.col("l_partkey").alias("npi"), F.col("l_linestatus").alias("specialty"),
        F.col("l_linenumber").alias("state_code"),
        F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("updated_at"),
    )
    return as_text(changed_since(source, S.PROVIDERS, _CHANGED_AFTER))


@query(_with_runs("""
  select feed.* from feed where cast(event_time as timestamp) >=
    (select max(cast(event_time as timestamp)) - interval 6 hours from target)"""))
def event_scan_inclusive_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = S.ENROLLMENT_EVENTS.source_name
    seen = watermark.newest(_first_run(spark, sf_dir), source, "event_time")
    since = watermark.since_frame(seen, source, S.EVENT_LOOKBACK).first()["since"]
    return events_since(L.event_feed(spark, sf_dir), since)


# -- files and pages -------------------------------------------------------------

_BRONZE_DROPS = with_parts(
    f"""select * exclude (_loaded_at) from bronze_pharmacy_claims
        qualify row_number() over (partition by claim_id, _source_file order by fill_time nulls last, {_DROP_TIES}) = 1""",
    "bronze_pharmacy_claims",
)


@query(_BRONZE_DROPS)
def csv_drift_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine- and ten-column CSV drops, loaded twice."""
    root = run_folder(spark, "csv_drift")
    lake = Lake(spark, f"{root}/lake")
    L.write_csv_drops(spark, sf_dir, f"{root}/drops")
    load_pharmacy_drops(lake, f"{root}/drops", "first", A.FIRST_LOAD)
    load_pharmacy_drops(lake, f"{root}/drops", "second", A.SECOND_LOAD)
    return read_bronze(lake, S.PHARMACY_CLAIMS).drop("_loaded_at")


@query(_BRONZE_DROPS)
def stream_file_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same drops followed as a stream of several micro-batches."""
    root = run_folder(spark, "stream_merge")
    lake = Lake(spark, f"{root}/lake")
    L.write_csv_drops(spark, sf_dir, f"{root}/drops")
    stream = follow_pharmacy_drops(
        lake, f"{root}/drops", f"{root}/checkpoint", files_per_batch=400, loaded_at=A.FIRST_LOAD
    )
    stream.awaitTermination()
    return read_bronze(lake, S.PHARMACY_CLAIMS).drop("_loaded_at")


@query(_BRONZE_DROPS)
def stream_dedup_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drops are sent twice and followed; rows read within the last hour go before the merge."""
    root = run_folder(spark, "stream_prefilter")
    lake, audits = Lake(spark, f"{root}/lake"), []
    for _ in range(2):
        L.write_csv_drops(spark, sf_dir, f"{root}/drops")
        follow_pharmacy_drops(lake, f"{root}/drops", f"{root}/checkpoint", loaded_at=A.FIRST_LOAD, audits=audits, full_audit=False,
                              repeats_within="1 hour").awaitTermination()
    if sum(a.rows_in for a in audits[1:]):
        raise RuntimeError("rows read before have reached the merge")
    return read_bronze(lake, S.PHARMACY_CLAIMS).drop("_loaded_at")


_TEXTS = """select *, ['plain', 'a, b', 'say "x"', 'two' || chr(10) || 'lines', chr(10) || '"', 'x"' || chr(10) || '", y'][o_orderkey % 6 + 1] as odd from orders"""


def _odd_text(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in ("plain", "a, b", 'say "x"', "two\nlines", '\n"', 'x"\n", y')]), (key % 6 + 1).cast("int"))


@query(f"select 'RX' || o_orderkey as claim_id, cast(o_custkey as varchar) as member_id, odd as drug_name, 'drop.csv' as _source_file from ({_TEXTS})")
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with commas, quotes and line breaks."""
    root = run_folder(spark, "quoted_breaks")
    lake = Lake(spark, f"{root}/lake")
    A.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("RX"), F.col("o_orderkey")).alias("claim_id"), F.col("o_custkey").alias("member_id"), F.lit("1").alias("ndc_code"),
        _odd_text(F.col("o_orderkey")).alias("drug_name"),
    ).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/drops/drop.csv")
    audit = load_pharmacy_drops(lake, f"{root}/drops", "first", line_breaks=True)
    if audit.rows_incomplete:
        raise RuntimeError("whole records were set aside")
    return read_bronze(lake, S.PHARMACY_CLAIMS).select("claim_id", "member_id", "drug_name", S.SOURCE_FILE)


@query("""select 'RX' || o_orderkey as claim_id, cast(o_custkey as varchar) as member_id, case when o_orderkey % 2 = 0 then o_orderpriority end as drug_name,
    case when o_orderkey % 2 = 0 then 'even.csv' else 'odd.csv' end as _source_file from orders""")
def csv_permuted_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops with columns in another order, columns left out and columns of their own, taken by name."""
    root = run_folder(spark, "permuted_headers")
    lake = Lake(spark, f"{root}/lake")
    orders = A.table(spark, sf_dir, "orders")
    claim, member = F.concat(F.lit("RX"), F.col("o_orderkey")).alias("claim_id"), F.col("o_custkey").alias("member_id")
    for name, rest, columns in (("even", 0, [F.col("o_orderpriority").alias("drug_name"), member, claim]),
                                ("odd", 1, [F.lit("x").alias("other"), claim, member])):
        orders.where(F.col("o_orderkey") % 2 == rest).select(*columns).write.option("header", True).csv(f"{root}/drops/{name}.csv")
    load_pharmacy_drops(lake, f"{root}/drops", "first", by_name=True)
    return read_bronze(lake, S.PHARMACY_CLAIMS).select("claim_id", "member_id", "drug_name", S.SOURCE_FILE)


@query(with_parts(
    """select claim_id, _source_file,
         'pharmacy_npi' as missing from bronze_pharmacy_claims where pharmacy_npi is null""",
    "bronze_pharmacy_claims",
))
def incomplete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = A.pharmacy_drop_rows(spark, sf_dir)
    _, incomplete = split_incomplete(drops, ["claim_id", "copay_amount", "pharmacy_npi"])
    return incomplete.select("claim_id", "_source_file", F.array_join("missing", ",").alias("missing"))


@query(with_parts(
    "select event_id, member_id, event_type, plan_code, event_time, created_at from bronze_enrollment_events",
    "bronze_enrollment_events",
))
def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed cut into pages, landed as JSON and read back as rows."""
    folder = f"{run_folder(spark, 'json_pages')}/pages"
    L.write_event_pages(spark, sf_dir, folder)
    return event_pages(spark, folder)


_PAGED = """, placed as (
    select *, row_number() over (order by created_at, event_id, plan_code) - 1 as position, count(*) over () as total
    from bronze_enrollment_events),
  landed as (select *, position // 500 %% 4 as kind, position // 500 as page from placed)
"""


@query(with_parts(
    (_PAGED + """
      select 'not a page in JSON' as reason, count(distinct page) as n from landed where kind = 0
      union all select 'no list of events', count(distinct page) from landed where kind = 1
      union all select 'not as many events as it says', count(distinct page) from landed where kind = 2
      union all select 'events read', count(*) from landed where kind > 1""").replace("%%", "%"),
    "bronze_enrollment_events",
))
def broken_event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which some are cut off, lack their list, or hold fewer events than they say."""
    folder = f"{run_folder(spark, 'broken_pages')}/pages"
    whole = pages(L.event_feed(spark, sf_dir), L.FEED_ORDER, L.PAGE_SIZE)
    kind, line = F.floor(F.col("cursor") / L.PAGE_SIZE) % 4, F.to_json(F.struct("data", "count", "total_matched", "next_cursor"))
    more = F.to_json(F.struct("data", (F.col("count") + 1).alias("count"), "total_matched", "next_cursor"))
    whole.select(
        F.when(kind == 0, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int")))
        .when(kind == 1, F.lit('{"data": null, "count": 5}')).when(kind == 2, more).otherwise(line).alias("value")
    ).write.text(folder)
    counts = broken_pages(spark, folder).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.union(event_pages(spark, folder).agg(F.lit("events read").alias("reason"), F.count(F.lit(1)).alias("n")))


@query(with_parts(
    f"""select event_id, member_id, event_type, plan_code,
         case when event_type = 'error' then 'noon' else event_time end as event_time, created_at
       from bronze_enrollment_events where event_type = 'error' or cast(event_time as timestamp) >= timestamp '{SINCE}'""",
    "bronze_enrollment_events",
))
def events_without_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose time cannot be read are pulled with those since the bound."""
    time = F.when(F.col("event_type") == "error", "noon").otherwise(F.col("event_time"))
    return events_since(L.event_feed(spark, sf_dir).withColumn("event_time", time), SINCE)


@query("""
  with feed as (select 'EV' || event_id as event_id, event_type, ts from events)
  select event_id from feed
  union all select 'FAR' where exists (select * from feed)""")
def watermark_future_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event dated 9999 comes between two loads: those after it are still pulled."""
    lake, spec = Lake(spark, run_folder(spark, "future_times")), S.ENROLLMENT_EVENTS
    rows = A.table(spark, sf_dir, "events").select(
        F.concat(F.lit("EV"), F.col("event_id")).alias("event_id"), F.col("user_id").cast("string").alias("member_id"),
        "event_type", F.lit("P").alias("plan_code"), F.col("ts").cast("string").alias("event_time"),
        F.col("ts").cast("string").alias("created_at"))
    far = rows.orderBy("event_id").limit(1).withColumns({"event_id": F.lit("FAR"), "event_time": F.lit("9999-12-31 00:00:00")})
    middle = rows.agg(F.expr("percentile_approx(timestamp(event_time), 0.5)").cast("timestamp_ntz").alias("t")).first()["t"]
    early = safe_timestamp("event_time") <= F.lit(middle)
    for load_id, part in (("1", rows.where(early)), ("2", far), ("3", rows.where(~early))):
        since = watermark.read_since(lake, spec.source_name, spec.lookback)
        load_batch(lake, spec, events_since(part, since), load_id, since=since)
    return read_bronze(lake, spec).select("event_id")


@query("""select 'RX' || o_orderkey as claim_id, d || '/x.csv' as _source_file from orders, (values ('d1'), ('d2')) t(d)""")
def same_name_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of one name in two folders are two sources: no claim of either is lost."""
    root = run_folder(spark, "same_name")
    rows = A.table(spark, sf_dir, "orders").select(F.concat(F.lit("RX"), F.col("o_orderkey")).alias("claim_id"))
    for folder in ("d1", "d2"):
        rows.write.option("header", True).csv(f"{root}/drops/{folder}/x.csv")
    lake = Lake(spark, f"{root}/lake")
    load_pharmacy_drops(lake, f"{root}/drops", "first", A.FIRST_LOAD)
    return read_bronze(lake, S.PHARMACY_CLAIMS).select("claim_id", "_source_file")


@query("""select cast(l_orderkey as varchar) as provider_id, l_returnflag as provider_name, cast(l_linenumber as varchar) as npi,
    l_linestatus as specialty, '' as state_code, '' as created_at, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as updated_at
  from lineitem where l_shipdate > timestamp '1998-07-01 00:00:00' and l_quantity <> 1
  union all select cast(l_orderkey as varchar), l_returnflag, cast(l_linenumber as varchar), l_linestatus, '', '', null
  from lineitem where l_quantity = 1""")
def table_pull_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update times as text, with a T, against a bound with a space; rows without one are pulled too."""
    lines = A.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("provider_id"), F.col("l_returnflag").alias("provider_name"),
        F.col("l_linenumber").cast("string").alias("npi"), F.col("l_linestatus").alias("specialty"),
        F.lit("").alias("state_code"), F.lit("").alias("created_at"),
        F.when(F.col("l_quantity") != 1, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("updated_at"),
    )
    return changed_since(lines, S.PROVIDERS, "1998-07-01 00:00:00")


_FEED = f"""select event_id, member_id, event_type, plan_code, event_time, created_at,
  row_number() over (order by created_at, event_id, plan_code) - 1 as position, count(*) over () as total
  from bronze_enrollment_events where cast(event_time as timestamp) >= timestamp '{{since}}'"""


def _feed_sql(since: str, body: str) -> str:
    return with_parts(f", feed as ({_FEED.format(since=since)})\n{body}", "bronze_enrollment_events")


@query(_feed_sql(SINCE, f"""
  select position - position % {L.PAGE_SIZE} as cursor, count(*) as count, max(total) as total_matched,
    case when position - position % {L.PAGE_SIZE} + {L.PAGE_SIZE} < max(total)
         then position - position % {L.PAGE_SIZE} + {L.PAGE_SIZE} end as next_cursor,
    min_by(event_id, position) as first_event, max_by(event_id, position) as last_event
  from feed group by position - position % {L.PAGE_SIZE}"""))
def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page of the filtered feed."""
    feed = events_since(L.event_feed(spark, sf_dir), SINCE)
    return pages(feed, L.FEED_ORDER, L.PAGE_SIZE).select(
        "cursor", "count", "total_matched", "next_cursor",
        F.element_at("data", 1)["event_id"].alias("first_event"),
        F.element_at("data", -1)["event_id"].alias("last_event"),
    )


_SLICE = "select event_id, member_id, event_type, plan_code, event_time, created_at from feed where position between {} and {}"


@query(_feed_sql("2024-01-01T00:00:00", _SLICE.format(500, 999)))
def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = events_since(L.event_feed(spark, sf_dir), "2024-01-01T00:00:00")
    return page(feed, L.FEED_ORDER, 500, 500)


@query(_feed_sql("2024-01-01T00:00:00", _SLICE.format(11000, 11499)))
def page_slice_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page too far in for a heap per task."""
    feed = events_since(L.event_feed(spark, sf_dir), "2024-01-01T00:00:00")
    return page(feed, L.FEED_ORDER, 11000, 500)


@query(with_parts("select * from silver_providers order by provider_id limit 5", "silver_providers"))
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(silver("silver_providers", spark, sf_dir), ["provider_id"], 0, 5)


# -- what loads leave behind ---------------------------------------------------------

@query("select 'RX' || o_orderkey as claim_id, o_orderpriority as drug_name, o_orderstatus as pharmacy_npi, 'drop.csv' as _source_file from orders")
def compressed_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop with surplus fields stands there plain and compressed, beside an empty folder: each claim is one row."""
    root = run_folder(spark, "compressed")
    lake = Lake(spark, f"{root}/lake")
    rows = A.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("RX"), F.col("o_orderkey")).alias("claim_id"),
        *[F.lit("1").alias(c) for c in ("member_id", "ndc_code")], F.col("o_orderpriority").alias("drug_name"),
        *[F.lit("1").alias(c) for c in ("quantity", "days_supply", "fill_time", "ingredient_cost", "copay_amount")],
        F.col("o_orderstatus").alias("pharmacy_npi"), F.lit("more").alias("surplus"), F.lit("fields").alias("and_more"))
    for compression in ("none", "gzip"):
        rows.write.mode("append").option("header", True).option("escape", '"').option("compression", compression).csv(f"{root}/drops/drop.csv")
    spark.range(0).selectExpr("'' AS value").write.text(f"{root}/none")
    if load_pharmacy_drops(lake, f"{root}/none", "none").rows_in:
        raise RuntimeError("an empty folder has rows")
    load_pharmacy_drops(lake, f"{root}/drops", "first")
    return read_bronze(lake, S.PHARMACY_CLAIMS).select("claim_id", "drug_name", "pharmacy_npi", S.SOURCE_FILE)


@query("""with times as (select cast(o_orderdate as timestamp) + interval 4000 day as t, timestamp '2006-01-01' as early, timestamp '2007-01-01' as late
    from orders), w as (select max(t) filter (t < early) as w1, max(t) filter (t < late) as w2, max(t) as w3 from times)
  select 'first' as load_id, '2000-01-01T00:00:00' as since, count(*) filter (t < early) as rows_in, count(*) filter (t < early) as rows_inserted,
    count(*) filter (t < early) as rows_total, strftime(any_value(w1), '%Y-%m-%dT%H:%M:%S.%f') as watermark from times, w
  union all select 'next', strftime(any_value(w1) - interval 5 minutes, '%Y-%m-%dT%H:%M:%S.%f'), count(*) filter (t > w1 - interval 5 minutes),
    count(*) filter (t >= early), count(*), strftime(any_value(w3), '%Y-%m-%dT%H:%M:%S.%f') from times, w
  union all select 'full', '2000-01-01T00:00:00', count(*) filter (t < late), 0, count(*), strftime(any_value(w2), '%Y-%m-%dT%H:%M:%S.%f') from times, w""")
def full_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull from the beginning adds nothing that is there and sets the watermark by what it saw, even back."""
    lake = Lake(spark, run_folder(spark, "full_pull"))
    source = A.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_orderkey")).alias("claim_id"),
        *[F.lit(None).cast("string").alias(c) for c in S.MEDICAL_CLAIMS.columns[1:-1]],
        (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 4000 DAYS")).alias("updated_at"))
    until = lambda t: F.col("updated_at") < F.lit(t).cast("timestamp_ntz")
    return audit_frame(spark, [
        load_changed_table(lake, S.MEDICAL_CLAIMS, source.where(until("2006-01-01")), load_id="first"),
        load_changed_table(lake, S.MEDICAL_CLAIMS, source, load_id="next"),
        load_changed_table(lake, S.MEDICAL_CLAIMS, source.where(until("2007-01-01")), full=True, load_id="full"),
    ]).select("load_id", "since", "rows_in", "rows_inserted", "rows_total", "watermark")


@query("""select * from (
    select unnest(['BRONZE', 'SILVER', 'GOLD']) as layer, unnest(['bronze_members', 'silver_members', 'gold_member_360']) as name, count(*) as n from customer
    union all select unnest(['BRONZE', 'SILVER']), unnest(['bronze_providers', 'silver_providers']), count(*) from supplier
    union all values ('BRONZE', 'ingestion_watermarks', 2))""")
def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and rows of the tables that SQL users see, by layer; tables without rows are not published."""
    lake = Lake(spark, run_folder(spark, "published"))
    load_batch(lake, S.MEMBERS, A.members_first(spark, sf_dir), "first")
    load_batch(lake, S.PROVIDERS, A.bronze_providers(spark, sf_dir), "first")
    build_models(lake)
    counts = [
        spark.table(name).agg(F.lit(name.split(".")[0]).alias("layer"), F.lit(name.split(".")[1]).alias("name"), F.count(F.lit(1)).alias("n"))
        for name in publish_views(lake)]
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out


@query("""select 'bronze_members' as name, true as within, count(*) as n from customer union all select 'ingestion_watermarks', true, 1""")
def load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times that a load stores lie between its start and its end."""
    lake = Lake(spark, run_folder(spark, "load_times"))
    started = spark.range(1).select(F.localtimestamp().alias("t")).first()["t"]
    load_batch(lake, S.MEMBERS, A.members_first(spark, sf_dir), "first")
    ended = spark.range(1).select(F.localtimestamp().alias("t")).first()["t"]

    def within(rows: DataFrame, name: str, column: str) -> DataFrame:
        return rows.agg(F.lit(name).alias("name"), F.bool_and(F.col(column).between(F.lit(started), F.lit(ended))).alias("within"),
                        F.count(F.lit(1)).alias("n"))

    return within(read_bronze(lake, S.MEMBERS), "bronze_members", S.LOADED_AT).union(
        within(watermark.state(lake), "ingestion_watermarks", "updated_at"))


# -- loads end to end --------------------------------------------------------------

@query(_with_runs("""
  , counts as (
    select (select count(*) from feed where cast(created_at as timestamp) < timestamp '%(run)s') as in1,
      (select count(*) from target) as n1, (select count(*) from pulled) as in2, (select count(*) from batch) as n2,
      (select count(*) from batch where event_id not in (select event_id from target)) as new2,
      (select max(cast(event_time as timestamp)) from target) as w1,
      (select max(cast(event_time as timestamp)) from pulled) as w2,
      (select count(*) from customer) as m, (select count(*) from customer where c_acctbal < 0) as c)
  select 'enrollment_events' as "table", 'run1' as load_id, null as since, in1 as rows_in, n1 as rows_deduped,
    n1 as rows_inserted, 0 as rows_updated, n1 as rows_total, 0 as rows_incomplete, strftime(w1, '%%Y-%%m-%%dT%%H:%%M:%%S.%%f') as watermark
    from counts
  union all select 'enrollment_events', 'run2', '%(since)s', in2, n2, new2, 0, n1 + new2, 0,
    strftime(greatest(w1, w2), '%%Y-%%m-%%dT%%H:%%M:%%S.%%f') from counts
  union all select 'enrollment_events', 'run3', '%(since)s', in2, n2, 0, 0, n1 + new2, 0,
    strftime(greatest(w1, w2), '%%Y-%%m-%%dT%%H:%%M:%%S.%%f') from counts
  union all select 'members', 'run1', null, m, m, m, 0, m, 0, '1994-06-01T00:00:00.000000' from counts
  union all select 'members', 'run2', null, c, c, 0, c, m, 0, '1995-06-01T08:30:00.000000' from counts
""" % {"run": RUN_TIME, "since": SINCE}))
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load reports; the third repeats the second and adds nothing."""
    lake = Lake(spark, run_folder(spark, "load_audit"))
    feed = L.event_feed(spark, sf_dir)
    recorded = safe_timestamp("created_at") < F.lit(RUN_TIME).cast("timestamp_ntz")
    pulled = _second_pull(spark, sf_dir)
    events, members = S.ENROLLMENT_EVENTS, S.MEMBERS
    return audit_frame(spark, [
        load_batch(lake, events, feed.where(recorded), "run1"),
        load_batch(lake, events, pulled, "run2", since=SINCE),
        load_batch(lake, events, pulled, "run3", since=SINCE),
        load_batch(lake, members, A.members_first(spark, sf_dir), "run1"),
        load_batch(lake, members, A.members_changed(spark, sf_dir), "run2"),
    ])


# In a refresh, claims reach bronze as text of typed values, one row per key.
_OPERATIONAL_CLAIMS = """
  select * from (
    select claim_id, member_id, provider_id, diagnosis_code, procedure_code,
      cast(try_cast(service_date as date) as varchar) as service_date,
      cast(try_cast(billed_amount as decimal(12,2)) as varchar) as billed_amount,
      cast(try_cast(allowed_amount as decimal(12,2)) as varchar) as allowed_amount, claim_status,
      cast(try_cast(created_at as timestamp) as varchar) as created_at,
      cast(coalesce(try_cast(updated_at as timestamp), try_cast(created_at as timestamp)) as varchar) as updated_at, _loaded_at
    from (%s))
  qualify row_number() over (partition by claim_id order by updated_at desc nulls first,
    member_id nulls last, provider_id nulls last, diagnosis_code nulls last, procedure_code nulls last,
    service_date nulls last, billed_amount nulls last, allowed_amount nulls last, claim_status nulls last,
    created_at nulls last) = 1"""


_PER_MEMBER = with_parts(
    """select g.*, cast(coalesce(e.in_state, 0) as bigint) as in_state_claims,
         cast(coalesce(e.disallowed, 0) as decimal(23,2)) as total_disallowed
       from gold_member_360 g left join (
         select member_id, sum(cast(in_state_care as bigint)) as in_state, sum(disallowed_amount) as disallowed
         from gold_claims_enriched group by 1) e using (member_id)""",
    "gold_member_360", "gold_claims_enriched",
    replace={"bronze_medical_claims": _OPERATIONAL_CLAIMS},
)


def _per_member(lake: Lake) -> DataFrame:
    per_member = lake.read("gold", "gold_claims_enriched").groupBy("member_id").agg(
        F.sum(F.col("in_state_care").cast("long")).alias("in_state_claims"),
        F.sum("disallowed_amount").alias("total_disallowed"),
    )
    return lake.read("gold", "gold_member_360").join(per_member, "member_id", "left").withColumns({
        c: F.coalesce(F.col(c), F.lit(0)) for c in ("in_state_claims", "total_disallowed")
    })


@query(_PER_MEMBER)
def refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental refreshes: the second brings later drops and pages, claims again, plan changes and no new providers.

    Each finds one page that is cut off.
    """
    root = run_folder(spark, "refresh_twice")
    lake = Lake(spark, f"{root}/lake")
    whole, early = L.operational_tables(spark, sf_dir), F.col("updated_at") < F.lit("2005-06-01").cast("timestamp_ntz")
    some = F.pmod(F.xxhash64("claim_id"), F.lit(3)) > 0
    one = latest_by(whole["medical_claims"], ["claim_id"], "updated_at", together=A.CLAIM_ORDER)
    first = {"medical_claims": one.where(some), "members": whole["members"].where(early), "providers": whole["providers"]}
    again = {"medical_claims": one.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 9 YEARS")),
             "members": whole["members"].where(~early), "providers": whole["providers"].limit(0)}
    for run, tables in enumerate((first, again)):
        L.write_csv_drops(spark, sf_dir, f"{root}/drops", run)
        L.write_event_pages(spark, sf_dir, f"{root}/pages", run)
        spark.createDataFrame([('{"data": [',)], "value string").write.text(f"{root}/pages/cut_off{run}")
        audits = refresh(lake, f"{root}/drops", f"{root}/pages", tables, loaded_at=A.FIRST_LOAD, checkpoints=f"{root}/checkpoints",
                         full_audit=False)
        if (lost := sum(a.rows_incomplete for a in audits)) != 1:
            raise RuntimeError(f"{lost} broken pages counted, not 1")
    return _per_member(lake)


@query(_PER_MEMBER)
def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each followed by the models: first rows, later drops, events and claims, then plan changes alone.

    From the second on only buckets that changed are written.
    """
    lake = Lake(spark, run_folder(spark, "incremental"))
    whole, early = L.operational_tables(spark, sf_dir), F.col("updated_at") < F.lit("2005-06-01").cast("timestamp_ntz")
    one = latest_by(whole["medical_claims"], ["claim_id"], "updated_at", together=A.CLAIM_ORDER)
    some = F.pmod(F.xxhash64("claim_id"), F.lit(3)) > 0
    drops, feed = A.pharmacy_drop_rows(spark, sf_dir), L.event_feed(spark, sf_dir)
    later, other = F.col(S.SOURCE_FILE) >= L.HALFWAY_DROP, F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    members = whole["members"]
    loads = (
        ((S.PHARMACY_CLAIMS, drops.where(~later)), (S.ENROLLMENT_EVENTS, feed.where(~other)), (S.MEDICAL_CLAIMS, one.where(some)),
         (S.MEMBERS, members.where(early)), (S.PROVIDERS, whole["providers"])),
        ((S.PHARMACY_CLAIMS, drops.where(later)), (S.ENROLLMENT_EVENTS, feed.where(other)), (S.MEDICAL_CLAIMS, one)),
        ((S.MEMBERS, members.where(~early)),),
    )
    for run, batches in enumerate(loads):
        for spec, batch in batches:
            load_batch(lake, spec, batch, f"run{run}", A.FIRST_LOAD, full_audit=False)
        done = set(build_models(lake).values())
        if run and "full" in done:
            raise RuntimeError(f"run {run} has built a table anew")
    return _per_member(lake)


@query(_PER_MEMBER)
def medallion_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources landed, loaded and modelled; both gold tables read back and joined."""
    root = run_folder(spark, "refresh")
    lake = Lake(spark, f"{root}/lake")
    L.write_csv_drops(spark, sf_dir, f"{root}/drops")
    L.write_event_pages(spark, sf_dir, f"{root}/pages")
    refresh(lake, f"{root}/drops", f"{root}/pages", L.operational_tables(spark, sf_dir), load_id="run1")
    return _per_member(lake)
