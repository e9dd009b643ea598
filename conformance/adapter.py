"""Bronze tables derived from the given TPC-H-like tables.

Each function has a SQL twin in ``oracle.py``. Besides mapping columns they put
in what real sources bring: unparseable values, keys without a partner, rows
sent twice, late rows and a column that appears at a cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_LOAD = "2026-07-01 00:00:00"
SECOND_LOAD = "2026-07-02 00:00:00"
NPI_CUTOFF = "1998-07-01"
#: The order of a claim line, which its claim_id begins with.
CLAIM_ORDER = "_order"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _loaded(text: str) -> Column:
    return _ntz(text).alias("_loaded_at")


def members_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members as first loaded."""
    customer = table(spark, sf_dir, "customer")
    birth = F.when(F.col("c_acctbal") > 9000, F.lit("unknown")).otherwise(
        _text(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")))
    )
    return customer.select(
        _text("c_custkey").alias("member_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        birth.alias("date_of_birth"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("plan_code"),
        _text("c_nationkey").alias("state_code"),
        _text(F.date_add(F.lit("1994-01-01").cast("date"), F.col("c_nationkey"))).alias("effective_date"),
        F.lit("1994-01-01T00:00:00").alias("created_at"),
        F.lit("1994-06-01T00:00:00").alias("updated_at"),
        _loaded(FIRST_LOAD),
    )


def members_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with a plan change: a newer row for each customer in debt."""
    debt = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(_text("c_custkey").alias("member_id"))
    return members_first(spark, sf_dir).join(debt, "member_id", "left_semi").select(
        "member_id", "first_name", "last_name", "date_of_birth", "gender",
        F.concat(F.lit("PLAN_"), F.col("state_code")).alias("plan_code"),
        "state_code", "effective_date", "created_at",
        F.lit("1995-06-01 08:30:00").alias("updated_at"),
        _loaded(SECOND_LOAD),
    )


def bronze_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members_first(spark, sf_dir).unionByName(members_changed(spark, sf_dir))


def providers_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        _text(F.col("s_suppkey") + 1000000000).alias("npi"),
        F.concat(F.lit("SPEC_"), _text(F.col("s_suppkey") % 5)).alias("specialty"),
        _text("s_nationkey").alias("state_code"),
        F.lit("1994-01-01T00:00:00").alias("created_at"),
        F.when(F.col("s_acctbal") > 9000, "soon").otherwise("1994-06-01T00:00:00").alias("updated_at"),
        _loaded(FIRST_LOAD),
    )


def bronze_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = providers_first(spark, sf_dir)
    newer = first.select(
        "provider_id", "provider_name", "npi", F.lit("General").alias("specialty"), "state_code", "created_at",
        F.lit("1995-06-01 08:30:00").alias("updated_at"), _loaded(SECOND_LOAD),
    )
    return first.unionByName(newer)


def bronze_medical_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim lines; keys repeat in the data, so the latest row of a key matters."""
    return dealt_medical_claims(spark, sf_dir).drop(CLAIM_ORDER)


def dealt_medical_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim lines with their order, by which they are dealt out.

    A lines file that is one row group is thus spread over all cores, and neither a join that is
    too large to broadcast nor the latest row of each claim needs another shuffle of them.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    quantity = F.col("l_quantity")
    billed = F.col("l_extendedprice").cast("decimal(12,2)")
    allowed = (billed * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)")
    claims = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    # formatted once, as that takes longer than all else that is done to a line here
    claims = claims.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    day = F.substring_index("shipped", " ", 1)
    return claims.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
        F.when(quantity == 1, "NOBODY").otherwise(_text("o_custkey")).alias("member_id"),
        F.when(quantity != 2, _text("l_suppkey")).alias("provider_id"),
        F.concat(F.lit("D"), _text(F.col("l_partkey") % 7)).alias("diagnosis_code"),
        F.concat(F.lit("P"), _text("l_linenumber")).alias("procedure_code"),
        F.when(quantity == 3, "not a date").when(quantity == 4, "1997-02").otherwise(day).alias("service_date"),
        F.when(quantity == 5, "n/a").when(quantity == 6, "99999999999.99").otherwise(_text(billed)).alias("billed_amount"),
        F.when(quantity == 7, "12.345").otherwise(_text(allowed)).alias("allowed_amount"),
        F.concat("l_returnflag", "l_linestatus").alias("claim_status"),
        F.translate("shipped", " ", "T").alias("created_at"),
        F.when(quantity == 8, "later").otherwise(F.col("shipped")).alias("updated_at"),
        _loaded(FIRST_LOAD),
        F.col("l_orderkey").alias(CLAIM_ORDER),
    )


def pharmacy_drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the CSV drops with the drop they are in, one drop per month.

    Rows of urgent orders are in their drop twice; orders of status P are sent
    again, corrected, with the next month's drop. ``pharmacy_npi`` is only
    meaningful for drops from the cutoff on.
    """
    orders = table(spark, sf_dir, "orders")
    cost = F.col("o_totalprice").cast("decimal(12,2)")
    priority = F.col("o_orderpriority")

    def rows(source: DataFrame, month: Column, copay: str) -> DataFrame:
        has_npi = month >= F.lit(NPI_CUTOFF).cast("date")
        return source.select(
            F.concat(F.lit("RX"), _text("o_orderkey")).alias("claim_id"),
            F.when(F.col("o_totalprice") < 2000, "NOBODY").otherwise(_text("o_custkey")).alias("member_id"),
            F.concat(F.lit("00071-"), F.substring(priority, 1, 1)).alias("ndc_code"),
            F.concat(F.lit('Tablet, "'), priority, F.lit('"')).alias("drug_name"),
            F.when(priority == "3-MEDIUM", "30.6").when(priority == "5-LOW", "many")
            .otherwise(_text(F.col("o_orderkey") % 90)).alias("quantity"),
            F.when(F.col("o_totalprice") > 450000, "3000000000").otherwise("30").alias("days_supply"),
            F.when(F.col("o_totalprice").between(440000, 450000), "noon")
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("fill_time"),
            _text(cost).alias("ingredient_cost"),
            F.lit(copay).alias("copay_amount"),
            F.when(has_npi, _text(F.col("o_custkey") + 1000000000)).alias("pharmacy_npi"),
            F.concat(F.lit("pharmacy_claims_"), F.date_format(month, "yyyyMMdd"), F.lit("_00.csv")).alias("_source_file"),
        )

    month = F.date_trunc("month", "o_orderdate").cast("date")
    once = rows(orders, month, "5.0")
    twice = rows(orders.where("o_orderpriority = '1-URGENT'"), month, "5.0")
    again = rows(orders.where("o_orderstatus = 'P'"), F.add_months(month, 1), "7.5")
    return once.unionByName(twice).unionByName(again)


def bronze_pharmacy_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drops in one frame, corrected rows loaded later."""
    again = F.col("copay_amount") == "7.5"
    return pharmacy_drop_rows(spark, sf_dir).withColumn(
        "_loaded_at", F.when(again, _ntz(SECOND_LOAD)).otherwise(_ntz(FIRST_LOAD))
    )


def bronze_enrollment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events; errors are recorded 1 to 6 hours late and signups are delivered twice."""
    events = table(spark, sf_dir, "events")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    late = F.when(F.col("event_type") == "error", F.col("event_id") % 6 + 1).otherwise(0)

    def rows(source: DataFrame, plan: str, delay: Column) -> DataFrame:
        recorded = F.col("ts") + F.make_dt_interval(F.lit(0), delay.cast("int"))
        return source.select(
            F.concat(F.lit("EV"), _text("event_id")).alias("event_id"),
            _text("user_id").alias("member_id"),
            "event_type",
            F.concat(F.lit(plan), _text(F.col("user_id") % 4)).alias("plan_code"),
            F.date_format("ts", iso).alias("event_time"),
            F.date_format(recorded, iso).alias("created_at"),
            _loaded(FIRST_LOAD),
        )

    again = rows(events.where("event_type = 'signup'"), "AGAIN_", late + 1)
    return rows(events, "PLAN_", late).unionByName(again)
