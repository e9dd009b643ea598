import pytest

from stratalake.__main__ import parser, run
from stratalake.plans import publish_views, refresh
from stratalake.schemas import CHANGED_TABLES, MEDICAL_CLAIMS, MEMBERS, PROVIDERS
from tests.helpers import rows
from tests.test_loads import member, page_of, table
from tests.test_sources import V1, V2, claim, drop, event


@pytest.fixture
def landed(folder):
    for name in ("drops", "pages"):
        (folder / name).mkdir()
    drop(folder / "drops", "a.csv", V1, claim(1), claim(1))
    drop(folder / "drops", "b.csv", V2, claim(2, "9"))
    page_of(folder / "pages", "p1.json", event(1), event(2))
    return folder


def operational(spark):
    return {
        "medical_claims": table(spark, MEDICAL_CLAIMS, {
            "claim_id": "MC1", "member_id": "M1", "provider_id": "P1", "billed_amount": "10", "allowed_amount": "4",
            "updated_at": "2026-07-01T10:00:00"}),
        "members": table(spark, MEMBERS, {**member(1, "A"), "state_code": "NC"}, member(2, "A")),
        "providers": table(spark, PROVIDERS, {"provider_id": "P1", "state_code": "NC", "updated_at": "2026-07-01T10:00:00"}),
    }


def test_refresh_and_sql(spark, lake, landed):
    tables = operational(spark)
    first = refresh(lake, str(landed / "drops"), str(landed / "pages"), tables, load_id="r1")
    assert [(a.table, a.rows_inserted) for a in first] == [
        ("pharmacy_claims", 2), ("enrollment_events", 2), ("medical_claims", 1), ("members", 2), ("providers", 1)]

    published = publish_views(lake)
    assert len(published) == 13
    assert rows(spark.sql("SELECT claim_id, disallowed_amount, in_state_care FROM GOLD.gold_claims_enriched")) \
        == rows(spark.sql("SELECT 'MC1', 6.00BD, true"))
    assert rows(spark.sql("SELECT member_id, total_claims, total_rx_fills, total_enrollment_events "
                          "FROM GOLD.gold_member_360")) == [("M1", 1, 1, 2), ("M2", 0, 1, 0)]
    assert rows(spark.sql("""
        SELECT CASE WHEN pharmacy_npi IS NULL THEN 'v1 (no npi)' ELSE 'v2 (has npi)' END AS schema_version,
               COUNT(*) AS row_count
        FROM BRONZE.bronze_pharmacy_claims GROUP BY 1""")) == [("v1 (no npi)", 1), ("v2 (has npi)", 1)]
    assert rows(spark.sql("SELECT source_name FROM BRONZE.ingestion_watermarks")) == [
        ("enrollment_api",), ("sqlserver_medical_claims",), ("sqlserver_members",), ("sqlserver_providers",)]

    # a second refresh finds the same sources and changes nothing
    gold = {n: rows(lake.read("gold", n)) for n in ("gold_claims_enriched", "gold_member_360")}
    second = refresh(lake, str(landed / "drops"), str(landed / "pages"), tables, load_id="r2")
    assert [a.rows_inserted for a in second] == [0] * 5
    assert {n: rows(lake.read("gold", n)) for n in gold} == gold


def test_command_line(spark, lake, landed, folder):
    args = []
    for name, df in operational(spark).items():
        df.write.parquet(str(folder / name))
        args += ["--table", f"{name}={folder / name}"]

    def step(*words):
        return run(spark, parser().parse_args([*words, "--root", lake.root]))

    assert rows(step("load-pharmacy", "--drops", str(landed / "drops")), "rows_inserted") == [(2,)]
    assert rows(step("load-events", "--pages", str(landed / "pages")), "rows_inserted") == [(2,)]
    assert rows(step("load-tables", *args), "table", "rows_inserted") == [
        ("medical_claims", 1), ("members", 2), ("providers", 1)]
    assert step("build-models", "--views").count() == 0
    assert lake.read("gold", "gold_member_360").count() == 2
    again = step("refresh", "--drops", str(landed / "drops"), "--pages", str(landed / "pages"), "--full", *args)
    assert {r.rows_inserted for r in again.collect()} == {0}
    assert {r.since for r in again.collect()} == {None, "2000-01-01T00:00:00"}


def test_second_refresh_reads_new_files_only(lake, folder):
    drops, pages = folder / "drops", folder / "pages"
    for f in (drops, pages):
        f.mkdir()
    spark = lake.spark
    empty = {s.name: spark.createDataFrame([], ", ".join(
        f"{c} {'timestamp_ntz' if c == s.watermark_column else 'string'}" for c in s.columns)) for s in CHANGED_TABLES}

    def run(n):
        (drops / f"d{n}.csv").write_text(f"claim_id,member_id\nRX{n},M1\n")
        (pages / f"p{n}.json").write_text(f'{{"data": [{{"event_id": "e{n}", "event_time": "2001-01-0{n}"}}], "count": 1}}\n')
        audits = refresh(lake, str(drops), str(pages), empty, checkpoints=str(folder / "checkpoints"), full_audit=False)
        return {a.table: (a.rows_in, a.rows_inserted) for a in audits if a.rows_in}

    assert run(1) == {"pharmacy_claims": (1, 1), "enrollment_events": (1, 1)}
    assert run(2) == {"pharmacy_claims": (1, 1), "enrollment_events": (1, 1)}
    assert lake.read("silver", "silver_pharmacy_claims").count() == 2
    assert lake.read("silver", "silver_enrollment_events").count() == 2
