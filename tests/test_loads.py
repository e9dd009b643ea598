import json
from datetime import datetime, timedelta

import pytest

from stratalake import watermark
from stratalake.plans import audit_frame, load_batch, load_changed_table, load_event_pages, load_pharmacy_drops, read_bronze
from stratalake.schemas import ENROLLMENT_EVENTS, FIRST_WATERMARK, MEDICAL_CLAIMS, MEMBERS, PHARMACY_CLAIMS, PROVIDERS
from tests.helpers import batch, rows
from tests.test_sources import V1, V2, claim, drop, event, landed

LOADED, LATER = "2026-07-04 00:00:00", "2026-07-05 00:00:00"


# -- CSV drops --------------------------------------------------------------------

def test_drops_loaded_twice_add_nothing(spark, lake, folder):
    drop(folder, "a.csv", V1, claim(1), claim(1), claim(2))
    drop(folder, "b.csv", V2, claim(1, "99"), claim(3, "99"))
    first = load_pharmacy_drops(lake, str(folder), "l1", LOADED)
    before = rows(read_bronze(lake, PHARMACY_CLAIMS))
    second = load_pharmacy_drops(lake, str(folder), "l2", LATER)
    assert (first.rows_in, first.rows_deduped, first.rows_inserted, first.rows_total) == (5, 4, 4, 4)
    assert (second.rows_inserted, second.rows_total) == (0, 4)
    assert rows(read_bronze(lake, PHARMACY_CLAIMS)) == before
    assert rows(read_bronze(lake, PHARMACY_CLAIMS), "claim_id", "_source_file") == [
        ("RX1", "a.csv"), ("RX1", "b.csv"), ("RX2", "a.csv"), ("RX3", "b.csv")]


def test_the_earliest_fill_of_a_drop_is_kept(spark, lake):
    made = batch(spark, PHARMACY_CLAIMS,
                 {"claim_id": "RX1", "_source_file": "a.csv", "fill_time": "2026-07-02 10:00:00", "quantity": "60"},
                 {"claim_id": "RX1", "_source_file": "a.csv", "fill_time": "2026-07-02 09:00:00", "quantity": "30"},
                 {"claim_id": "RX1", "_source_file": "a.csv", "fill_time": None, "quantity": "90"})
    load_batch(lake, PHARMACY_CLAIMS, made, "l1")
    assert rows(read_bronze(lake, PHARMACY_CLAIMS), "quantity") == [("30",)]


@pytest.mark.parametrize("missing", [False, True])
def test_an_empty_or_missing_folder_loads_nothing(lake, folder, missing):
    audit = load_pharmacy_drops(lake, str(folder / "none" if missing else folder), "l1")
    assert (audit.rows_in, audit.rows_total) == (0, 0)


def test_staging_is_gone_after_a_load(lake, folder):
    drop(folder, "a.csv", V1, claim(1))
    load_pharmacy_drops(lake, str(folder), "l1")
    assert not lake.exists(f"{lake.path('staging', 'pharmacy_claims')}/l1")


def test_a_load_id_used_again_loses_nothing(lake, folder):
    drop(folder, "a.csv", V1, claim(1), claim(2))
    load_pharmacy_drops(lake, str(folder), "l1", LOADED)
    (folder / "a.csv").unlink()
    drop(folder, "b.csv", V1, claim(3))
    again = load_pharmacy_drops(lake, str(folder), "l1", LATER)
    assert (again.rows_inserted, again.rows_total) == (1, 3)


def test_a_fixed_batch_loaded_again_replaces_itself(spark, lake):
    made = batch(spark, MEDICAL_CLAIMS, {"claim_id": "MC1"}, {"claim_id": None})
    for _ in range(2):
        audit = load_batch(lake, MEDICAL_CLAIMS, made, "l1", fixed_batch=True)
        assert (audit.rows_inserted, audit.rows_total) == (2, 2)


def test_incomplete_rows_can_be_set_aside(lake, folder):
    drop(folder, "a.csv", V1, claim(1), "RX2,M2", ",M3,x")
    kept = load_pharmacy_drops(lake, str(folder), "l1")
    assert (kept.rows_inserted, kept.rows_incomplete) == (3, 0)
    # a row without a key never matches, so it would come again with every load
    assert load_pharmacy_drops(lake, str(folder), "l2").rows_inserted == 1
    strict = load_pharmacy_drops(lake, str(folder), "l3", required=["claim_id"])
    assert (strict.rows_in, strict.rows_inserted, strict.rows_incomplete) == (3, 0, 1)
    apart = lake.spark.read.parquet(f"{lake.path('bronze', 'incomplete_pharmacy_claims')}/load_id=l3")
    assert rows(apart, "member_id", "missing") == [("M3", ["claim_id"])]


# -- event pages ------------------------------------------------------------------

def page_of(folder, name, *events):
    landed(folder, name, {"data": list(events), "count": len(events), "total_matched": len(events), "next_cursor": None})


def test_late_events_inside_the_lookback_are_found(lake, folder):
    mark = datetime(2026, 7, 2, 12)
    page_of(folder, "p1.json", event(1, mark.isoformat()), event(2, "2026-07-01T10:05:00"))
    first = load_event_pages(lake, str(folder), load_id="l1")
    assert first.since == FIRST_WATERMARK and first.watermark == "2026-07-02T12:00:00.000000"

    inside, edge, outside = (mark - timedelta(**d) for d in ({"hours": 5, "minutes": 59}, {"hours": 6}, {"hours": 6, "seconds": 1}))
    page_of(folder, "p2.json", *(event(n, t.isoformat()) for n, t in ((3, inside), (4, edge), (5, outside))))
    second = load_event_pages(lake, str(folder), load_id="l2")
    assert second.since == "2026-07-02T06:00:00.000000"
    assert (second.rows_in, second.rows_inserted) == (3, 2)  # event 1 is pulled again
    assert [r[0] for r in rows(read_bronze(lake, ENROLLMENT_EVENTS), "event_id")] == ["EV1", "EV2", "EV3", "EV4"]
    assert second.watermark == first.watermark

    full = load_event_pages(lake, str(folder), full=True, load_id="l3")
    assert full.since == FIRST_WATERMARK and (full.rows_in, full.rows_inserted, full.rows_total) == (5, 1, 5)


def test_the_newest_record_of_an_event_wins_in_a_batch_but_not_over_bronze(spark, lake):
    def version(created, plan):
        return {"event_id": "EV1", "event_time": "2026-07-01T10:00:00", "created_at": created, "plan_code": plan}

    load_batch(lake, ENROLLMENT_EVENTS, batch(spark, ENROLLMENT_EVENTS, version("2026-07-01T10:00:00", "old"),
                                               version("2026-07-01T11:00:00", "new")), "l1")
    load_batch(lake, ENROLLMENT_EVENTS, batch(spark, ENROLLMENT_EVENTS, version("2026-07-01T12:00:00", "newest")), "l2")
    assert rows(read_bronze(lake, ENROLLMENT_EVENTS), "plan_code") == [("new",)]


# -- operational tables -------------------------------------------------------------

def table(spark, spec, *dicts):
    schema = ", ".join(f"{c} {'timestamp_ntz' if c.endswith('_at') else 'string'}" for c in spec.columns)
    data = [tuple(datetime.fromisoformat(d[c]) if c.endswith("_at") and d.get(c) else d.get(c) for c in spec.columns)
            for d in dicts]
    return spark.createDataFrame(data, schema)


def member(n, plan, at="2026-07-01T10:00:00"):
    return {"member_id": f"M{n}", "plan_code": plan, "updated_at": at}


def test_members_change_and_keep_their_first_load_time(spark, lake):
    first = load_changed_table(lake, MEMBERS, table(spark, MEMBERS, member(1, "A"), member(2, "A")), load_id="l1", loaded_at=LOADED)
    now = table(spark, MEMBERS, member(1, "B", "2026-07-02T10:00:00"), member(2, "A"), member(3, "C", "2026-07-02T11:00:00"))
    second = load_changed_table(lake, MEMBERS, now, load_id="l2", loaded_at=LATER)
    assert (first.rows_inserted, first.rows_updated) == (2, 0)
    assert second.since == "2026-07-01T09:55:00.000000"
    assert (second.rows_in, second.rows_inserted, second.rows_updated, second.rows_total) == (3, 1, 2, 3)
    got = rows(read_bronze(lake, MEMBERS), "member_id", "plan_code", "updated_at", "_loaded_at")
    loaded, later = datetime.fromisoformat(LOADED), datetime.fromisoformat(LATER)
    assert got == [("M1", "B", "2026-07-02 10:00:00", loaded), ("M2", "A", "2026-07-01 10:00:00", loaded),
                   ("M3", "C", "2026-07-02 11:00:00", later)]


def test_claims_never_change(spark, lake):
    def claims(status, at):
        return table(spark, MEDICAL_CLAIMS, {"claim_id": "MC1", "claim_status": status, "updated_at": at})

    load_changed_table(lake, MEDICAL_CLAIMS, claims("SUBMITTED", "2026-07-01T10:00:00"), load_id="l1")
    audit = load_changed_table(lake, MEDICAL_CLAIMS, claims("APPROVED", "2026-07-02T10:00:00"), load_id="l2")
    assert (audit.rows_inserted, audit.rows_updated) == (0, 0)
    assert audit.watermark == "2026-07-02T10:00:00.000000"
    assert rows(read_bronze(lake, MEDICAL_CLAIMS), "claim_status") == [("SUBMITTED",)]


def test_a_key_twice_in_a_batch_is_one_row(spark, lake):
    source = table(spark, MEMBERS, member(1, "A"), member(1, "B", "2026-07-02T10:00:00"))
    audit = load_changed_table(lake, MEMBERS, source, load_id="l1")
    assert (audit.rows_in, audit.rows_deduped, audit.rows_inserted) == (2, 1, 1)
    assert rows(read_bronze(lake, MEMBERS), "plan_code") == [("B",)]


def test_nothing_pulled_leaves_the_watermark(spark, lake):
    load_changed_table(lake, MEMBERS, table(spark, MEMBERS, member(1, "A")), load_id="l1")
    before = rows(watermark.state(lake))
    audit = load_changed_table(lake, MEMBERS, table(spark, MEMBERS, member(1, "A", "2026-06-01T10:00:00")), load_id="l2")
    assert audit.rows_in == 0 and audit.watermark is None
    assert rows(watermark.state(lake)) == before


def test_a_source_may_be_opened_late(spark, lake):
    asked = []

    def open_since(since):
        asked.append(since)
        return table(spark, PROVIDERS, {"provider_id": "P1", "updated_at": "2026-07-01T10:00:00"})

    load_changed_table(lake, PROVIDERS, open_since, load_id="l1")
    load_changed_table(lake, PROVIDERS, open_since, load_id="l2", lookback="1 hour")
    assert asked == [FIRST_WATERMARK, "2026-07-01T09:00:00.000000"]


# -- watermarks ---------------------------------------------------------------------

def test_watermarks_never_move_back(spark, lake):
    def seen(source, mark):
        return spark.createDataFrame([(source, mark)], "source_name string, last_watermark string")

    for mark in ("2026-07-02T10:00:00", "2026-07-01T10:00:00", None, "2026-07-02 09:00:00"):
        assert watermark.commit(lake, "a", seen("a", mark)) == "2026-07-02T10:00:00.000000"
    watermark.commit(lake, "b", seen("b", "2026-07-01T00:00:00"))
    state = watermark.state(lake)
    assert rows(state, "source_name", "last_watermark") == [
        ("a", "2026-07-02T10:00:00.000000"), ("b", "2026-07-01T00:00:00.000000")]
    assert state.where("updated_at IS NULL").count() == 0
    assert watermark.read_since(lake, "a", "5 minutes") == "2026-07-02T09:55:00.000000"
    assert watermark.read_since(lake, "a", "5 minutes", full=True) == FIRST_WATERMARK
    assert watermark.read_since(lake, "unknown", "5 minutes") == FIRST_WATERMARK


def test_a_null_watermark_reads_as_the_beginning(spark, lake):
    state = spark.createDataFrame([("a", None, None)], watermark.WATERMARK_SCHEMA)
    lake.replace("bronze", "ingestion_watermarks/a", state)
    assert watermark.read_since(lake, "a", "6 hours") == FIRST_WATERMARK


def test_newest_compares_times_not_text(spark):
    df = spark.createDataFrame([("2026-07-02 09:00:00",), ("2026-07-02T08:00:00",), ("None",), (None,)], "t string")
    assert rows(watermark.newest(df, "s", "t")) == [("s", "2026-07-02T09:00:00.000000")]


def test_a_crash_between_data_and_watermark_is_repaired(spark, lake, monkeypatch):
    source = table(spark, MEDICAL_CLAIMS, {"claim_id": "MC1", "updated_at": "2026-07-01T10:00:00"})
    with monkeypatch.context() as broken:
        broken.setattr(watermark, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load_changed_table(lake, MEDICAL_CLAIMS, source, load_id="l1")
    audit = load_changed_table(lake, MEDICAL_CLAIMS, source, load_id="l2")
    assert (audit.rows_inserted, audit.rows_total) == (0, 1)
    assert audit.watermark == "2026-07-01T10:00:00.000000"


def test_audit_frame(spark, lake):
    audit = load_changed_table(lake, MEMBERS, table(spark, MEMBERS, member(1, "A")), load_id="l1")
    row = audit_frame(spark, [audit]).first().asDict()
    assert row["table"] == "members" and row["rows_inserted"] == 1 and row["watermark"] == audit.watermark
    quick = load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, {"claim_id": "C1"}), "l1", full_audit=False)
    assert quick.rows_total == 1 and quick.rows_deduped is None and quick.rows_inserted == 1
