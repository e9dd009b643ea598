from datetime import date, datetime
from decimal import Decimal

from stratalake.plans import SILVER_MODELS, build_silver, claims_enriched, member_360, schema_versions
from stratalake.schemas import ENROLLMENT_EVENTS, MEDICAL_CLAIMS, MEMBERS, PHARMACY_CLAIMS, PROVIDERS
from tests.helpers import bronze, final_plan, plan, rows

EARLY, LATE = datetime(2026, 7, 1), datetime(2026, 7, 2)


def silver(spark, spec, *dicts):
    return build_silver(f"silver_{spec.name}", bronze(spark, spec, *dicts))


def test_columns_and_types(spark):
    want = {
        "silver_pharmacy_claims": "string string string string bigint bigint timestamp_ntz decimal(10,2) decimal(10,2) string "
                                  "string timestamp_ntz",
        "silver_enrollment_events": "string string string string timestamp_ntz timestamp_ntz timestamp_ntz",
        "silver_medical_claims": "string string string string string date decimal(12,2) decimal(12,2) string "
                                 "timestamp_ntz timestamp_ntz timestamp_ntz",
        "silver_members": "string string string date string string string date timestamp_ntz timestamp_ntz timestamp_ntz",
        "silver_providers": "string string string string string timestamp_ntz timestamp_ntz timestamp_ntz",
    }
    for name, model in SILVER_MODELS.items():
        df = build_silver(model, bronze(spark, model.bronze))
        assert df.columns == model.bronze.bronze_schema.names
        assert [t for _, t in df.dtypes] == want[name].split()


def test_pharmacy(spark):
    got = silver(spark, PHARMACY_CLAIMS,
                 {"claim_id": "RX1", "_source_file": "a.csv", "quantity": "30", "days_supply": "x", "_loaded_at": EARLY,
                  "fill_time": "2026-07-02 23:14:00", "ingredient_cost": "32.5", "copay_amount": "5.0"},
                 {"claim_id": "RX2", "_source_file": "a.csv", "pharmacy_npi": "12", "_loaded_at": EARLY},
                 {"claim_id": "RX2", "_source_file": "b.csv", "pharmacy_npi": "34", "_loaded_at": LATE})
    assert rows(got, "claim_id", "quantity", "days_supply", "fill_time", "ingredient_cost", "copay_amount",
                "pharmacy_npi", "_source_file") == [
        ("RX1", 30, None, datetime(2026, 7, 2, 23, 14), Decimal("32.50"), Decimal("5.00"), "UNKNOWN", "a.csv"),
        ("RX2", None, None, None, None, None, "34", "b.csv")]


def test_bad_values_become_null_and_the_row_stays(spark):
    got = silver(spark, MEDICAL_CLAIMS,
                 {"claim_id": "MC1", "service_date": "yesterday", "billed_amount": "ten", "allowed_amount": "99999999999",
                  "created_at": "soon", "updated_at": "2026-07-01"})
    assert rows(got, "claim_id", "service_date", "billed_amount", "allowed_amount", "created_at", "updated_at") == [
        ("MC1", None, None, None, None, datetime(2026, 7, 1))]


def test_newest_by_time_where_text_order_differs(spark):
    got = silver(spark, ENROLLMENT_EVENTS,
                 {"event_id": "EV1", "created_at": "2026-07-01T09:00:00", "plan_code": "old"},
                 {"event_id": "EV1", "created_at": "2026-07-01 10:00:00", "plan_code": "new"})
    assert rows(got, "plan_code") == [("new",)]


def test_an_unparseable_update_time_counts_as_newest(spark):
    got = silver(spark, MEMBERS, {"member_id": "M1", "plan_code": "A", "updated_at": "2026-07-01"},
                 {"member_id": "M1", "plan_code": "B", "updated_at": "soon"})
    assert rows(got, "plan_code") == [("B",)]


def gold_inputs(spark):
    claims = silver(
        spark, MEDICAL_CLAIMS,
        {"claim_id": "C1", "member_id": "M1", "provider_id": "P1", "billed_amount": "100.00", "allowed_amount": "60.10",
         "service_date": "2026-06-01", "updated_at": "2026-07-01"},
        {"claim_id": "C2", "member_id": "M1", "provider_id": "P2", "billed_amount": "50.00", "allowed_amount": "n/a",
         "service_date": "2026-06-03"},
        {"claim_id": "C3", "member_id": "GONE", "provider_id": "GONE", "billed_amount": "1", "allowed_amount": "1"},
        {"claim_id": "C4"},
    )
    members = silver(spark, MEMBERS, {"member_id": "M1", "state_code": "NC", "plan_code": "PPO", "gender": "F"},
                     {"member_id": "M2", "state_code": "GA", "date_of_birth": "1980-02-03"})
    providers = silver(spark, PROVIDERS, {"provider_id": "P1", "state_code": "NC", "specialty": "Cardiology"},
                       {"provider_id": "P2", "state_code": "GA"})
    return claims, members, providers


def test_claims_enriched(spark):
    got = claims_enriched(*gold_inputs(spark))
    assert got.columns == [
        "claim_id", "member_id", "provider_id", "diagnosis_code", "procedure_code", "service_date", "billed_amount",
        "allowed_amount", "disallowed_amount", "claim_status", "plan_code", "member_state", "gender", "provider_name",
        "specialty", "provider_state", "in_state_care", "updated_at"]
    assert dict(got.dtypes)["disallowed_amount"] == "decimal(13,2)"
    assert rows(got, "claim_id", "disallowed_amount", "member_state", "provider_state", "specialty", "in_state_care") == [
        ("C1", Decimal("39.90"), "NC", "NC", "Cardiology", True), ("C2", None, "NC", "GA", None, False),
        ("C3", Decimal("0.00"), None, None, None, False), ("C4", None, None, None, None, False)]


def test_member_360(spark):
    claims, members, _ = gold_inputs(spark)
    pharmacy = silver(spark, PHARMACY_CLAIMS, {"claim_id": "R1", "member_id": "M1", "ingredient_cost": "10.25"},
                      {"claim_id": "R2", "member_id": "M1", "ingredient_cost": "bad"}, {"claim_id": "R3", "member_id": "GONE"})
    events = silver(spark, ENROLLMENT_EVENTS, {"event_id": "E1", "member_id": "M1", "event_time": "2026-07-01T10:00:00"},
                    {"event_id": "E2", "member_id": "M1", "event_time": "2026-07-03T10:00:00"})
    got = member_360(members, claims, pharmacy, events)
    assert got.columns == [
        "member_id", "first_name", "last_name", "plan_code", "state_code", "date_of_birth", "total_claims",
        "total_billed", "total_allowed", "last_service_date", "total_rx_fills", "total_rx_cost",
        "total_enrollment_events", "last_enrollment_event"]
    assert rows(got, "member_id", *got.columns[6:]) == [
        ("M1", 2, Decimal("150.00"), Decimal("60.10"), date(2026, 6, 3), 2, Decimal("10.25"), 2, datetime(2026, 7, 3, 10)),
        ("M2", 0, Decimal("0.00"), Decimal("0.00"), None, 0, Decimal("0.00"), 0, None)]


def test_schema_versions(spark):
    got = schema_versions(bronze(spark, PHARMACY_CLAIMS, {"claim_id": "1"}, {"claim_id": "2"}, {"pharmacy_npi": "9"}))
    assert rows(got) == [("v1 (no npi)", 2), ("v2 (has npi)", 1)]


def stored(spark, folder, *frames):
    """The frames as written tables, as a refresh has them."""
    for i, df in enumerate(frames):
        df.write.parquet(str(folder / str(i)))
    return [spark.read.parquet(str(folder / str(i))) for i in range(len(frames))]


def test_each_table_of_the_member_summary_is_shuffled_once(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    claims, members, _ = gold_inputs(spark)
    others = [build_silver(f"silver_{s.name}", bronze(spark, s)) for s in (PHARMACY_CLAIMS, ENROLLMENT_EVENTS)]
    members, claims, pharmacy, events = stored(spark, folder, members, claims, *others)
    text = plan(member_360(members, claims, pharmacy, events))
    assert text.count("Exchange hashpartitioning(member_id") == text.count("Exchange") == 4
    assert text.count("partial_") >= 3
    assert "ReadSchema: struct<member_id:string,ingredient_cost:decimal(10,2)>" in text


def test_small_dimensions_are_broadcast_and_claims_not_shuffled(spark, folder):
    claims, members, providers = stored(spark, folder, *gold_inputs(spark))
    text = final_plan(claims_enriched(claims, members, providers))
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") >= 2
