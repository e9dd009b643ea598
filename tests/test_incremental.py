"""Models kept up to date by what has changed are those that a full build makes."""

import random

import pytest

from stratalake.keyed import KeyedTable
from stratalake.plans import build_models, load_batch
from stratalake.plans import models as M
from stratalake.plans.bronze import bronze_table
from stratalake.plans.gold import GOLD_TABLES
from stratalake.plans.silver import SILVER_MODELS
from stratalake.schemas import ENROLLMENT_EVENTS, MEDICAL_CLAIMS, MEMBERS, PHARMACY_CLAIMS, PROVIDERS
from tests.helpers import batch, rows

TABLES = [("silver", n) for n in SILVER_MODELS] + [("gold", n) for n in GOLD_TABLES]


def contents(lake):
    return {name: rows(lake.read(layer, name)) for layer, name in TABLES}


def some(rng, kind, count):
    """Rows of a kind, some with keys seen before, some without a key or a partner."""
    def pick(letter, n):
        return None if rng.random() < 0.05 else f"{letter}{rng.randrange(n)}"

    time = lambda: f"2026-0{rng.randrange(1, 9)}-1{rng.randrange(9)} 10:00:00"
    made = {
        "pharmacy": lambda: {"claim_id": pick("RX", 60), "_source_file": f"{rng.choice('abc')}.csv", "member_id": pick("M", 20),
                             "fill_time": time(), "ingredient_cost": f"{rng.randrange(99)}.5"},
        "events": lambda: {"event_id": pick("EV", 60), "member_id": pick("M", 20), "event_time": time(), "created_at": time()},
        "claims": lambda: {"claim_id": pick("MC", 80), "member_id": pick("M", 25), "provider_id": pick("P", 8),
                           "billed_amount": f"{rng.randrange(500)}", "allowed_amount": "7", "updated_at": time()},
        "members": lambda: {"member_id": pick("M", 20), "plan_code": rng.choice("ABC"), "state_code": rng.choice(["NC", "VA"]), "updated_at": time()},
        "providers": lambda: {"provider_id": pick("P", 8), "specialty": rng.choice("xyz"), "state_code": rng.choice(["NC", "VA"]), "updated_at": time()},
    }[kind]
    return [made() for _ in range(count)]


SPECS = {"pharmacy": PHARMACY_CLAIMS, "events": ENROLLMENT_EVENTS, "claims": MEDICAL_CLAIMS, "members": MEMBERS, "providers": PROVIDERS}


def test_builds_after_random_loads_equal_full_ones(spark, lake):
    rng = random.Random(11)
    loads = (dict.fromkeys(SPECS, 25), {"claims": 6, "members": 2}, {"providers": 1, "pharmacy": 4}, {"events": 3, "members": 1, "claims": 2})
    for run, counts in enumerate(loads):
        for kind, count in counts.items():
            load_batch(lake, SPECS[kind], batch(spark, SPECS[kind], *some(rng, kind, count)), f"run{run}", f"2026-09-0{run + 1} 00:00:00")
        if run == 2:
            assert bronze_table(lake, PHARMACY_CLAIMS).compact()
        done = build_models(lake)
        assert ("full" in done.values()) == (run == 0)
        if run == 1:
            assert done["silver_providers"] == done["silver_enrollment_events"] == "nothing"
        kept = contents(lake)
        assert set(build_models(lake).values()) == {"nothing"} and contents(lake) == kept
        if run:
            assert set(build_models(lake, full=True).values()) == {"full"} and contents(lake) == kept


def test_a_replaced_load_and_other_buckets(spark, lake):
    def load(load_id, *ids):
        made = batch(spark, MEDICAL_CLAIMS, *({"claim_id": f"MC{i}", "member_id": "M1", "billed_amount": "2"} for i in ids))
        load_batch(lake, MEDICAL_CLAIMS, made, load_id, "2026-09-01 00:00:00", fixed_batch=True)

    load("s1", *range(20))
    load_batch(lake, MEMBERS, batch(spark, MEMBERS, {"member_id": "M1", "updated_at": "2026-01-01"}), "m", "2026-09-01 00:00:00")
    build_models(lake)
    load("s1", *range(20), 30)  # the micro-batch again
    assert build_models(lake)["silver_medical_claims"] == "buckets"
    assert lake.read("gold", "gold_claims_enriched").count() == 21
    assert lake.read("gold", "gold_member_360").first()["total_claims"] == 21
    bronze_table(lake, MEDICAL_CLAIMS).compact(buckets=5)
    assert build_models(lake)["silver_medical_claims"] == "full"
    assert lake.read("silver", "silver_medical_claims").count() == 21


def test_a_run_that_dies_before_gold_is_made_good(spark, lake, monkeypatch):
    def load(run, *claims):
        made = batch(spark, MEDICAL_CLAIMS, *({"claim_id": c, "member_id": "M1"} for c in claims))
        load_batch(lake, MEDICAL_CLAIMS, made, run)

    load_batch(lake, MEMBERS, batch(spark, MEMBERS, {"member_id": "M1"}, {"member_id": "M2"}), "m")
    load("l1", "C1")
    build_models(lake)
    load("l2", "C2")
    with monkeypatch.context() as broken:
        broken.setattr(M, "update_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            build_models(lake)
    assert lake.read("gold", "gold_claims_enriched").count() == 1
    done = build_models(lake)
    assert done["silver_medical_claims"] == "nothing" and done["gold_claims_enriched"] == "buckets"
    assert rows(lake.read("gold", "gold_member_360"), "member_id", "total_claims") == [("M1", 2), ("M2", 0)]


def test_changes_of_a_table_are_found_once_for_both_gold_tables(spark, lake, monkeypatch):
    def load(run, claim, member):
        load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, {"claim_id": claim, "member_id": member}), run)

    load_batch(lake, MEMBERS, batch(spark, MEMBERS, {"member_id": "M1"}, {"member_id": "M2"}), "m")
    load("l1", "C1", "M1")
    build_models(lake)
    load("l2", "C2", "M2")
    found, before = [], KeyedTable.changed_since
    monkeypatch.setattr(KeyedTable, "changed_since", lambda self, *a: found.append(self.name) or before(self, *a))
    assert build_models(lake)["gold_member_360"] == "buckets"
    assert sorted(found) == sorted(SILVER_MODELS)
    assert rows(lake.read("gold", "gold_claims_enriched"), "claim_id", "member_id") == [("C1", "M1"), ("C2", "M2")]
    assert rows(lake.read("gold", "gold_member_360"), "member_id", "total_claims") == [("M1", 1), ("M2", 1)]
    assert not lake.children(lake.path("staging", "changed_silver_medical_claims"))


def test_new_claims_are_added_to_silver_and_gold(spark, lake):
    """Rows of before stay in their files; a NULL key and a changed member are still those of a full build."""
    def load(run, *claims):
        load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, *(
            {"claim_id": c, "member_id": m, "provider_id": "P1", "billed_amount": "9", "allowed_amount": "2"} for c, m in claims)), run)

    def member(run, plan, *ids):
        load_batch(lake, MEMBERS, batch(spark, MEMBERS, *({"member_id": m, "plan_code": plan, "updated_at": "2026-01-01"} for m in ids)), run)

    tables = [M.silver_table(lake, "silver_medical_claims"), M.gold_table(lake, "gold_claims_enriched")]
    member("m1", "A", "M1", "M2")
    load("l1", *((f"C{i}", f"M{i % 3}") for i in range(40)))
    build_models(lake)
    first = [t.snapshot().parts for t in tables]
    load("l2", *((f"C{i}", f"M{i % 3}") for i in range(30, 60)))
    done = build_models(lake)
    assert done["silver_medical_claims"] == done["gold_claims_enriched"] == "buckets"
    for table, parts in zip(tables, first, strict=True):
        now = table.snapshot()
        assert now.parts[:1] == parts and [p.rows for p in now.parts] == [40, 20] and now.rows == table.read().count() == 60
        for b in range(now.buckets):
            assert rows(table.read([b])) == rows(table.read().where(table.bucket(now.buckets) == b))

    def same_as_full():
        done = build_models(lake)
        assert done["silver_medical_claims"] != "full" != done["gold_claims_enriched"]
        kept = contents(lake)
        build_models(lake, full=True)
        assert contents(lake) == kept

    load("l3", (None, "M1"), ("C70", "M2"))
    load("l4", (None, "M0"), ("C71", None))
    member("m2", "B", "M2", "M0", "M7")
    same_as_full()
    member("m3", "C", "M1")
    load_batch(lake, PROVIDERS, batch(spark, PROVIDERS, {"provider_id": "P1", "specialty": "x", "updated_at": "2026-01-01"}), "p1")
    same_as_full()
    assert {r["plan_code"] for r in lake.read("gold", "gold_claims_enriched").where("member_id = 'M1'").collect()} == {"C"}
    assert lake.read("gold", "gold_claims_enriched").where("claim_id is null").count() == 1


def test_tables_too_large_to_broadcast(spark, lake, conf):
    """Claims that joins have moved are dealt out again, whichever side of the update they are on."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rng = random.Random(5)
    for run, counts in enumerate((dict.fromkeys(SPECS, 25), {"claims": 9, "members": 3})):
        for kind, count in counts.items():
            made = [r for r in some(rng, kind, count) if r.get("claim_id", "")]
            load_batch(lake, SPECS[kind], batch(spark, SPECS[kind], *made), f"run{run}", f"2026-09-0{run + 1} 00:00:00")
        build_models(lake)
        kept = contents(lake)
    build_models(lake, full=True)
    assert contents(lake) == kept
