import json
import os

import pytest
from pyspark.sql import functions as F

from stratalake import Lake
from stratalake.keyed import BUCKET, FOLDER, KeyedTable, touched
from stratalake.operators import unmatched
from stratalake.plans import load_batch, read_bronze
from stratalake.plans import bronze as loads
from stratalake.plans.bronze import bronze_table
from stratalake.schemas import MEDICAL_CLAIMS, MEMBERS
from tests.helpers import batch, plan, rows


@pytest.fixture
def table(lake) -> KeyedTable:
    return lake.keyed("bronze", "t", "k")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int")


def many(spark, first, last, v=0):
    return spark.range(first, last).selectExpr("concat('k', id) AS k", f"{v} AS v")


def files(table):
    return {os.path.join(d, f) for d, _, names in os.walk(table.data) for f in names if f.endswith(".parquet")}


def test_appends_add_up(spark, table):
    assert table.append(frame(spark, ("a", 1), (None, 2)), "l1") == 2
    assert table.append(frame(spark, ("b", 3), (None, 4)), "l2") == 2
    at = table.snapshot()
    assert rows(table.read()) == [("a", 1), ("b", 3), (None, 2), (None, 4)]
    assert (at.rows, [p.loads for p in at.parts]) == (4, [("l1",), ("l2",)])
    assert table.append(frame(spark, ("c", 5)), "l2", replacing=True) == 1
    assert rows(table.read()) == [("a", 1), ("c", 5), (None, 2)] and table.snapshot().rows == 3
    assert rows(table.lake.read("bronze", "t")) == rows(table.read())


def test_an_empty_write_commits_no_folder(spark, table):
    assert table.append(frame(spark, ("a", 1)).limit(0), "l1") == 0
    assert table.snapshot().parts == () and table.read().count() == 0 and table.read().columns == ["k", "v"]
    with pytest.raises(FileNotFoundError):
        table.lake.keyed("bronze", "other", "k").read()


def test_rows_of_a_key_share_a_bucket_and_the_rest_is_not_listed(spark, table):
    for load in range(3):
        table.append(many(spark, 0, 200, load), f"l{load}")
    bucket = spark.range(1).select(F.lit("k7").alias("k")).select(table.bucket(16)).first()[0]
    one = table.read([bucket])
    assert rows(one.where("k = 'k7'")) == [("k7", 0), ("k7", 1), ("k7", 2)]
    assert 0 < one.count() < 600 / 4
    scan = next(line for line in plan(one).splitlines() if "FileScan" in line or "PartitionFilters" in line)
    assert BUCKET in scan.split("PartitionFilters")[1]
    assert {r[0].split(f"{BUCKET}=")[1].split("/")[0] for r in one.select(F.input_file_name()).collect()} == {str(bucket)}


def test_a_merge_reads_the_buckets_of_its_batch(spark, lake, monkeypatch):
    def claims(*ids):
        return batch(spark, MEDICAL_CLAIMS, *({"claim_id": f"C{i}"} for i in ids))

    load_batch(lake, MEDICAL_CLAIMS, claims(*range(100)), "l1")
    seen = []
    monkeypatch.setattr(loads, "unmatched", lambda new, target, *a, **k: seen.append((new, target)) or unmatched(new, target, *a, **k))
    audit = load_batch(lake, MEDICAL_CLAIMS, claims(5, 100), "l2")
    assert (audit.rows_inserted, audit.rows_total) == (1, 101)
    new, target = seen[0]
    text = plan(target)
    assert f"PartitionFilters: [isnotnull({BUCKET}" in text or f"PartitionFilters: [{BUCKET}" in text
    wanted = {r[0] for r in spark.createDataFrame([("C5",), ("C100",)], "claim_id string").select(
        bronze_table(lake, MEDICAL_CLAIMS).bucket(16)).collect()}
    assert {int(r[0].split(f"{BUCKET}=")[1].split("/")[0]) for r in target.select(F.input_file_name()).collect()} <= wanted


def test_a_load_that_dies_half_way_is_not_seen(spark, lake):
    load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, {"claim_id": "C1"}), "l1")
    table, reader = bronze_table(lake, MEDICAL_CLAIMS), read_bronze(lake, MEDICAL_CLAIMS)
    before = table.snapshot()
    # half of a load's files, as a dead job leaves them
    half = read_bronze(lake, MEDICAL_CLAIMS).withColumn("claim_id", F.lit("C2")).withColumn(BUCKET, F.lit(3))
    half.write.partitionBy(BUCKET).parquet(f"{table.data}/{FOLDER}=wdead")
    # and one whose entry was not written to its end
    lake.create_text(f"{table.path}/_log/{before.number + 1:012d}.json", '{"number": 2, "buck')
    assert table.snapshot() == before
    assert rows(reader, "claim_id") == rows(read_bronze(lake, MEDICAL_CLAIMS), "claim_id") == [("C1",)]
    audit = load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, {"claim_id": "C2"}, {"claim_id": "C1"}), "l1")
    assert (audit.rows_inserted, audit.rows_total) == (1, 2)
    assert table.snapshot().number == before.number + 2 and not lake.exists(f"{table.data}/{FOLDER}=wdead")


def test_a_failing_write_leaves_the_rows_before(spark, table):
    table.append(frame(spark, ("a", 1)), "l1")
    with pytest.raises(Exception, match="(?i)divi"):
        table.append(frame(spark, ("b", 0), ("c", 1)).selectExpr("k", "CAST(1 DIV v AS INT) AS v"), "l2")
    assert rows(table.read()) == [("a", 1)]


def test_a_second_writer_fails(spark, table):
    table.append(frame(spark, ("a", 1)), "l1")
    before = table.snapshot()
    table.append(frame(spark, ("b", 1)), "l2")
    with pytest.raises(RuntimeError, match="another writer"):
        table.append(frame(spark, ("c", 1)), "l3", before)
    assert rows(table.read(), "k") == [("a",), ("b",)]


def test_readers_stay_on_what_they_have(spark, table):
    table.append(many(spark, 0, 50), "l1")
    reader = table.read()
    table.overwrite(many(spark, 0, 5), "l2")
    assert reader.count() == 50 and table.read().count() == 5
    table.append(many(spark, 5, 6), "l3")
    table.append(many(spark, 6, 7), "l4")
    assert len([n for n in table.lake.children(table.data)]) == 3


# -- updates --------------------------------------------------------------------

def test_an_update_leaves_files_of_other_buckets(spark, lake):
    def members(plan_code, *ids):
        return batch(spark, MEMBERS, *({"member_id": f"M{i}", "plan_code": plan_code, "updated_at": "2026-01-01"} for i in ids))

    load_batch(lake, MEMBERS, members("A", *range(200)), "l1")
    table = bronze_table(lake, MEMBERS)
    before, in_force = files(table), table.folders()
    audit = load_batch(lake, MEMBERS, members("B", 3, 900), "l2")
    assert (audit.rows_in, audit.rows_deduped, audit.rows_inserted, audit.rows_updated, audit.rows_total) == (2, 2, 1, 1, 201)
    assert before < files(table) and len(in_force) == 1
    buckets = {b for p in table.snapshot().parts for b in p.buckets if p.loads == ("l2",)}
    assert 1 <= len(buckets) <= 2
    kept = next(p for p in table.snapshot().parts if p.loads == ("l1",))
    assert not kept.whole and set(kept.buckets).isdisjoint(buckets)
    got = dict(rows(read_bronze(lake, MEMBERS), "member_id", "plan_code"))
    assert len(got) == 201 and {k for k, v in got.items() if v == "B"} == {"M3", "M900"}
    read = {r[0] for r in read_bronze(lake, MEMBERS).select(F.input_file_name()).distinct().collect()}
    assert len(read & {f"file://{f}" for f in before}) > 5


def test_rewriting_buckets_without_flags_counts_rows(spark, table):
    table.append(many(spark, 0, 100), "l1")
    before = table.snapshot()
    table.rewrite(table.read([0, 1]).where("v = 1"), [0, 1], "l2", before)
    assert table.snapshot().rows == table.read().count() < 100


# -- compaction -----------------------------------------------------------------

def test_compaction_keeps_the_rows_in_fewer_files(spark, table):
    for load in range(5):
        table.append(many(spark, 40 * load, 40 * load + 60, load), f"l{load}")
    before, rows_before = table.snapshot(), rows(table.read())
    files_before = {f for f in files(table)}
    reader = table.read()
    assert table.compact()
    assert rows(table.read()) == rows_before and rows(reader) == rows_before
    at = table.snapshot()
    assert len(at.parts) == 1 and at.rows == 300 and touched(before, at) == ([], [])
    new = files(table) - files_before
    assert len(new) <= 16 < len(files_before)
    for file in new:  # sorted by key
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)
    assert not table.compact()


def test_a_load_put_together_with_others_is_not_loaded_again(spark, lake):
    made = batch(spark, MEDICAL_CLAIMS, {"claim_id": "C1"}, {"claim_id": None})
    load_batch(lake, MEDICAL_CLAIMS, made, "s1", fixed_batch=True)
    load_batch(lake, MEDICAL_CLAIMS, batch(spark, MEDICAL_CLAIMS, {"claim_id": "C2"}), "s2", fixed_batch=True)
    assert bronze_table(lake, MEDICAL_CLAIMS).compact()
    again = load_batch(lake, MEDICAL_CLAIMS, made, "s1", fixed_batch=True)
    assert (again.rows_inserted, again.rows_total) == (0, 3)


def test_a_grown_table_gets_more_buckets(spark, table):
    table.append(many(spark, 0, 300), "l1")
    want = rows(table.read())
    assert table.compact(buckets=40)
    at = table.snapshot()
    assert at.buckets == 40 and max(at.parts[0].buckets) > 16 and rows(table.read()) == want
    table.append(many(spark, 300, 400), "l2")
    assert max(table.snapshot().parts[1].buckets) > 16 and table.read().count() == 400


def test_touched_buckets(spark, table):
    table.append(many(spark, 0, 100), "l1")
    first = table.snapshot()
    table.append(frame(spark, ("k1", 7)), "l2")
    second = table.snapshot()
    new, buckets = touched(first, second)
    assert [p.loads for p in new] == [("l2",)] and buckets == list(new[0].buckets) and len(buckets) == 1
    table.rewrite(table.read([4]), [4], "l3", second)
    assert touched(second, table.snapshot())[1] == [4]
    table.append(frame(spark, ("k1", 8)), "l2", replacing=True)
    assert set(touched(second, table.snapshot())[1]) == {4, *buckets}


def test_the_log_is_plain_json(spark, lake):
    Lake(spark, lake.root, buckets=3).keyed("bronze", "t", "k").append(frame(spark, ("a", 1)), "l1")
    entry = json.loads(lake.read_text(f"{lake.path('bronze', 't')}/_log/000000000001.json"))
    assert entry["buckets"] == 3 and entry["rows"] == 1 and entry["parts"][0]["loads"] == ["l1"]


def test_jobs_of_a_load(spark, lake):
    """Rows, newest time, buckets and totals come from the tasks that write: stage, merge, watermark."""
    def jobs(load):
        tracker, group = spark.sparkContext.statusTracker(), f"jobs of {load}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            made = batch(spark, MEDICAL_CLAIMS, {"claim_id": load, "updated_at": "2026-01-01"})
            load_batch(lake, MEDICAL_CLAIMS, made, load, full_audit=False)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert [jobs("l1"), jobs("l2"), jobs("l3")][1:] <= [12, 12]
