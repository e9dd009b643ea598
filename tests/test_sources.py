import gzip
import json
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from stratalake.schemas import ENROLLMENT_EVENTS, MEDICAL_CLAIMS, MEMBERS, PHARMACY_CLAIMS, PROVIDERS
from stratalake.sources import (
    as_text, broken_pages, changed_since, csv_drops, csv_drops_with_breaks, event_pages, events_since, split_incomplete,
)
from stratalake.sources.csv_drop import _with_source
from stratalake.sources.tables import jdbc_options, stride_predicates, stride_query
from tests.helpers import plan, rows

V1 = "claim_id,member_id,ndc_code,drug_name,quantity,days_supply,fill_time,ingredient_cost,copay_amount"
V2 = V1 + ",pharmacy_npi"


def claim(n, npi=None, drug="Lipitor 20mg"):
    row = f"RX{n},M{n},00071-0155,{drug},30,90,2026-07-02 23:14:00,32.50,5.0"
    return row if npi is None else f"{row},{npi}"


def drop(folder, name, header, *lines):
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_both_versions_without_shifted_values(spark, folder):
    drop(folder, "pharmacy_claims_20260702_23.csv", V1, claim(1))
    drop(folder, "pharmacy_claims_20260703_00.csv", V2, claim(2, "1234567890"))
    got = rows(csv_drops(spark, str(folder)), "claim_id", "copay_amount", "pharmacy_npi", "_source_file")
    assert got == [
        ("RX1", "5.0", None, "pharmacy_claims_20260702_23.csv"),
        ("RX2", "5.0", "1234567890", "pharmacy_claims_20260703_00.csv"),
    ]


def test_columns_are_taken_by_position(spark, folder):
    drop(folder, "a.csv", ",".join(reversed(V1.split(","))), claim(1))
    assert rows(csv_drops(spark, str(folder)), "claim_id", "copay_amount") == [("RX1", "5.0")]


def test_odd_rows_are_kept(spark, folder):
    drop(folder, "a.csv", V2, "RX1,M1", claim(2, "1,extra,more"), claim(3, '""', '"Tablet, ""big"""'), claim(4, ""))
    got = rows(csv_drops(spark, str(folder)), "claim_id", "drug_name", "pharmacy_npi")
    assert got == [("RX1", None, None), ("RX2", "Lipitor 20mg", "1"), ("RX3", 'Tablet, "big"', None),
                   ("RX4", "Lipitor 20mg", None)]


def test_a_compressed_copy_has_the_same_source(spark, folder):
    drop(folder, "a.csv", V1, claim(1))
    with gzip.open(folder / "a.csv.gz", "wt") as f:
        f.write(f"{V1}\n{claim(1)}\n")
    assert rows(csv_drops(spark, str(folder)), "claim_id", "_source_file") == [("RX1", "a.csv")] * 2


def test_sources_are_cut_at_fixed_places_and_searched_for_patterns_only_elsewhere(spark, folder):
    drop(folder, "a.csv", V1, claim(1))
    found = plan(csv_drops(spark, str(folder)))
    assert "regexp_extract" not in found and found.count("regexp_replace") <= 1
    at = f"{folder}/"
    cases = {
        f"file://{at}a.csv": "a.csv", f"file:{at}a.csv": "a.csv", f"{at}a.csv": "a.csv", f"hdfs://h:1{at}d/a.csv.gz": "d/a.csv",
        f"file://{at}a.csv/part-0.csv": "a.csv", f"file://{at}drop=a.csv/part-0.csv.gz": "a.csv", f"file://{at}d/x=a=b.csv": "d/a=b.csv",
        f"file://{at}=a.csv": "=a.csv", f"file://{at}a.csv/d/p=1": "a.csv/d/1", f"file://{at}.csv/p": ".csv", f"file://{at}k=v/a.csv": "k=v/a.csv",
    }
    paths = spark.createDataFrame([(str(n), p) for n, p in enumerate(cases)], "claim_id string, p string")
    paths = paths.select("*", *[F.lit(None).cast("string").alias(c) for c in PHARMACY_CLAIMS.columns if c != "claim_id"])
    got = {r["claim_id"]: r["_source_file"] for r in _with_source(paths, str(folder), F.col("p")).collect()}
    assert got == {str(n): want for n, want in enumerate(cases.values())}


def test_a_folder_of_parts_is_one_drop(spark, folder):
    for where in (folder / "a.csv", folder / "drop=b.csv"):
        where.mkdir()
        for part in (1, 2):
            drop(where, f"part-{part}.csv", V1, claim(part))
    assert rows(csv_drops(spark, str(folder)), "_source_file") == [("a.csv",)] * 2 + [("b.csv",)] * 2


def test_other_files_and_an_empty_folder(spark, folder):
    assert csv_drops(spark, str(folder)).count() == 0
    (folder / "notes.txt").write_text("not a drop")
    assert csv_drops(spark, str(folder)).count() == 0


def test_incomplete_rows(spark, folder):
    drop(folder, "a.csv", V1, claim(1), "RX2,M2", ",M3,x")
    complete, incomplete = split_incomplete(csv_drops(spark, str(folder)), ["claim_id", "copay_amount"])
    assert rows(complete, "claim_id") == [("RX1",)]
    assert rows(incomplete, "claim_id", "missing") == [("RX2", ["copay_amount"]), (None, ["claim_id", "copay_amount"])]


ODD = ["plain", "a, b", 'say ""x""', "two\nlines", "\n", 'x ""\n"", y', "end\n"]


def quoted_drop(folder, name, columns, values):
    lines = "".join(f"RX{i},M{i},{n},\"{v}\"\n" for i, (v, n) in enumerate(zip(values, range(len(values)), strict=True)))
    (folder / name).write_text(",".join(columns) + "\n" + lines)


@pytest.mark.parametrize("split", [None, 7, 64])
def test_records_over_several_lines(spark, folder, conf, split):
    if split:
        conf(spark__sql__files__maxPartitionBytes=str(split), spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1")
    names = ["claim_id", "member_id", "ndc_code", "drug_name"]
    for file, values in (("a.csv", ODD), ("b.csv", list(reversed(ODD)) * 5)):
        quoted_drop(folder, file, names, values)
    got, broken = csv_drops_with_breaks(spark, str(folder))
    want = [(f"RX{i}", v.replace('""', '"'), file) for file, values in (("a.csv", ODD), ("b.csv", list(reversed(ODD)) * 5))
            for i, v in enumerate(values)]
    assert rows(got, "claim_id", "drug_name", "_source_file") == sorted(want, key=repr)
    assert broken.count() == 0


def test_a_quote_without_an_end_is_set_aside(spark, folder):
    (folder / "a.csv").write_text('claim_id,member_id\r\nRX1,"M\r\n1"\r\n\r\nRX2,"M2\nRX3,M3\n')
    (folder / "b.csv").write_text('claim_id,member_id\nRX4,M4\n')
    (folder / "c.csv").write_text("")
    got, broken = csv_drops_with_breaks(spark, str(folder))
    assert rows(got, "claim_id", "member_id", "copay_amount") == [("RX1", "M\r\n1", None), ("RX4", "M4", None)]
    assert rows(broken, "reason", "line") == [("a quote is not closed", 'RX2,"M2'), ("a quote is not closed", "RX3,M3")]


def test_columns_by_name(spark, folder):
    (folder / "a.csv").write_text('drug_name, Claim_ID ,extra\n"x, y",RX1,1\n,RX2\n')
    (folder / "b.csv").write_text('member_id,"claim_id",pharmacy_npi\nM3,RX3,9\n')
    (folder / "c.csv").write_text("claim_id\n")
    got, broken = csv_drops_with_breaks(spark, str(folder), by_name=True)
    assert rows(got, "claim_id", "member_id", "drug_name", "pharmacy_npi", "_source_file") == [
        ("RX1", None, "x, y", None, "a.csv"), ("RX2", None, None, None, "a.csv"), ("RX3", "M3", None, "9", "b.csv")]
    assert broken.count() == 0
    empty = folder / "none"
    empty.mkdir()
    assert csv_drops_with_breaks(spark, str(empty), by_name=True)[0].count() == 0


def event(n, time="2026-07-01T10:05:00"):
    return {"event_id": f"EV{n}", "member_id": "M1", "event_type": "ENROLLED", "plan_code": "PPO_GOLD",
            "event_time": time, "created_at": "2026-07-01T10:00:00"}


def landed(folder, name, *pages):
    (folder / name).write_text("".join(json.dumps(p) + "\n" for p in pages))


def test_pages_are_put_together(spark, folder):
    landed(folder, "p1.json", {"data": [event(1), event(2)], "count": 2, "total_matched": 4, "next_cursor": 2})
    landed(folder, "p2.json", {"data": [event(2), event(3)], "count": 2, "total_matched": 4, "next_cursor": None},
           {"data": [], "count": 0, "total_matched": 0, "next_cursor": None})
    events = event_pages(spark, str(folder))
    assert events.columns == list(ENROLLMENT_EVENTS.columns)
    assert rows(events, "event_id") == [("EV1",), ("EV2",), ("EV2",), ("EV3",)]


def test_events_filter_is_inclusive(spark):
    events = spark.createDataFrame(
        [(t,) for t in ("2026-07-01T09:59:59", "2026-07-01T10:00:00", "2026-07-01 10:00:01", "soon", None)],
        "event_time string",
    )
    assert rows(events_since(events, "2026-07-01T10:00:00")) == [
        ("2026-07-01 10:00:01",), ("2026-07-01T10:00:00",), ("soon",), (None,)]


def member_table(spark, *times):
    data = [(f"M{i}", datetime.fromisoformat(t)) for i, t in enumerate(times)]
    df = spark.createDataFrame(data, "member_id string, updated_at timestamp_ntz")
    return df.selectExpr(*[c if c in df.columns else f"CAST(NULL AS STRING) AS {c}" for c in MEMBERS.columns], "1 AS extra")


def test_table_filter_is_exclusive_and_takes_the_load_columns(spark):
    table = member_table(spark, "2026-07-01T09:59:59", "2026-07-01T10:00:00", "2026-07-01T10:00:01")
    changed = changed_since(table, MEMBERS, "2026-07-01T10:00:00")
    assert changed.columns == list(MEMBERS.columns)
    assert rows(changed, "member_id") == [("M2",)]


def test_table_filter_and_columns_reach_the_scan(spark, folder):
    member_table(spark, "2026-07-01T10:00:00").write.parquet(str(folder / "t"))
    text = plan(changed_since(spark.read.parquet(str(folder / "t")), MEMBERS, "2026-07-01T10:00:00"))
    assert "GreaterThan(updated_at,2026-07-01T10:00)" in text and "extra" not in text


def test_as_text(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b, DATE '2026-07-01' AS d, 12.50BD AS x, "
                   "TIMESTAMP_NTZ '2026-07-01 10:00:00' AS t")
    assert rows(as_text(df)) == [("1", None, "2026-07-01", "12.50", "2026-07-01 10:00:00")]
    assert {t for _, t in as_text(df).dtypes} == {"string"}


@pytest.mark.parametrize("spec", [MEDICAL_CLAIMS, MEMBERS])
def test_jdbc_reads_are_split_by_change_time(spec):
    options = jdbc_options(spec, f"dbo.{spec.name}", "2026-07-01T00:00:00", "2026-07-02T00:00:00", 8)
    assert options["dbtable"] == f"dbo.{spec.name}"
    assert options["partitionColumn"] == "updated_at" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("2026-07-01 00:00:00", "2026-07-02 00:00:00")


def test_broken_pages_are_told_apart(spark, folder):
    whole = '{"data": [{"event_id": "e1", "event_time": "2026-07-01T10:00:00"}], "count": 1}'
    (folder / "a.json").write_text("\n".join([
        whole, whole[:40], '{"data": "none", "count": 1}', '{"count": 3}', '{"data": [], "count": 0}',
        '{"data": [{"event_id": "e2"}], "count": 2}', '{', '  "data": []', '}',
    ]))
    found = rows(broken_pages(spark, str(folder)), "reason")
    assert found == [("no list of events",)] + [("not a page in JSON",)] * 5 + [("not as many events as it says",)]
    assert rows(event_pages(spark, str(folder)), "event_id") == [("e1",), ("e2",)]


def test_drops_of_one_name_in_two_folders(spark, folder):
    for name in ("d1", "d2"):
        (folder / name).mkdir()
        (folder / name / "x.csv").write_text("claim_id\nRX1\n")
    assert rows(csv_drops(spark, str(folder)), "claim_id", "_source_file") == [("RX1", "d1/x.csv"), ("RX1", "d2/x.csv")]


def test_text_update_times_compare_as_times(spark):
    source = spark.createDataFrame(
        [(t,) for t in ("2026-07-01T10:00:00", "2026-07-01 10:00:00", "2026-07-01T10:00:01", "soon", None)], "updated_at string")
    full = source.select(*[F.lit("x").alias(c) for c in PROVIDERS.columns if c != "updated_at"], "updated_at")
    assert rows(changed_since(full, PROVIDERS, "2026-07-01 10:00:00"), "updated_at") == [
        ("2026-07-01T10:00:01",), ("soon",), (None,)]


def test_even_strides_cover_each_row_once(spark):
    times = [None, *("2026-07-01 %02d:00:00" % h for h in (1, 1, 1, 2, 3, 9, 9, 12))]
    df = spark.createDataFrame([(t,) for t in times], "updated_at string")
    assert "NTILE(4) OVER (ORDER BY updated_at)" in stride_query(MEMBERS, "dbo.members", "2026-07-01T00:00:00", 4)
    for bounds in ([], [times[1]], [times[1], times[1], times[5], None, times[8]]):
        predicates = stride_predicates(MEMBERS, bounds)
        assert sorted(sum((rows(df.where(p)) for p in predicates), []), key=repr) == sorted(((t,) for t in times), key=repr)
    assert len(stride_predicates(MEMBERS, times)) == 5


def test_lines_of_records_are_read_once_and_whole_ones_not_grouped(spark, folder):
    drop(folder, "a.csv", V1, claim(1), claim(2, drug='"two\nlines"'), claim(3) + "\r")
    got, broken = csv_drops_with_breaks(spark, str(folder), kept=f"{folder}/kept")
    found = plan(got)
    assert "Scan text" not in found and "Scan text" not in plan(broken) and "Scan parquet" in found
    assert rows(spark.read.parquet(f"{folder}/kept"), "value") == sorted(
        [(x,) for x in (V1, claim(1), *claim(2, drug='"two\nlines"').split("\n"), claim(3) + "\r")], key=repr)
    assert rows(got, "claim_id", "drug_name", "copay_amount") == [
        ("RX1", "Lipitor 20mg", "5.0"), ("RX2", "two\nlines", "5.0"), ("RX3", "Lipitor 20mg", "5.0")]
    assert broken.count() == 0
