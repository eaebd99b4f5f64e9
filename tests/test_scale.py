"""What keeps tasks, files and expressions small as the input grows."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_tables import D1, orders_frame

from parcelmart.functions import numbers
from parcelmart.plans import source_queries
from parcelmart.plans.loads import Layout, load_orders
from parcelmart.session import TUNING, tune
from parcelmart.sources import exports, payloads


@pytest.fixture
def tuned(spark):
    before = {key: spark.conf.get(key) for key in TUNING}
    tune(spark)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_numbers_parse_their_input_once(spark):
    df = spark.createDataFrame([("1,250.50",), (" 7 ",), ("1e400",), ("-1e999",), ("-0",), ("NaN",), ("Infinity",), ("1d",), ("",), (None,)], "x string")
    both = df.select(numbers.parse_number(F.col("x")).alias("n"), numbers.parse_money(F.col("x")).alias("m"))
    assert [r.n for r in both.collect()] == [1250.5, 7.0] + [0.0] * 8
    assert [float(r.m) for r in both.collect()] == [1250.5, 7.0] + [0.0] * 8
    plan = df.select(numbers.parse_money(F.col("x")).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    lines = [part for part in plan.splitlines() if "translate(" in part]
    assert plan.count("translate(") == 1, lines


def test_amounts_beyond_money_stay_null(spark):
    df = spark.createDataFrame([("9" * 23,)], "x string")
    assert df.select(numbers.parse_money(F.col("x"))).first()[0] is None


@pytest.mark.parametrize(("rows", "files"), [(10, 2), (1_000_000, 10)])
def test_titled_exports_grow_by_files(spark, tmp_path, rows, files):
    df = spark.range(500).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    path = source_queries.write_titled_csv(df, str(tmp_path / "titled"), rows)
    written = list((tmp_path / "titled").glob("part=*/*.csv"))
    assert len(written) == max(files, spark.sparkContext.defaultParallelism // 4)
    assert all(f.read_text().splitlines()[:2] == ["Report 0,Report 1", "a,b"] for f in written)
    back = exports.read_layout(spark, [path], ["a", "b"])
    assert back.filter("a <> 'a'").count() == 500


def test_a_load_writes_a_file_per_bucket(spark, tmp_path):
    orders = orders_frame(spark, *[(f"o{k}", D1, "c", "Delivered") for k in range(400)])
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        load_orders(spark, Layout(str(tmp_path), buckets=16), orders)
    finally:
        spark.conf.set(key, before)
    files = list((tmp_path / "staging/orders/load=1/has_id=true").glob("*.parquet"))
    assert sum(pq.read_metadata(f).num_rows for f in files) == 400
    assert len(files) <= 16  # one per task and bucket were 8 x 16


def test_the_audit_sorts_the_heads_of_files_only(tuned, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{k}\n" for k in range(20_000)))
    (tmp_path / "b.txt").write_text("\n" * 4095 + ",")
    (tmp_path / "c.txt").write_text("\n" * 4096 + ",")
    audit = exports.file_format_audit(tuned, str(tmp_path))
    assert {r.path[-5:]: r.format for r in audit.collect()} == {"a.txt": "unsupported", "b.txt": "csv", "c.txt": "unsupported"}
    plan = audit._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    limit = final.index("WindowGroupLimit")
    assert "first" in final[limit:] and "4096" in final[final.index("Join", limit):]


def test_payloads_land_as_one_column(tuned, tmp_path):
    rows = tuned.range(50).select(
        F.lit("2026-01-05").cast("timestamp").alias("run_ts"), F.lit("s").alias("source"), F.col("id").alias("page"),
        F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("payload"),
    )
    payloads.land_raw(rows, str(tmp_path))
    files = list(tmp_path.glob("source=s/*/*.parquet"))
    assert files and all("typed_value" not in str(pq.read_schema(f).field("body").type) for f in files)
    assert payloads.unreadable_payloads(payloads.read_raw(tuned, str(tmp_path))).count() == 0


def test_json_records_are_compressed(spark):
    df = source_queries.records_json(spark, "/root/testdata/sf0.001")
    assert all(f.endswith(".json.gz") for f in df.inputFiles())
