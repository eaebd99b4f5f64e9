"""What lies on disk: compressed tables, shuffle files that go with their write, and narrow rows where they move."""

import gzip
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_scale import tuned  # noqa: F401
from test_tables import D1, orders_frame

from parcelmart.plans import source_queries
from parcelmart.plans.landing import land_orders
from parcelmart.plans.loads import Layout, load_orders, read_base
from parcelmart.schemas import EXPORT_FIELDS
from parcelmart.session import CLEANUP, tidy
from parcelmart.sources import exports, payloads


def pages(spark, n=50):
    return spark.range(n).select(
        F.lit("2026-01-05").cast("timestamp").alias("run_ts"), F.lit("s").alias("source"), F.col("id").alias("page"),
        F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("payload"),
    )


def codecs(path):
    groups = [pq.read_metadata(f).row_group(0) for f in path.rglob("*.parquet")]
    return {g.column(k).compression for g in groups for k in range(g.num_columns)}


def test_landed_and_staged_tables_are_compressed_well(tuned, tmp_path):  # noqa: F811
    payloads.land_raw(pages(tuned), str(tmp_path / "raw"))
    load_orders(tuned, Layout(str(tmp_path / "w")), orders_frame(tuned, (1, D1, "A", "Delivered")))
    assert codecs(tmp_path / "raw") == codecs(tmp_path / "w/staging/orders") == codecs(tmp_path / "w/mart") == {"ZSTD"}


def shuffled(spark):
    """Bytes of shuffle files by name."""
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName(): files.apply(k).length() for k in range(files.size()) if files.apply(k).getName().endswith(".data")}


def left_by(spark, action):
    before = set(shuffled(spark))
    action()
    for _ in range(50):  # Spark removes them in the background
        left = sum(size for name, size in shuffled(spark).items() if name not in before)
        if left < 100_000:
            break
        time.sleep(0.1)
    return left


def wide_orders(spark, n=20_000):
    one = orders_frame(spark, (1, D1, "A", "Delivered")).drop("order_id", "city")
    ids = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("order_id"), F.sha2(F.col("id").cast("string"), 224).alias("city"))
    return one.crossJoin(ids).select(*orders_frame(spark).columns)


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    orders, layout = wide_orders(spark), Layout(str(tmp_path / "w"), buckets=8)
    before = spark.conf.get(CLEANUP)
    assert left_by(spark, lambda: load_orders(spark, layout, orders)) < 100_000
    assert left_by(spark, lambda: land_orders(orders, layout, 1)) < 100_000
    assert spark.conf.get(CLEANUP) == before
    assert read_base(spark, layout).agg(F.sum("n_rows")).first()[0] == 20_000


def test_tidy_puts_the_setting_back(spark):
    before = spark.conf.get(CLEANUP)
    try:
        with tidy(spark):
            assert spark.conf.get(CLEANUP) == "true"
            raise OSError
    except OSError:
        pass
    assert spark.conf.get(CLEANUP) == before


def test_cells_are_made_where_rows_have_moved(spark, tmp_path):
    df = spark.range(300).select("id")
    cells = [F.concat(F.lit("L-"), "id").alias("a"), F.lit("").alias("b")]
    path = source_queries.write_titled_csv(df, str(tmp_path / "t"), 300, cells, "gzip")
    files = list((tmp_path / "t").glob("part=*/*.csv.gz"))
    assert files and all(gzip.open(f, "rt").read().splitlines()[:2] == ["Report 0,Report 1", "a,b"] for f in files)
    back = exports.read_layout(spark, [path], ["a", "b"]).filter("a <> 'a'")
    assert sorted(r.a for r in back.collect()) == sorted(f"L-{k}" for k in range(300))
    # a file without rows has its header row as well
    source_queries.write_titled_csv(df.limit(0), str(tmp_path / "e"), 0, cells, "gzip")
    assert len(list((tmp_path / "e").glob("part=*/*.csv.gz"))) == max(2, spark.sparkContext.defaultParallelism // 4)


def test_landed_exports_are_those_of_all_lines(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    paths = source_queries.land_exports(spark, sf, str(tmp_path))
    fields = [f for f in EXPORT_FIELDS if f != "pickup_region"]  # titled exports have it in three empty parts
    back = exports.read_exports(spark, paths).select(*fields)
    whole = exports._na_to_null(source_queries.shipments(spark, sf, fields))
    assert back.exceptAll(whole).count() == whole.exceptAll(back).count() == 0


def test_a_first_load_holds_repeated_keys_once(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"))
    load_orders(spark, layout, orders_frame(spark, (1, D1, "A", "Delivered"), (2, D1, "A", "Delivered"), (3, None, "A", "Lost")))
    rows = read_base(spark, layout).collect()
    assert sorted((str(r.week_of_year), r.total_shipments, r.n_rows) for r in rows) == [("6", 2, 2), ("None", 1, 1)]
