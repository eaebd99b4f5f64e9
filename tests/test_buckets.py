"""Bucketed scratch tables."""

import os

from parcelmart.operators.buckets import write_buckets


def test_joins_of_bucketed_tables_do_not_shuffle(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = write_buckets(spark.range(1000).selectExpr("id", "id * 2 AS a"), "id", 4, "a")
        b = write_buckets(spark.range(0, 1000, 7).selectExpr("id"), "id", 4, "b")
        left = a.rows.join(b.rows, "id", "left_anti")
        assert left.count() == 1000 - 143
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        rest = write_buckets(left, "id", 4, "rest", shuffle=False)
        kept = rest.rows.join(a.rows, "id", "left_semi")
        assert kept.count() == 857 and "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        for t in (a, b, rest):
            t.drop()
            assert not os.path.exists(t.path.removeprefix("file:"))
        assert spark.sql("SHOW TABLES LIKE 'parcelmart_*'").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
