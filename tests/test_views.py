"""Streams of tables that are folders of part files."""

from dealscope.plans import views
from dealscope.plans.catalog import QUERIES
from dealscope.streaming import feeds


def taken_in(spark, tmp_path, folder, name):
    rows = views.stream(spark, folder, name)
    out = f"file://{tmp_path}/out-{name}"
    feeds.append_raw(rows, "test", out, f"file://{tmp_path}/c-{name}", feeds.AVAILABLE_NOW)
    return spark.read.parquet(out).select(*rows.columns)


def test_part_files_and_partitions(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    rows = spark.range(100).selectExpr("id", "id % 3 AS k")
    rows.repartition(4).write.parquet(f"{folder}/plain.parquet")
    rows.repartition(2).write.partitionBy("k").parquet(f"{folder}/parted.parquet")
    for name in ("plain", "parted"):
        got = taken_in(spark, tmp_path, folder, name).selectExpr("int(id) AS id", "int(k) AS k").collect()
        assert sorted(map(tuple, got)) == [(i, i % 3) for i in range(100)], name


def test_daily_stream_of_a_folder(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(5).write.parquet(f"file://{tmp_path}/events.parquet")
    one, parts = (QUERIES["funnel_daily_stream"](spark, d) for d in (sf_dir, f"file://{tmp_path}"))
    assert one.count() > 0 and one.exceptAll(parts).isEmpty() and parts.exceptAll(one).isEmpty()
