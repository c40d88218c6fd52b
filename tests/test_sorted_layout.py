"""Tables written in ranges: a filter on the leading column reads few row groups, and order needs no sort."""
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillroll.plans import pipeline
from tillroll.sources import files


def groups(folder, column):
    """(min, max, rows) of every row group, files in name order."""
    found = []
    for path in sorted(glob.glob(f"{folder}/part-*.parquet")):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        found += [(meta.row_group(i).column(at).statistics.min, meta.row_group(i).column(at).statistics.max,
                   meta.row_group(i).num_rows) for i in range(meta.num_row_groups)]
    return found


def sales(spark):
    """60,000 rows of 24 months in no order, a third of them in one month."""
    n = F.col("id")
    month = F.when(n % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(24))).cast("int")
    return spark.range(60_000).repartition(6).select(
        F.format_string("2%03d-%02d", F.lit(1) + F.floor(month / 12), month % 12 + 1).alias("month"),
        F.sha2(n.cast("string"), 256).alias("region"), n.alias("units"))


def test_a_month_filter_reads_few_row_groups(spark, tmp_lake):
    df = sales(spark)
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.setInt("parquet.block.size", 64 << 10)
    hadoop.setInt("parquet.page.size.row.check.min", 100)
    try:
        plain, _ = files.stage_version(df, tmp_lake, "gold", "plain")
        laid, _ = files.stage_version(df, tmp_lake, "gold", "laid", sort_by=["month", "region"])
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size.row.check.min")

    def read(table, v, month):
        found = groups(f"{tmp_lake}/gold/{table}/v={v}", "month")
        return sum(rows for low, high, rows in found if low <= month <= high), sum(rows for *_, rows in found)

    held = df.filter("month = '2002-03'").count()
    touched, total = read("laid", laid, "2002-03")
    assert total == 60_000 and held <= touched < total / 4
    assert read("plain", plain, "2002-03")[0] == total
    back = spark.read.parquet(f"{tmp_lake}/gold/laid/v={laid}")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_ranges_follow_each_other(spark, tmp_lake):
    v, _ = files.stage_version(sales(spark), tmp_lake, "gold", "laid", sort_by=["month", "region"])
    found = groups(f"{tmp_lake}/gold/laid/v={v}", "month")
    assert sum(rows for *_, rows in found) == 60_000
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_gold_stores_lie_in_the_order_of_the_leaderboard(spark, tmp_lake):
    stores = spark.range(3000).select(F.col("id").cast("string").alias("store_id"),
                                      F.pmod(F.xxhash64("id"), F.lit(500)).cast("double").alias("revenue"))
    v = files.write_version(spark, stores, tmp_lake, "gold", "store_performance", pipeline._gold_order()["store_performance"])
    at = [(-r, s) for path in sorted(glob.glob(f"{tmp_lake}/gold/store_performance/v={v}/part-*.parquet"))
          for r, s in zip(*(pq.read_table(path).to_pydict()[c] for c in ("revenue", "store_id")))]
    assert len(at) == 3000 and at == sorted(at)


def test_an_empty_table_keeps_its_columns(spark, tmp_lake):
    v = files.write_version(spark, sales(spark).limit(0), tmp_lake, "gold", "none", ["month"])
    assert spark.read.schema("month string").parquet(f"{tmp_lake}/gold/none/v={v}").count() == 0
