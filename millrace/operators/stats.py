"""Exact order statistics and positions without a global sort in one task."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_statistics(df: DataFrame, column: str) -> DataFrame:
    """One row: n, total, least, p50 (upper median), p95 (item floor(0.95 n) from 0), most. Nulls are left out; no rows give nulls.

    Values are counted first, so the running count goes over distinct values only (a bounded domain such as window sizes)."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = counted.select("v", "c", upto.alias("upto"), F.sum("c").over(total).alias("n"))

    def item(at):
        return F.min(F.when(F.col("upto") > at, F.col("v")))

    n = F.col("n")
    return s.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.sum(F.col("v") * F.col("c")).alias("total"), F.min("v").alias("least"), item(F.floor(n / 2)).alias("p50"),
        item(F.floor(n * F.lit(0.95))).alias("p95"), F.max("v").alias("most"),
    )


def at_positions(df: DataFrame, key: str, tie: str, wanted: Callable[[int], dict[str, int]]) -> DataFrame:
    """The rows at the wanted 1-based places of the order by key (a hex digest) and tie, with a label; labels of one place: the first.

    Rows are counted by the first four digits; only the parts that hold a wanted place are ranked."""
    part = F.substring(key, 1, 4)
    counts = sorted((r[0], r[1]) for r in df.groupBy(part).count().collect())  # at most 65536 rows
    n = sum(c for _, c in counts)
    places: dict[int, str] = {}
    for label, p in wanted(n).items():
        if 1 <= p <= n:
            places.setdefault(p, label)
    before, hits = 0, []
    for p, c in counts:
        hits += [(p, place - before, label) for place, label in places.items() if before < place <= before + c]
        before += c
    spark = df.sparkSession
    found = spark.createDataFrame(hits, "_part string, _place int, label string")
    rows = df.withColumn("_part", part).where(F.col("_part").isin([h[0] for h in hits]) if hits else F.lit(False))
    ranked = rows.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(key, tie)))
    return ranked.join(F.broadcast(found), ["_part", "_place"]).drop("_part", "_place")
