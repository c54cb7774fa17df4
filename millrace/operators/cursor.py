"""Progress through ordered rows: cursors under a commit policy, resuming, and reports at every so many rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: When a run commits its cursor: after each row that succeeded, after each row, or never (a run that retries what is missing).
POLICIES = ("success", "every", "never")


def committed(df: DataFrame, key: str, pos: str, ok: Column, policy: str = "every", start: Column | int = 0) -> DataFrame:
    """(key, cursor): the place after the last row that commits, start where none does. df has the rows that were worked on, with their
    0-based place; partial maxima are combined before the shuffle. Rows that are rejected after the last success are done again under
    the policy "success"."""
    if policy not in POLICIES:
        raise ValueError(f"{policy} is none of {', '.join(POLICIES)}")
    counts = F.lit(False) if policy == "never" else ok if policy == "success" else F.lit(True)
    start = start if isinstance(start, Column) else F.lit(start)
    return df.groupBy(key).agg(F.greatest(F.coalesce(F.max(F.when(counts, F.col(pos) + 1)), F.lit(0)), F.max(start)).cast("long").alias("cursor"))


def resumed(cursor: Column, n: Column) -> Column:
    """Where to go on: at the cursor, or from 0 if it is null, negative or beyond the n rows there are."""
    return F.when(cursor.between(0, n), cursor).otherwise(0).cast("long")


def progress(df: DataFrame, digest: str, tie: str, ok: Column, every: int = 50) -> DataFrame:
    """(place, tie, n_ok) of every so manyth row in the order of a hex digest and tie: n_ok rows succeeded so far.

    Rows are counted by the first four digits of the digest, which takes 65,536 rows at most; each part ranks its own rows and starts
    from the counts of those before it."""
    rows = df.select(tie, digest, F.substring(digest, 1, 4).alias("_part"), ok.cast("long").alias("_ok"))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_ok").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum"))
    own = Window.partitionBy("_part").orderBy(digest, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.select(tie, "_part", F.row_number().over(Window.partitionBy("_part").orderBy(digest, tie)).alias("_place"), F.sum("_ok").over(own).alias("_own"))
    placed = ranked.join(F.broadcast(ahead), "_part").select((F.col("_n") + F.col("_place")).alias("place"), tie, (F.col("_sum") + F.col("_own")).alias("n_ok"))
    return placed.where(F.col("place") % every == 0)
