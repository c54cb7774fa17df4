"""Keyed comparison of numeric arrays before and after a change, with a verdict."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def compare_arrays(before: DataFrame, after: DataFrame, key: str, values: str, is_target) -> DataFrame:
    """(key, is_target, status, max_diff): modified, identical, missing_before or missing_after. Arrays of other lengths are modified.
    is_target is a Column over the key."""
    b = before.select(key, F.col(values).alias("b"))
    a = after.select(key, F.col(values).alias("a"))
    both = b.join(a, key, "full_outer")
    diff = F.aggregate(F.zip_with("b", "a", lambda x, y: F.abs(y.cast("double") - x.cast("double"))), F.lit(0.0), lambda m, x: F.greatest(m, x))
    status = F.when(F.col("b").isNull(), "missing_before").when(F.col("a").isNull(), "missing_after").when(F.col("b") == F.col("a"), "identical").otherwise("modified")
    return both.select(key, is_target.alias("is_target"), status.alias("status"), diff.alias("max_diff"))


def verdict(compared: DataFrame) -> DataFrame:
    """One row of counts; FAIL if a target is identical or none is modified. Modified controls only warn."""
    n = {(t, s): F.count_if((F.col("is_target") == t) & (F.col("status") == s)) for t in (True, False) for s in ("modified", "identical")}
    out = compared.agg(
        n[True, "modified"].alias("target_modified"), n[True, "identical"].alias("target_identical"), n[False, "modified"].alias("control_modified"), n[False, "identical"].alias("control_identical"),
        F.count_if(F.col("status").startswith("missing")).alias("skipped"),
    )
    return out.withColumn("verdict", F.when((F.col("target_identical") > 0) | (F.col("target_modified") == 0), "FAIL").otherwise("PASS"))


def indexed_lookup(wanted: DataFrame, index: DataFrame, tensors: DataFrame, key: str, shard: str, values: str) -> DataFrame:
    """(key, shard, values) for every wanted key: the index names its shard, the shard holds its values. A key that the index or the shard
    lacks has nulls."""
    placed = wanted.select(key).join(index.select(key, shard), key, "left")
    return placed.join(tensors.select(key, shard, values), [key, shard], "left").select(key, shard, values)


def mapped(c: Column, names: dict[str, str], default: str | None = None) -> Column:
    """The value of a fixed map, default (null) for a key that it lacks."""
    entries = [F.lit(x) for pair in names.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), c) if entries else F.lit(None).cast("string")
    return F.coalesce(found, F.lit(default).cast("string"))


def module_keys(spark: SparkSession, layers: list[int], attention: list[str], mlp: list[str], controls: list[str]) -> DataFrame:
    """(key, is_target): every layer with every module under its path, and the controls. Both lists are literals of a fixed size."""
    modules = spark.createDataFrame([(m, "self_attn") for m in attention] + [(m, "mlp") for m in mlp], "module string, part string")
    grid = modules.select(F.explode(F.array(*map(F.lit, layers))).alias("layer"), "module", "part")
    targets = grid.select(F.concat(F.lit("language_model.model.layers."), F.col("layer").cast("string"), F.lit("."), "part", F.lit("."), "module", F.lit(".weight")).alias("key"), F.lit(True).alias("is_target"))
    return targets.unionByName(spark.createDataFrame([(c, False) for c in controls], "key string, is_target boolean"))
