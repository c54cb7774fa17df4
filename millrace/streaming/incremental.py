"""Incremental, idempotent appends with Structured Streaming."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_rows(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in existing, one for each new key (the smallest row by the other columns)."""
    others = [c for c in rows.columns if c != key]
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("r"))
    return first.join(existing.select(key).distinct(), key, "left_anti").select(key, "r.*").select(*rows.columns)


def append_new(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str, transform=lambda df: df, files_per_trigger: int = 1000) -> None:
    """Append what is new in the source folder to target (Parquet), each key once, also over restarts.

    A batch that is run again after a failure finds the keys that it wrote before and adds nothing twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        existing = spark.read.schema(out.schema).option("ignoreMissingFiles", "true").parquet(target) if exists(spark, target) else out.limit(0)
        new_rows(out, existing, key).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
