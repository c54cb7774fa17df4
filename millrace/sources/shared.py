"""The folder that driver and executors share, and tables kept there between jobs."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share: spark.checkpoint.dir, or the warehouse where it is unset (local
    runs). All paths of an application stand in one folder."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/millrace"
    return f"{root.rstrip('/')}/m-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that no result reads any more. What stored() did not make is left alone."""
    for df in tables:
        if path := getattr(df, "stored_path", None):
            _delete(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has stored, once its results are written elsewhere."""
    _delete(spark, shared_dir(spark).rpartition("/")[0])


def release(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage: Spark deletes the files of shuffles that nothing refers to any more."""
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, and a lost executor costs a re-read only. Shuffles that
    earlier stored tables came from are released."""
    spark = df.sparkSession
    path = shared_dir(spark)
    release(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """Broadcast df, of rows of bounded size, if it has at most most_rows of them; otherwise the join shuffles both sides."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
