"""Intermediate tables of the llm operators, kept in the shared folder.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``, which every
executor can read, so a lost executor costs a re-read of these files and not a
rerun of what made them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barlab.plans.materialize import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession, what: str) -> str:
    """A new folder name under the session's checkpoint folder."""
    return shared_folder(spark, f"llm-{what}")


def stored(df: DataFrame, what: str, small: bool = False, path: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written as Parquet to the shared folder (or to ``path``) and read back.

    Files follow the cluster and not the partitions that ``df`` happens to have:
    four a core, and a quarter of ``spark.sql.shuffle.partitions`` at least.
    ``small`` is for tables of some bytes a document, made by work that
    deserves all its tasks: they are dealt anew to a dozen times fewer.  ``by`` are
    columns to keep apart in folders."""
    spark = df.sparkSession
    cores, parts = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(max(1, cores // 3, parts // 50)) if small else df.coalesce(max(4 * cores, parts // 4))
    path = path or scratch_dir(spark, what)
    # The write's shuffle files are of no use after it; Spark drops them at its end.
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)
