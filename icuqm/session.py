"""Session set-up: the site's time zone, adaptive execution and reliable checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "icuqm", tz: str = "UTC", master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session for local work; on a cluster the submitted settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if cores:
            builder = builder.config("spark.sql.shuffle.partitions", str(cores))
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
    spark = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", tz)
        .getOrCreate()
    )
    use_timezone(spark, tz)
    return use_sizes(spark)


def use_timezone(spark: SparkSession, tz: str) -> SparkSession:
    """Every local-day rule follows the session time zone, so it must be the site's."""
    if spark.conf.get("spark.sql.session.timeZone") != tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    return spark


#: Set unless the session has values of its own. Spark takes a file's compressed size for that of its rows, so it would
#: send tables many times the broadcast limit through the driver; and a fixed number of partitions gives tasks that grow
#: with the input, where small partitions are merged up to a size that does not. A measure joins dozens of tables that are
#: sent to every task while they are small, so the limit of one is a tenth of Spark's. Both sides of a union are merged by
#: their own sizes.
SIZES = {
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.sources.fileCompressionFactor": "10.0",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "960",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def use_sizes(spark: SparkSession) -> SparkSession:
    """Broadcasts follow the size of the rows, and tasks have a size that does not follow the input."""
    for name, value in SIZES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share.

    ``spark.checkpoint.dir`` names it; where that is unset it lies in the warehouse
    folder. The rule is the same for every master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into a new folder under ``shared_root`` and read it back.

    Unlike a checkpoint the stage is columnar, so later readers fetch only the columns
    they use, and it survives lost executors. Every call has a folder of its own.
    """
    path = f"{shared_root(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so that later plans start from its rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
