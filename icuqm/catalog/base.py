"""Registry of queries over the star tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuqm.functions.time import micros
from icuqm.session import use_sizes, use_timezone

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The star tables of one folder, read in a UTC session as the SQL engine does."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_sizes(use_timezone(spark, "UTC"))
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def line(self) -> DataFrame:
        """``events`` as a timeline: ``us`` is the time in microseconds."""
        e = self.events
        return e.select("event_id", "user_id", micros(e, "ts").alias("us"), "event_type", "value")

    @property
    def units(self) -> DataFrame:
        """Nation and region of every user; nation nests in region."""
        c, n, r = self.customer, self.nation, self.region
        named = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        return named.select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("unit_name"), F.col("r_name").alias("unit"))


def query(name: str, sql: str | None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return build

    return register


# Shared pieces of the SQL counterparts.
LINE = "line AS (SELECT event_id, user_id, epoch_us(ts) AS us, event_type, value FROM events)"
UNITS = (
    "units AS (SELECT c_custkey AS user_id, n_name AS unit_name, r_name AS unit FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
DAY = 86_400_000_000
HOUR = 3_600_000_000


def day_of(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%d')"


def week_of(day: str) -> str:
    return f"strftime({day}, '%G-W%V')"
