"""Tables that are replaced together: each refresh is a new version of all, readers follow a log.

The tables of a refresh are written to a folder of their own first. Only then one row naming it is
appended to the log, so a reader sees all old tables or all new ones, and a refresh that fails on the way
shows nothing. Versions are ordered by their number in the log, not by a clock. A number is claimed by
creating a file of that name, which only one of several publishers can do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG_SCHEMA = "number BIGINT, version STRING, schemas MAP<STRING, STRING>, published_at TIMESTAMP"


def _log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/published")


def _claim(spark: SparkSession, root: str, number: int) -> int:
    """The first number from ``number`` on that no other publisher has claimed."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/claims")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    while True:
        claim = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}")
        try:
            files.create(claim, False).close()
            return number
        except Py4JJavaError:
            if not files.exists(claim):
                raise
            number += 1


def publish(spark: SparkSession, root: str, builds: dict[str, Callable[[], DataFrame]]) -> str:
    """Write every table as part of one new version and make it the current one; returns the version."""
    spark.createDataFrame([], _LOG_SCHEMA).write.mode("ignore").parquet(f"{root}/published")
    version, schemas = uuid.uuid4().hex, {}
    for name, build in builds.items():
        table = build()
        table.write.parquet(f"{root}/versions/{version}/{name}")
        schemas[name] = table.schema.json()
    last = _log(spark, root).agg(F.coalesce(F.max("number"), F.lit(0)).alias("last")).first().last
    listed = F.create_map(*[F.lit(x) for pair in schemas.items() for x in pair])
    number = _claim(spark, root, last + 1)
    entry = spark.range(1).select(
        F.lit(number).cast("bigint").alias("number"),
        F.lit(version).alias("version"),
        listed.alias("schemas"),
        F.current_timestamp().alias("published_at"),
    )
    # Written aside and moved, so that readers and other publishers never meet unfinished files.
    entry.coalesce(1).write.parquet(f"{root}/versions/{version}/entry")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done, listed_at = path(f"{root}/versions/{version}/entry"), path(f"{root}/published/{number:012d}")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(done, listed_at):
        raise OSError(f"version {version} could not be listed")
    return version


def read_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version that is current now; the returned DataFrame stays on it."""
    newest = F.max_by(F.struct("version", "schemas"), F.struct("number", "version"))
    current = _log(spark, root).agg(newest.alias("v")).first().v
    schema = T.StructType.fromJson(json.loads(current.schemas[name]))
    return spark.read.schema(schema).parquet(f"{root}/versions/{current.version}/{name}")


def drop_old_versions(spark: SparkSession, root: str, age: timedelta) -> list[str]:
    """Remove versions that were replaced at least ``age`` ago; readers may hold one for so long."""
    log = _log(spark, root).orderBy("number", "version").collect()  # one row a refresh
    now = spark.range(1).select(F.current_timestamp().alias("now")).first().now
    dropped = [old.version for old, new in zip(log, log[1:]) if new.published_at <= now - age]
    for version in dropped:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{version}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return dropped
