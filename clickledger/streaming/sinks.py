"""Micro-batch writers that may be replayed.

A micro-batch can be handed over again after a failure. Parquet tables are laid out by date and batch
and a batch overwrites exactly its own folders, so a replay changes nothing. Batch numbers start anew
with a new checkpoint; the ``run`` that goes with a checkpoint keeps such batches apart.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickledger.sources.tables import with_load_time

BatchWriter = Callable[[DataFrame, int], None]

# Folder that Spark uses for rows without a date.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

log = logging.getLogger(__name__)


def ensure_table(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Create an empty table where there is none, so that readers and writers find the folder."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(root)


def stored_schema(schema: T.StructType) -> T.StructType:
    """Table columns, the time of writing, and the two folder levels."""
    added = [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("batch_id", T.StringType()),
    ]
    return T.StructType(schema.fields + added)


def read_if_there(
    spark: SparkSession, path: str, schema: str | T.StructType, base: str | None = None
) -> DataFrame | None:
    """The Parquet folder, or None where there is none yet; ``base`` is the root of its table."""
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def checkpoint_run(spark: SparkSession, checkpoint: str, name: str) -> str:
    """Name of the run that goes with a query's checkpoint; made up and stored at its first start."""
    path = f"{checkpoint}/{name}_run"
    stored = read_if_there(spark, path, "run STRING")
    if stored is None or stored.isEmpty():  # empty if an earlier start stopped between the two
        fresh = spark.range(1).select(F.lit(uuid.uuid4().hex).alias("run"))
        fresh.coalesce(1).write.mode("overwrite").parquet(path)
        stored = spark.read.schema("run STRING").parquet(path)
    return stored.first().run


def read_store(
    spark: SparkSession, root: str, schema: T.StructType, days: list | None = None
) -> DataFrame:
    """Stored rows, of the given days if any.

    Days are opened by their folders, so that only these are listed, however long the table's history.
    """
    whole = stored_schema(schema)
    if days is None:
        return spark.read.schema(whole).parquet(root)
    folders = [f"{root}/event_date={NO_DAY if day is None else day}" for day in days]
    there = [folder for folder in folders if _exists(spark, folder)]
    if not there:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", root).parquet(*there)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def batch_name(run: str, batch_id: int) -> str:
    return f"{run}-{batch_id}" if run else str(batch_id)


def _write_batch(batch: DataFrame, batch_id: str, root: str, *folders: str) -> None:
    counted = Observation()
    (
        with_load_time(batch, "created_at")
        .withColumn("batch_id", F.lit(batch_id))
        .observe(counted, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders, "batch_id")
        .parquet(root)
    )
    log.info("batch %s: %s rows to %s", batch_id, counted.get["rows"], root)


def write_by_date(batch: DataFrame, batch_id: str, root: str, time: str) -> None:
    _write_batch(batch.withColumn("event_date", F.to_date(time)), batch_id, root, "event_date")


def _span_of(batch: DataFrame, time: str) -> tuple | None:
    """Earliest and latest time and the days of the batch, or None for an empty one."""
    days = F.collect_set(F.coalesce(F.to_date(time).cast("string"), F.lit(NO_DAY)))
    row = batch.agg(F.count("*").alias("n"), F.min(time).alias("low"), F.max(time).alias("high"), days.alias("days")).first()
    if not row.n:
        return None
    return row.low, row.high, [None if day == NO_DAY else day for day in sorted(row.days)]


def first_copies(events: DataFrame, key: str, time: str) -> DataFrame:
    """One row per key: of different copies that with the earliest time, then the least columns."""
    others = [F.col(c) for c in events.columns if c not in (key, time)]
    copy = F.struct(F.col(time).isNull().alias("untimed"), F.col(time), *others)
    return events.groupBy(key).agg(F.min(copy).alias("copy")).select(
        *[F.col(key) if c == key else F.col(f"copy.{c}").alias(c) for c in events.columns]
    )


def keyed_writer(
    root: str, schema: T.StructType, key: str, time: str, run: str = ""
) -> BatchWriter:
    """Append writer that stores each key once.

    Of the copies inside a batch the first one stays, whatever their order, so a replay writes the same
    folders. Repeats of earlier batches carry the same event time: they are found by an anti-join on
    time and key, against rows stored between the batch's earliest and latest time only. Copies that
    differ in their time are both stored; :func:`read_once` keeps the earlier.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(run, batch_id)
        batch = first_copies(batch.select(*schema.names), key, time).persist()
        try:
            span = _span_of(batch, time)
            if span is None:
                log.info("batch %s: nothing to write to %s", name, root)
                return
            low, high, days = span
            stored = read_store(batch.sparkSession, root, schema, days).where(F.col("batch_id") != name)
            timed = stored.where(F.col(time).isNull() | F.col(time).between(F.lit(low), F.lit(high)))
            earlier = timed.select(F.col(key).alias("stored_key"), F.col(time).alias("stored_time"))
            repeated = (F.col(key) == F.col("stored_key")) & F.col(time).eqNullSafe(F.col("stored_time"))
            write_by_date(batch.join(earlier, repeated, "left_anti"), name, root, time)
        finally:
            batch.unpersist()

    return write


def read_once(
    spark: SparkSession, root: str, schema: T.StructType, key: str, time: str, days: list | None = None
) -> DataFrame:
    """The table's rows, one per key: of copies with different times the earliest."""
    return first_copies(read_store(spark, root, schema, days).select(*schema.names), key, time)


def read_recent(
    spark: SparkSession, root: str, schema: T.StructType, key: str, time: str, since: Column
) -> DataFrame:
    """Stored rows from a time on, one per key; the day folders prune the scan.

    Of copies with different times the earliest of those days counts, so the time is asked for after
    the copies are told apart; a copy on a day before all of these is not looked for.
    """
    stored = read_store(spark, root, schema).where(F.col("event_date") >= since.cast("date"))
    return first_copies(stored.select(*schema.names), key, time).where(F.col(time) >= since)


def compact_days(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    days: list[str],
    time: str,
    merge: Callable[[DataFrame], DataFrame],
) -> None:
    """Put the files of closed days, which no batch adds to any more, into one folder a day.

    ``merge`` is the reduction that readers of the table apply, so a stop between writing the merged
    folder and dropping the old ones shows them nothing twice, and the next call finishes the work.
    """
    stored = read_store(spark, root, schema, days)
    folders = stored.select("event_date", "batch_id").distinct().collect()  # of these days only
    name = f"compacted-{uuid.uuid4().hex}"
    merged = merge(stored.drop("event_date", "batch_id"))
    merged = merged.withColumn("event_date", F.to_date(time)).withColumn("batch_id", F.lit(name))
    merged = merged.repartition("event_date")
    merged.write.mode("append").partitionBy("event_date", "batch_id").parquet(root)
    for row in folders:
        day = NO_DAY if row.event_date is None else row.event_date
        _delete(spark, f"{root}/event_date={day}/batch_id={row.batch_id}")


def expire_days(spark: SparkSession, root: str, days: list) -> None:
    """Remove the given days of a table."""
    for day in days:
        _delete(spark, f"{root}/event_date={NO_DAY if day is None else day}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def each_of(*writers: BatchWriter | None) -> BatchWriter:
    """One writer that hands the batch to several; an error of any ends the query."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for one in writers:
            if one is not None:
                one(batch, batch_id)

    return write


def quarantining_writer(
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    shape: Callable[[DataFrame], DataFrame],
    write_valid: BatchWriter,
    quarantine: str,
    run: str = "",
) -> BatchWriter:
    """Writer that stores valid rows with another writer and keeps the others as they were decoded."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Kept for both writes, so that the source is read and decoded once.
        valid, bad = split(batch.persist())
        try:
            write_valid(shape(valid), batch_id)
            if not bad.isEmpty():
                _write_batch(bad, batch_name(run, batch_id), quarantine)
        finally:
            batch.unpersist()

    return write


def jdbc_writer(
    url: str, table: str, properties: dict[str, str], connections: int = 8
) -> BatchWriter:
    """Append to a database table; empty batches are skipped and errors end the query.

    ``connections`` limits how many tasks write at a time, whatever the size of the cluster.
    A plain append repeats rows when a batch is replayed. Where the target has a unique key, append to
    a staging table and let the database merge by key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            log.info("batch %s: nothing to write to %s", batch_id, table)
            return
        counted = Observation()
        (
            batch.observe(counted, F.count("*").alias("rows"))
            .write.option("numPartitions", connections)
            .jdbc(url, table, mode="append", properties=properties)
        )
        log.info("batch %s: %s rows to %s", batch_id, counted.get["rows"], table)

    return write
