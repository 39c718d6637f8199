"""Session construction and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


_STATE = "spark.sql.streaming.stateStore"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "clickledger", master: str | None = None, streaming: bool = False, **conf: str
) -> SparkSession:
    """Create a session with the settings the library relies on.

    Event times are compared across sources that spell UTC, so the session zone is UTC, and stored
    times carry statistics that prune scans. With
    ``streaming`` the join state lives in RocksDB, off the heap, and each batch uploads only its
    changes. The number of shuffle partitions is fixed at a streaming query's first start, so set it
    for the cluster before. Extra Spark settings go in ``conf`` with ``__`` for dots
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    if streaming:
        builder = builder.config(f"{_STATE}.providerClass", _ROCKSDB).config(
            f"{_STATE}.rocksdb.changelogCheckpointing.enabled", "true"
        )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a fresh temporary folder; a
    cluster session must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="clickledger-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback
