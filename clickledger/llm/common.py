"""What the operators share: staged tables, folds, bounded slices of texts, a mix of integers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.session import shared_dir

#: Texts are worked on in slices of about so many bytes, so memory follows the slice, not the table.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    A ``narrow`` table, of ids and counts, is written in at most four files a core, since small tables in
    as many files as there are shuffle partitions cost more in files than in rows.
    """
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    (df.coalesce(4 * spark.sparkContext.defaultParallelism) if narrow else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def slices(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds at most ``max_bytes`` of text, or one longer text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + max_bytes, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix; equal inputs give equal outputs on every machine."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
