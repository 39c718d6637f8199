"""Click and checkout feeds as they come off the wire: read, decode, set bad records apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickledger.functions.times import parse_event_time
from clickledger.schemas import CHECKOUT_REQUIRED, CLICK_REQUIRED, MONEY

CORRUPT = "_corrupt_record"


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    limit: int | None = None,
    **options: str | int,
) -> DataFrame:
    """Streaming read from the oldest record on, at most ``limit`` files or records a micro-batch.

    Without a limit a first start takes a whole backlog as one batch, which every sink then has to hold.
    With one, batches follow each other, also under ``availableNow``, and the watermark moves between.

    ``fmt`` is any streaming source on the classpath. Files are read from the oldest by nature; for
    Kafka the earliest offset is asked for. Other connectors take their own option from the caller.
    """
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    if limit is not None:
        options.setdefault("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", limit)
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def decode(
    feed: DataFrame, schema: T.StructType, payload: str | Column = "data", keep: str | None = None
) -> DataFrame:
    """Binary or text JSON payload to flat columns plus ``event_timestamp``.

    Unknown fields are ignored, unless ``keep`` names a VARIANT column that holds the whole record for
    :func:`open_field`; it is NULL for text that is no JSON. A field of the wrong type becomes NULL. Text that is no JSON gives
    NULLs everywhere; the original stays in ``_corrupt_record`` for :func:`split_valid`.

    The record is flattened by a generator, which keeps later filters above the parser: pushed below
    it, each filter on a parsed column would parse the text again.
    """
    text = (F.col(payload) if isinstance(payload, str) else payload).cast("string")
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    whole = [] if keep is None else [F.try_parse_json(text).alias(keep)]
    return feed.select(F.inline(F.array(parsed)), *whole).withColumn(
        "event_timestamp", parse_event_time(F.col("timestamp"))
    )


def open_field(path: str, kind: str, column: str = "payload") -> Column:
    """A field of a kept record by its path (``$.shipping_address.country``), whether a schema knows it or not.

    NULL where the record has no such field, or holds something else than ``kind`` there.
    """
    return F.try_variant_get(column, path, kind)


def split_valid(
    decoded: DataFrame, required: list[str], money: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows fit for the tables, quarantined rest as decoded). Together they are the whole input.

    Required columns must be present. Money columns become exact decimals, cast once before any sum,
    and have to be in range when required.
    """
    exact = {name: F.col(name).try_cast(MONEY) for name in money}
    complete = F.lit(True)
    for name in required:
        complete = complete & exact.get(name, F.col(name)).isNotNull()
    return decoded.where(complete).drop(CORRUPT).withColumns(exact), decoded.where(~complete)


def valid_clicks(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid(decoded, CLICK_REQUIRED)


def valid_checkouts(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid(decoded, CHECKOUT_REQUIRED, ["total_amount"])
