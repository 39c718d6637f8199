"""Importance resampling towards a target corpus: hashed n-gram counts of distinct lines, Gumbel draws."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickledger.llm.bytewords import lowered, text_bytes
from clickledger.llm.common import slices, stage

#: Bytes of words: digits, small letters and all of other than ASCII characters.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_HAS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Rows fed byte by byte together; fewer go through zlib one by one, so one endless word costs no loop.
_TOGETHER = 8


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc_after(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of what ``crc`` stands for followed by each byte range, all ranges at once."""
    register = ~crc.astype(np.uint32)
    rows = np.flatnonzero(ends > starts)
    at = starts[rows]
    while len(rows) > _TOGETHER:
        old = register[rows]
        register[rows] = (old >> np.uint32(8)) ^ _CRC[(old ^ data[at]) & np.uint32(0xFF)]
        at = at + 1
        more = at < ends[rows]
        rows, at = rows[more], at[more]
    out = ~register
    for row, start in zip(rows.tolist(), at.tolist()):
        out[row] = zlib.crc32(data[start : ends[row]], int(out[row]))
    return out


@dataclass
class Words:
    """Words of a slice in order: byte ranges, and the text and line (of all lines) that each is in."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    line: np.ndarray


def words_of(texts: pa.Array) -> Words:
    data, text_ends = text_bytes(lowered(texts))
    solid = _WORD[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    inner = text_ends[(text_ends > 0) & (text_ends < len(data))]
    begins[inner], stops[inner - 1] = solid[inner], solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    breaks = np.sort(np.concatenate([np.flatnonzero(data == 0x0A), text_ends]))
    text = np.searchsorted(text_ends, starts, side="right")
    return Words(data, starts, ends, text, np.searchsorted(breaks, starts, side="right"))


def features(words: Words, width: int, across: bool | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, crc32) of every run of 1 to ``width`` words of a text, joined by one space.

    ``across``: only runs that cross lines, or only runs inside one line; None for both.
    """
    n = len(words.starts)
    at = np.arange(n)
    crc = crc_after(np.zeros(n, np.uint32), words.data, words.starts, words.ends)
    space = np.full(1, 0x20, np.uint8)
    owners, crcs = ([], []) if across else ([words.text], [crc])
    for k in range(1, width):
        keep = at + k < n
        at, crc = at[keep], crc[keep]
        keep = words.text[at] == words.text[at + k]
        at, crc = at[keep], crc[keep]
        crc = crc_after(crc, space, np.zeros(len(at), np.int64), np.ones(len(at), np.int64))
        crc = crc_after(crc, words.data, words.starts[at + k], words.ends[at + k])
        wanted = slice(None)
        if across is not None:
            wanted = (words.line[at] != words.line[at + k]) == across
        owners.append(words.text[at][wanted])
        crcs.append(crc[wanted])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *owners]), np.concatenate([empty.astype(np.uint32), *crcs])


def _counted(rows: DataFrame, width: int, buckets: int, across: bool | None) -> DataFrame:
    """``bucket, n`` of ``rows(text, times)``, the features of each text counted ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            times = part.column("times").to_numpy()
            owner, crc = features(words_of(part.column("text")), width, across)
            np.add.at(total, crc % np.uint32(buckets), times[owner])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return rows.mapInArrow(run, "bucket long, n long")


def bucket_counts(texts: DataFrame, width: int, buckets: int) -> DataFrame:
    """``bucket, n``: how many features of ``texts(text)`` fall into each bucket; none is left out.

    Newlines cut texts into lines, and equal lines meet in one shuffle, after each task has counted its
    own, so that a line on a third of all rows costs a row a task. The features of a distinct line are
    hashed once and counted as often as the line occurs. Runs of words that cross lines, for a
    ``width`` above 1, are counted text by text beside that.
    """
    text = F.col("text").cast("string")
    lines = texts.select(F.explode(F.split(text, "\n")).alias("text")).filter(F.col("text").rlike(_HAS_WORD))
    lines = lines.groupBy("text").agg(F.count("*").alias("times"))
    parts = _counted(lines, width, buckets, None)
    if width > 1:
        parts = parts.unionAll(_counted(texts.select(text.alias("text"), F.lit(1).cast("long").alias("times")), width, buckets, True))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, width: int, buckets: int) -> DataFrame:
    """``bucket, gain`` for every bucket: the thousandfold log ratio of smoothed shares, floored."""
    counted = bucket_counts(docs, width, buckets).withColumnRenamed("n", "s")
    aimed = bucket_counts(target, width, buckets).withColumnRenamed("n", "t")
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for side in (counted, aimed):
        both = both.join(side, "bucket", "left")
    both = stage(both.fillna(0), "gains", narrow=True)  # one row a bucket: a fixed number
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    share = ((F.col("t") + 1).cast("double") * (F.col("all_s") + buckets).cast("double")) / (
        (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets).cast("double")
    )
    return both.join(F.broadcast(whole)).select("bucket", F.floor(1000 * F.log(share)).alias("gain"))


def weighed(docs: DataFrame, gain: np.ndarray, width: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of each text's features, 0 for none.

    A slice's distinct lines are scored once; a text adds up its lines and the runs that cross them.
    """
    buckets = np.uint32(len(gain))
    columns = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = pc.fill_null(part.column("text"), "")
            cut = pc.split_pattern(texts, "\n")
            coded = cut.flatten().dictionary_encode()
            lines, code = coded.dictionary, coded.indices.to_numpy()
            words = words_of(lines)
            owner, crc = features(words, width)
            per_line = np.zeros((3, len(lines)), np.int64)
            per_line[0] = np.bincount(words.text, minlength=len(lines))
            per_line[1] = np.bincount(owner, minlength=len(lines))
            np.add.at(per_line[2], owner, gain[crc % buckets])
            running = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(per_line[:, code], axis=1)], axis=1)
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])
            n_words, n, total = np.diff(running[:, bounds], axis=1)
            if width > 1:
                owner, crc = features(words_of(texts), width, across=True)
                n = n + np.bincount(owner, minlength=len(n))
                np.add.at(total, owner, gain[crc % buckets])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, (n_words, n, weight))], columns)

    ddl = ", ".join(f"{c} long" for c in columns)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ddl)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place`` from 1 by falling score, ties by doc_id, and without a task that sees them all.

    Rows are dealt by ranges of that order and numbered inside them; what lies before a range is added.
    """
    order = [F.col("score").desc(), F.col("doc_id"), F.col("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stage(dealt.withColumn("at", F.monotonically_increasing_id()), "ranges", narrow=False)
    part, inner = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", before.alias("before"))
    return dealt.join(F.broadcast(sizes), part == F.col("part")).withColumn("place", F.col("before") + inner + 1)


def resample(
    docs: DataFrame, target: DataFrame, width: int = 2, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024
) -> DataFrame:
    """Draw ``percent`` of the documents, those more like ``target(text)`` likelier, without replacement.

    Returns ``doc_id, n_features, weight, score, rank`` for every row: the score is the weight plus
    Gumbel noise from the seed and the doc_id, ranks number the drawn rows, null for others. Only rows
    of ``least_words`` words or more can be drawn; the highest scores win, ties go to the smaller doc_id.
    Features fall into ``buckets`` by crc32, so what tasks are sent grows with ``buckets`` alone.

    Null texts are empty: no features, weight 0. Rows without a doc_id have neither score nor rank and
    are not among those drawn from, but their texts count. Rows that share a doc_id are rows of their own.
    An empty table gives no rows; an empty target is uniform. Columns other than doc_id and text are ignored.
    """
    table = gains(docs.select("text"), target.select("text"), width, buckets).toArrow()  # ``buckets`` rows
    gain = np.zeros(buckets, np.int64)
    gain[table.column("bucket").to_numpy()] = table.column("gain").to_numpy()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed(docs, gain, width).withColumn("score", F.col("weight") + noise)
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    quota = percent * scored.filter(fit).count() // 100
    rank = F.when(F.col("place") <= quota, F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = _ranked(scored.filter(fit)).select(*columns, rank.cast("long").alias("rank"))
    return drawn.unionAll(scored.filter(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))
