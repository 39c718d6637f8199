"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.bytewords import byte_words, lowered
from clickledger.llm.common import mixed, slices, stage
from clickledger.llm.components import components

SLOTS = 128
BANDS = 32
#: Texts are worked on in slices of so many bytes, whose shingles and draws a worker holds at once.
TEXT_BYTES = 2 << 20
#: A large cluster is compared tile by tile, each tile about so many shingles and rows at most.
TILE_ITEMS, TILE_ROWS = 1 << 20, 1024
#: One-bit signatures of documents at the threshold differ in fewer slots, but for six deviations.
DEVIATIONS = 6.0

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word n-grams, A-Z lower-cased.

    A text of fewer words is one shingle, its whole sequence; one without words has none.
    """
    words = byte_words(lowered(texts))
    bounds = words.bounds
    if not len(words.codes):
        return [np.empty(0, np.uint64) for _ in bounds[1:]]
    word = words.hashes[words.codes]
    with np.errstate(over="ignore"):
        rolled = mixed(word + _STEP)
        for j in range(1, width):
            rolled = mixed(rolled[:-1] * np.uint64(31) + word[j:]) if len(rolled) > 1 else rolled[:0]
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                one = np.uint64(b - a)
                for w in word[a:b]:
                    one = mixed(one * np.uint64(31) + w)
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: row per set, column per slot; values compare as (level, fraction) in one integer.

    Element ``e`` walks a random permutation of the slots drawn from its own hash; at step j it offers
    ``j + fraction`` to the slot its permutation visits then. All elements of all sets take a step
    together, and a set stops early once every slot holds a value below the next step, since no later
    offer can be smaller. The permutation is a Fisher-Yates shuffle that is never stored: the content
    of a position follows from the earlier draws. Empty sets keep the largest value in every slot.
    """
    lengths = [len(s) for s in sets]
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    out = np.full(len(sets) * slots, np.iinfo(np.uint64).max, np.uint64)
    draws: list[np.ndarray] = []
    for level in range(slots):
        if not len(elements):
            break
        with np.errstate(over="ignore"):
            x = mixed(elements + np.uint64(level + 1) * _STEP)
        low = x & np.uint64(0xFFFFFFFF)
        drawn = level + ((low * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)
        place = drawn.copy()
        for back in range(level - 1, -1, -1):
            place[place == draws[back]] = back
        np.minimum.at(out, owner * slots + place, (np.uint64(level) << np.uint64(40)) | (x >> np.uint64(24)))
        draws.append(drawn)
        filled = out.reshape(-1, slots).max(axis=1) < (np.uint64(level + 1) << np.uint64(40))
        keep = ~filled[owner]
        elements, owner = elements[keep], owner[keep]
        draws = [d[keep] for d in draws]
    return out.reshape(-1, slots)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per row and band, the band's number mixed in."""
    rows = signature.shape[1] // bands
    parts = signature[:, : rows * bands].reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        key = mixed(np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, parts.shape[:2]))
        for r in range(rows):
            key = mixed(key * np.uint64(31) + parts[:, :, r])
    return key.view(np.int64)


def one_bit(signature: np.ndarray) -> np.ndarray:
    """The signatures' lowest mixed bits, 64 slots to an integer."""
    bits = np.packbits((mixed(signature) & np.uint64(1)).astype(np.uint8), axis=1)
    return np.ascontiguousarray(bits).view(np.int64)


_SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.string()),
        ("bands", pa.list_(pa.int64())),
        ("bits_a", pa.int64()),
        ("bits_b", pa.int64()),
    ]
)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Per document: size and digest of its whole shingle set, band keys and one-bit signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            sets = shingle_sets(part.column("text"), width)
            signature = signatures(sets)
            keys, bits = band_keys(signature, BANDS), one_bit(signature)
            bands = pa.ListArray.from_arrays(
                np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32), pa.array(keys.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]),
                    bands,
                    pa.array(bits[:, 0]),
                    pa.array(bits[:, 1]),
                ],
                schema=_SKETCH,
            )

    ddl = "doc_id long, n_shingles long, set_key string, bands array<long>, bits_a long, bits_b long"
    return _narrow(docs).mapInArrow(run, ddl)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """Whole shingle sets of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            sets = shingle_sets(part.column("text"), width)
            bounds = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(s) for s in sets], out=bounds[1:])
            values = np.concatenate([np.empty(0, np.uint64), *sets])
            values = values.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(values))], ["id", "items"]
            )

    wanted = _narrow(docs).join(ids, "doc_id", "left_semi")
    return wanted.mapInArrow(run, "id long, items array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs(a, b)`` whose full sets overlap enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    shared = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - F.col("shared")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .select("a", "b", shared.alias("shared"), "items_a", "items_b")
        .filter(100 * F.col("shared") >= percent * union)
        .select("a", "b")
    )


def _alike(percent: int) -> int:
    """Most differing one-bit slots of a pair at the threshold."""
    s = percent / 100
    agree = (1 + s) / 2
    return int(np.ceil(SLOTS * (1 - agree) + DEVIATIONS * np.sqrt(SLOTS * agree * (1 - agree))))


def _compared_groups(members: DataFrame) -> DataFrame:
    """``bucketed, group, tiles, rep, component``: what is compared completely, from ``members(cluster, key, rep, component, n)``.

    That is a whole cluster or, where this copies fewer sets, each open bucket of it by itself. Documents that
    only share boilerplate with their neighbours can chain up to a cluster far larger than any of its buckets.
    """
    share = F.greatest(F.sum("n") / TILE_ITEMS, F.count("*") / TILE_ROWS)
    size = [F.ceil(share).cast("int").alias("tiles"), F.count("*").alias("rows")]
    copies = F.col("tiles") * F.col("rows")
    once = members.select("cluster", "rep", "component", "n").distinct()
    buckets = members.groupBy("cluster", "key").agg(*size)
    apart = buckets.groupBy("cluster").agg(F.sum(copies).alias("apart"))
    whole = once.groupBy("cluster").agg(*size).join(apart, "cluster")
    whole = whole.select("cluster", "tiles", (F.col("apart") < copies).alias("bucketed"))
    columns = ["bucketed", "group", "tiles", "rep", "component"]
    together = once.join(whole.filter("NOT bucketed"), "cluster").withColumnRenamed("cluster", "group")
    singly = members.join(whole.filter("bucketed").select("cluster", "bucketed"), "cluster")
    singly = singly.join(buckets.select("key", "tiles"), "key").withColumnRenamed("key", "group")
    return together.select(*columns).unionAll(singly.select(*columns))


def _links_across(members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links that join different components of a group, enough to span what they join.

    ``members(bucketed, group, tiles, rep, component, n, bits_a, bits_b, bands, items)``. A group is cut into
    tiles of about TILE_ITEMS shingles or TILE_ROWS rows, and each pair of tiles is compared in one task on the full sets, so
    neither plausible pairs nor a whole group are ever held. A pair of documents that meets in several buckets
    is compared in that of their first common band.
    """
    placed = members.withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    order = ["bucketed", "group", "low", "high"]
    columns = [*order, "tile", "rep", "component", "n", "bits_a", "bits_b", "items"]
    grouped = placed.select(*columns, "bands").repartition(*order).sortWithinPartitions(*order)
    most = _alike(percent)

    def compare(rows: pd.DataFrame) -> list[tuple[int, int]]:
        tile, rep, label, n, one, two, items = (rows[c].to_numpy() for c in columns[4:])
        label, inner = label.copy(), rows["low"].iloc[0] == rows["high"].iloc[0]
        bands = np.stack(rows["bands"].to_numpy()) if rows["bucketed"].iloc[0] else None
        found = []
        for i in range(len(rows) - 1):
            rest = slice(i + 1, None)
            near = label[rest] != label[i]
            if not inner:
                near &= tile[rest] != tile[i]
            near &= 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
            j = np.flatnonzero(near) + i + 1
            if bands is not None:
                earlier = bands[i, : np.argmax(bands[i] == rows["group"].iloc[0])]
                j = j[~(bands[j, : len(earlier)] == earlier).any(axis=1)]
            far = np.bitwise_count((one[j] ^ one[i]).view(np.uint64)).astype(int)
            far += np.bitwise_count((two[j] ^ two[i]).view(np.uint64))
            for k in j[np.argsort(far, kind="stable")][: int((far <= most).sum())]:
                if label[k] != label[i] and _overlap(items[i], items[k], percent):
                    found.append((min(rep[i], rep[k]), max(rep[i], rep[k])))
                    label[label == label[k]] = label[i]
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        for batch in batches:
            found = []
            for key, rows in batch.groupby(order, sort=False):
                if key != at:
                    found += compare(pd.concat(held, ignore_index=True)) if held else []
                    at, held = key, []
                held.append(rows)
            yield pd.DataFrame(found, columns=["a", "b"])
        if held:
            yield pd.DataFrame(compare(pd.concat(held, ignore_index=True)), columns=["a", "b"])

    return grouped.mapInPandas(run, "a long, b long").distinct()


def _overlap(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of distinct hashes overlap enough."""
    if len(a) > len(b):
        a, b = b, a
    a, b = a.view(np.uint64), b.view(np.uint64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by ``100 * |A and B| >= percent * |A or B|`` of word shingles.

    Returns ``doc_id, n_shingles, component_id, kept`` per row. Texts with equal sets are one class,
    joined later by its least doc_id, so thousands of copies cost one row. Bands put classes into
    buckets; each class is first compared with the least of its bucket, one row per member. Classes of
    buckets that still hold several components form clusters, and these are compared completely, as a whole
    or bucket by bucket, tile by tile: every candidate that banding gives is decided on full sets, but no list of
    pairs is made.

    Null or wordless texts have an empty set and are linked with nothing. Rows without a doc_id are
    linked with nothing either: component_id null and kept true. Rows that share a doc_id are one node.
    Columns other than doc_id and text are ignored. An empty table gives no rows.
    """
    sketched = stage(sketches(docs, width), "sketch")
    usable = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(
        usable.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n"),
            *[F.first(c).alias(c) for c in ("bands", "bits_a", "bits_b")],
        ),
        "classes",
    )
    rows = classes.select("rep", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("size"))
    buckets = stage(rows.join(sizes.filter("size > 1"), "key"), "buckets")

    facts = classes.select("rep", "n", "bits_a", "bits_b")
    first = buckets.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    near = first
    for side in "ab":
        near = near.join(facts.select(*[F.col(c).alias(f"{c}_{side}") for c in facts.columns]), F.col(side) == F.col(f"rep_{side}"))
    differ = sum(F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("bits_a", "bits_b"))
    near = near.filter(
        (differ <= _alike(percent)) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    ).select("a", "b")
    near = stage(near, "candidates", narrow=True)

    ids = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(_sets(docs, ids, width), "sets")
    links = stage(_confirm(near, sets, percent), "links", narrow=True)
    labels = components(links)

    member = buckets.filter("size > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    member = member.select("key", "rep", F.coalesce("component", "rep").alias("component"))
    open_keys = (
        member.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter("least <> most")
    )
    opened = stage(member.join(open_keys.select("key", "least"), "key"), "open", narrow=True)
    meeting = opened.filter("component <> least").select(F.col("least").alias("a"), F.col("component").alias("b"))
    clusters = components(meeting.distinct()).select(F.col("component").alias("cluster"), F.col("node").alias("component"))
    placed = opened.select("key", "rep", "component").join(clusters, "component").join(facts.select("rep", "n"), "rep")
    groups = _compared_groups(stage(placed, "members", narrow=True))
    details = classes.select("rep", "n", "bits_a", "bits_b", "bands").join(sets.withColumnRenamed("id", "rep"), "rep")
    members = groups.join(details, "rep").withColumn("bands", F.when(F.col("bucketed"), F.col("bands")))
    later = stage(_links_across(members, percent), "links", narrow=True)
    if not later.isEmpty():
        labels = components(links.unionAll(later))

    named = classes.select("set_key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = sketched.join(named, (sketched.set_key == named.set_key) & sketched.doc_id.isNotNull(), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
