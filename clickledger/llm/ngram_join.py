"""Jaccard join of documents' n-gram sets by prefix trees over a global order, rarest n-grams first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import slices, stage
from clickledger.llm.components import components
from clickledger.llm.neardup import shingle_sets

#: Texts whose n-grams are sorted together, and n-grams of the corpus that meet in one task.
BLOCK_BYTES, BUCKET_ITEMS = 6 << 20, 1 << 20
#: A tree holds about so many n-grams and documents at most.
TILE_ITEMS, TILE_ROWS = 1 << 19, 512
#: N-grams of a node at most, so that a long branch is pruned before its end.
RUN = 32


def _packed(values: np.ndarray) -> bytes:
    """64-bit integers by byte planes, compressed; planes of zeros cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _differences(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.uint64(0))


def _key(items: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(items.tobytes())


def _sizes(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, set_key``: size and digest of each text's whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), width)
            columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(map(_key, sets)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_key"])

    return docs.mapInArrow(run, "doc_id long, n long, set_key string")


def _node(doc_id: int, key: str) -> int:
    """Stands for one of several texts of a doc_id; such ids get negative numbers by a hash."""
    return -1 - (xxhash.xxh3_64_intdigest(f"{doc_id} {key}") >> 2)


def _postings(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """``bucket, base, items, nodes, known``: the n-grams of each block of texts, in buckets by value.

    A block sends each of its n-grams to a bucket once: with its document if it has only one, else as
    ``known`` to be shared. The documents of the latter go to buckets past the others, as done. Equal
    sets of a block count as one, that of the least document.
    """
    columns = ["bucket", "base", "items", "nodes", "known"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(columns, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(slices(batches, "text", BLOCK_BYTES)):
            sets = shingle_sets(part.column("text"), width)
            least: dict[str, tuple[int, np.ndarray]] = {}
            for doc_id, several, items in zip(*(part.column(c).to_pylist() for c in ("doc_id", "several")), sets):
                if doc_id is not None and len(items):
                    key = _key(items)
                    node = _node(doc_id, key) if several else doc_id
                    if key not in least or node < least[key][0]:
                        least[key] = node, items
            if not least:
                continue
            nodes = np.array([n for n, _ in least.values()], np.int64)
            base = nodes.min()
            items = np.concatenate([s for _, s in least.values()])
            owner = np.repeat((nodes - base).view(np.uint64), [len(s) for _, s in least.values()])
            order = np.argsort(items, kind="stable")
            items, owner = items[order], owner[order]
            again = np.zeros(len(items), bool)
            again[1:] = items[1:] == items[:-1]
            shared = again.copy()
            shared[:-1] |= again[1:]
            rows = [(buckets + number % buckets, base, _packed(_differences(items[shared])), _packed(owner[shared]), None)]
            lone, lone_owner, known = items[~shared], owner[~shared], items[shared & ~again]
            edges = np.arange(1, buckets)
            cuts = [
                np.concatenate([[0], np.searchsorted(_bucket(x, buckets), edges), [len(x)]]).tolist() for x in (lone, known)
            ]
            for b in range(buckets):
                (i, j), (k, m) = (c[b : b + 2] for c in cuts)
                if j > i or m > k:
                    parts = (_differences(lone[i:j]), lone_owner[i:j], _differences(known[k:m]))
                    rows.append((b, base, *map(_packed, parts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

    return docs.mapInArrow(run, "bucket long, base long, items binary, nodes binary, known binary")


def _bucket(items: np.ndarray, buckets: int) -> np.ndarray:
    return ((items >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _shared(postings: DataFrame) -> DataFrame:
    """``node, item`` for n-grams that more than one set holds; single ones are dropped here."""

    def found(rows: list[dict]) -> pa.RecordBatch:
        items = np.concatenate([np.cumsum(_unpacked(r["items"]), dtype=np.uint64) for r in rows])
        nodes = np.concatenate([_unpacked(r["nodes"]).view(np.int64) + r["base"] for r in rows])
        if rows[0]["known"] is not None:
            known = np.unique(np.concatenate([np.cumsum(_unpacked(r["known"]), dtype=np.uint64) for r in rows]))
            order = np.argsort(items, kind="stable")
            items, nodes = items[order], nodes[order]
            keep = np.zeros(len(items), bool)
            keep[1:] = items[1:] == items[:-1]
            keep[:-1] |= keep[1:]
            if len(known):
                at = np.minimum(np.searchsorted(known, items), len(known) - 1)
                keep |= known[at] == items
            items, nodes = items[keep], nodes[keep]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(items.view(np.int64))], ["node", "item"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["bucket"] != held[0]["bucket"] or row["known"] is None):
                    yield found(held)
                    held = []
                held.append(row)
        if held:
            yield found(held)

    return postings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "node long, item long")


class Trie:
    """Ordered sets as a tree: a node holds up to RUN items in a row that all sets below it share there.

    Nodes are numbered level by level, so that children and the sets that end at a node are ranges.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        run_from, level = [0], [(0, len(sets), 0)]
        runs: list[np.ndarray] = []
        self.depth, self.most, self.least, self.last = [], [], [], []
        kids, ends = [], []
        lengths = np.array([len(s) for s in sets])
        while level:
            below = []
            for low, high, depth in level:
                first, final = sets[order[low]], sets[order[high - 1]]
                stop = min(len(first), len(final), depth + RUN) if runs else 0  # the root holds nothing
                differ = np.flatnonzero(first[depth:stop] != final[depth:stop])
                stop = depth + int(differ[0]) if len(differ) else stop
                runs.append(first[depth:stop])
                run_from.append(run_from[-1] + stop - depth)
                members = order[low:high]
                self.depth.append(stop)
                self.last.append(first[stop - 1] if stop else -1)
                self.most.append(lengths[members].max())
                self.least.append(sizes[members].min())
                at = low
                while at < high and len(sets[order[at]]) == stop:
                    at += 1
                ends.append(order[low:at])
                kids.append(0)
                while at < high:
                    token, to = sets[order[at]][stop], at + 1
                    while to < high and sets[order[to]][stop] == token:
                        to += 1
                    below.append((at, to, stop))
                    kids[-1] += 1
                    at = to
            level = below
        self.items = np.concatenate([np.empty(0, np.int64), *runs]).astype(np.int64)
        self.run_from = np.array(run_from)
        self.depth, self.most, self.least, self.last = map(np.array, (self.depth, self.most, self.least, self.last))
        self.kid_from = 1 + np.concatenate([[0], np.cumsum(kids)])
        self.end_from = np.concatenate([[0], np.cumsum([len(e) for e in ends])])
        self.ends = np.array([i for e in ends for i in e], np.int64)

    def alike(self, probe: np.ndarray, size: int, mark: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
        """The sets that overlap ``probe``, a set of ``size`` marked in ``mark``, enough.

        The tree is walked level by level. A node's overlap is its parent's and its own hits, counted once
        for all sets below. A subtree goes when even all that remains of the probe, or of its longest
        set, would not reach what its smallest set needs.
        """
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            start, length = self.run_from[nodes], self.run_from[nodes + 1] - self.run_from[nodes]
            hits = np.concatenate([[0], np.cumsum(mark[self.items[_ranges(start, length)]])])
            ends = np.cumsum(length)
            overlap = overlap + hits[ends] - hits[ends - length]
            rest = np.minimum(
                len(probe) - np.searchsorted(probe, self.last[nodes], side="right"), self.most[nodes] - self.depth[nodes]
            )
            keep = (100 + percent) * (overlap + rest) >= percent * (size + self.least[nodes])
            nodes, overlap = nodes[keep], overlap[keep]
            n = self.end_from[nodes + 1] - self.end_from[nodes]
            here = self.ends[_ranges(self.end_from[nodes], n)]
            found.append(here[(100 + percent) * np.repeat(overlap, n) >= percent * (size + sizes[here])])
            n = self.kid_from[nodes + 1] - self.kid_from[nodes]
            nodes, overlap = _ranges(self.kid_from[nodes], n), np.repeat(overlap, n)
        return np.concatenate(found)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(size.sum()) + np.repeat(start - (ends - size), size)


def tree_links(rows: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links of ``rows(node, n, times, items, indexed, probes)`` between probes and indexed sets.

    Enough links to span what the links join. Items are ordered by how many sets hold them, then by value.
    """
    lengths = rows["items"].map(len).to_numpy()
    times, items = (np.concatenate(rows[c].to_list()) for c in ("times", "items"))
    order = np.lexsort((items, times))
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = (items[order][1:] != items[order][:-1]) | (times[order][1:] != times[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    sets = np.split(rank, np.cumsum(lengths)[:-1])
    node, size, indexed, probes = (rows[c].to_numpy() for c in ("node", "n", "indexed", "probes"))
    held = np.flatnonzero(indexed)
    if not len(held):
        return []
    trie = Trie([sets[i] for i in held], size[held])
    mark = np.zeros(len(order), np.int64)
    label, out = np.arange(len(rows)), []
    for x in np.flatnonzero(probes).tolist():
        mark[sets[x]] = 1
        near = held[trie.alike(sets[x], int(size[x]), mark, size[held], percent)]
        mark[sets[x]] = 0
        others, first = np.unique(label[near], return_index=True)
        for other, y in zip(others.tolist(), near[first].tolist()):
            if other != label[x]:
                out.append((int(min(node[x], node[y])), int(max(node[x], node[y]))))
                label[label == other] = label[x]
    return out


def _joined(placed: DataFrame, order: list[str], percent: int) -> DataFrame:
    """``a, b``: the links found in each task's rows, which ``order`` names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        for batch in batches:
            found = []
            for key, rows in batch.groupby(order, sort=False):
                if key != at:
                    found += tree_links(pd.concat(held, ignore_index=True), percent) if held else []
                    at, held = key, []
                held.append(rows)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if held:
            yield pd.DataFrame(tree_links(pd.concat(held, ignore_index=True), percent), columns=["a", "b"], dtype="int64")

    columns = [*order, "node", "n", "times", "items", "indexed", "probes"]
    dealt = placed.select(*columns).repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInPandas(run, "a long, b long").distinct()


def _tiles(by: list[str]) -> list:
    share = F.greatest(F.sum(F.size("items")) / TILE_ITEMS, F.count("*") / TILE_ROWS)
    return [F.ceil(share).cast("int").alias("tiles")]


def _spot(tiles: str) -> F.Column:
    return F.pmod(F.xxhash64("node"), F.col(tiles)).cast("int")


def _first_links(members: DataFrame, percent: int) -> DataFrame:
    """Each tile of a group against itself and against the group's first tile: work in line with the group."""
    totals = members.groupBy("group").agg(*_tiles(["group"]))
    placed = members.join(totals, "group").withColumn("tile", _spot("tiles"))
    task = F.when(F.col("tile") == 0, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))
    placed = placed.withColumn("task", F.explode(task)).withColumn("indexed", F.col("task") == F.col("tile"))
    return _joined(placed.withColumn("probes", F.lit(True)), ["group", "task"], percent)


def _later_links(members: DataFrame, percent: int) -> DataFrame:
    """Tiles against tiles where a group of several tiles is not yet one component.

    ``members`` carry their ``label`` so far. Documents of a group's largest component are compared with
    all others but not with one another, so its tiles are copied only as often as the rest has tiles.
    """
    labels = members.groupBy("group", "label").agg(F.count("*").alias("rows"))
    main = labels.groupBy("group").agg(F.max(F.struct("rows", "label")).alias("top"), F.count("*").alias("labels"), F.sum("rows").alias("all"))
    main = main.filter("labels > 1").select("group", F.col("top.label").alias("main"))
    split = members.join(main, "group").withColumn("core", F.col("label") == F.col("main"))
    totals = split.groupBy("group", "core").agg(*_tiles(["group", "core"]))
    totals = totals.groupBy("group").agg(
        F.max(F.when(F.col("core"), F.col("tiles"))).alias("cores"), F.max(F.when(~F.col("core"), F.col("tiles"))).alias("rest")
    )
    placed = split.join(totals, "group")
    tile = F.when(F.col("core"), F.col("rest") + _spot("cores")).otherwise(_spot("rest"))
    reach = F.when(F.col("core"), F.col("rest")).otherwise(F.col("rest") + F.col("cores"))
    placed = placed.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), reach - 1)))
    placed = placed.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    placed = placed.withColumn("indexed", F.col("tile") == F.col("high")).withColumn("probes", F.col("tile") == F.col("low"))
    return _joined(placed, ["group", "low", "high"], percent)


def ngram_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents linked by ``100 * |A and B| >= percent * |A or B|`` of word n-grams.

    Returns ``doc_id, n_shingles, component_id`` per row; no link between different sets is lost.

    Equal sets are one class. Every n-gram of every class goes once a block to a bucket by its hash, and
    only those that several sets hold come back, with their documents. A document whose shared n-grams
    are fewer than its least overlap has no partner; the others' n-grams are counted and ordered, rarest
    first. Two alike sets share one of the first ``n - overlap + 1`` of that order, so documents that
    meet there form groups. Each group's ordered sets are put into prefix trees, which all its documents
    walk, with overlaps shared along common beginnings and subtrees pruned by what remains. Large groups
    are cut into tiles; each meets the first tile, and only what stays apart is compared further.

    Null or wordless texts have an empty set and are linked with nothing. Rows without a doc_id are
    linked with nothing either, with a null component_id. Rows that share a doc_id are one node, however
    many different texts they have. Columns other than doc_id and text are ignored. An empty table
    gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sized = stage(_sizes(docs, width), "sizes")
    usable = sized.filter("n > 0 AND doc_id IS NOT NULL")
    several = usable.groupBy("doc_id").agg(F.min("set_key").alias("one"), F.max("set_key").alias("two"))
    several = stage(several.filter("one <> two").select("doc_id"), "several", narrow=True)
    flagged, keyed = docs.withColumn("several", F.lit(False)), usable.withColumn("node", F.col("doc_id"))
    if not several.isEmpty():
        marks = several.withColumn("several", F.lit(True))
        flagged = docs.join(marks, "doc_id", "left").fillna(False, ["several"])
        node = F.udf(lambda i, key: _node(i, key), "long")
        keyed = usable.join(marks, "doc_id", "left")
        keyed = keyed.withColumn("node", F.when(F.col("several"), node("doc_id", "set_key")).otherwise(F.col("doc_id")))
    classes = keyed.groupBy("set_key").agg(F.min("node").alias("node"), F.first("n").alias("n"), F.min("doc_id").alias("least"))
    classes = stage(classes, "classes")

    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ITEMS))
    shared = stage(_shared(_postings(flagged.select("doc_id", "text", "several"), width, buckets)), "shared")
    enough = 100 * F.col("k") >= percent * F.col("n")
    counts = shared.groupBy("node").agg(F.count("*").alias("k"))
    hopeful = stage(classes.join(counts, "node").filter(enough).select("node", "n"), "hopeful", narrow=True)
    kept = stage(shared.join(hopeful, "node").select("node", "n", "item").distinct(), "kept")
    times = kept.groupBy("item").agg(F.count("*").alias("times")).filter("times > 1")
    ordered = kept.join(times, "item").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "item"))).alias("x"))
    ordered = ordered.select("node", "n", F.size("x").alias("k"), F.col("x.times").alias("times"), F.col("x.item").alias("items"))
    ordered = stage(ordered.filter(enough), "ordered")

    overlap = F.ceil(percent * F.col("n") / 100)
    first = F.slice("items", F.lit(1), (F.col("k") - overlap + 1).cast("int"))
    prefixes = ordered.select("node", F.explode(first).alias("item"))
    least = prefixes.groupBy("item").agg(F.min("node").alias("a"), F.count("*").alias("rows")).filter("rows > 1")
    meeting = prefixes.join(least, "item").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    groups = components(meeting).select("node", F.col("component").alias("group"))
    members = stage(ordered.join(groups, "node"), "members")

    links = stage(_first_links(members, percent), "links", narrow=True)
    if not several.isEmpty():
        twins = keyed.filter("several").join(classes.select("set_key", F.col("node").alias("rep")), "set_key")
        pivot = twins.groupBy("doc_id").agg(F.min("rep").alias("a"))
        twins = twins.join(pivot, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))
        links = stage(links.unionAll(twins).distinct(), "links", narrow=True)
    labels = components(links)
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    tiles = members.groupBy("group").agg(*_tiles(["group"])).filter("tiles > 1").select("group")
    later = stage(_later_links(labelled.join(tiles, "group", "left_semi"), percent), "links", narrow=True)
    if not later.isEmpty():
        labels = components(links.unionAll(later))

    named = classes.join(labels, "node", "left").select("set_key", "least", F.coalesce("component", "node").alias("label"))
    lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "label").select(F.col("set_key").alias("known"), "component_id")
    out = sized.join(named, (F.col("set_key") == F.col("known")) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
