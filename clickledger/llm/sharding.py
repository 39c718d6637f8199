"""Shards of documents by balanced label propagation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickledger.llm.common import stage

#: How far a shard may outgrow the mean while labels move; the last step evens sizes out.
SLACK = 0.2
ROUNDS = 4
#: Groups of links with more than this share of a shard move document by document, others together.
TOGETHER = 0.25
#: Running sums are taken over blocks: so many hash buckets a shard, large groups in parts of PART rows.
BUCKETS, PART = 1024, 4096

_BIG = 1 << 40


def _unit(*columns: Column | str) -> Column:
    """A number from 0 to 1 that depends on the columns only."""
    return F.pmod(F.xxhash64(*columns), F.lit(_BIG)) / F.lit(float(_BIG))


def _quotas(loads: dict[int, float], flows: dict[tuple[int, int], float], capacity: float, shards: int) -> list[float]:
    """Share of the wanted moves into each shard so that no shard passes its capacity."""
    share = [1.0] * shards
    for _ in range(50):
        for s in range(shards):
            coming = sum(flows.get((a, s), 0.0) for a in range(shards))
            going = sum(share[b] * flows.get((s, b), 0.0) for b in range(shards))
            room = capacity - loads.get(s, 0.0) + going
            share[s] = min(1.0, max(0.0, room / coming)) if coming else 1.0
    return share


def _two_quotas(loads: dict[int, float], small: dict[tuple[int, int], float], large: dict[tuple[int, int], float], capacity: float, shards: int) -> tuple[list[float], list[float]]:
    """Quotas of small links, and of large ones in the room that those leave; what is refused keeps its claim."""
    first = _quotas(loads, small, capacity, shards)
    left = dict(loads)
    for (a, b), size in small.items():
        left[a] = left.get(a, 0.0) - first[b] * size
        left[b] = left.get(b, 0.0) + size
    return first, _quotas(left, large, capacity, shards)


def propagate(nodes: DataFrame, members: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``node, shard``: shards of ``nodes(node, size)`` that few of the links in ``members`` cross.

    ``members(node, link)`` says which links a node is part of; the nodes of one link are neighbours of
    each other, and no pair of them is ever formed: a link carries one count per shard. In each round
    every node wants the shard that most of its neighbours are in, equal counts by a hash of the link so
    that neighbours agree; from the flows between shards (twice shards squared numbers, all that the
    driver sees) follow quotas, and a mover is let in by a hash below its quota. A group of links moves
    together unless it is large against a shard; large ones get the room that the others leave. Nodes are unique and not null; nodes without links keep
    their first shard, a hash. Rounds are written to the shared folder.
    """
    state = nodes.select("node", "size", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"))
    state = stage(state, "shards", narrow=True)
    linked = members.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1").select("link")
    members = stage(members.join(linked, "link", "left_semi").select("node", "link"), "members", narrow=True)
    for number in range(rounds):
        placed = members.join(state, "node")
        votes = placed.groupBy("link", "shard").agg(F.count("*").alias("votes"), F.sum("size").alias("bytes"))
        heard = (
            members.join(votes, "link")
            .groupBy("node", "shard")
            .agg(F.sum("votes").alias("votes"), F.max(F.xxhash64("link", "shard")).alias("tie"), F.min("link").alias("link"))
        )
        wanted = heard.groupBy("node").agg(F.max(F.struct("votes", "tie", "shard", "link")).alias("best"))
        weights = votes.groupBy("link").agg(F.sum("bytes").alias("bytes"))
        moves = (
            wanted.select("node", F.col("best.shard").alias("to"), F.col("best.link").alias("link"))
            .join(state, "node")
            .filter("to <> shard")
            .join(weights, "link")
        )
        moves = stage(moves.select("node", "link", "size", "shard", "to", "bytes"), "moves", narrow=True)
        loads = {r["shard"]: float(r["size"]) for r in state.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
        capacity = sum(loads.values()) / shards * (1 + SLACK)
        apart = F.col("bytes") > TOGETHER * capacity
        flows = moves.groupBy("shard", "to", apart.alias("apart")).agg(F.sum("size").alias("size")).collect()
        if not flows:
            break
        small, large = ({(r["shard"], r["to"]): float(r["size"]) for r in flows if r["apart"] == kind} for kind in (False, True))
        quotas = [F.array(*[F.lit(x) for x in q]) for q in _two_quotas(loads, small, large, capacity, shards)]
        drawn = F.when(apart, _unit("node", F.lit(number))).otherwise(_unit("link", F.lit(number)))
        share = F.when(apart, F.element_at(quotas[1], F.col("to") + 1)).otherwise(F.element_at(quotas[0], F.col("to") + 1))
        let_in = moves.filter(drawn < share).select("node", "to")
        state = state.join(let_in, "node", "left").select("node", "size", F.coalesce("to", "shard").alias("shard"))
        state = stage(state, "shards", narrow=True)
    return state.select("node", "shard")


def even_out(rows: DataFrame, shards: int) -> DataFrame:
    """``rows(.., size, shard, group, node)`` with ``shard`` and ``slot``, sizes equal to within a row.

    Rows are put in one line by shard and group, and the line is cut at equal sizes, so only the groups
    at a cut are split and rows move only as far as their shard was out of balance. Positions come from
    running sums over buckets, over blocks within a bucket, and over rows within a block.
    """
    many = rows.groupBy("group").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).filter("parts > 1")
    bucket = F.pmod("group", F.lit(BUCKETS)).cast("int")
    rows = rows.join(many, "group", "left").withColumns(
        {
            "bucket": bucket,
            "heavy": F.when(F.col("parts").isNotNull(), F.col("group")),
            "part": F.coalesce(F.pmod(F.xxhash64("node", "size", F.lit(1)), "parts").cast("int"), F.lit(0)),
        }
    )
    block = ["shard", "bucket", "heavy", "part"]

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sums = rows.groupBy(*block).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    totals = sums.groupBy("shard", "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    # at most shards * BUCKETS rows, whatever the input
    line = Window.orderBy("shard", "bucket")
    starts = totals.select("shard", "bucket", before("bytes", line).alias("bytes_0"), before("n", line).alias("n_0"))
    inside = Window.partitionBy("shard", "bucket").orderBy("heavy", "part")
    blocks = sums.select(*block, before("bytes", inside).alias("bytes_1"), before("n", inside).alias("n_1"))
    blocks = blocks.join(starts, ["shard", "bucket"]).select(
        *block, (F.col("bytes_0") + F.col("bytes_1")).alias("bytes_0"), (F.col("n_0") + F.col("n_1")).alias("n_0")
    )
    own = Window.partitionBy(*block).orderBy("group", "node", "size")
    row = rows.withColumns({"bytes_2": before("size", own), "n_2": F.row_number().over(own) - 1})
    same = [row[c].eqNullSafe(blocks[c]) for c in block]
    row = row.join(blocks, same).drop(*[blocks[c] for c in block])
    whole = rows.agg(F.sum("size")).scalar()
    place = F.col("bytes_0") + F.col("bytes_2")
    cut = F.floor((2 * place + F.col("size")) * shards / (2 * whole)).cast("int")
    row = row.withColumns({"shard": F.least(cut, F.lit(shards - 1)), "index": F.col("n_0") + F.col("n_2")})
    row = stage(row.drop(*block[1:], "parts", "bytes_0", "bytes_2", "n_0", "n_2"), "line", narrow=True)
    first = row.groupBy("shard").agg(F.min("index").alias("first"))  # one row per shard
    return row.join(F.broadcast(first), "shard").withColumn("slot", (F.col("index") - F.col("first")).cast("long")).drop("index", "first")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: equal texts together, shards of equal size in bytes.

    Size is the text's UTF-8 bytes plus 1. Documents of equal texts are linked; what propagation leaves
    is evened out exactly, so shard sizes differ by less than two documents. Slots count from 0 in each
    shard. A null text has no bytes, crc 0, and is equal to an empty one. Rows of one doc_id share a
    label while labels move; rows without one are labelled by their text. Columns other than doc_id and
    text are ignored. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("link"),
    )
    unnamed = F.lit(-1) - F.pmod(F.xxhash64("link", "size"), F.lit(1 << 62))
    rows = stage(rows.withColumn("node", F.coalesce("doc_id", unnamed)), "documents", narrow=True)
    nodes = rows.groupBy("node").agg(F.sum("size").alias("size"))
    labels = propagate(nodes, rows.select("node", "link").distinct(), shards)
    labelled = rows.withColumnRenamed("link", "group").join(labels, "node")
    return even_out(labelled, shards).select("doc_id", "size", "text_crc32", "shard", "slot")
