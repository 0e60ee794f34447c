"""Operator 4 [native]: k-d tree sharding.

Documents are points in a few metadata dimensions: their size and the given
columns. A coordinate is a share of the bytes: a size stands at the share of
all bytes in smaller documents, a category at the share of those before it (in
the order of its hash), each plus half of its own. So one scale measures all
dimensions, and a node's width in one says how much of the corpus's variety in
it the node still holds.

A node that stands for k shards is split along the dimension in which it is
widest, at the point where floor(k/2) of k parts of its bytes lie below, until
a node stands for one shard: with shards = ceil(total / target) leaves reach
the target bytes. Below the share, a coordinate holds a tie of each row's own,
so documents equal in a dimension, and repeated rows, can still be divided.

Split points are weighted quantiles over all documents, found by histograms of
2**16 bins that refine the bin holding the quantile until that bin's bytes no
longer matter. All nodes of a level share each pass. Passes read a small table
of sizes and coordinates, which holds every row's node and is written anew
after a level; only the nodes' figures (fewer than there are shards) reach the
driver and come back as a small table.

The law is ``bytes``: shards' sizes are near equal. Copies of one text need not
stay together, so a group of copies larger than a shard is divided too.

A null text has 8 bytes and the check sum of the empty text; a null dimension
is a category of its own. Repeated rows are rows of their own. Ties follow the
rows' place in the input, so the same files give the same shards. Other columns
are left aside. An empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regloom.session import written

#: Bits of a coordinate: the share, then the row's tie; and of one histogram.
DIM_BITS, TIE_BITS, PASS_BITS = 16, 40, 16
#: Cells that a column's categories are hashed to.
CATEGORY_CELLS = 1 << 12
#: A split point is fine enough when its bin holds at most this share of a shard.
TOLERANCE = 1 / 4096
#: Slots of a shard are counted in so many parts, so that no task sorts a whole shard.
SLOT_PARTS = 256


def _cells(docs: DataFrame, *, text: str, key: str, dims: Sequence[str]) -> DataFrame:
    """(id, size, crc, tie, c0, c1, ...): cell 0 is the logarithm of the size, the others a hash of a column."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    base = docs.select(
        F.col(key).alias("id"), size.alias("size"), F.coalesce(F.crc32(F.col(text)), F.lit(0).cast("long")).alias("crc"),
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"m{i}") for i, c in enumerate(dims, 1)],
    )
    tie = F.xxhash64("id", "crc", "row").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    log = F.least(F.floor(F.log2("size") * F.lit((1 << DIM_BITS) / 40)), F.lit((1 << DIM_BITS) - 1)).cast("int")
    hashed = [F.when(F.col(f"m{i}").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(f"m{i}"), F.lit(CATEGORY_CELLS)) + 1).cast("int") for i in range(1, len(dims) + 1)]
    return base.select("id", "size", "crc", tie.alias("tie"), *[c.alias(f"c{i}") for i, c in enumerate([log, *hashed])])


def points(docs: DataFrame, *, text: str = "text", key: str = "doc_id", dims: Sequence[str] = ("lang", "source")) -> DataFrame:
    """(id, size, crc, tie, d0, d1, ..., node): coordinates of every row, all in node 0, as a table."""
    cells, many = written(_cells(docs, text=text, key=key, dims=dims), "cells"), 1 + len(dims)
    each = F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"c{i}").alias("cell")) for i in range(many)])
    weights = cells.select("size", F.explode(each).alias("x")).groupBy("x.dim", "x.cell").agg(F.sum("size").alias("bytes"))
    upto, total = F.sum("bytes").over(Window.partitionBy("dim").orderBy("cell")), F.sum("bytes").over(Window.partitionBy("dim"))
    share = F.floor((upto - F.col("bytes") / 2) / total * F.lit((1 << DIM_BITS) - 1)).cast("long")
    # At most 2**16 rows for the size and CATEGORY_CELLS + 1 for each column.
    shares = written(weights.select("dim", "cell", share.alias("share")), "shares")
    for i in range(many):
        own = shares.where(F.col("dim") == i).select(F.col("cell").alias(f"c{i}"), F.col("share").alias(f"s{i}"))
        cells = cells.join(F.broadcast(own), f"c{i}")
    coordinates = [(F.shiftleft(f"s{i}", TIE_BITS) + F.col("tie")).alias(f"d{i}") for i in range(many)]
    return written(cells.select("id", "size", "crc", "tie", *coordinates, F.lit(0).alias("node")), "points")


def _with(cloud: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Points of the given nodes with the nodes' figures (one row per node, fewer than there are shards)."""
    figures = cloud.sparkSession.createDataFrame(rows, f"node int, {schema}".rstrip(", "))
    return cloud.join(F.broadcast(figures), "node")


def _splits(cloud: DataFrame, widest: dict[int, int], goal: dict[int, float], fine: dict[int, float], n_dims: int) -> dict[int, int]:
    """Of each node the coordinate, in its widest dimension, below which ``goal`` bytes lie."""
    begin, below, found, shift = dict.fromkeys(goal, 0), dict.fromkeys(goal, 0), {}, DIM_BITS + TIE_BITS
    while open_ := sorted(goal.keys() - found.keys()):
        width, shift = min(PASS_BITS, shift), max(0, shift - PASS_BITS)
        rows = [(k, widest[k], begin[k], float(goal[k] - below[k])) for k in open_]
        point = F.get(F.array(*[f"d{i}" for i in range(n_dims)]), F.col("dim"))
        bins = _with(cloud, rows, "dim int, start long, want double").withColumn("bin", F.shiftright(point - F.col("start"), shift))
        summed = bins.where((F.col("bin") >= 0) & (F.col("bin") < (1 << width))).groupBy("node", "want", "bin").agg(F.sum("size").alias("bytes"))
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
        reached = summed.withColumn("upto", upto).where(F.col("upto") >= F.col("want")).groupBy("node").agg(F.min(F.struct("bin", "upto", "bytes")).alias("x"))
        for r in reached.collect():
            k, x = r["node"], r["x"]
            lower = below[k] + x["upto"] - x["bytes"]
            begin[k] += x["bin"] << shift
            if x["bytes"] <= fine[k] or shift == 0:
                nearer = goal[k] - lower > lower + x["bytes"] - goal[k]
                found[k] = begin[k] + ((1 << shift) if nearer else 0)
            below[k] = lower
        if shift == 0:
            found = dict(begin) | found
    return found


def assign(cloud: DataFrame, shards: int, n_dims: int) -> DataFrame:
    """The points with their shard in ``node``: split level by level, every pass one aggregation for all nodes of the level."""
    leaves = {0: shards}  # first shard of a node: how many it stands for
    while open_ := {k: n for k, n in leaves.items() if n > 1}:
        spread = [(F.shiftright(F.max(f"d{i}"), TIE_BITS) - F.shiftright(F.min(f"d{i}"), TIE_BITS)).alias(f"w{i}") for i in range(n_dims)]
        stats = {r["node"]: r for r in _with(cloud, [(k,) for k in open_], "").groupBy("node").agg(F.sum("size").alias("bytes"), *spread).collect()}
        widest = {k: max(range(n_dims), key=lambda i, r=r: r[f"w{i}"]) for k, r in stats.items()}
        goal = {k: r["bytes"] * (open_[k] // 2) / open_[k] for k, r in stats.items()}
        fine = {k: r["bytes"] / open_[k] * TOLERANCE for k, r in stats.items()}
        splits = _splits(cloud, widest, goal, fine, n_dims)
        if splits:
            figures = cloud.sparkSession.createDataFrame([(k, widest[k], splits[k], k + open_[k] // 2) for k in splits], "node int, dim int, split long, high int")
            point = F.get(F.array(*[f"d{i}" for i in range(n_dims)]), F.col("dim"))
            moved = F.when(point >= F.col("split"), F.col("high")).otherwise(F.col("node"))
            cloud = written(cloud.join(F.broadcast(figures), "node", "left").select(*[c for c in cloud.columns if c != "node"], moved.alias("node")), "points")
        for k, n in open_.items():  # a node without points has no figures and needs no splitting
            leaves[k] = 1
            if k in splits:
                leaves[k], leaves[k + n // 2] = n // 2, n - n // 2
    return cloud


def kd_shards(docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None, text: str = "text", key: str = "doc_id", dims: Sequence[str] = ("lang", "source")) -> DataFrame:
    """One row per document: (key, size, text_crc32, law, shard, slot, grown_shard).

    Give the number of shards, or the bytes that a shard should reach. Slots
    are gapless from 0 inside a shard; grown_shard is null under this law.
    """
    cloud = points(docs, text=text, key=key, dims=dims)
    if shards is None:
        total = cloud.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    sharded = assign(cloud, shards, 1 + len(dims))
    placed = sharded.select("id", "size", "crc", "tie", F.col("node").alias("shard"), F.pmod("tie", F.lit(SLOT_PARTS)).cast("int").alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # At most shards x SLOT_PARTS rows, whatever the size of the data.
    numbered = placed.withColumn("at", F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "crc", "tie"))).join(F.broadcast(offsets), ["shard", "part"])
    return numbered.select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
