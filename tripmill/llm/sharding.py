"""Shards of nearly equal bytes by Karmarkar-Karp differencing of groups that must stay together.

A partial partition is one sum for each shard. Differencing takes the two with the largest spread, adds the
largest sum of one to the smallest of the other and so on, and puts the result back, until one is left.

To run it on many tasks, groups that are large beside a task's share are differenced first, in blocks as well; the
blocks' partial partitions are then differenced with each other, which only needs their sums. What spread the large
groups leave is dealt to the blocks of small ones in equal shares, each differences its groups together with its
share, and the sums cancel out over all blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

# Every row costs this many bytes besides its text.
ROW_BYTES = 8
# Groups differenced by one task.
GROUPS_PER_BLOCK = 20_000
# A group is large if it has more than one part in so many of a shard's share of a block.
_LARGE_PARTS = 8
# Rows of the slot counts: one for each shard and bucket.
_BUCKET_ROWS = 50_000


def _differenced(leaves: list[np.ndarray]) -> list[np.ndarray]:
    """For each partial partition, the shard that each of its sums ended up in, by Karmarkar-Karp differencing."""
    shards = len(leaves[0])
    # A node is a leaf, or two nodes and how the second's sums are dealt to the first's places.
    left, right, deal = [], [], []
    heap = [(-float(sums.max() - sums.min()), i, sums - sums.min()) for i, sums in enumerate(leaves)]
    count = len(heap)
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, first = heapq.heappop(heap)
        _, b, second = heapq.heappop(heap)
        places = np.empty(shards, dtype=np.int32)
        places[np.argsort(-second, kind="stable")] = np.argsort(first, kind="stable")
        sums = first.copy()
        sums[places] += second
        sums -= sums.min()
        heapq.heappush(heap, (-float(sums.max()), count + len(left), sums))
        left.append(a)
        right.append(b)
        deal.append(places)
    # From the last node down: where each node's places ended up.
    result: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * count
    stack = [(heap[0][1], np.arange(shards, dtype=np.int32))]
    while stack:
        node, places = stack.pop()
        if node < count:
            result[node] = places
        else:
            k = node - count
            stack += ((left[k], places), (right[k], places[deal[k]]))
    return result


def difference(sizes: np.ndarray, shards: int, start: np.ndarray | None = None) -> np.ndarray:
    """The shard of each size, by Karmarkar-Karp differencing.

    ``start`` is a partial partition whose sums are tied to their shards; the result fits it. Without it the
    shards are interchangeable. Equal sizes are told apart by their place, so the result is deterministic.
    """
    if not len(sizes):
        return np.zeros(0, dtype=np.int32)
    leaves = []
    for size in sizes:
        sums = np.zeros(shards)
        sums[0] = size
        leaves.append(sums)
    if start is not None:
        leaves.append(start)
    places = _differenced(leaves)
    result = np.array([found[0] for found in places[: len(sizes)]], dtype=np.int32)
    if start is None:
        return result
    back = np.empty(shards, dtype=np.int32)
    back[places[-1]] = np.arange(shards)
    return back[result]


def _difference_block(shards: int, start: list[float], with_block: bool = False):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["bytes", "member"], ascending=[False, True], ignore_index=True)
        sums = np.array(start)
        # Shards with equal sums differ in order from block to block, so that small leftovers do not add up.
        order = np.random.default_rng(int(block["block"].iloc[0])).permutation(shards)
        shard = order[difference(block["bytes"].to_numpy(), shards, sums[order])]
        made = pd.DataFrame({"member": block["member"], "shard": shard.astype("int32")})
        if with_block:
            made.insert(0, "block", block["block"])
        return made

    return run


def _assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(member, shard) of groups given as (member binary, bytes long)."""
    spark = groups.sparkSession
    total = groups.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-total["n"] // GROUPS_PER_BLOCK))
    large = total["bytes"] / (shards * blocks * _LARGE_PARTS)
    schema = "member binary, shard int"
    # At most shards * blocks * _LARGE_PARTS groups are larger than that.
    big = groups.filter(F.col("bytes") > large)
    big_blocks = max(1, -(-big.count() // GROUPS_PER_BLOCK))
    big = big.withColumn("block", F.pmod(F.xxhash64("member"), F.lit(big_blocks)).cast("int"))
    of_block = big.groupBy("block").applyInPandas(_difference_block(shards, [0.0] * shards, True), f"block int, {schema}")
    of_block = stage(of_block, new_folder(spark, "large-groups"))
    # One row for each block and shard: what is differenced on the driver is the sums of blocks of many groups.
    sums = of_block.join(big.drop("block"), "member").groupBy("block", "shard").agg(F.sum("bytes").cast("double").alias("b"))
    leaves: dict[int, np.ndarray] = {}
    for block, shard, size in sums.orderBy("block").collect():
        leaves.setdefault(block, np.zeros(shards))[shard] = size
    filled = [0.0] * shards
    moved = []
    for (block, own), places in zip(leaves.items(), _differenced(list(leaves.values())) if leaves else []):
        for shard, place in enumerate(places.tolist()):
            filled[place] += own[shard]
            moved.append((block, shard, place))
    moves = spark.createDataFrame(moved, "block int, shard int, place int")
    # As many rows as shards for each block of GROUPS_PER_BLOCK large groups.
    big_shards = of_block.join(moves, ["block", "shard"]).select("member", F.col("place").alias("shard"))
    share = [size / blocks for size in filled]
    small = groups.filter(F.col("bytes") <= large)
    small = small.withColumn("block", F.pmod(F.xxhash64("member"), F.lit(blocks)).cast("int"))
    small_shards = small.groupBy("block").applyInPandas(_difference_block(shards, share), schema)
    return stage(small_shards.unionByName(big_shards), new_folder(spark, "group-shards"))


def balance_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the text's UTF-8 bytes and 8 more (NULL: 8). Rows of equal text are one group and share a shard;
    NULL and empty text are one group. ``slot`` counts a shard's rows from 0 without gaps; ties between rows of
    one id are broken by size and checksum, and repeated rows get a slot each. A NULL id is a row like any other.
    ``law`` is ``bytes``, for which ``grown_shard`` is NULL. Other columns are ignored. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    importable(spark)
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("row_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("member"),
    )
    rows = stage(rows, new_folder(spark, "sizes"))
    groups = stage(rows.groupBy("member").agg(F.sum("size").alias("bytes")), new_folder(spark, "groups"))
    placed = rows.join(_assign_groups(groups, shards), "member").drop("member")
    # Slots: a shard's rows are numbered bucket by bucket, so no task numbers a whole shard.
    buckets = max(1, -(-rows.count() // (_BUCKET_ROWS * shards)))
    # Rows that repeat go to different buckets: the table is written before anything is counted.
    bucket = F.pmod(F.xxhash64("row_id", "text_crc32", F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
    placed = stage(placed.withColumn("bucket", bucket), new_folder(spark, "placed"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row_id", "size", "text_crc32"))
    numbered = placed.withColumn("rank", rank).join(offsets, ["shard", "bucket"])
    return numbered.select(
        F.col("row_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
