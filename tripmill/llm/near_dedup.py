"""Near-duplicates of texts by BagMinHash.

A text is a bag of word shingles with their multiplicities as weights. For each shingle a Poisson process runs
over the weights from 0 up. It is kept as a hierarchy: an interval of weights yields its first point, and goes on
as its two halves from that point's time; an interval of one unit yields all its points. A point belongs to a
register and to one unit of weight, and counts for a bag if the unit is below the shingle's weight there. All
that follows from the shingle alone, so two bags share a register's first point with the probability of their
weighted Jaccard similarity. Bands of registers give candidates, and candidates are verified on the whole bags.

Equal texts are one node. A bucket of a band links its nodes to one of them, a different one in each band, so a
bucket of any size gives one candidate a node. Nodes of a bucket that the verified links leave in different
components are then compared with each other, block by block, so that no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm import textscan
from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

SHINGLE = 5
SIMILARITY = 0.8
# A pair at the threshold shares no band with a probability of (1 - 0.8 ** ROWS) ** BANDS: three in a million.
BANDS = 24
ROWS = 4
# Pairs of texts verified at once by a task.
_PAIRS = 64
# Nodes of a block, where blocks of a bucket are compared, and columns of the matrix that does it.
_BLOCK = 256
_COLUMNS = 4096

_U = np.uint64
_STEPS = tuple(_U(x) for x in (0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xF1357AEA2E62A9C5))
_PLACES = np.array([pow(int(_STEPS[0]), k, 1 << 64) for k in range(SHINGLE)], _U)


# ---- bags


def shingles(words: textscan.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle. A text with fewer words, but not none, is one shingle."""
    hashes, texts = words.hashes, words.texts
    total, size = len(hashes), SHINGLE
    sums = np.zeros(max(0, total - size + 1), _U)
    for k in range(size):
        sums += hashes[k : k + len(sums)] * _PLACES[k]
    whole = texts[: len(sums)] == texts[size - 1 :] if len(sums) else np.zeros(0, bool)
    owner, made = texts[: len(sums)][whole], sums[whole]
    counts = np.bincount(texts, minlength=words.last - words.first)
    short = (counts > 0) & (counts < size)
    if short.any():
        first = np.cumsum(counts) - counts
        place = np.arange(total) - first[texts]
        inside = short[texts]
        parts = hashes[inside] * _PLACES[place[inside]]
        extra = np.zeros(len(counts), _U)
        np.add.at(extra, texts[inside], parts)
        owner = np.concatenate([owner, np.flatnonzero(short)])
        made = np.concatenate([made, extra[short] + counts[short].astype(_U)])
    return owner, textscan.mix(made)


def bags(words: textscan.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, multiplicity), each shingle of a text once."""
    owner, made = shingles(words)
    order = np.lexsort((made, owner))
    owner, made = owner[order], made[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], made[first], np.diff(np.append(first, len(made)))


# ---- signatures


def _uniform(seeds: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1."""
    return ((seeds >> _U(11)) + _U(1)).astype(np.float64) * 2.0**-53


def _run(owner, seeds, low, size, weight, limit, registers, out) -> None:
    """Run processes to their texts' time limits and note each register's first point in ``out``."""
    at = np.zeros(len(seeds))
    while len(seeds):
        at = at - np.log(_uniform(textscan.mix(seeds + _STEPS[0]))) / size
        inside = at < limit[owner]
        owner, seeds, low, size, weight, at = (x[inside] for x in (owner, seeds, low, size, weight, at))
        if not len(seeds):
            return
        drawn = textscan.mix(seeds + _STEPS[1])
        register = ((drawn >> _U(32)) % _U(registers)).astype(np.int64)
        unit = low + ((drawn & _U(0xFFFFFFFF)) % size.astype(_U)).astype(np.int64)
        counts = unit < weight
        np.minimum.at(out, owner[counts] * registers + register[counts], at[counts])
        half = size > 1
        if half.any():
            # The halves go on from here; an upper half beyond the weight is of no use.
            upper = low + size // 2
            more = half & (upper < weight)
            low = np.concatenate([low, upper[more]])
            sizes = np.where(half, size // 2, size)
            size = np.concatenate([sizes, sizes[more]])
            seeds = np.concatenate([textscan.mix(seeds + _STEPS[2]), textscan.mix(seeds[more] + _STEPS[3])])
            owner, weight, at = (np.concatenate([x, x[more]]) for x in (owner, weight, at))
        else:
            seeds = textscan.mix(seeds + _STEPS[2])


def signatures(owner: np.ndarray, made: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """For each text and register the time of the first point; infinity for a text without shingles."""
    out = np.full(texts * registers, np.inf)
    total = np.bincount(owner, weight, minlength=texts)
    open_texts = total > 0
    for extra in count(2, 5):
        # By this time all registers of most texts have a point.
        limit = np.zeros(texts)
        limit[open_texts] = registers / total[open_texts] * (np.log(registers) + extra)
        roots = []
        chosen = open_texts[owner]
        mine = (owner[chosen], made[chosen], weight[chosen])
        # Weights 0 to 1, 1 to 2, 2 to 4, 4 to 8 and so on each have a process of their own.
        low, size, level = 0, 1, 0
        while len(mine[0]):
            roots.append((*mine, np.full(len(mine[0]), low), np.full(len(mine[0]), size), level))
            low, size, level = low + size, (1 if low == 0 else size * 2), level + 1
            more = mine[2] > low
            mine = tuple(x[more] for x in mine)
        if not roots:
            return out.reshape(texts, registers)
        seeds = np.concatenate([textscan.mix(m + _U(level)) for _, m, _, _, _, level in roots])
        joined = [np.concatenate([root[k] for root in roots]) for k in (0, 2, 3, 4)]
        _run(joined[0], seeds, joined[2], joined[3], joined[1], limit, registers, out)
        open_texts = open_texts & np.isinf(out.reshape(texts, registers)).any(axis=1)
        if not open_texts.any():
            return out.reshape(texts, registers)


def band_keys(times: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = textscan.mix(np.ascontiguousarray(times).view(_U)).reshape(len(times), bands, rows)
    keys = np.zeros((len(times), bands), _U) + np.arange(bands, dtype=_U)
    for row in range(rows):
        keys = textscan.mix(keys * _STEPS[3] + bits[:, :, row])
    return keys.view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("row_text")
        for words in textscan.scan(texts):
            owner, made, weight = bags(words)
            size = words.last - words.first
            keys = band_keys(signatures(owner, made, weight, size, BANDS * ROWS))
            empty = np.bincount(owner, minlength=size) == 0
            ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, BANDS))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[~empty].reshape(-1)))
            part = batch.slice(words.first, size)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("row_id"), lists], names=["node", "row_id", "bands"]
            )


# ---- verification


def _bag_keys_of_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, multiplicity)."""
    found = [(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for words in textscan.scan(texts):
        owner, made, weight = bags(words)
        found.append((made, owner + words.first, weight))
    shingle, row, weight = (np.concatenate(x) for x in zip(*found))
    return shingle, row, weight


def _bag_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of row and shingle, row, multiplicity), sorted by key."""
    shingle, row, weight = _bag_keys_of_rows(texts)
    key = textscan.mix(shingle + textscan.mix(row.astype(_U)))
    order = np.argsort(key)
    return key[order], row[order], weight[order]


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The weighted Jaccard similarity of each pair of texts; 0 if either has no words."""
    key_a, row_a, weight_a = _bag_keys(left)
    key_b, row_b, weight_b = _bag_keys(right)
    total = np.bincount(row_a, weight_a, minlength=len(left)) + np.bincount(row_b, weight_b, minlength=len(left))
    _, a, b = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    shared = np.bincount(row_a[a], np.minimum(weight_a[a], weight_b[b]), minlength=len(left))
    return np.divide(shared, total - shared, out=np.zeros(len(left)), where=total > shared)


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, _PAIRS):
                batch = whole.slice(first, _PAIRS)
                near = similarities(batch.column("text_a"), batch.column("text_b")) >= similarity - 1e-12
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are that similar. Texts of a are joined last, so a common a moves once."""
    left = texts.select(F.col("node").alias("a"), F.col("row_text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("row_text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verified(similarity), "a binary, b binary")


# ---- the rest of a bucket


def _block_pairs(members: DataFrame) -> DataFrame:
    """The members of a bucket in blocks, each block with itself and every other: (left, right) is one comparison.

    A comparison holds two blocks at most, whatever the bucket's size.
    """
    blocks = F.ceil(F.col("n") / _BLOCK).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = own.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return other.select(
        "band", "node", "root", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )


def _compare_blocks(similarity: float):
    """Links between nodes of different components, one for each two components.

    Bags are rows of a matrix with a column for each shingle's first, second, ... occurrence, so that the product
    of two rows is the overlap of their bags.
    """

    def run(task: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []})
        roots, codes = np.unique(task["root"].to_numpy(dtype=object), return_inverse=True)
        if len(roots) == 1:
            return none
        shingle, row, weight = _bag_keys_of_rows(pa.array(task["row_text"], pa.string()))
        total = np.bincount(row, weight, minlength=len(task))
        repeated = np.repeat(np.arange(len(row)), weight)
        nth = np.arange(len(repeated)) - np.repeat(np.cumsum(weight) - weight, weight)
        key = textscan.mix(shingle[repeated] + nth.astype(_U) * _STEPS[1])
        row = row[repeated]
        _, column, count = np.unique(key, return_inverse=True, return_counts=True)
        # A shingle of one text only overlaps nothing.
        shared = count[column] > 1
        row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
        block, left = task["block"].to_numpy(), int(task["left"].iloc[0])
        ups, downs = np.flatnonzero(block == left), np.flatnonzero(block == int(task["right"].iloc[0]))
        overlap = np.zeros((len(ups), len(downs)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            part = slice(np.searchsorted(column, first), np.searchsorted(column, first + _COLUMNS))
            matrix = np.zeros((len(task), _COLUMNS), np.float32)
            matrix[row[part], column[part] - first] = 1
            overlap += matrix[ups] @ matrix[downs].T
        union = total[ups][:, None] + total[downs][None, :] - overlap
        near = (overlap >= (similarity - 1e-12) * union) & (overlap > 0) & (codes[ups][:, None] != codes[downs][None, :])
        a, b = np.nonzero(near)
        a, b = ups[a], downs[b]
        pair = np.minimum(codes[a], codes[b]) * len(roots) + np.maximum(codes[a], codes[b])
        _, one = np.unique(pair, return_index=True)
        node = task["node"].to_numpy(dtype=object)
        return pd.DataFrame({"a": node[a[one]], "b": node[b[one]]}) if len(one) else none

    return run


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: the smallest node that links lead to.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its smallest, and
    every node and its smaller neighbours are linked to the smallest. The number of rounds grows with the
    logarithm of the nodes. Each round is a written table.
    """
    spark = links.sparkSession

    def stars(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.select(F.col("u"), F.col("v"))
        if larger:
            both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
            moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            least = both.groupBy("u").agg(F.min("v").alias("m"))
            down = both.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            moved = down.unionByName(least.select("u", F.col("m").alias("v")))
        return moved.filter("u <> v").distinct()

    larger_first = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(larger_first, new_folder(spark, "edges"))
    state = None
    while True:
        edges = stage(stars(stars(edges, True), False), new_folder(spark, "edges"))
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if seen == state:
            break
        state = seen
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


# ---- the operator


def _node(text: Column) -> Column:
    """128 bits of the text's digest: equal texts are one node."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def find_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id``, ``class_size`` and ``kept``.

    A class is a set of documents connected by links; two are linked if their texts are equal, or if the weighted
    Jaccard similarity of their bags of 5-word shingles is ``similarity`` or more. Words are runs of letters and
    digits, A-Z in lower case; a text of one to four words is one shingle. Texts without words are only linked to
    equal texts; NULL counts as empty. ``class_id`` is the smallest id of the class, NULL if it has none, and the
    row with it is ``kept``. Rows of one id and one text are one document: they are kept or not together. Other
    columns are ignored. An empty table gives an empty result.
    """
    return _classes(docs, id_col, text_col, similarity).drop("node")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each class; rules as in
    :func:`find_near_copies`."""
    gone = _classes(docs, id_col, text_col, similarity).filter("NOT kept")
    gone = gone.select(F.col(id_col).alias("gone_id"), F.col("node").alias("gone_node")).distinct()
    same = docs[id_col].eqNullSafe(gone["gone_id"]) & (_node(whole_text(docs[text_col])) == gone["gone_node"])
    return docs.join(gone, same, "left_anti")


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    spark = docs.sparkSession
    importable(spark)
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("row_id"), text.alias("row_text"), _node(text).alias("node"))
    id_type = rows.schema["row_id"].dataType
    signed_schema = T.StructType(
        [
            T.StructField("node", T.BinaryType()),
            T.StructField("row_id", id_type),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    signed = stage(rows.mapInArrow(_bands, signed_schema), new_folder(spark, "signed"))

    # A node's smallest id stands for it.
    nodes = signed.groupBy("node").agg(F.min("row_id").alias("node_id"), F.first("bands").alias("bands"))
    members = nodes.select("node", "node_id", F.explode("bands").alias("band"))
    lead = F.struct(F.xxhash64("band", "node").alias("draw"), F.col("node").alias("node"))
    members = stage(members, new_folder(spark, "members"))
    buckets = members.groupBy("band").agg(F.count("*").alias("n"), F.min(lead).alias("lead")).filter("n > 1")
    shared = members.join(buckets.select("band", "n", F.col("lead.node").alias("leader")), "band")
    shared = stage(shared, new_folder(spark, "buckets"))

    involved = shared.select("node", "node_id").distinct()
    of_node = (rows["node"] == involved["node"]) & rows["row_id"].eqNullSafe(involved["node_id"])
    texts = rows.join(involved, of_node, "left_semi").select("node", "row_text").dropDuplicates(["node"])
    texts = stage(texts, new_folder(spark, "texts"))

    # The leader of each bucket with each of its other nodes.
    stars = shared.filter(F.col("node") != F.col("leader"))
    stars = stars.groupBy(F.least("leader", "node").alias("b"), F.greatest("leader", "node").alias("a"))
    stars = stage(stars.agg(F.count("*").alias("n")).select("a", "b"), new_folder(spark, "stars"))
    links = stage(_links(stars, texts, similarity), new_folder(spark, "links"))
    found = stage(components(links), new_folder(spark, "components"))

    # Nodes of one bucket that are not connected yet, compared with each other.
    placed = shared.filter("n > 2").join(found, "node", "left")
    placed = placed.select("band", "n", "node", F.coalesce("root", "node").alias("root"))
    placed = stage(placed, new_folder(spark, "placed"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("first"), F.max("root").alias("last"))
    mixed = mixed.filter(F.col("first") != F.col("last")).select("band")
    tasks = _block_pairs(placed.join(mixed, "band", "left_semi"))
    tasks = tasks.join(texts, "node").select("band", "left", "right", "block", "node", "root", "row_text")
    more = tasks.groupBy("band", "left", "right").applyInPandas(_compare_blocks(similarity), "a binary, b binary")
    more = stage(more, new_folder(spark, "links"))
    if not more.isEmpty():
        found = stage(components(links.unionByName(more)), new_folder(spark, "components"))

    rows_of = signed.select("node", "row_id")
    classed = rows_of.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = classed.groupBy("root").agg(
        F.min("row_id").alias("class_id"), F.count("*").alias("class_size"), F.min_by("node", "row_id").alias("head")
    )
    # Of several texts under the smallest id, or if no row has an id, one stays.
    head = F.coalesce(F.col("head"), F.col("root"))
    kept = F.col("row_id").eqNullSafe(F.col("class_id")) & (F.col("node") == head)
    return classed.join(heads, "root").select(
        F.col("row_id").alias(id_col), "class_id", "class_size", kept.alias("kept"), "node"
    )
