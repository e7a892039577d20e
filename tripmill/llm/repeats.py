"""Removal of long repeated strings by grouping hashes of windows, in place of a radix sort of suffixes.

Only the first ``depth`` bytes of a suffix count, so suffixes that stay together through all passes are exactly
the repeated windows. Nothing is ordered, and a digit is no leading byte. A pass groups suffixes by one more digit, from
the most significant on, and those alone in their group drop out. What a digit is makes the passes cheap:

* First digit: the bytes of the window's anchor and the anchor's place in it. The anchor is the piece of
  ``ANCHOR`` bytes with the smallest hash in the window, so it follows from the window alone, and neighbouring
  windows share it. Windows with one anchor move as one run.
* Next digits: the bytes of the whole run, then of blocks of a run's windows, then of single windows. Windows of
  a group that is repeated are settled as one; only what is left is cut into smaller parts.

Groups are counted with partial aggregates and joined back, so a passage that a third of all texts share costs
no task more than its share. Digits are compared by 64-bit hashes, each window by two of them at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm import textscan
from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

DEPTH = 400
ANCHOR = 192
# Windows in a block, pass by pass.
BLOCKS = (16, 1)

_U = np.uint64
_POWERS = textscan.Powers(0xA0761D6478BD642F)
_OTHER_POWERS = textscan.Powers(0xE7037ED1A0B428DB)
_CODES, _OTHER_CODES = np.random.default_rng(31_415_926).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
# An anchor's place among the windows looked at together takes the low bits of the number that is compared, so that
# the leftmost of equals wins.
_PLACE_BITS = 27
_PLACE = _U((1 << _PLACE_BITS) - 1)
# A run or block is packed into one number: where its first window starts, the windows, and the anchor's place.
_LOW = 10
# Texts sent back at once.
_ROWS = 500


class _Hashes:
    """Two hashes of any span of a text's bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self._first = textscan.prefix_hashes(_CODES[data], _POWERS)
        self._second = textscan.prefix_hashes(_OTHER_CODES[data], _OTHER_POWERS)

    def first(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return textscan.mix(textscan.span_hashes(self._first, starts, ends, _POWERS))

    def second(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return textscan.mix(textscan.span_hashes(self._second, starts, ends, _OTHER_POWERS))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def anchors(hashes: _Hashes, size: int, depth: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text of ``size`` bytes: the anchors, and the first and last window of each."""
    windows, span = size - depth + 1, depth - anchor
    # So many windows at a time that a place among them fits into its bits, whatever the text's length.
    step = (1 << _PLACE_BITS) - span
    at, first = [], []
    for begin in range(0, windows, step):
        places = np.arange(min(step, windows - begin) + span)
        numbers = hashes.first(places + begin, places + begin + anchor) & ~_PLACE | places.astype(_U)
        chosen = (_smallest(numbers, span + 1) & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
        at.append(chosen[new] + begin)
        first.append(new + begin)
    chosen, first = np.concatenate(at), np.concatenate(first)
    # A run may go on from one piece to the next.
    new = np.append(True, chosen[1:] != chosen[:-1])
    first = first[new]
    return chosen[new], first, np.append(first[1:], windows) - 1


def _runs(depth: int, anchor: int):
    """From texts to runs: the anchor's digit, the run's digit, and where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, ends = textscan.raw_bytes(batch.column("row_text"))
            found = []
            for row in range(batch.num_rows):
                data = whole[ends[row] : ends[row + 1]]
                if len(data) < depth:
                    continue
                hashes = _Hashes(data)
                at, first, last = anchors(hashes, len(data), depth, anchor)
                digit = hashes.second(at, at + anchor)
                shape = ((at - first) << _LOW | (last - first)).astype(_U)
                body = textscan.mix(hashes.first(first, last + depth) + shape)
                found.append((np.full(len(at), row), digit, body, first, last - first + 1, at - first))
            columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 6
            rows = pa.array(columns[0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id").take(rows),
                    batch.column("text_key").take(rows),
                    pa.array(columns[1].astype(_U).view(np.int64)),
                    pa.array(columns[2].astype(_U).view(np.int64)),
                    pa.array(columns[3] << 2 * _LOW | columns[4] << _LOW | columns[5]),
                ],
                names=["row_id", "text_key", "digit", "body", "place"],
            )

    return run


def _places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed places as first window, windows, and the anchor's distance from the first window."""
    packed = column.to_numpy(zero_copy_only=False)
    low = (1 << _LOW) - 1
    return packed >> 2 * _LOW, packed >> _LOW & low, packed & low


def _stretches(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first byte, byte after the last) of the maximal stretches that spans cover."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            if last > merged[-1][1]:
                merged[-1] = (merged[-1][0], last)
        else:
            merged.append((first, last))
    return merged


def _kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for first, last in removed:
        parts.append(text[at:first])
        at = last
    parts.append(text[at:])
    return b"".join(parts)


def _settled(depth: int, with_kept: bool, schema: pa.Schema):
    """From texts with their settled runs and the runs that are still open or stand for others: the result of
    those without such runs; of the others the text and the bytes of those runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                texts = batch.column("row_text").cast(pa.binary()).to_pylist()
                settled, members = batch.column("settled").to_pylist(), batch.column("members").to_pylist()
                out = []
                for text, places, runs in zip(texts, settled, members):
                    spans = []
                    for place in places or ():
                        first, windows = place >> 2 * _LOW, place >> _LOW & (1 << _LOW) - 1
                        spans.append((first, first + windows - 1 + depth))
                    spans = _stretches(spans)
                    if runs:
                        bodies = []
                        for item in runs:
                            first, windows = item["place"] >> 2 * _LOW, item["place"] >> _LOW & (1 << _LOW) - 1
                            bodies.append(item | {"bytes": text[first : first + windows - 1 + depth]})
                        out.append((text, spans, bodies, None, None))
                    else:
                        kept = _kept(text, spans)
                        out.append((None, spans, None, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
                columns = [batch.column("row_id"), batch.column("text_key"), pa.array([len(t) for t in texts], pa.int64())]
                for k, name in enumerate(("text", "spans", "members", "kept_sha256", "kept")):
                    values = [row[k] for row in out]
                    if name == "spans":
                        values = [[{"start": a, "length": b - a} for a, b in spans] for spans in values]
                    columns.append(pa.array(values, schema.field(name).type))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _finished(depth: int, with_kept: bool, schema: pa.Schema):
    """From texts with their settled spans and the parts found since to the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                out = []
                for text, spans, parts in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "parts"))):
                    found = [(s["start"], s["start"] + s["length"]) for s in spans]
                    found += [(p["first"], p["first"] + p["windows"] - 1 + depth) for p in parts or ()]
                    found = _stretches(found)
                    kept = _kept(text, found)
                    out.append((found, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
                columns = [batch.column("row_id"), batch.column("n_bytes")]
                columns += [
                    pa.array([[{"start": a, "length": b - a} for a, b in row[0]] for row in out], schema.field("spans").type),
                    pa.array([row[1] for row in out], pa.string()),
                    pa.array([row[2] for row in out], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _cut(depth: int, size: int):
    """From runs with the blocks that go on to the digits of those blocks' parts of ``size`` windows.

    Parts are counted from the anchor, so that equal windows are in equal parts. ``group`` is the anchor's digit,
    the part's number, and the bytes that all its windows share: a window can only be equal to one of its group.
    ``key`` is the bytes of the whole part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, _, reach = _places(batch.column("place"))
            digits = batch.column("digit").to_numpy().view(_U)
            found = []
            for row, (body, blocks) in enumerate(zip(batch.column("bytes").to_pylist(), batch.column("blocks").to_pylist())):
                hashes = _Hashes(np.frombuffer(body, np.uint8))
                for block in blocks:
                    first, windows = block >> _LOW, block & (1 << _LOW) - 1
                    # Distances from the anchor, cut at whole multiples of the size.
                    far, near = reach[row] - first, reach[row] - first - windows + 1
                    tops = np.arange(far // size * size, near // size * size - 1, -size)
                    parts_far = np.minimum(tops + size - 1, far)
                    parts_near = np.maximum(tops, near)
                    starts = reach[row] - parts_far
                    lengths = parts_far - parts_near + 1
                    # All windows of a whole part have these bytes in common.
                    inner = reach[row] - tops
                    inner_ends = np.maximum(inner - size + 1 + depth, inner)
                    shared = hashes.second(inner, inner_ends)
                    group = textscan.mix(textscan.mix((tops // size).astype(_U) + digits[row]) + shared)
                    shape = (parts_far << _LOW | lengths).astype(_U)
                    key = textscan.mix(hashes.first(starts, starts + lengths - 1 + depth) + shape)
                    found.append((np.full(len(starts), row), group, key, starts, lengths))
            columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
            at = pa.array(columns[0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("run").take(at),
                    batch.column("open").take(at),
                    pa.array(columns[1].astype(_U).view(np.int64)),
                    pa.array(columns[2].astype(_U).view(np.int64)),
                    pa.array((columns[3] << _LOW | columns[4]).astype(np.int32)),
                ],
                names=["run", "open", "group", "key", "part"],
            )

    return run


def _pass(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass over parts (run, open, group, key, part): which open parts are repeated, and which parts go on.

    A part goes on if its group has several keys and one of them is open and alone. Of the parts with one key one
    goes on, as an open one only if it is alone.
    """
    keys = parts.groupBy("group", "key").agg(
        F.count("*").alias("n"), F.min(F.struct("run", "part", "open")).alias("one")
    )
    repeated = keys.filter("n > 1").select("group", "key")
    settled = parts.filter("open").join(repeated, ["group", "key"]).select("run", "part")
    alone = (F.col("n") == 1) & F.col("one.open")
    groups = keys.groupBy("group").agg(F.count("*").alias("keys"), F.max(alone).alias("waits"))
    groups = stage(groups.filter("keys > 1 AND waits").select("group"), new_folder(parts.sparkSession, "waiting-groups"))
    onward = keys.join(groups, "group").select("one.run", "one.part", alone.alias("open"))
    return settled, onward


def find_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    *,
    with_kept: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans``.

    Texts are taken as UTF-8 bytes. A byte is removed if it lies in a string of ``depth`` bytes that also starts
    anywhere else, in the same text or another; the strings are those of the input, and may overlap. ``spans`` are
    the maximal removed stretches (first byte, bytes), ``kept_sha256`` is the digest of what is left, and
    ``with_kept`` adds those bytes as ``kept``. NULL text counts as empty; texts of fewer bytes than ``depth`` keep
    all; a text of any length is taken whose row fits in memory. Repeated rows repeat each other's text, so all of it
    goes, if it is long enough. A NULL id is an id; rows of one id and different texts each have their own result.
    Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    importable(spark)
    anchor = min(ANCHOR, max(1, depth // 2))
    if depth - anchor + 1 >= 1 << _LOW:
        anchor = depth - (1 << _LOW) + 2
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("row_id"), F.xxhash64(text).alias("text_key"), text.alias("row_text"))
    id_type = rows.schema["row_id"].dataType
    key = [T.StructField("row_id", id_type), T.StructField("text_key", T.LongType())]

    # First digit, and the second where one count of the first tells all.
    run_schema = T.StructType([*key, *(T.StructField(name, T.LongType()) for name in ("digit", "body", "place"))])
    runs = stage(rows.mapInArrow(_runs(depth, anchor), run_schema), new_folder(spark, "runs"))
    digits = runs.groupBy("digit").agg(F.count("*").alias("n"), F.min("body").alias("low"), F.max("body").alias("high"))
    digits = digits.filter("n > 1").select("digit", (F.col("low") == F.col("high")).alias("pure"))
    # Written before it is joined, so that the join is split where one digit has very many runs: a join that counts
    # one of its sides itself is not.
    digits = stage(digits, new_folder(spark, "digits"))
    shared = stage(runs.join(digits, "digit"), new_folder(spark, "shared-runs"))
    # The second digit of the others. A run is named by where it is.
    mixed = shared.filter("NOT pure")
    bodies = mixed.groupBy("digit", "body").agg(
        F.count("*").alias("n"), F.min(F.struct("row_id", "text_key", "place")).alias("one")
    )
    bodies = stage(bodies, new_folder(spark, "bodies"))
    repeated = bodies.filter("n > 1").select("digit", "body")
    settled = shared.filter("pure").select("row_id", "text_key", "place")
    settled = settled.unionByName(mixed.join(repeated, ["digit", "body"]).select("row_id", "text_key", "place"))
    # A group of several bodies goes on if one of them is alone. Each body is there once.
    waits = bodies.groupBy("digit").agg(F.min("n").alias("least")).filter("least = 1").select("digit")
    waits = stage(waits, new_folder(spark, "waiting-digits"))
    members = bodies.join(waits, "digit").select("one.*", "digit", (F.col("n") == 1).alias("open"))
    members = members.withColumn("run", F.xxhash64("digit", "row_id", "text_key", "place"))

    item = F.struct("run", "digit", "place", "open")
    by_text = settled.groupBy("row_id", "text_key").agg(F.collect_set("place").alias("settled"))
    of_members = members.groupBy("row_id", "text_key").agg(F.collect_set(item).alias("members"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"row_id": "other_id", "text_key": "other_key"})
        same = left["row_id"].eqNullSafe(right["other_id"]) & (left["text_key"] == right["other_key"])
        return left.join(right, same, "left").drop("other_id", "other_key")

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    body = T.StructType(
        [
            T.StructField("run", T.LongType()),
            T.StructField("digit", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("bytes", T.BinaryType()),
        ]
    )
    half_schema = T.StructType(
        [
            *key,
            T.StructField("n_bytes", T.LongType()),
            T.StructField("text", T.BinaryType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("members", T.ArrayType(body)),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    joined = beside(beside(rows, by_text), of_members)
    joined = joined.select("row_id", "text_key", "row_text", "settled", "members")
    half = joined.mapInArrow(_settled(depth, with_kept, _arrow(half_schema)), half_schema)
    half = stage(half, new_folder(spark, "half-settled"))

    # Smaller and smaller parts of the runs that are left. Repeated rows hold the same runs, once is enough.
    contexts = half.filter("members IS NOT NULL").select("row_id", "text_key", F.explode("members").alias("m"))
    contexts = contexts.select("row_id", "text_key", "m.*").dropDuplicates(["run"])
    contexts = stage(contexts, new_folder(spark, "contexts"))
    whole_run = F.array((F.shiftright("place", _LOW).bitwiseAND((1 << _LOW) - 1)).cast("int"))
    work = contexts.withColumn("blocks", whole_run)
    found = None
    for size in BLOCKS:
        part_schema = "run long, open boolean, group long, key long, part int"
        parts = work.select("run", "open", "digit", "place", "bytes", "blocks").mapInArrow(_cut(depth, size), part_schema)
        parts = stage(parts, new_folder(spark, "parts"))
        done, onward = _pass(parts)
        found = done if found is None else found.unionByName(done)
        blocks = onward.groupBy("run", "open").agg(F.collect_list("part").alias("blocks"))
        work = contexts.drop("open").join(blocks, "run")
    places = contexts.select("run", "row_id", "text_key", F.shiftright("place", 2 * _LOW).alias("begin"))
    found = found.join(places, "run").select(
        "row_id",
        "text_key",
        F.struct(
            (F.col("begin") + F.shiftright("part", _LOW)).alias("first"),
            F.col("part").bitwiseAND((1 << _LOW) - 1).alias("windows"),
        ).alias("found"),
    )
    found = found.groupBy("row_id", "text_key").agg(F.collect_list("found").alias("parts"))

    result_schema = T.StructType(
        [
            T.StructField("row_id", id_type),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    late = beside(half.filter("members IS NOT NULL").select("row_id", "text_key", "n_bytes", "text", "spans"), found)
    late = late.select("row_id", "n_bytes", "text", "spans", "parts")
    late = late.mapInArrow(_finished(depth, with_kept, _arrow(result_schema)), result_schema)
    early = half.filter("members IS NULL").select(*result_schema.names)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["length"])
    return early.unionByName(late).select(
        F.col("row_id").alias(id_col),
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        "spans",
        *(["kept"] if with_kept else []),
    )


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
