"""Exact deduplication by a content sort.

Rows are range-partitioned by (beginning of the normalised text, its digest, id) with splitters that Spark samples,
sorted on each partition (the sort spills), and neighbours are compared in full. Splitters are sampled from keys of
bounded size, so long texts do not go through the driver. The id is part of the sort key, so copies of one text that
hold a third of all rows are spread over many partitions; the runs that touch a partition's edge are then stitched
together by comparing the edge texts, of which there are two a partition at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

# A run's number is its partition times this plus its place there.
_RUNS_PER_PARTITION = 1 << 40
# Characters of a text that go into the keys the splitters are sampled from.
_HEAD = 32


def _starts(values: pa.Array, before: pa.Scalar | None) -> pa.Array:
    """Where a value differs from the one before it; NULLs are equal."""
    first = True if before is None else values[0].as_py() != before.as_py()
    if len(values) == 1:
        return pa.array([first])
    left, right = values.slice(0, len(values) - 1), values.slice(1)
    differ = pc.fill_null(pc.not_equal(left, right), True)
    both_null = pc.and_(pc.is_null(left), pc.is_null(right))
    return pa.concat_arrays([pa.array([first]), pc.and_not(differ, both_null)])


def _runs(payload: list[str], names: list[str], text_col: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From sorted rows to (id, digest, run, repeat, edge text, payload of the first row of each run).

    ``text_col`` is the payload column that is the sorted text itself, NULL where ``no_text`` says so; None if none is.
    """

    def cells(batch: pa.RecordBatch, name: str) -> pa.Array:
        if name != text_col:
            return batch.column(f"p_{name}")
        texts = batch.column("sort_text")
        return pc.if_else(batch.column("no_text"), pa.scalar(None, texts.type), texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() * _RUNS_PER_PARTITION
        number, text_before, id_before, last = -1, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, ids = batch.column("sort_text"), batch.column("sort_id")
            new_run = _starts(texts, text_before)
            new_row = pc.or_(new_run, _starts(ids, id_before)).to_pylist()
            numbers, repeats, edges = [], [], []
            for i, starts in enumerate(new_run.to_pylist()):
                edge = None
                if starts:
                    number += 1
                    if number == 0:
                        edge = texts[i].as_py()
                numbers.append(base + number)
                repeats.append(not new_row[i])
                edges.append(edge)
            text_before, id_before = texts[-1], ids[-1]
            columns = [
                ids,
                batch.column("digest"),
                pa.array(numbers, pa.int64()),
                pa.array(repeats, pa.bool_()),
                pa.array(edges, pa.string()),
                new_run,
            ]
            # Only the first row of a run may stay, so only its payload goes on.
            first = pc.if_else(new_run, pa.array(range(batch.num_rows)), None)
            columns += [cells(batch, name).take(first) for name in payload]
            if last is not None:
                yield last
            last = pa.RecordBatch.from_arrays(columns, names=names)
        if last is None:
            return
        if number > 0:
            # The last row carries the text of the last run. It is no first run, so its cell is free.
            edges = last.column("edge_text").to_pylist()
            edges[-1] = text_before.as_py()
            at = names.index("edge_text")
            last = pa.RecordBatch.from_arrays(
                [*last.columns[:at], pa.array(edges, pa.string()), *last.columns[at + 1 :]], names=names
            )
        yield last

    return run


def _sorted_runs(
    docs: DataFrame, id_col: str, text_col: str, largest: bool, normalise: Callable[[Column], Column] | None, payload: list[str]
) -> DataFrame:
    importable(docs.sparkSession)
    text = whole_text(text_col)
    text = normalise(text) if normalise else text
    # A text that is sorted as it is goes along once.
    given = next((name for name in payload if name == text_col), None) if normalise is None else None
    if given is not None and not isinstance(docs.schema[given].dataType, T.StringType):
        given = None
    rows = docs.select(
        F.col(id_col).alias("sort_id"),
        text.alias("sort_text"),
        F.substring(text, 1, _HEAD).alias("sort_head"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        *(F.col(name).alias(f"p_{name}") for name in payload if name != given),
        *([F.col(given).isNull().alias("no_text")] if given is not None else []),
    )
    by_id = F.desc_nulls_last("sort_id") if largest else F.asc_nulls_last("sort_id")
    fields = [
        T.StructField("sort_id", rows.schema["sort_id"].dataType),
        T.StructField("digest", T.BinaryType()),
        T.StructField("run", T.LongType()),
        T.StructField("repeat", T.BooleanType()),
        T.StructField("edge_text", T.StringType()),
        T.StructField("first", T.BooleanType()),
        *(T.StructField(f"p_{name}", docs.schema[name].dataType) for name in payload),
    ]
    schema = T.StructType(fields)
    ranged = rows.repartitionByRange("sort_head", "digest", by_id)
    runs = ranged.sortWithinPartitions("sort_head", "digest", "sort_text", by_id).mapInArrow(_runs(payload, schema.names, given), schema)
    # Splitters are sampled anew each time the plan runs, so later steps read one written result.
    return stage(runs, new_folder(docs.sparkSession, "content-sort"))


def _with_roots(runs: DataFrame) -> DataFrame:
    """Runs of one text in neighbouring partitions get one root: the first of them."""
    edges = runs.filter("edge_text IS NOT NULL").select(F.col("run").alias("edge_run"), "edge_text").distinct()
    roots = edges.groupBy("edge_text").agg(F.min("edge_run").alias("root"))
    stitched = edges.join(roots, "edge_text").filter("root <> edge_run").select("edge_run", "root")
    joined = runs.drop("edge_text").join(stitched, runs["run"] == stitched["edge_run"], "left")
    return joined.withColumn("root", F.coalesce("root", "run")).drop("edge_run")


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are compared in full after ``normalise`` (by default unchanged). ``keep`` is ``smallest`` or
    ``largest``: the id that stays of a group. NULL text counts as empty. A NULL id stays only if no row of its
    group has one. Repeated rows (same id, same text) count in ``group_size``, and one of them stays. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    runs = _with_roots(_sorted_runs(docs, id_col, text_col, keep == "largest", normalise, []))
    chosen = F.max("sort_id") if keep == "largest" else F.min("sort_id")
    groups = runs.groupBy("root").agg(chosen.alias("keep_id"), F.count("*").alias("group_size"))
    kept = F.col("sort_id").eqNullSafe(F.col("keep_id")) & ~F.col("repeat")
    return runs.join(groups, "root").select(
        F.col("sort_id").alias(id_col),
        "keep_id",
        "group_size",
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in :func:`find_copies`.

    The row that stays is the first of its run in sort order, so the rows need no second shuffle.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    runs = _with_roots(_sorted_runs(docs, id_col, text_col, keep == "largest", normalise, docs.columns))
    stays = runs.filter(F.col("first") & (F.col("run") == F.col("root")))
    return stays.select(*(F.col(f"p_{name}").alias(name) for name in docs.columns))
