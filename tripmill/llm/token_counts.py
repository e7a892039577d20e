"""Token counts by a finite-state transducer whose transitions carry the number of emitted tokens.

A piece of text is a map from the state before it to the state after it and the tokens in between. Maps compose,
and composing is associative, so a text's count is the end of a prefix scan over the maps of its chunks. A chunk that
begins with a word's start has a map that is the same for every state before it, because no token goes over a word's
end; such maps compose by adding counts, in any order, and each is computed once for a word. A word too long for that is
cut into chunks. Each chunk's map is made by itself, for the state that the few characters before the chunk lead to,
and the scan composes the maps in a tree whose depth is the logarithm of the chunks. Where another state than the
likely one is reached, the map is made for that one too, so the likely state decides about time only.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.bpe import LONG_UNIT, MAX_UNITS, START, MergeAutomaton, automaton, no_cycle_search, spelled, units
from tripmill.llm.common import importable, whole_text

# Characters of a chunk of a long word.
CHUNK = 4096
# Characters before a chunk that tell its likely state.
LOOK_BACK = 64

# The state after, and the tokens in between.
Step = tuple[int, int]


class ChunkMap:
    """The map of a chunk: for the state that the characters before it are likely to lead to, and any it is asked for."""

    def __init__(self, machine: MergeAutomaton, text: str, before: str = "") -> None:
        self._machine, self._text, self._known = machine, text, {}
        self[self._run(before[-LOOK_BACK:], START)[0]]

    def _run(self, text: str, state: int) -> Step:
        machine, count = self._machine, 0
        for char in text:
            state, grows = machine.steps[state].get(char) or machine.compile_step(state, char)
            count += grows
        return state, count

    def __getitem__(self, state: int) -> Step:
        step = self._known.get(state)
        if step is None:
            step = self._known[state] = self._run(self._text, state)
        return step


class Composed:
    """One map after another, as one map."""

    def __init__(self, first: ChunkMap | Composed, second: ChunkMap | Composed) -> None:
        self._first, self._second, self._known = first, second, {}

    def __getitem__(self, state: int) -> Step:
        step = self._known.get(state)
        if step is None:
            between, count = self._first[state]
            after, more = self._second[between]
            step = self._known[state] = (after, count + more)
        return step


def prefixes(maps: list[ChunkMap | Composed]) -> list[ChunkMap | Composed]:
    """For each map, the map of all up to it: neighbours are composed, scanned, and composed with those in between."""
    if len(maps) < 2:
        return maps
    pairs = prefixes([Composed(first, second) for first, second in zip(maps[::2], maps[1::2])])
    scanned = [maps[0]]
    for k in range(1, len(maps)):
        scanned.append(pairs[k // 2] if k % 2 else Composed(pairs[k // 2 - 1], maps[k]))
    return scanned


def chunk_maps(machine: MergeAutomaton, text: str, size: int) -> list[ChunkMap]:
    """The maps of a text's chunks. Equal chunks behind equal characters share one."""
    made: dict[tuple[str, str], ChunkMap] = {}
    maps = []
    for at in range(0, len(text), size):
        chunk = (text[at : at + size], text[max(at - LOOK_BACK, 0) : at])
        if chunk not in made:
            made[chunk] = ChunkMap(machine, *chunk)
        maps.append(made[chunk])
    return maps


class UnitCounts(dict):
    """Tokens of a unit, by the unit without its first space."""

    def __init__(self, machine: MergeAutomaton) -> None:
        self._machine = machine

    def __missing__(self, unit: str) -> int:
        text = spelled(unit)
        maps = chunk_maps(self._machine, text, CHUNK) if len(text) > CHUNK else [ChunkMap(self._machine, text)]
        _, count = prefixes(maps)[-1][START]
        if len(unit) <= LONG_UNIT:
            if len(self) >= 2 * MAX_UNITS:
                self.clear()
            self[unit] = count
        self._machine.make_room()
        return count


_COUNTS: dict[bytes, UnitCounts] = {}


def count(text: str, counts: UnitCounts) -> int:
    return sum(map(counts.__getitem__, units(text))) if text else 0


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_tokens``, and ``over_limit`` (more than ``limit``).

    ``model_path`` is a sentencepiece model of type BPE without normalisation rules; it is read by the driver and
    sent to the tasks. Tokens are those of the library without begin and end; special strings inside a text are
    text. NULL text counts as empty, which has no tokens. A NULL id, repeated rows and other columns do not
    matter: each row is counted by itself. An empty table gives an empty result.
    """
    importable(docs.sparkSession)
    model = Path(model_path).read_bytes()
    rows = docs.select(F.col(id_col).alias("row_id"), whole_text(text_col).alias("row_text"))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _COUNTS.get(model)
        if counts is None:
            counts = _COUNTS[model] = UnitCounts(automaton(model))
        for batch in batches:
            texts = batch.column("row_text")
            sizes = pc.binary_length(texts)
            with no_cycle_search():
                tokens = [count(text, counts) for text in texts.to_pylist()]
            over = [n > limit for n in tokens]
            columns = [batch.column("row_id"), sizes, pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)
