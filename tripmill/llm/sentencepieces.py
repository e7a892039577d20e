"""SentencePiece encoding and decoding of merge-type models by a prefix table.

For each prefix of a word the table holds its unique last token, found by automaton matches and tests of
compatible pairs (see :mod:`tripmill.llm.bpe`). The ids are recovered backwards: the last token of the whole
word, then the last token of what is before it, and so on. Texts are taken in slices of bounded size; the distinct
words of a slice are sorted, so a word goes on with the table of the prefix it shares with the one before, and ids and
decoded words are put together by Arrow. Nothing of a slice is kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.bpe import LINE, SPACE, START, MergeAutomaton, automaton, no_cycle_search, spelled, units
from tripmill.llm.common import importable, whole_text

# Bytes of text that are encoded at once.
_SLICE_BYTES = 4 << 20
# Words between two looks at what the automaton keeps.
_BLOCK = 20_000
# Characters up to which a shared prefix is looked for.
_SHARED = 32


def decode(machine: MergeAutomaton, ids: Iterable[int]) -> str:
    """The text of ids, spaces as the model writes them. Bytes that are no UTF-8 become U+FFFD."""
    out, spelled = [], bytearray()
    for token in ids:
        byte = machine.bytes_of.get(token)
        if byte is not None:
            spelled.append(byte)
            continue
        if spelled:
            out.append(spelled.decode(errors="replace"))
            spelled.clear()
        out.append(machine.piece[token])
    out.append(spelled.decode(errors="replace"))
    return "".join(out)


def encode_units(machine: MergeAutomaton, words: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """The ids of sorted words as they are read, one after another; where each word's ids begin and the last one's end;
    and, by their place, what the words decode to that are spelled in bytes."""
    ids: list[int] = []
    ends, in_bytes = [0], {}
    lengths, compile_step = machine.lengths, machine.compile_step
    for first in range(0, len(words), _BLOCK):
        # A state number is good until room is made.
        machine.make_room()
        steps, last_of = machine.steps, machine.lasts
        block = words[first : first + _BLOCK]
        # The prefix table and the states of the word before, as far as it is shared.
        states, table = [START], []
        for word, shared in zip(block, _shared_prefixes(block)):
            del states[shared + 1 :], table[shared:]
            state = states[shared]
            for char in word[shared:]:
                state, _ = steps[state].get(char) or compile_step(state, char)
                states.append(state)
                table.append(last_of[state])
            backwards, at = [], len(word)
            while at:
                token = table[at - 1]
                if token < 0:
                    backwards += [machine.byte_ids[byte] for byte in reversed(word[at - 1].encode())]
                    at -= 1
                    in_bytes[len(ends) - 1] = ""
                else:
                    backwards.append(token)
                    at -= lengths[token]
            ids += backwards[::-1]
            ends.append(len(ids))
            if in_bytes and len(ends) - 2 in in_bytes:
                in_bytes[len(ends) - 2] = decode(machine, backwards[::-1])
    return np.array(ids, dtype=np.int32), np.array(ends, dtype=np.int64), in_bytes


def _shared_prefixes(words: list[str]) -> list[int]:
    """Characters that each word shares with the one before; long words are compared as far as they may share."""
    if not words:
        return []
    grid = np.array([word[:_SHARED] for word in words], dtype=f"U{_SHARED}").view(np.uint32).reshape(len(words), _SHARED)
    # Words that are cut, or end in a zero character, look longer or shorter to numpy, but not where they are alike.
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    alike = np.logical_and.accumulate(grid[1:] == grid[:-1], axis=1).sum(axis=1)
    return [0, *np.minimum(alike, np.minimum(sizes[1:], sizes[:-1])).tolist()]


def _parts(texts: pa.StringArray) -> pa.ListArray:
    """Texts cut at spaces. The units of a text are those of its parts, one after another; an empty text has none."""
    odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE))
    odd = pc.or_(odd, pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
    odd = pc.or_(odd, pc.equal(pc.binary_length(texts), 0))
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    others = []
    for text in texts.filter(odd).to_pylist():
        parts: list[str] = []
        for unit in units(text) if text else []:
            if unit.startswith(LINE):
                # What begins with a line feed goes with the part before, from which it is cut again.
                parts[-1] += unit[1:]
            else:
                parts.append(unit)
        others.append(parts)
    where = odd.to_numpy(zero_copy_only=False)
    place = np.where(where, len(plain) + np.cumsum(where) - 1, np.cumsum(~where) - 1)
    return pa.concat_arrays([plain, pa.array(others, plain.type)]).take(pa.array(place))


def _distinct_units(parts: pa.StringArray) -> tuple[list[str], pa.ListArray]:
    """The distinct units of distinct parts as they are read, sorted, and the places of each part's units in them."""
    several = pc.or_(pc.match_substring(parts, "\n"), pc.match_substring(parts, SPACE))
    several = pc.or_(several, pc.equal(pc.binary_length(parts), 0)).to_numpy(zero_copy_only=False)
    counts = np.ones(len(parts), dtype=np.int64)
    cut = [[spelled(unit) for unit in units(part)] for part in parts.filter(pa.array(several)).to_pylist()]
    counts[several] = [len(group) for group in cut]
    ends = np.concatenate([[0], np.cumsum(counts)])
    read = pc.binary_join_element_wise(SPACE, parts.filter(pa.array(~several)), "")
    every = pa.concat_arrays([read, pa.array([word for group in cut for word in group], pa.string())]).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    ranks = rank[every.indices.to_numpy()]
    places = np.empty(ends[-1], dtype=np.int32)
    of_several = np.repeat(several, counts)
    places[~of_several], places[of_several] = ranks[: len(read)], ranks[len(read) :]
    return every.dictionary.take(pa.array(order)).to_pylist(), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places))


def encode_texts(machine: MergeAutomaton, texts: pa.StringArray) -> tuple[pa.ListArray, pa.StringArray]:
    """The ids of each text, and the decoded texts."""
    parts = _parts(texts)
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    words, units_of = _distinct_units(coded.dictionary)
    ids, ends, in_bytes = encode_units(machine, words)
    del words
    ids_of = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
    text_of = pc.binary_join(pa.ListArray.from_arrays(ids_of.offsets, machine.pieces.take(pa.array(ids))), "")
    if in_bytes:
        mask = np.zeros(len(text_of), dtype=bool)
        mask[list(in_bytes)] = True
        text_of = pc.replace_with_mask(text_of, pa.array(mask), pa.array([in_bytes[i] for i in sorted(in_bytes)], pa.string()))
    text_of = pc.replace_substring(text_of, SPACE, " ")
    # Where each text's units, and its ids, end.
    unit_counts = pc.list_value_length(units_of).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
    sequence = units_of.take(coded.indices).flatten()
    unit_ends = np.concatenate([[0], np.cumsum(unit_counts)])[offsets]
    id_ends = np.concatenate([[0], np.cumsum(np.diff(ends)[sequence.to_numpy()])])[unit_ends]
    lists = pa.ListArray.from_arrays(pa.array(id_ends, pa.int32()), ids_of.take(sequence).flatten())
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(unit_ends, pa.int32()), text_of.take(sequence)), "")
    # The space of the text's start is not part of the text.
    return lists, pc.utf8_slice_codeunits(joined, 1)


def slices_of_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts have about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        after = max(int(np.searchsorted(ends, before + most, side="right")), first + 1)
        yield batch.slice(first, after - first)
        first = after


def encode_and_decode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``ids`` (array of int) and ``decoded`` (string).

    ``model_path`` is a sentencepiece model of type BPE without normalisation rules; it is read by the driver and
    sent to the tasks. The ids are the library's without begin and end, and ``decoded`` is what its decode makes
    of them. NULL text counts as empty: no ids, and empty text. A NULL id, repeated rows and other columns do not
    matter: each row is encoded by itself. An empty table gives an empty result.
    """
    importable(docs.sparkSession)
    model = Path(model_path).read_bytes()
    rows = docs.select(F.col(id_col).alias("row_id"), whole_text(text_col).alias("row_text"))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("decoded", T.StringType()),
        ]
    )
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(model)
        for whole in batches:
            for batch in slices_of_bytes(whole, "row_text", _SLICE_BYTES):
                with no_cycle_search():
                    lists, decoded = encode_texts(machine, batch.column("row_text"))
                columns = [batch.column("row_id"), lists, decoded]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From ids and decoded texts to their number and digests."""
    spelled = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
