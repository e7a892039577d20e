import hashlib

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import bpe, sentencepieces, token_counts
from tripmill.llm.queries import PIECES, op6_token_counts, op7_sentencepieces, tokenizer_file
from tripmill.llm.sentencepieces import encode_and_decode
from tripmill.llm.token_counts import ChunkMap, Composed, UnitCounts, chunk_maps, count, count_tokens, prefixes


@pytest.fixture(scope="module")
def model():
    return open(tokenizer_file(PIECES), "rb").read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def machine(model):
    return bpe.automaton(model)


def encoded(machine, text):
    ids, decoded = sentencepieces.encode_texts(machine, pa.array([text], pa.string()))
    return ids[0].as_py(), decoded[0].as_py()


pieces = st.sampled_from(
    [" ", "  ", "\n", "\t", "▁", "the", "ing", "é", "日", "本", "😀", "\0", "<s>", "</s>", "<0x0A>", "!", "123", "://", "a", "B"]
)
texts = st.one_of(st.lists(pieces, max_size=30).map("".join), st.text(max_size=40))


@settings(max_examples=600, deadline=None)
@given(text=texts)
def test_same_as_the_library(machine, library, text):
    want = library.encode(text)
    assert encoded(machine, text) == (want, library.decode(want))
    assert count(text, UnitCounts(machine)) == len(want)


@settings(max_examples=100, deadline=None)
@given(several=st.lists(texts, max_size=12))
def test_texts_of_a_slice_are_encoded_together(machine, library, several):
    ids, decoded = sentencepieces.encode_texts(machine, pa.array(several, pa.string()))
    assert ids.to_pylist() == [library.encode(text) for text in several]
    assert decoded.to_pylist() == [library.decode(library.encode(text)) for text in several]


def test_slices_of_bytes():
    texts = ["x" * n for n in (0, 3, 50, 1, 1, 1, 9, 10, 11, 0, 0)]
    batch = pa.RecordBatch.from_pydict({"t": texts})
    slices = [s.column("t").to_pylist() for s in sentencepieces.slices_of_bytes(batch, "t", 10)]
    assert [text for s in slices for text in s] == texts
    assert all(sum(map(len, s)) <= 10 or len(s) == 1 or sum(map(len, s[:-1])) <= 10 for s in slices) and len(slices) > 4


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, " " * 500 + "x", "日本" * 4_000, "\n" * 3_000, "=" * 7_777, "12" * 5_000])
def test_long_words(machine, library, text):
    assert count(text, UnitCounts(machine)) == len(library.encode(text))
    assert encoded(machine, text)[0] == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(
    text=st.text("aeinostr▁é日!=", min_size=1, max_size=60) | st.text(min_size=1, max_size=20),
    size=st.integers(1, 12),
    look_back=st.integers(0, 5),
)
def test_chunk_maps_compose(machine, text, size, look_back):
    """Wherever a text is cut, and whatever states are thought likely, each prefix has the map of its whole."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "LOOK_BACK", look_back)
        scanned = prefixes(chunk_maps(machine, text, size))
    assert len(scanned) == -(-len(text) // size)
    for k, prefix in enumerate(scanned):
        assert prefix[bpe.START] == ChunkMap(machine, text[: (k + 1) * size])[bpe.START]


def test_composing_is_associative(machine):
    a, b, c = (ChunkMap(machine, text) for text in ("▁inter", "nation", "alize"))
    for before in ("▁", "▁an", "▁un", "日"):
        state = ChunkMap(machine, before)[bpe.START][0]
        assert Composed(Composed(a, b), c)[state] == Composed(a, Composed(b, c))[state]


def test_depth_of_the_scan(machine):
    """A word of 4,000 chunks is no recursion of 4,000 levels, and few chunks are read for a second state."""
    read = []

    class Counted(ChunkMap):
        def _run(self, text, state):
            read.append(len(text))
            return super()._run(text, state)

    text = "".join(chr(97 + k * k % 26) for k in range(40_000))
    maps = [Counted(machine, text[at : at + 10], text[max(at - 64, 0) : at]) for at in range(0, len(text), 10)]
    assert prefixes(maps)[-1][bpe.START] == ChunkMap(machine, text)[bpe.START]
    assert sum(size == 10 for size in read) < 1.2 * len(maps)


def test_a_small_bound_changes_no_result(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "MAX_TRANSITIONS", 30)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 10)
    monkeypatch.setattr(token_counts, "MAX_UNITS", 2)
    monkeypatch.setattr(sentencepieces, "_BLOCK", 3)
    machine = bpe.MergeAutomaton(model)
    text = "Several words, which do not fit; several words in a row\nand some more of them. " * 3
    assert count(text, UnitCounts(machine)) == len(library.encode(text))
    assert encoded(machine, text)[0] == library.encode(text)


def test_odd_rows(spark, odd, nothing, library):
    path = tokenizer_file(PIECES)
    want = sorted((len((row["text"] or "").encode()), len(library.encode(row["text"] or ""))) for row in odd.collect())
    rows = count_tokens(odd, path, 100).collect()
    assert sorted((row["n_bytes"], row["n_tokens"]) for row in rows) == want
    assert all(row["over_limit"] == (row["n_tokens"] > 100) for row in rows)
    made = encode_and_decode(odd, path).collect()
    assert sorted((len(row["decoded"].encode()), len(row["ids"])) for row in made) == want
    assert count_tokens(nothing, path, 1).count() == encode_and_decode(nothing, path).count() == 0


def test_queries_on_the_smallest_tables(spark, small, library):
    texts = {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{small}/documents.parquet").collect()}
    counts = {row["doc_id"]: row for row in op6_token_counts(spark, small).collect()}
    made = {row["doc_id"]: row for row in op7_sentencepieces(spark, small).collect()}
    assert counts.keys() == made.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode(text)
        row = counts[doc_id]
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), len(ids), len(ids) > 4096)
        row = made[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize(
    ("part", "said"),
    [
        (b"\x12\x02\x18\x01", "type BPE"),
        (b"\x1a\x03\x12\x01x", "rules"),
        (b"\x1a\x02\x18\x00", "dummy prefix"),
        (b"\x1a\x02\x20\x01", "white space"),
    ],
)
def test_models_of_another_kind_are_refused(part, said):
    from tripmill.llm.bpe import MergeAutomaton
    from tripmill.llm.queries import PIECES, tokenizer_file

    with open(tokenizer_file(PIECES), "rb") as file:
        model = file.read()
    # A later part is what counts, as when messages are joined; what it leaves out is put as the model has it.
    kept = b"\x12\x02\x18\x02\x1a\x04\x18\x01\x20\x00"
    MergeAutomaton(model + kept)
    with pytest.raises(ValueError, match=said):
        MergeAutomaton(model + kept + part)
