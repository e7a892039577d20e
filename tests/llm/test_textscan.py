import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import textscan


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é.9_\n日😀", max_size=20), max_size=8), st.integers(1, 60))
def test_words_of_each_text(texts, size):
    found, seen = [[] for _ in texts], {}
    before = textscan.SLICE_BYTES
    textscan.SLICE_BYTES = size
    try:
        for words in textscan.scan(pa.array(texts, pa.string())):
            for start, end, hashed, text in zip(words.starts, words.ends, words.hashes, words.texts):
                word = bytes(words.data[start:end]).decode()
                found[words.first + text].append(word)
                assert seen.setdefault(word, hashed) == hashed
    finally:
        textscan.SLICE_BYTES = before
    lowered = ["".join(c.lower() if "A" <= c <= "Z" else c for c in text) for text in texts]
    assert found == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) for text in lowered]
    assert len(set(seen.values())) == len(seen)
