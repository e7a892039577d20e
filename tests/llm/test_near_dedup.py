import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import near_dedup, textscan
from tripmill.llm.near_dedup import bags, components, drop_near_copies, find_near_copies, signatures, similarities
from tripmill.llm.queries import op8_near_dedup


def bag(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def classes(rows, least=0.8):
    """The smallest id of each row's class, all pairs compared."""
    own = {i: bag(text) for i, text in rows}
    texts = {i: text or "" for i, text in rows}
    parent = {i: i for i in own}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(own)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if texts[a] == texts[b] or jaccard(own[a], own[b]) >= least:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


words = st.lists(st.sampled_from("a B c. d é 1 a_b -".split()), max_size=12).map(" ".join)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=5))
def test_similarities_of_bags(pairs):
    got = similarities(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    assert got.tolist() == pytest.approx([jaccard(bag(a), bag(b)) for a, b in pairs])


def test_registers_agree_as_often_as_bags_overlap():
    """Over many registers the share of equal points is the weighted Jaccard similarity, for any weights."""
    rng = np.random.default_rng(1)
    for most in (1, 3, 40):
        for _ in range(4):
            a, b = rng.integers(0, most + 1, (2, 60))
            owner = np.repeat([0, 1], 60)
            made = textscan.mix(np.tile(np.arange(60, dtype=np.uint64), 2))
            weight = np.concatenate([a, b])
            there = weight > 0
            times = signatures(owner[there], made[there], weight[there], 2, 6000)
            want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
            assert abs((times[0] == times[1]).mean() - want) < 0.03


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "b", "c", "d", "e"], rng.integers(0, 60))) for _ in range(40)]
    whole = {}
    for words_ in textscan.scan(pa.array(texts)):
        whole = signatures(*bags(words_), words_.last - words_.first, 96)
    for i, text in enumerate(texts):
        for words_ in textscan.scan(pa.array([text])):
            assert np.array_equal(signatures(*bags(words_), 1, 96)[0], whole[i])


def family(size, edits, seed, length=120):
    """Texts made from one by replacing single words."""
    rng = np.random.default_rng(seed)
    base = [f"s{seed}w{k}" for k in range(length)]
    out = []
    for _ in range(size):
        text = list(base)
        for k in rng.choice(length, rng.integers(0, edits + 1), replace=False):
            text[k] = f"e{rng.integers(10**9)}"
        out.append(" ".join(text))
    return out


def test_same_classes_as_brute_force(spark):
    texts = family(12, 1, 1) + family(12, 4, 2) + family(15, 8, 3) + [f"alone {k} is k{k} and r{k * 7}" for k in range(10)]
    texts += ["short", "short", "Short!", "", None, "a b c", "a  b  c"]
    rows = [(100 - i, text) for i, text in enumerate(texts)]
    got = find_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = classes(rows)
    assert {row["doc_id"]: row["class_id"] for row in got} == want
    assert all(row["kept"] == (row["doc_id"] == row["class_id"]) for row in got)
    sizes = Counter(want.values())
    assert all(row["class_size"] == sizes[row["class_id"]] for row in got)


def test_leaders_that_do_not_link_lose_no_link(spark, monkeypatch):
    """With one band for all texts every bucket is mixed, and links inside it must still be found."""

    def one_bucket(batches):
        for batch in batches:
            bands = pa.array([[7]] * batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("row_id"), bands], names=["node", "row_id", "bands"])

    monkeypatch.setattr(near_dedup, "_bands", one_bucket)
    monkeypatch.setattr(near_dedup, "_BLOCK", 5)
    texts = family(6, 1, 1) + family(6, 1, 2) + family(9, 6, 3)
    rows = list(enumerate(texts))
    got = find_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {row["doc_id"]: row["class_id"] for row in got} == classes(rows)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)).filter(lambda e: e[0] != e[1]), min_size=1, max_size=40))
def test_components(spark, edges):
    parent = list(range(31))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {bytes(row["node"])[0]: bytes(row["root"])[0] for row in components(df).collect()}
    assert got == {i: top(i) for edge in edges for i in edge}


def test_a_long_chain_is_one_component(spark):
    df = spark.createDataFrame([(i.to_bytes(2), (i + 1).to_bytes(2)) for i in range(300)], "a binary, b binary")
    assert {bytes(row["root"]) for row in components(df).collect()} == {(0).to_bytes(2)}


def test_odd_rows(odd, nothing):
    rows = find_near_copies(odd).collect()
    assert len(rows) == odd.count()
    of = {row["doc_id"]: row for row in rows if row["doc_id"] is not None}
    assert of[1]["class_id"] == of[2]["class_id"] == 1 and of[1]["class_size"] == 3
    assert of[3]["class_id"] == of[4]["class_id"] == 3 and of[3]["class_size"] == 3
    assert of[5]["class_size"] == 1
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((row["doc_id"] or -1) for row in kept.collect()) == [-1, 1, 3, 3, 5, 6, 7]
    assert find_near_copies(nothing).count() == drop_near_copies(nothing).count() == 0


def test_query_on_the_smallest_tables(spark, small):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert {row["doc_id"]: row["class_id"] for row in op8_near_dedup(spark, small).collect()} == classes(rows)
