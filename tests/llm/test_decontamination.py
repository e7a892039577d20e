import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import decontamination
from tripmill.llm.decontamination import decontaminate, find_contamination


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window):
    sets = [(str(i), words(text)) for i, text in items]
    sets = [(i, w, min(len(w), window)) for i, w in sets if w]
    out = []
    for doc_id, text in docs:
        own, hit, seen = words(text), set(), set()
        for item, w, n in sets:
            parts = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in parts:
                    hit.update(range(k, k + n))
                    seen.add(item)
        digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(seen), digest, bool(hit)))
    return sorted(out)


text = st.lists(st.sampled_from(["a", "B", "é", "c.", "d_", "É", "9", "Σ"]), max_size=14).map(" ".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(text, max_size=8), st.lists(text, max_size=5), st.integers(2, 4))
def test_same_as_brute_force(spark, texts, item_texts, window):
    docs, items = list(enumerate(texts)), [(10 - i, t) for i, t in enumerate(item_texts)]
    found = find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=window,
    )
    assert sorted(tuple(row)[:6] for row in found.collect()) == brute(docs, items, window)


def test_a_set_too_large_to_broadcast_gives_the_same(spark, monkeypatch):
    docs = [(i, f"x{i % 3} one two three four y{i}") for i in range(20)]
    items = [(1, "One two; three four five"), (2, "three four y7")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_WINDOWS", 0)
    found = find_contamination(*frames, window=4)
    assert sorted(tuple(row)[:6] for row in found.collect()) == brute(docs, items, 4)


def test_long_texts_without_a_broadcast(spark, monkeypatch):
    """A text of 20,000 words, hit all over, and items of several lengths: the words do not go with their windows."""
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_WINDOWS", 0)
    long = " ".join(f"w{i % 977}" for i in range(20_000))
    docs = [(1, long), (2, long + " and more"), (3, "w1 w2"), (4, None), (5, "x " * 20_000)]
    items = [(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (2, "w1 w2"), (3, "w970 w971 w972")]
    items += [(4, " ".join(f"w{i}" for i in range(977)))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(*frames)
    assert sorted(tuple(row)[:6] for row in found.collect()) == brute(docs, items, 10)


@settings(max_examples=6, deadline=None)
@given(st.lists(text, max_size=8), st.lists(text, max_size=5), st.integers(2, 4))
def test_same_as_brute_force_without_a_broadcast(spark, texts, item_texts, window):
    before = decontamination.MAX_BROADCAST_WINDOWS
    decontamination.MAX_BROADCAST_WINDOWS = 0
    try:
        docs, items = list(enumerate(texts)), [(10 - i, t) for i, t in enumerate(item_texts)]
        frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        assert sorted(tuple(row)[:6] for row in find_contamination(*frames, window=window).collect()) == brute(docs, items, window)
    finally:
        decontamination.MAX_BROADCAST_WINDOWS = before


def test_names_that_clash(spark):
    names = "hit_id, hit_key, hit_spans, kept_text, items, at, spans, w, key, row_id, text_key, own_id"
    docs = spark.sql(f"SELECT 1L AS doc_id, 'Keep THE bad words' AS text, {', '.join(f'7 AS {n}' for n in names.split(', '))}")
    items = spark.createDataFrame([(1, "the bad words")], "item_id long, text string")
    cut = decontaminate(docs, items, remove="spans")
    assert cut.columns == docs.columns and cut.first()["text"] == "Keep " and cut.first()["hit_spans"] == 7
    assert decontaminate(docs, items).count() == 0 and find_contamination(docs, items).first()["n_hit"] == 3


def test_only_built_in_functions(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "benchmark"))
    plan = find_contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "Same TEXT here"), (2, None), (3, ""), (None, "two three"), (1, "Same TEXT here")], "item_id long, text string")
    rows = find_contamination(odd, items).collect()
    assert len(rows) == odd.count()
    by_id = {row["doc_id"]: row for row in rows if row["doc_id"] is not None}
    assert (by_id[3]["n_hit"], by_id[3]["n_items"]) == (3, 1)
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[5]["n_words"] == 0
    assert sorted((row["n_words"], row["n_hit"], row["n_items"]) for row in rows if row["doc_id"] is None) == [(0, 0, 0), (3, 2, 0)]
    assert find_contamination(nothing, items).count() == 0
    assert not find_contamination(odd, items.limit(0)).filter("contaminated").count()


def test_documents_or_spans_go(spark):
    docs = spark.createDataFrame([(1, "Keep, THE bad, words. here!", "x"), (2, "clean", "y"), (None, "the bad words", "z")], "doc_id long, text string, hit_id string")
    items = spark.createDataFrame([(1, "the bad words")], "item_id long, text string")
    assert [tuple(row) for row in decontaminate(docs, items).collect()] == [(2, "clean", "y")]
    cut = decontaminate(docs, items, remove="spans")
    assert cut.columns == docs.columns
    assert {row["hit_id"]: row["text"] for row in cut.collect()} == {"x": "Keep, here!", "y": "clean", "z": ""}
