import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[1]))

import corpus_pipeline
from compare import assert_same, oracle_frame
from test_decontamination import words
from test_near_dedup import bag, jaccard

from tripmill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, small, name):
    assert_same(QUERIES[name](spark, small), oracle_frame(small, ORACLES[name]))


def test_stages(spark, small):
    """Each stage by itself: columns stay, what goes must go, and what stays must stay."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [words(text) for (text,) in duckdb.sql(f"SELECT text FROM '{small}/benchmark.parquet'").fetchall()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepieces"]
    before = {row["doc_id"]: row["text"] for row in docs.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, small)
        assert out.columns == docs.columns
        after = {row["doc_id"]: row["text"] for row in out.collect()}
        gone = {i: text for i, text in before.items() if i not in after}
        assert all(before[i] == text for i, text in after.items())
        if name == "exact_dedup":
            assert len(set(after.values())) == len(after) and set(after.values()) == set(before.values())
        elif name == "near_dedup":
            bags = {i: bag(text) for i, text in before.items()}
            kept = sorted(after)
            assert not any(jaccard(bags[a], bags[b]) >= 0.8 for k, a in enumerate(kept) for b in kept[:k])
        elif name == "decontamination":
            def hit(text):
                w = words(text)
                return any(tuple(w[i : i + 10]) in windows for i in range(len(w)))

            assert all(hit(text) for text in gone.values()) and not any(hit(text) for text in after.values())
        docs, before = out, after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert sorted(row["doc_id"] for row in last.collect()) == sorted(before)
    assert sorted(row["doc_id"] for row in corpus_pipeline.run(spark, small).collect()) == sorted(before)


ODD = [
    (1, None, "en"), (2, "", None), (None, "one two three", "x"), (None, None, "x"), (3, "same text here", "a"),
    (3, "same text here", "a"), (4, "same text here", "b"), (5, " \n\t !!! ", "c"), (6, "word " * 40_000, "d"),
]


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "nothing"])
def test_stages_on_odd_rows_and_clashing_names(spark, small, rows):
    """Nulls, empty and long texts, repeated rows, an empty table, and columns with names that stages use themselves."""
    names = ["row_toxic", "row_text", "row_id", "text_key", "hit_id", "hit_key", "hit_spans", "node", "run", "toxic", "p_text", "no_text"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.select("*", *(F.lit(7).alias(name) for name in names))
    left = {row["text"] or "" for row in docs.collect()}
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", *names]
        got = docs.collect()
        # None of these texts is toxic, near another one, or in the benchmark.
        assert {row["text"] or "" for row in got} == left and all(row["node"] == 7 for row in got)
    assert docs.count() == len(left)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == len(left)
