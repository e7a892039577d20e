import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmill.llm import toxicity
from tripmill.llm.queries import op5_toxicity
from tripmill.llm.toxicity import Model, held_out, offending_sentences, score, train


def corpus(count, seed=0):
    """Texts of which some hold one bad sentence; only the text is labelled."""
    rng = np.random.default_rng(seed)
    plain = [f"word{k}" for k in range(400)]
    rows = []
    for i in range(count):
        sentences = [" ".join(rng.choice(plain, rng.integers(3, 9))) for _ in range(rng.integers(1, 12))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            sentences[rng.integers(len(sentences))] += f" you {rng.choice(['vileness', 'vilely', 'rotter'])}"
        rows.append((i, ". ".join(sentences) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return rows, docs, labels, train(docs, labels)


def test_held_out_accuracy(fitted):
    rows, docs, _, model = fitted
    predicted = {row["doc_id"]: row["predicted"] for row in score(docs, model).collect()}
    kept = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([predicted[i] == y for i, y in kept]) > 0.97


def test_offending_sentences_are_located(fitted):
    rows, docs, _, model = fitted
    texts = {i: t for i, t, _ in rows}
    found = offending_sentences(docs, model).collect()
    assert len(found) > 150
    for row in found:
        assert texts[row["doc_id"]][row["start"] : row["start"] + row["length"]] == row["sentence"]
    assert np.mean([any(w in row["sentence"] for w in ("vile", "rotter")) for row in found]) > 0.98


def test_positions_are_characters(spark, fitted):
    _, _, _, model = fitted
    docs = spark.createDataFrame([(1, "Éé 日本 😀. Ün you rotter vilely!")], "doc_id long, text string")
    row = offending_sentences(docs, model).first()
    assert row["sentence"] == "Ün you rotter vilely"
    assert (row["start"], row["length"]) == (9, 20)


def test_held_out_labels_are_never_learned(spark, fitted):
    rows, docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = train(docs, turned)
    assert again.bias == model.bias and np.array_equal(again.weights, model.weights)


def test_only_the_text_counts(fitted):
    _, docs, _, model = fitted
    other = docs.withColumns({"doc_id": F.col("doc_id") + 1000, "lang": F.lit("xx"), "score": F.lit("old")})
    one = sorted(row["score"] for row in score(docs, model).collect())
    assert one == sorted(row["score"] for row in score(other, model).collect())


def test_noisy_or(spark, fitted):
    """The text's score is one minus the product of what its sentences leave over."""
    _, _, _, model = fitted
    texts = ["you rotter word1", "word2 word3", "you rotter word1. word2 word3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, b, both = (row["score"] for row in score(docs, model).orderBy("doc_id").collect())
    assert both == pytest.approx(1 - (1 - a) * (1 - b))


def test_many_sentences_by_the_formula(fitted):
    """Sentence by sentence: those of 0.5 or more in full, the others with the background up to just below 0.5."""
    rows, _, _, model = fitted
    clean = [text for _, text, toxic in rows if not toxic]
    texts = ["", " ".join(clean[:40]), " ".join(clean) * 3, " ".join(clean) + " You rotter. Vilely you. vileness, you rotter!"]
    texts += [text for _, text, _ in rows[:50]]
    scorer = toxicity._Scorer(model)
    got = scorer.score(pa.array(texts))
    logits = [[] for _ in texts]
    for words, begins, z in scorer.scans(pa.array(texts)):
        for owner, value in zip(words.texts[begins], z):
            logits[words.first + owner].append(value)
    for one, zs in zip(got, logits):
        strong = [math.log1p(math.exp(z)) for z in zs if z >= 0]
        mild = [math.log1p(math.exp(z)) for z in zs if z < 0] + [math.log1p(math.exp(model.background))] * bool(zs)
        assert one == pytest.approx(1 - math.exp(-sum(strong) - min(sum(mild), 0.999 * math.log(2))), abs=1e-9)


def test_training_follows_the_formula_of_the_score():
    """The slopes used in training are those of the loss of the scores, also where mild sentences are at their bound."""
    chance = np.random.default_rng(3)
    owner = np.sort(chance.integers(0, 30, 400))
    owner = np.concatenate([owner, np.full(300, 29)])
    z, label, spoken = chance.normal(-2, 2, 700), chance.random(30) < 0.4, np.ones(30, bool)
    loss, by_sentence, by_background = toxicity._slopes(label, z, owner, spoken, -3.0)
    left = toxicity.evidence(z, owner, spoken, -3.0)[0]
    # The score is one minus exp(-left).
    assert loss == pytest.approx(-np.mean(np.where(label, np.log(-np.expm1(-left)), -left)))
    assert toxicity.evidence(z, owner, spoken, -3.0)[1][29]
    step = 1e-6
    for k in [0, 5, 100, 399, 400, 650, 699]:
        moved = z.copy()
        moved[k] += step
        assert (toxicity._slopes(label, moved, owner, spoken, -3.0)[0] - loss) / step == pytest.approx(by_sentence[k], abs=1e-5)
    assert (toxicity._slopes(label, z, owner, spoken, -3.0 + step)[0] - loss) / step == pytest.approx(by_background, abs=1e-5)


def test_names_that_clash(fitted):
    _, docs, labels, model = fitted
    names = ["row_toxic", "row_text", "label_id", "text_id", "toxic", "k_text", "score", "predicted", "sentences"]
    other = docs.withColumns({name: F.lit(1) for name in names})
    assert np.array_equal(train(other, labels.withColumn("text", F.lit("x"))).weights, model.weights)
    one, two = (sorted(row["score"] for row in score(df, model).collect()) for df in (docs, other))
    assert one == two


def test_clean_texts_of_any_length_stay_clean(spark, fitted):
    """Length alone is not toxic: neither unknown sentences nor those of the clean training texts, many times over."""
    rows, _, _, model = fitted
    clean = " ".join(text for _, text, toxic in rows if not toxic)
    texts = ["alpha beta gamma. ", "alpha beta gamma. " * 200_000, clean, clean * 200, clean * 200 + " You rotter vilely."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = score(docs, model).orderBy("doc_id").collect()
    assert [row["predicted"] for row in got] == [0, 0, 0, 0, 1]
    assert got[0]["score"] == got[1]["score"]


def test_sentences_of_the_tables_many_times_over_stay_clean(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = train(docs, labels)
    calm = score(docs, model).filter("predicted = 0")
    long = calm.agg(F.array_join(F.collect_list("text"), "\n").alias("text")).select(F.lit(1).alias("doc_id"), F.repeat("text", 20).alias("text"))
    assert score(long, model).first()["predicted"] == 0


def test_odd_rows(odd, nothing, fitted):
    _, _, _, model = fitted
    rows = score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= row["score"] <= 1 for row in rows)
    assert {row["score"] for row in rows if not (row["text"] or "").strip(" \n\t!")} == {0.0}
    assert score(nothing, model).count() == offending_sentences(nothing, model).count() == 0


@pytest.mark.parametrize(("labels", "expected"), [([], 0.0), ([(1, None)], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0)])
def test_labels_of_one_class(spark, labels, expected):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (6, "")], "doc_id long, text string")
    model = train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert isinstance(model, Model)
    assert {row["score"] for row in score(docs, model).collect()} == {expected}


def test_query(spark, small):
    rows = op5_toxicity(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.5)


def test_accuracy_on_the_tables(spark):
    tables = "/root/testdata/sf0.1"
    scored = op5_toxicity(spark, tables).filter("held_out")
    rows = scored.join(spark.read.parquet(f"{tables}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").collect()
    right = np.mean([row["predicted"] == row["toxic"] for row in rows])
    ones, zeros = ([row["score"] for row in rows if row["toxic"] == label] for label in (1, 0))
    area = np.mean([[(a > b) + 0.5 * (a == b) for b in zeros] for a in ones])
    assert right > 0.95 and area > 0.95
