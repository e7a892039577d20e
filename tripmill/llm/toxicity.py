"""Toxicity by multiple-instance learning.

A text is a bag of sentences. Each sentence has a score, the logistic function of the weights of its words and of
the words' four-byte pieces, and the text's score is the noisy-or of its sentences: one minus the product of what
each leaves over. Only the text's label is known in training; the likelihood of the labels, derived through the
noisy-or, decides which sentences carry it. Afterwards the sentence scores locate what is offending. A sentence
without a feature that has a weight is left out of the noisy-or; what no sentence explains in training is a background
that each text has once. Sentences below 0.5 never make 0.5 together, so a text's length alone does not make it toxic:
what they add ends just below it. Training and scoring share this one formula (:func:`evidence`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm import textscan
from tripmill.llm.common import importable, whole_text
from tripmill.scratch import new_folder, stage

# The model is fitted on at most so many labelled rows, those with the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000
# Features that may have a weight: those that tell the labels apart best.
MAX_FEATURES = 4_096
# A feature must be in so many texts of the label.
_LEAST_TEXTS = 3
_BITS = 20
# Words and pieces have a half of the features each.
_FEATURES = 2 << _BITS
_PIECE = 4
# Half of the likelihood ratio statistic: among a million features that mean nothing, a few pass by chance.
_LEAST_RATIO = 9.0
# Weights are whole numbers of this part, so that sums do not depend on their order.
_UNIT = 1 << 24
_PENALTY = 2e-5
# Sentences below 0.5 add to a score up to just below it.
_MOST_MILD = 0.999 * np.log(2)
_SENTENCE_ENDS = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


def held_out(id_col: str | Column) -> Column:
    """Whether a row's label is never learned from: one in five by the checksum of its id."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Weights of the features, in parts of ``_UNIT``, of every sentence that has some, and of every text."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    background: float = -np.inf

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(_FEATURES, np.int64)
        whole[self.features] = self.weights
        return whole[: 1 << _BITS], whole[1 << _BITS :]


def _pieces(data: np.ndarray) -> np.ndarray:
    """The feature, within its half, of the four bytes that begin at each place."""
    if len(data) < _PIECE:
        return np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    value = wide[:-3] << np.uint32(24) | wide[1:-2] << np.uint32(16) | wide[2:-1] << np.uint32(8) | wide[3:]
    return ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)).astype(np.int64)


def _word_features(words: textscan.Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - _BITS)).astype(np.int64)


def _sentences(words: textscan.Words, raw: np.ndarray) -> np.ndarray:
    """Where in the words each sentence begins."""
    ended = np.concatenate([[0], np.cumsum(_SENTENCE_ENDS[raw])])[words.starts]
    new = np.ones(len(ended), bool)
    new[1:] = (ended[1:] != ended[:-1]) | (words.texts[1:] != words.texts[:-1])
    return np.flatnonzero(new)


def _scans(texts: pa.Array) -> Iterator[tuple[textscan.Words, np.ndarray]]:
    whole, ends = textscan.raw_bytes(texts)
    for words in textscan.scan(texts):
        yield words, whole[ends[words.first] : ends[words.last]]


def _piece_places(words: textscan.Words) -> tuple[np.ndarray, np.ndarray]:
    """Each place at which a piece inside a word begins, and the word."""
    counts = np.maximum(0, words.ends - words.starts - _PIECE + 1)
    word = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(len(word)) - first[word] + words.starts[word], word


def _unique_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature), each pair once."""
    for words, _ in _scans(texts):
        places, word = _piece_places(words)
        feature = np.concatenate([_word_features(words), _pieces(words.data)[places] + (1 << _BITS)])
        text = np.concatenate([words.texts, words.texts[word]])
        pairs = np.unique(text * _FEATURES + feature)
        yield pairs // _FEATURES + words.first, pairs % _FEATURES


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, texts of label 1, texts of label 0)."""
    for batch in batches:
        toxic = np.array(batch.column("row_toxic").to_pylist(), bool)
        counts = np.zeros((2, _FEATURES), np.int32)
        for text, feature in _unique_features(batch.column("row_text")):
            for label in (0, 1):
                counts[label] += np.bincount(feature[toxic[text] == label], minlength=_FEATURES).astype(np.int32)
        seen = np.flatnonzero(counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(counts[1][seen].astype(np.int64)), pa.array(counts[0][seen].astype(np.int64))],
            names=["feature", "ones", "zeros"],
        )


def _bags(features: np.ndarray):
    """From texts to their number of sentences and the chosen features of each sentence."""
    place = np.full(_FEATURES, -1, np.int32)
    place[features] = np.arange(len(features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            total, sentence, chosen = np.zeros(count, np.int64), [[] for _ in range(count)], [[] for _ in range(count)]
            for words, raw in _scans(batch.column("row_text")):
                begins = _sentences(words, raw)
                of_word = np.searchsorted(begins, np.arange(len(words.starts)), side="right") - 1
                places, word = _piece_places(words)
                found = np.concatenate([place[_word_features(words)], place[_pieces(words.data)[places] + (1 << _BITS)]])
                at = np.concatenate([of_word, of_word[word]])
                text = words.texts[begins]
                np.add.at(total, text + words.first, 1)
                first = np.searchsorted(text, np.arange(words.last - words.first))
                for k in np.flatnonzero(found >= 0):
                    owner = text[at[k]]
                    sentence[owner + words.first].append(int(at[k] - first[owner]))
                    chosen[owner + words.first].append(int(found[k]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_toxic").cast(pa.int32()),
                    pa.array(total),
                    pa.array(sentence, pa.list_(pa.int32())),
                    pa.array(chosen, pa.list_(pa.int32())),
                ],
                names=["toxic", "sentences", "sentence", "feature"],
            )

    return run


def _screen(counts: DataFrame, ones: int, zeros: int) -> np.ndarray:
    """The features whose share of texts differs most between the labels, by the likelihood ratio."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("ones").cast("double"), F.col("zeros").cast("double")
    share = (a + b) / F.lit(float(ones + zeros))
    ratio = (
        part(a, share * ones) + part(b, share * zeros)
        + part(ones - a, (1 - share) * ones) + part(zeros - b, (1 - share) * zeros)
    )
    counts = counts.groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    # More in texts of label 1 than by chance, and that at one in some thousands.
    counts = counts.filter((F.col("ones") >= _LEAST_TEXTS) & (a / ones > b / zeros)).withColumn("ratio", ratio)
    best = counts.filter(F.col("ratio") > _LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES)
    return np.sort(np.array([row["feature"] for row in best.collect()], np.int64))


def evidence(
    z: np.ndarray, owner: np.ndarray, spoken: np.ndarray, background: float
) -> tuple[np.ndarray, np.ndarray]:
    """Minus the logarithm of what is left over in each text, whose score is one minus what is left over; and whether its
    mild sentences are at their bound.

    ``z`` are the logits of sentences, ``owner`` their texts; ``spoken`` says which texts have any sentence. A sentence
    of 0.5 or more counts in full. The others count together, with the background, up to just below 0.5.
    """
    part, strong = np.logaddexp(0, z), z >= 0
    full = np.bincount(owner, np.where(strong, part, 0), minlength=len(spoken))
    mild = np.bincount(owner, np.where(strong, 0, part), minlength=len(spoken))
    once = np.logaddexp(0, background)
    most = max(0, _MOST_MILD - once)
    return full + np.minimum(mild, most) + np.where(spoken, once, 0), mild > most


def _slopes(
    label: np.ndarray, z: np.ndarray, owner: np.ndarray, spoken: np.ndarray, background: float
) -> tuple[float, np.ndarray, float]:
    """The loss (minus the mean log likelihood of the labels), and its slopes by each ``z`` and by the background."""
    left, bound = evidence(z, owner, spoken, background)
    left = np.maximum(left, 1e-9)
    loss = np.where(label, -np.log(-np.expm1(-left)), left).mean()
    slope = np.where(label, -1 / np.expm1(left), 1.0) / len(label)
    # At the bound neither a mild sentence nor the background changes anything.
    by_sentence = slope[owner] / (1 + np.exp(-z)) * ((z >= 0) | ~bound[owner])
    by_background = (slope * spoken * ~bound).sum() / (1 + np.exp(-background))
    return loss, by_sentence, by_background


def _fit(toxic: np.ndarray, bags: list[tuple[int, np.ndarray, np.ndarray]], features: int, rounds: int = 400) -> tuple[np.ndarray, float, float]:
    """Weights, bias and background by full gradient steps (Adam) on the likelihood of the labels, with a penalty on weights."""
    # Sentences without a chosen feature are left out; a text that has any sentence has the background once.
    owner, row, column, spoken = [], [], [], np.zeros(len(bags), bool)
    count = 0
    for text, (total, sentence, feature) in enumerate(bags):
        kinds, place = np.unique(sentence, return_inverse=True)
        spoken[text] = total > 0
        owner.append(np.full(len(kinds), text))
        row.append(place + count)
        column.append(feature)
        count += len(kinds)
    owner, row, column = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (owner, row, column))
    weights, bias, background = np.zeros(features), -4.0, -4.0
    moments = np.zeros((2, features + 2))
    label = toxic.astype(bool)
    for step in range(1, rounds + 1):
        z = np.bincount(row, weights[column], minlength=count) + bias
        _, by_sentence, by_background = _slopes(label, z, owner, spoken, background)
        gradient = np.bincount(column, by_sentence[row], minlength=features) + _PENALTY * weights
        gradient = np.append(gradient, [by_sentence.sum(), by_background])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-9)
        weights -= move[:-2]
        bias -= move[-2]
        background -= move[-1]
    return weights, float(bias), float(background)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Fit the model on at most ``MAX_TRAINING_ROWS`` labelled rows that are not held out.

    Labels that are NULL are left out; of several for one id the largest counts; labels without a document have no
    effect. With one class only, or no label, every text has that class's score (0 if there is none).
    """
    spark = docs.sparkSession
    importable(spark)
    given = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    given = given.groupBy(F.col(id_col).alias("label_id")).agg((F.max(label_col) > 0).alias("row_toxic"))
    chosen = given.orderBy(F.xxhash64("label_id"), "label_id").limit(MAX_TRAINING_ROWS)
    # The chosen labels are bounded, so the documents need not move.
    given_texts = docs.select(F.col(id_col).alias("text_id"), whole_text(text_col).alias("row_text"))
    texts = given_texts.join(F.broadcast(chosen), F.col("text_id") == F.col("label_id"))
    texts = stage(texts.select("row_text", "row_toxic"), new_folder(spark, "training"))
    sizes = texts.agg(F.count_if("row_toxic").alias("ones"), F.count_if(~F.col("row_toxic")).alias("zeros")).first()
    ones, zeros = sizes["ones"], sizes["zeros"]
    if not ones or not zeros:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.int64), np.inf if ones else -np.inf)
    counts = texts.mapInArrow(_count_texts, "feature int, ones long, zeros long")
    features = _screen(counts, ones, zeros)
    bags = texts.mapInArrow(_bags(features), "toxic int, sentences long, sentence array<int>, feature array<int>").toPandas()
    bags = bags.assign(key=bags["feature"].map(tuple)).sort_values(["toxic", "sentences", "key"], ignore_index=True)
    rows = [(r.sentences, np.asarray(r.sentence, np.int64), np.asarray(r.feature, np.int64)) for r in bags.itertuples()]
    weights, bias, background = _fit(bags["toxic"].to_numpy(), rows, len(features))
    return Model(features, np.round(weights * _UNIT).astype(np.int64), bias, background)


class _Scorer:
    def __init__(self, model: Model) -> None:
        self.of_word, self.of_piece = model.tables()
        self.bias = model.bias
        self.background = model.background

    def scans(self, texts: pa.Array) -> Iterator[tuple[textscan.Words, np.ndarray, np.ndarray]]:
        """The words, where each sentence begins among them, and the logit of each sentence."""
        for words, raw in _scans(texts):
            begins = _sentences(words, raw)
            if not len(begins):
                yield words, begins, np.zeros(0)
                continue
            sums = np.zeros(len(words.data) + 1, np.int64)
            pieces = self.of_piece[_pieces(words.data)]
            np.cumsum(pieces, out=sums[1 : len(pieces) + 1])
            stop = np.maximum(words.starts, words.ends - _PIECE + 1)
            score = self.of_word[_word_features(words)] + sums[stop] - sums[words.starts]
            sums = np.add.reduceat(score, begins)
            # Without a weight there is nothing to tell, but with labels of one class there are no weights at all.
            silent = (sums == 0) & np.isfinite(self.bias)
            yield words, begins, np.where(silent, -np.inf, sums / _UNIT + self.bias)

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.bias == np.inf:
            return np.ones(len(texts))
        left = np.zeros(len(texts))
        for words, begins, z in self.scans(texts):
            # Sentences are summed in the order of their text.
            owner = words.texts[begins]
            spoken = np.zeros(words.last - words.first, bool)
            spoken[owner] = True
            left[words.first : words.last] = evidence(z, owner, spoken, self.background)[0]
        return -np.expm1(-left)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5 on), in columns of those names.

    Columns of ``docs`` with these names are replaced. Only the text is looked at: equal texts have equal scores.
    NULL counts as empty. A text without words has no sentence, and so the score 0 (1 if every label was 1). A text
    reaches 0.5 only by a sentence that does so itself, unless most texts that no sentence explains were toxic.
    Repeated rows, NULL ids and an empty table need no special care.
    """
    importable(docs.sparkSession)
    kept = [name for name in docs.columns if name not in ("score", "predicted")]
    rows = docs.select(*(F.col(name).alias(f"k_{name}") for name in kept), whole_text(text_col).alias("row_text"))
    fields = [T.StructField(name, rows.schema[f"k_{name}"].dataType) for name in kept]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            found = scorer.score(batch.column("row_text"))
            columns = [batch.column(f"k_{name}") for name in kept]
            columns += [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def offending_sentences(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sentences of ``docs`` that score 0.5 or more: id, ``start`` and ``length`` in characters, ``sentence``, ``score``.

    A sentence goes from its first word's first character to its last word's last. Rules as in :func:`score`.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("row_id"), whole_text(text_col).alias("row_text"))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("sentence", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            ids, texts, found = batch.column("row_id"), batch.column("row_text"), []
            whole, ends = textscan.raw_bytes(texts)
            for words, begins, z in scorer.scans(texts):
                stops = np.append(begins[1:], len(words.starts)) - 1
                for k in np.flatnonzero(z >= 0):
                    text = words.first + int(words.texts[begins[k]])
                    base = int(ends[words.first])
                    first, last = base + int(words.starts[begins[k]]), base + int(words.ends[stops[k]])
                    before = whole[int(ends[text]) : first].tobytes().decode()
                    said = whole[first:last].tobytes().decode()
                    found.append((ids[text].as_py(), len(before), len(said), said, float(1 / (1 + np.exp(-z[k])))))
            columns = zip(*found) if found else ([] for _ in arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)
