"""Toxicity by class-conditional Kneser-Ney models.

The models predict each character of a word (and its end) from the four bytes before it. Both
classes, toxic and ordinary, have counts of their own for these five-grams, taken from labelled
rows; what they have not seen they leave to one shared model, interpolated Kneser-Ney of orders 4
to 1 on the continuation counts of the whole corpus. An expression that is rare in both classes
thus gets the same probability from both and says nothing.

The log-likelihood ratio of the two models, normalised by length, is looked at over the whole text,
over its most toxic run of words and over its most toxic word; a logistic regression on other
labelled rows turns that into a score. Labels are used only where crc32(doc_id as text) mod 5 is
not 0; labels, lang, source and doc_id are no inputs of a score.

Corpus counts cover all documents. Class counts are fitted on FIT_ROWS labelled rows of each class
at most, and the regression on CALIBRATION_ROWS of each class at most, picked by a hash of the id;
this bounds the model that is sent to every task.

A null text is empty; a text without words gets the score of a text that says nothing. Labels of a
document that differ count as toxic; null labels and labels of unknown documents are left out.
Without labels of either class the score is a low constant. Rows repeated in full are scored
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm import words as W
from concord.llm.frames import picked, release_memory, sent, table, written

ORDER = 5
DISCOUNT = 0.75
END = 1
FIT_ROWS = 50_000
CALIBRATION_ROWS = 20_000
#: Words of a run, and the ratio from which a single word counts as an expression.
RUN = 6
CLEAR = 2.0
FEATURES = 4
#: Five-grams a task holds before it passes them on.
HELD = 1 << 18


def checksum(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    return checksum(doc_id) % 5 == 0


@dataclass
class Distinct:
    """The distinct words of a block: five-grams of all of them, and which word each occurrence is."""

    grams: np.ndarray
    owner: np.ndarray
    which: np.ndarray
    symbols: np.ndarray


def distinct_words(found: W.Words) -> Distinct:
    _, at, which = np.unique(found.hashes(), return_index=True, return_inverse=True)
    starts, lengths = found.starts[at], (found.ends - found.starts)[at]
    owner = np.repeat(np.arange(len(at)), lengths + 1)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    last = place == lengths[owner]
    symbols = W.LOWER[found.data[np.minimum(starts[owner] + place, len(found.data) - 1)]].astype(np.int64) if len(owner) else np.zeros(0, np.int64)
    symbols[last] = END
    grams = symbols.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(symbols)
        before[back:] = symbols[:-back]
        before[place < back] = 0
        grams |= before << (8 * back)
    return Distinct(grams, owner, which, lengths + 1)


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of (gram, toxic, plain) with equal grams added up."""
    rows = np.concatenate(parts, axis=1)
    grams, which = np.unique(rows[0], return_inverse=True)
    return np.stack([grams, *(np.bincount(which, weights=x, minlength=len(grams)).astype(np.int64) for x in rows[1:])])


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram, toxic, plain) of all texts of (text, label): occurrences in rows labelled 1 and 0."""

    def run(batches):
        release_memory()
        yield from counted(batches)
        release_memory()

    def counted(batches):
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            label = b["label"].fill_null(-1).to_numpy()
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                if not len(found.starts):
                    continue
                words = distinct_words(found)
                of_word = np.repeat(label[i:j], found.counts)
                counts = [np.bincount(words.which, weights=of_word == x, minlength=len(words.symbols)) for x in (1, 0)]
                held.append(_merged([np.stack([words.grams, *(c[words.owner].astype(np.int64) for c in counts)])]))
                size += held[-1].shape[1]
                if size > HELD:
                    held = [_merged(held)]
                    size = held[0].shape[1]
                    if size > HELD // 2:
                        yield from batches_of(held[0])
                        held, size = [], 0
        if held:
            yield from batches_of(_merged(held))

    def batches_of(rows):
        for k in range(0, rows.shape[1], 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 17)]) for x in rows], names=["gram", "toxic", "plain"])

    counts = labelled.select("text", "label").mapInArrow(run, "gram long, toxic long, plain long")
    return counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def _suffix(gram: str, order: int) -> Column:
    return F.col(gram).bitwiseAND((1 << (8 * order)) - 1)


def shared_model(grams: DataFrame) -> DataFrame:
    """(gram, p): the interpolated Kneser-Ney probability of order ORDER - 1, from distinct five-grams."""
    levels, finer = {}, grams
    for order in range(ORDER - 1, 0, -1):
        finer = finer.groupBy(_suffix("gram", order).alias("gram")).agg(F.count("*").alias("n"))
        levels[order] = finer
    total = levels[1].agg(F.sum("n")).first()[0] or 1
    model = levels[1].select("gram", (F.col("n") / F.lit(total)).alias("p"))
    for order in range(2, ORDER):
        context = Window.partitionBy(F.shiftright("gram", 8))
        counted = levels[order].select(
            "gram", "n", F.sum("n").over(context).alias("total"), F.count("*").over(context).alias("kinds"),
            _suffix("gram", order - 1).alias("rest"),
        )
        below = model.select(F.col("gram").alias("rest"), F.col("p").alias("below"))
        model = counted.join(below, "rest").select(
            "gram", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("total")).alias("p")
        )
    return model


def class_ratios(grams: DataFrame) -> DataFrame:
    """(gram, ratio, otherwise): log of toxic over ordinary probability, and that of unseen ends of its context."""
    seen = grams.where("toxic > 0 OR plain > 0").withColumn("rest", _suffix("gram", ORDER - 1))
    seen = seen.join(shared_model(grams).select(F.col("gram").alias("rest"), "p"), "rest")
    context = Window.partitionBy(F.shiftright("gram", 8))
    logs, left = [], []
    for c in ("toxic", "plain"):
        total, kinds = F.sum(c).over(context), F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).over(context)
        backoff = F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0)
        own = F.when(total > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / total).otherwise(0.0)
        logs.append(F.log(own + backoff * F.col("p")))
        left.append(F.log(backoff))
    return seen.select("gram", (logs[0] - logs[1]).alias("ratio"), (left[0] - left[1]).alias("otherwise"))


class Ratios:
    """The ratios as sorted arrays, to look grams up."""

    def __init__(self, gram: np.ndarray, ratio: np.ndarray, otherwise: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.ratio = gram[order], ratio[order]
        self.context, at = np.unique(self.gram >> 8, return_index=True)
        self.otherwise = otherwise[order][at]

    def of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.zeros(len(grams))
        at = np.minimum(np.searchsorted(self.gram, grams), len(self.gram) - 1)
        known = self.gram[at] == grams
        out = np.where(known, self.ratio[at], 0.0)
        rest = np.flatnonzero(~known)
        context = grams[rest] >> 8
        at = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        out[rest] = np.where(self.context[at] == context, self.otherwise[at], 0.0)
        return out


def features(column: pa.Array, ratios: Ratios) -> np.ndarray:
    """For each text: ratio a symbol, that of its best run, clear words' excess a word, its best word."""
    out = []
    for i, j, data, offsets in W.blocks(column):
        found = W.split(data, offsets)
        rows = np.zeros((j - i, FEATURES))
        counts, first = found.counts, found.first
        full = np.flatnonzero(counts)
        if len(full):
            words = distinct_words(found)
            of_word = np.bincount(words.owner, weights=ratios.of(words.grams), minlength=len(words.symbols))[words.which]
            symbols = words.symbols[words.which]
            sums, lengths = np.concatenate([[0], np.cumsum(of_word)]), np.concatenate([[0], np.cumsum(symbols)])
            stop = np.minimum(np.arange(len(of_word)) + RUN, np.repeat(first[1:], counts))
            start = np.maximum(stop - RUN, np.repeat(first[:-1], counts))
            heads = first[:-1][full]
            rows[full, 0] = (sums[first[1:]] - sums[first[:-1]])[full] / (lengths[first[1:]] - lengths[first[:-1]])[full]
            rows[full, 1] = np.maximum.reduceat((sums[stop] - sums[start]) / (lengths[stop] - lengths[start]), heads)
            rows[full, 2] = np.add.reduceat(np.maximum(of_word - CLEAR, 0), heads) / counts[full]
            rows[full, 3] = np.maximum.reduceat(of_word, heads)
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, FEATURES))


@dataclass
class Regression:
    """Logistic regression on scaled features."""

    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -30, 30)))

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), x / self.scale], axis=1)


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> Regression:
    """Newton steps on the ridge-penalised likelihood; the prior is smoothed, so no row or one class is enough."""
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(FEATURES)
    model = Regression(scale, np.zeros(FEATURES + 1))
    model.weights[0] = np.log((y.sum() + 0.5) / ((1 - y).sum() + 1.5))
    if not 0 < y.sum() < len(y):
        return model
    a = model.design(x)
    penalty = np.full(a.shape[1], ridge)
    for _ in range(50):
        p = model.score(x)
        slope = a.T @ (y - p) - penalty * model.weights
        bend = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        model.weights = model.weights + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return model


@dataclass
class ToxicityModel:
    ratios: Broadcast
    regression: Regression

    def score(self, text: Column) -> Column:
        ratios, regression = self.ratios, self.regression

        @F.arrow_udf("double")
        def toxicity(texts: pa.Array) -> pa.Array:
            scores = pa.array(regression.score(features(texts, ratios.value)))
            release_memory()
            return scores

        return toxicity(text)


def picked_labels(labels: DataFrame, fit: bool, rows: int) -> DataFrame:
    """(doc_id, label) of at most so many rows of each class, all of them rows labels may be learnt from."""
    ours = ~held_out(F.col("doc_id"))
    fold = F.floor(checksum(F.col("doc_id")) / 5) % 4 == 0
    one = (
        labels.where(F.col("toxic").isNotNull() & ours & (~fold if fit else fold))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return one.where("label = 1").orderBy(*order).limit(rows).unionByName(one.where("label = 0").orderBy(*order).limit(rows))


def fit(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS,
    id_column: str = "doc_id", text_column: str = "text",
) -> ToxicityModel:
    """labels: (doc_id, toxic 0/1). The two samples of labels are bounded, so they are broadcast."""
    docs = picked(docs, doc_id=id_column, text=text_column)
    labels = labels.select("doc_id", "toxic")
    sample = F.broadcast(written(picked_labels(labels, True, fit_rows)))
    grams = written(gram_counts(docs.join(sample, "doc_id", "left")))
    model = class_ratios(grams).toPandas()
    ratios = Ratios(model["gram"].to_numpy(np.int64), model["ratio"].to_numpy(float), model["otherwise"].to_numpy(float))
    ratios = sent(docs.sparkSession, ratios)

    @F.arrow_udf("array<double>")
    def looked_at(texts: pa.Array) -> pa.Array:
        x = features(texts, ratios.value)
        return W.list_column(x.reshape(-1), np.full(len(x), FEATURES), pa.float64())

    others = F.broadcast(written(picked_labels(labels, False, calibration_rows)))
    seen = docs.join(others, "doc_id").select("label", looked_at("text").alias("x")).toPandas()
    x = np.array(seen["x"].tolist(), float).reshape(-1, FEATURES)
    return ToxicityModel(ratios, fitted(x, seen["label"].to_numpy(float)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column)
    scored = picked(docs, doc_id=id_column, text=text_column).select("doc_id", model.score(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with a score under 0.5, all columns kept; rows are scored where they are, nothing is shuffled."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column)
    return docs.where(model.score(docs[text_column]) < 0.5)


def op2_toxicity(spark, folder: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents."""
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
