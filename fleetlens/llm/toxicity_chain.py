"""Toxicity by a chain of classifiers.

Categories are predicted one after the other by logistic regressions over hashed words
and word beginnings; each model is also fed the probabilities of the categories before
it.  While a chain is fitted those come from models that did not see the document
(out-of-fold), so a later model learns what an earlier one is worth on new texts.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import ALNUM, Scratch, Words, blocks, carried, documents, trim, utf8_parts
from fleetlens.llm.fm_quality import logistic
from fleetlens.llm.labelled import held_out, labelled_sample

#: The chain over the labels table: poor quality first, then toxic.
CATEGORIES = ("poor", "toxic")
#: Labelled documents that the chain is fitted on, at most.
MAX_SAMPLE = 9_000
DIM_BITS = 20
BEGINNINGS = (4, 5, 6)
FOLDS = 3
#: Documents of the sample that a feature must stand in to be used.
LEAST_DOCS = 4
#: Standard deviations from an even draw that a feature's documents must lie at.
LEAST_Z = 4.0
EPOCHS = 150
DECAY = 0.05
THRESHOLD = 0.5


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of what a block of texts holds: beginnings of 4, 5 and 6 bytes of
    the words (runs of letters and digits; shorter words whole), each once a text."""
    words = Words(data, offs, ALNUM, BEGINNINGS)
    shift = np.uint64(64 - DIM_BITS)
    doc = words.doc.astype(np.uint64) << np.uint64(DIM_BITS)
    found = np.unique(np.concatenate([doc | (words.prefix[k] >> shift) for k in BEGINNINGS]))
    return (found >> np.uint64(DIM_BITS)).astype(np.int32), (found & np.uint64((1 << DIM_BITS) - 1)).astype(np.int32)


def tally(at: np.ndarray, values: np.ndarray, of: np.ndarray | None, size: int, step: int = 1 << 18) -> np.ndarray:
    """Sums by ``at`` of values[of] (or of 1), a slice at a time, so no array of the
    sample's features is made in a wider type."""
    out = np.zeros(size)
    for i in range(0, len(at), step):
        out += np.bincount(at[i : i + step], weights=None if of is None else values[of[i : i + step]], minlength=size)
    return out


def screened(row, column, n_columns, y) -> np.ndarray:
    """Columns that stand in documents of one class far more often than chance lets:
    by ``LEAST_Z`` standard deviations of the count under an even draw."""
    share = y.mean()
    docs = tally(column, y, None, n_columns)
    positive = tally(column, y, row, n_columns)
    spread = np.sqrt(np.maximum(docs * share * (1 - share) * (1 - docs / len(y)), 1e-9))
    return np.flatnonzero((docs >= LEAST_DOCS) & (np.abs(positive - docs * share) >= LEAST_Z * spread))


def fit_linear(row, column, n_columns, extra, y, decay=DECAY, epochs=EPOCHS, rate=0.1):
    """Logistic regression by Adam over the whole sample, on the screened columns:
    (bias, weights, weights of the extra columns)."""
    n = len(y)
    weights = np.zeros(n_columns)
    share = (y.sum() + 0.01) / (n + 0.02)  # within 0 and 1 for labels of one class, too
    params = [np.array([np.log(share / (1 - share))]), np.zeros(0), np.zeros(extra.shape[1])]
    if not n or y.min() == y.max():
        return params[0][0], weights, params[2]
    kept = screened(row, column, n_columns, y)
    place = np.full(n_columns, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))
    used = place[column] >= 0
    row, column = row[used], place[column[used]]
    params[1] = np.zeros(len(kept))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, epochs + 1):
        bias, w, u = params
        g = logistic(bias[0] + np.bincount(row, weights=w[column], minlength=n) + extra @ u) - y
        grads = [np.array([g.sum()]), np.bincount(column, weights=g[row], minlength=len(kept)) + decay * w, extra.T @ g + decay * u]
        for i, grad in enumerate(grads):
            m, s = moments[i]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            params[i] = params[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    weights[kept] = params[1]
    return params[0][0], weights, params[2]


def _predict(model, row, column, n, extra):
    bias, w, u = model
    return logistic(bias + tally(row, w, column, n) + extra @ u)


def fit_chain(row, column, n_columns, labels: np.ndarray, fold: np.ndarray) -> list:
    """A model a category (columns of ``labels``), each with the out-of-fold
    probabilities of the categories before it as further columns."""
    n, n_categories = labels.shape
    extra = np.zeros((n, 0))
    models = []
    for c in range(n_categories):
        models.append(fit_linear(row, column, n_columns, extra, labels[:, c]))
        if c + 1 == n_categories:
            break
        apart = np.zeros(n)
        for k in range(FOLDS):
            inside = fold != k
            place = np.cumsum(inside) - 1
            used = inside[row]
            model = fit_linear(place[row[used]], column[used], n_columns, extra[inside], labels[inside, c])
            apart[~inside] = _predict(model, row, column, n, extra)[~inside]
        extra = np.column_stack([extra, apart])
    return models


def _train(n_categories: int):
    def run(batches):
        rows, columns, ids, labels, n = [], [], [], [], 0
        for batch in batches:
            data, offs = utf8_parts(batch.column(1))
            for i, j in blocks(offs):
                row, column = features(data, offs[i : j + 1])
                rows.append(row + np.int32(n))
                columns.append(column)
                n += j - i
            ids.append(batch.column(0).to_numpy())
            labels.append(np.column_stack([batch.column(2 + c).to_numpy() for c in range(n_categories)]).astype(np.float64))
        row = column = used = batch = data = offs = None
        if not n:
            models, kept = [(-4.0, np.zeros(0), np.zeros(c)) for c in range(n_categories)], np.zeros(0, np.int64)
        else:
            row, column = np.concatenate(rows), np.concatenate(columns)
            rows.clear()
            columns.clear()
            kept = np.flatnonzero(tally(column, row, None, 1 << DIM_BITS, 1 << 20) >= LEAST_DOCS)
            place = np.full(1 << DIM_BITS, -1, dtype=np.int32)
            place[kept] = np.arange(len(kept))
            column = place[column]
            used = column >= 0
            row, column = row[used], column[used]
            fold = np.concatenate(ids) % FOLDS
            models = fit_chain(row, column, len(kept), np.concatenate(labels), fold)
        model = {"features": kept.astype(np.int32), "models": [(float(b), w.astype(np.float32), u) for b, w, u in models]}
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})
        del row, column, used
        trim()

    return run


def _score(model, names):
    def run(batches):
        m = model.value
        weights = []
        for _, w, _ in m["models"]:
            full = np.zeros(1 << DIM_BITS)
            full[m["features"]] = w
            weights.append(full)
        for batch in batches:
            data, offs = utf8_parts(batch.column(1))
            scores = [[] for _ in names]
            for i, j in blocks(offs):
                n = j - i
                row, column = features(data, offs[i : j + 1])
                extra = np.zeros((n, 0))
                for c, (bias, _, u) in enumerate(m["models"]):
                    p = _predict((bias, weights[c], u), row, column, n, extra)
                    scores[c].append(p)
                    extra = np.column_stack([extra, p])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.concatenate(s) if s else np.zeros(0)) for s in scores)], names=[*batch.schema.names, *names])
        trim()

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, max_sample: int = MAX_SAMPLE) -> dict:
    """Fit the chain by one task on a bounded sample of ``labels``, a table of doc_id and a
    0 or 1 column for each category.  Without labels nothing is toxic."""
    Scratch(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels, list(categories), max_sample).select("doc_id", "text", *[F.col(c).cast("double").alias(c) for c in categories])
    ordered = sample.repartition(1).sortWithinPartitions("doc_id")
    fitted = ordered.mapInArrow(_train(len(categories)), "model binary").first()
    if fitted is None:  # no labelled document, so no task
        return {"features": np.zeros(0, np.int32), "models": [(-4.0, np.zeros(0), np.zeros(c)) for c in range(len(categories))]}
    return pickle.loads(fitted["model"])


def score_toxicity(docs: DataFrame, model: dict, categories=CATEGORIES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text, carried (the other columns), held_out, p_<category> of each category
    in the chain's order, and toxic: whether the last one's is at least ``threshold``.

    Every row is answered; NULL and empty texts have no features and get the models'
    base rates; NULL doc_ids count as not held out."""
    context = docs.sparkSession.sparkContext
    names = [f"p_{c}" for c in categories]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), carried(docs), held_out().alias("held_out"))
    schema = T.StructType([*rows.schema.fields, *[T.StructField(x, T.DoubleType()) for x in names]])
    scored = rows.mapInArrow(_score(context.broadcast(model), names), schema)
    return scored.withColumn("toxic", F.col(names[-1]) >= threshold)


def chain_labels(labels: DataFrame) -> DataFrame:
    """The labels table as categories: poor quality, toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")


def q_toxicity(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_toxicity(docs, chain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score_toxicity(docs, model).drop("text", "carried")
