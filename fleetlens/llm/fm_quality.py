"""Quality classifier: a factorisation machine over hashed words, structure statistics
and size metadata of a document.

    z = bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

The last sum gives all pairwise interactions in time linear in the features (the
sum-of-squares identity).  The score is the logistic function of z.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Scratch, Words, blocks, byte_class, documents, trim, utf8_parts
from fleetlens.llm.labelled import held_out, labelled_sample

#: Labelled documents that the machine is fitted on, at most.
MAX_SAMPLE = 6_000
BUCKETS = 1 << 15
FACTORS = 4
EPOCHS = 60
_CLASSES = [byte_class(range(65, 91)), byte_class(range(48, 58)), byte_class(b".,;:?"), byte_class(b"!"), byte_class(b"|<>{}[]()/\\_=+~^"), byte_class(b"#$%&*@"), byte_class(b" \t"), byte_class(b"\n"), byte_class(range(128, 256))]
N_STATS = len(_CLASSES) + 7


def _per_doc(doc: np.ndarray, values, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the hashed words, unit length a row, and the matrix of
    statistics of a block of texts.  All are 0 for a text without words."""
    n = len(offs) - 1
    size = np.diff(offs).astype(np.float64)
    text = data[offs[0] : offs[-1]]
    words = Words(data, offs)
    count = words.counts().astype(np.float64)
    key = (words.doc.astype(np.uint64) << np.uint64(32)) | (words.hash >> np.uint64(64 - 15))
    pairs, tf = np.unique(key, return_counts=True)
    row, bucket = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    value = 1.0 + np.log(tf)
    value /= np.sqrt(_per_doc(row, value * value, n))[row]
    # Shares of byte classes, by running sums
    stats = np.zeros((n, N_STATS))
    least = np.maximum(size, 1)
    at = offs - offs[0]
    for c, members in enumerate(_CLASSES):
        run = np.concatenate([[0], np.cumsum(members[text])])
        stats[:, c] = (run[at[1:]] - run[at[:-1]]) / least
    k = len(_CLASSES)
    least_words = np.maximum(count, 1)
    exact = (words.doc.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24))
    kinds, many = np.unique(exact, return_counts=True)
    kind_doc = (kinds >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, kind_doc, many)
    same = (words.doc[1:] == words.doc[:-1]) & (words.hash[1:] == words.hash[:-1])
    stats[:, k] = np.log1p(size) / 10
    stats[:, k + 1] = np.log1p(count) / 10
    stats[:, k + 2] = _per_doc(words.doc, words.length, n) / least_words / 10
    stats[:, k + 3] = _per_doc(kind_doc, None, n) / least_words  # different words
    stats[:, k + 4] = top / least_words  # share of the most frequent
    stats[:, k + 5] = _per_doc(words.doc[1:][same], None, n) / least_words  # said twice running
    stats[:, k + 6] = count / np.maximum(1, stats[:, 7] * size + 1) / 100  # words a line
    stats[count == 0] = 0
    return row, bucket, value, stats


def _design(row, bucket, value, stats, mean, spread, n):
    """Words and standardised statistics as one sparse matrix."""
    scaled = np.clip((stats - mean) / spread, -5, 5) / np.sqrt(N_STATS)
    rows = np.concatenate([row, np.repeat(np.arange(n), N_STATS)])
    columns = np.concatenate([bucket, np.tile(BUCKETS + np.arange(N_STATS), n)])
    return rows, columns, np.concatenate([value, scaled.ravel()])


def machine(rows, columns, x, n, bias, w, v) -> tuple[np.ndarray, np.ndarray]:
    """(z, sums by factor): the factorisation machine in linear time."""
    z = bias + np.bincount(rows, weights=w[columns] * x, minlength=n)
    sums = np.empty((v.shape[1], n))
    for f in range(v.shape[1]):
        part = v[columns, f] * x
        sums[f] = np.bincount(rows, weights=part, minlength=n)
        z += 0.5 * (sums[f] ** 2 - np.bincount(rows, weights=part * part, minlength=n))
    return z, sums


def logistic(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(rows, columns, x, y, n_columns, factors=FACTORS, epochs=EPOCHS, rate=0.05, decay=1e-3, seed=7):
    """Adam on the logistic loss over the whole sample."""
    n = len(y)
    v = np.random.default_rng(seed).standard_normal((n_columns, factors)) * 0.05
    share = np.clip(y.mean(), 0.01, 0.99)
    params = [np.array([np.log(share / (1 - share))]), np.zeros(n_columns), v]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, epochs + 1):
        bias, w, v = params
        z, sums = machine(rows, columns, x, n, bias[0], w, v)
        g = (logistic(z) - y) / n
        gx = g[rows] * x
        grad_v = np.empty_like(v)
        square = np.bincount(columns, weights=gx * x, minlength=n_columns)
        for f in range(factors):
            grad_v[:, f] = np.bincount(columns, weights=gx * sums[f][rows], minlength=n_columns) - v[:, f] * square
        grads = [np.array([g.sum()]), np.bincount(columns, weights=gx, minlength=n_columns) + decay * w / n, grad_v + decay * v / n]
        for i, grad in enumerate(grads):
            m, s = moments[i]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            params[i] = params[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return params[0][0], params[1], params[2]


def _train(batches):
    """All rows of the (bounded) sample come to this one task."""
    parts, ys, n = [], [], 0
    for batch in sorted((b for b in batches if b.num_rows), key=lambda b: b.column(0)[0].as_py()):
        data, offs = utf8_parts(batch.column(1))
        for i, j in blocks(offs):
            row, bucket, value, stats = features(data, offs[i : j + 1])
            parts.append((row + n, bucket, value, stats))
            n += j - i
        ys.append(batch.column(2).to_numpy().astype(np.float64))
    if not n or len(np.unique(np.concatenate(ys))) < 2:
        share = 0.5 if not n else float(np.concatenate(ys).mean())
        model = {"bias": float(np.log((share + 0.01) / (1.01 - share))), "w": np.zeros(BUCKETS + N_STATS), "v": np.zeros((BUCKETS + N_STATS, FACTORS)), "mean": np.zeros(N_STATS), "spread": np.ones(N_STATS)}
    else:
        y = np.concatenate(ys)
        row, bucket, value, stats = (np.concatenate([p[i] for p in parts]) for i in range(4))
        mean, spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        bias, w, v = fit(*_design(row, bucket, value, stats, mean, spread, n), y, BUCKETS + N_STATS)
        model = {"bias": bias, "w": w, "v": v, "mean": mean, "spread": spread}
    model = {k: np.asarray(x, dtype=np.float32 if k in ("w", "v") else np.float64) for k, x in model.items()}
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})
    parts.clear()
    trim()


def _score(model):
    def run(batches):
        m = model.value
        w, v = m["w"].astype(np.float64), m["v"].astype(np.float64)
        for batch in batches:
            data, offs = utf8_parts(batch.column(1))
            scores = []
            for i, j in blocks(offs):
                n = j - i
                row, bucket, value, stats = features(data, offs[i : j + 1])
                rows, columns, x = _design(row, bucket, value, stats, m["mean"], m["spread"], n)
                scores.append(logistic(machine(rows, columns, x, n, float(m["bias"]), w, v)[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["doc_id", "held_out", "score"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> dict:
    """The machine's parameters, fitted by one task on a bounded sample.  With no labels,
    or labels of one class alone, it scores their share everywhere."""
    Scratch(docs.sparkSession, "quality")
    sample = labelled_sample(docs, labels, ["quality"], max_sample).select("doc_id", "text", F.col("quality").cast("double").alias("quality"))
    ordered = sample.repartition(1).sortWithinPartitions("doc_id")
    fitted = ordered.mapInArrow(_train, "model binary").first()
    if fitted is None:  # no labelled document, so no task
        return next(pickle.loads(b.column(0)[0].as_py()) for b in _train(iter(())))
    return pickle.loads(fitted["model"])


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score and predicted for every row, whatever its text: NULL and
    empty texts are scored with all features 0; repeated rows each; NULL doc_ids count
    as not held out; further columns are not read."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    scored = rows.mapInArrow(_score(context.broadcast(model)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def q_quality(spark, sf_dir) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
