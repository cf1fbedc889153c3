"""Quality classifier: supervised subword embeddings.

Every text is a bag of hashed features: its words, its byte n-grams inside
words (the blanks around a word mark its ends), and one mark for each word that
repeats the word before it. A feature has a learned vector; the vectors are averaged per
text and a softmax layer gives the chance of label 1. Training is plain
stochastic gradient descent in numpy over a bounded sample of labelled texts,
in one task. Scoring uses that averaging and the linear layer commute: the model
shrinks to one number per feature bucket (1 MB), so scoring is a table look-up
in one pass over the texts, without a shuffle.

Null and empty texts have no features and score the share of label 1 in the
training sample. Rows keep all their columns, so repeated rows each get the same
score. With no labelled rows every text scores 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.llm.hashing import Words, chunks, running_hash, span_hash, mix

BUCKETS = 1 << 18
GRAMS = (3, 5)
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
#: Most labelled rows used to fit the model; which ones is a hash of doc_id.
TRAIN_ROWS = 6000
KEEP_AT = 0.7
_SAME_WORD = np.uint64(0x5A17)
_KEEP_CASE = np.arange(256)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of a chunk and the text each belongs to, ordered by kind."""
    words = Words(data, offsets, _KEEP_CASE)
    blank = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data == 32) | ((data >= 9) & (data <= 13))), out=blank[1:])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    values, rows = [words.hashes], [words.row]
    same = np.flatnonzero((words.hashes[1:] == words.hashes[:-1]) & (words.row[1:] == words.row[:-1])) + 1
    values.append(np.full(len(same), _SAME_WORD))
    rows.append(words.row[same])
    for n in GRAMS:
        start = np.arange(max(0, len(data) - n + 1))
        inner = blank[start + n - 1] - blank[start + 1]
        start = start[(inner == 0) & (owner[start] == owner[start + n - 1])] if len(start) else start
        values.append(span_hash(words.sums, start, start + n) + np.uint64(n))
        rows.append(owner[start])
    hashed = (mix(np.concatenate(values)) % np.uint64(BUCKETS)).astype(np.int32)
    return hashed, np.concatenate(rows)


def bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text."""
    out = []
    for first, end, data, offsets in chunks(column):
        values, rows = features(data, offsets)
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
        cuts = np.searchsorted(rows, np.arange(end - first + 1))
        for i in range(end - first):
            ids, counts = np.unique(values[cuts[i] : cuts[i + 1]], return_counts=True)
            out.append((ids, (counts / max(1, counts.sum())).astype(np.float32)))
    return out


def train(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> np.ndarray:
    """One number per bucket, then the bias: the difference of the two classes' scores."""
    if not len(labels):
        return np.zeros(BUCKETS + 1, np.float32)
    rng = np.random.default_rng(seed)
    bag = bags(texts)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = np.log(np.array([1 - share, share]))
    target = np.eye(2, dtype=np.float32)[labels]
    step, steps = 0, EPOCHS * len(bag)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bag)):
            ids, shares = bag[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            if not len(ids):
                continue
            hidden = shares @ vectors[ids]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            error = (p / p.sum() - target[i]).astype(np.float32)
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            # shares of a few hundred features are small: scale by their spread
            vectors[ids] -= np.outer(shares * (rate / (shares @ shares)), back)
    return np.append(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]).astype(np.float32)


def score_texts(column: pa.Array, model: np.ndarray) -> np.ndarray:
    out = np.empty(len(column))
    for first, end, data, offsets in chunks(column):
        values, rows = features(data, offsets)
        n = np.bincount(rows, minlength=end - first)
        total = np.bincount(rows, weights=model[values], minlength=end - first)
        out[first:end] = 1 / (1 + np.exp(-(total / np.maximum(n, 1) + model[-1])))
    return out


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Model from at most train_rows labelled texts; a doc_id labelled twice counts as its lower label.

    The sample's ids are found among the labels alone; their number is the limit
    above, so they are broadcast and no text is shuffled but the sample's.
    """
    ids = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_label").limit(train_rows)
    )

    def run(batches):
        table = pa.Table.from_batches(list(batches))
        if table.num_rows == 0:
            yield pa.RecordBatch.from_pydict({"model": pa.array([], pa.binary())})
            return
        table = table.sort_by([("doc_id", "ascending")])
        texts = table.column("text").combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
        model = train(texts, table.column("_label").to_numpy())
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary())})

    rows = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return np.frombuffer(rows[0][0], np.float32) if rows else np.zeros(BUCKETS + 1, np.float32)


def score(docs: DataFrame, model: np.ndarray, column: str = "quality_score") -> DataFrame:
    """docs with the chance of label 1 in one more column, which replaces any of that name."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = pa.array(score_texts(batch.column("text"), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
