"""Quality scores by nearest-neighbour voting in a latent semantic space.

Terms are the case-preserving character 1-, 2- and 3-grams of the whole text (hashed to 2**13); their
document frequencies are counted over all documents. The TF-IDF rows of a bounded sample of labelled
documents (``max_labelled``), with eight shape terms for the share of distinct 6-grams, give, by a truncated singular value decomposition, a space of ``rank``
dimensions. The labelled vectors are broadcast (at most max_labelled x rank floats) and every
document's vector is multiplied with all of them, block by block; the ``neighbours`` most similar
ones, with all ties of the last of them, vote with their similarity.

Defined results: a null or empty text, and any text when no row is labelled, gets the share of label
1 among the learned rows (0.5 without any). Repeated label rows count as often as they stand; of several texts of a
labelled id the smallest is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curaspark.llm import common, grams

SIZES, BITS = (1, 2, 3), 13
SHAPES, SHAPE_BITS, SHAPE_WEIGHT = 8, 17, 0.8
TERMS = (1 << BITS) + SHAPES


def term_counts(points: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Counts of the hashed grams, then the shape terms: how much of the text is not a repetition."""
    found = np.zeros(TERMS, np.float32)
    if len(points):
        found[: 1 << BITS] = grams.counts(points, SIZES, BITS)
        share = SHAPES * len(grams.distinct(points, (6,), SHAPE_BITS, seen)) / max(len(points) - 5, 1)
        low = min(int(share), SHAPES - 1)
        found[(1 << BITS) + low] = 1 - (share - low) / 2
        found[(1 << BITS) + min(low + 1, SHAPES - 1)] += (share - low) / 2
    return found


@dataclass
class NeighbourModel:
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int

    def tfidf(self, counts: np.ndarray) -> np.ndarray:
        """Rows of unit length; the shape terms keep their own share of it."""
        rows = np.log1p(counts[:, : 1 << BITS]).astype(np.float32) * self.idf
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        rows = np.hstack([rows, counts[:, 1 << BITS :] * np.float32(SHAPE_WEIGHT)])
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        rows = self.tfidf(counts) @ self.space
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        # rounded, so that a row's result does not depend on the block it stands in
        similar = np.round(self.latent(counts) @ self.vectors.T, 4)
        k = min(self.neighbours, similar.shape[1])
        least = np.partition(similar, similar.shape[1] - k, axis=1)[:, -k][:, None]
        weight = np.where(similar >= least, np.maximum(similar, 0), 0).astype(np.float64)
        total = weight.sum(axis=1)
        voted = (weight @ self.labels) / np.maximum(total, 1e-12)
        empty = (counts.sum(axis=1) == 0) | (total <= 0)
        return np.clip(np.where(empty, self.prior, np.round(voted, 6)), 0, 1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and the number of documents."""

    def run(batches):
        total, n, seen = np.zeros(1 << BITS, np.int64), 0, np.zeros(1 << BITS, bool)
        for batch in batches:
            n += len(batch)
            for points in grams.each_text(batch.column("text")):
                total[grams.distinct(points, SIZES, BITS, seen)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(1 << BITS), -1).astype(np.int32)), pa.array(np.append(total, n))], ["term", "n"])

    # 2**13 + 1 rows, whatever the number of documents
    rows = common.map_arrow(docs.select("text"), run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r.term: r.n for r in rows}
    return np.array([found.get(t, 0) for t in range(1 << BITS)], np.float64), found.get(-1, 0)


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", max_labelled: int = 3000, rank: int = 48, neighbours: int = 15, seed: int = 7
) -> NeighbourModel:
    """Fit from the labelled rows where ``learn`` (of doc_id) holds."""
    df, n_docs = document_frequencies(docs)
    idf = np.log((1 + n_docs) / (1 + df)).astype(np.float32) + np.float32(1)
    chosen = (
        labels.select("doc_id", F.col(label_col).cast("int").alias("label"))
        .filter(learn & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_labelled)
    )
    # one text for each id, however often it stands
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi").filter(F.length("text") > 0).groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")

    def run(batches):
        seen = np.zeros(1 << SHAPE_BITS, bool)
        for batch in batches:
            terms, times = [], []
            for points in grams.each_text(batch.column("text")):
                count = term_counts(points, seen)
                terms.append(np.flatnonzero(count).astype(np.int32))
                times.append(count[terms[-1]])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.float32()))], ["doc_id", "label", "terms", "times"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    # at most max_labelled rows, each with at most TERMS terms
    learned = sorted(common.map_arrow(rows, run, f"doc_id {kind}, label int, terms array<int>, times array<float>").collect(), key=lambda r: (r.doc_id, r.label))
    y = np.array([r.label for r in learned], np.float64)
    prior = float(y.mean()) if len(y) else 0.5
    model = NeighbourModel(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), y, prior, neighbours)
    if not len(y):
        return model
    table = np.zeros((len(y), TERMS), np.float32)
    for k, r in enumerate(learned):
        table[k, r.terms] = r.times
    rows_ = model.tfidf(table)
    # randomised range finder with two power steps, then the small exact decomposition
    sketch = rows_ @ np.random.default_rng(seed).standard_normal((TERMS, min(rank + 8, len(y))), dtype=np.float32)
    for _ in range(2):
        sketch = rows_ @ (rows_.T @ np.linalg.qr(sketch)[0])
    basis = np.linalg.qr(sketch)[0]
    _, _, right = np.linalg.svd(basis.T @ rows_, full_matrices=False)
    model.space = np.ascontiguousarray(right[:rank].T)
    model.vectors = model.latent(table)
    return model


def score(docs: DataFrame, model: NeighbourModel, score_as: str = "score", block: int = 256) -> DataFrame:
    """All columns of ``docs`` (with its ``text``) and a score in 0 to 1."""
    rows = docs.drop(score_as)
    schema = T.StructType([*rows.schema.fields, T.StructField(score_as, T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        counts = np.zeros((block, TERMS), np.float32)
        seen = np.zeros(1 << SHAPE_BITS, bool)
        for batch in batches:
            n, begun, out = len(batch), 0, np.zeros(len(batch))
            for k, points in enumerate(grams.each_text(batch.column("text"))):
                counts[k - begun] = term_counts(points, seen)
                if k + 1 - begun == block or k + 1 == n:
                    out[begun : k + 1] = model.score(counts[: k + 1 - begun])
                    begun = k + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, score_as])

    return common.map_arrow(rows, run, schema)
