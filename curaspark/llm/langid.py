"""Language identification with string kernels.

The kernel of two texts is the number of distinct character 1-, 2- and 3-grams (letters lower-cased,
everything else a space, hashed to 2**17 values) that both hold, over the root of the product of
their numbers: a blended-spectrum presence kernel. A few landmark texts for each language give the
Nyström features; kernel ridge regression, one language against the rest, is solved in them on the
driver from a bounded sample of labelled rows. Scoring is one map over the documents: presence
rows of a block times the landmarks' presence rows, times the weights.

Bounds: ``per_language`` labelled rows of each language and ``max_rows`` in all are read for the fit,
and ``landmarks`` of each language become landmarks. Whole texts are scored.

Defined results: a null text or one without any letter gives ``und`` and score 0; with no labelled
row every text does; equal texts get equal results; ties between languages go to the first name; an id that stands
several times is learned from once (its smallest label and text), every row is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from curaspark.llm import common, grams

SIZES, BITS = (1, 2, 3), 17
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """``languages`` in order, gram hashes that landmarks hold, their presence rows, the weights."""

    languages: list[str]
    vocabulary: np.ndarray
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray

    def scores(self, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One row of one-versus-rest outputs for each presence row over the vocabulary."""
        kernel = presence @ self.landmarks.T
        kernel /= np.sqrt(np.maximum(sizes, 1))[:, None] * self.norms[None, :]
        return kernel @ self.weights


def labelled_sample(docs: DataFrame, label: Column, per_label: int, max_rows: int) -> DataFrame:
    """(doc_id, label) of about the first ``per_label`` rows of each label by id hash, never more, and ``max_rows`` in all.

    Rows whose hash lies below a bound, from the label's count, are ranked; so the rows of a frequent label never meet in one task.
    """
    rows = docs.select("doc_id", label.alias("label")).filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    sizes = common.stored(rows.groupBy("label").agg(F.count("*").alias("size")))
    # the upper half of the hash's range is not used, so that shares of 2**62 can be compared
    place = F.shiftright(F.xxhash64("doc_id"), 1) + F.lit(1 << 62)
    below = F.least(F.lit(1.0), F.lit(2.0 * per_label) / F.col("size")) * float(1 << 63)
    few = rows.join(common.if_small(sizes), "label").filter(place.cast("double") <= below).select("doc_id", "label").distinct()
    turn = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = few.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= per_label)
    return ranked.orderBy("turn", "label").limit(max_rows).select("doc_id", "label")


def fit(
    docs: DataFrame, learn: Column, lang_col: str = "lang", per_language: int = 300, max_rows: int = 3000, landmarks: int = 24, max_landmarks: int = 384, ridge: float = 0.05
) -> LanguageModel | None:
    """Fit from the rows where ``learn`` holds and the language is not null."""
    known = docs.filter(learn).select(F.col("doc_id"), F.col("text"), F.col(lang_col).alias("label"))
    chosen = labelled_sample(known, F.col("label"), per_language, max_rows).select("doc_id").distinct()
    rows = known.join(F.broadcast(chosen), "doc_id", "left_semi").filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    # one row for each id, however often it stands
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("label", "text")).alias("row")).select("doc_id", "row.label", "row.text")

    def run(batches):
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            found = [grams.distinct(points, SIZES, BITS, seen).astype(np.int32) for points in grams.each_text(batch.column("text"), grams.fold_letters)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "grams"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    # at most max_rows rows, each with at most 2**17 small numbers
    learned = sorted(common.map_arrow(rows, run, f"doc_id {kind}, label string, grams array<int>").collect(), key=lambda r: (r.label, r.doc_id))
    learned = [r for r in learned if len(r.grams) > 1]
    languages = sorted({r.label for r in learned})
    if not languages:
        return None
    each = max(1, min(landmarks, max_landmarks // len(languages)))
    marks: list = []
    for language in languages:
        own = [r for r in learned if r.label == language]
        marks += sorted(own, key=lambda r: (-min(len(r.grams), 800), r.doc_id))[:each]
    vocabulary = np.unique(np.concatenate([np.asarray(r.grams) for r in marks]))

    def presence(rows):
        table = np.zeros((len(rows), len(vocabulary)), np.float32)
        for k, r in enumerate(rows):
            table[k, np.searchsorted(vocabulary, np.intersect1d(r.grams, vocabulary))] = 1
        return table, np.array([len(r.grams) for r in rows], np.float64)

    mark_rows, mark_sizes = presence(marks)
    norms = np.sqrt(mark_sizes)
    inner = (mark_rows @ mark_rows.T).astype(np.float64) / norms[:, None] / norms[None, :]
    values, vectors = np.linalg.eigh(inner)
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    rows_, sizes = presence(learned)
    features = ((rows_ @ mark_rows.T) / np.sqrt(sizes)[:, None] / norms[None, :]).astype(np.float64) @ whiten
    target = np.where(np.array([r.label for r in learned])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]), features.T @ target)
    return LanguageModel(languages, vocabulary, mark_rows, norms.astype(np.float32), (whiten @ solved).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel | None, lang_as: str = "lang_pred", score_as: str = "score", block: int = 256) -> DataFrame:
    """All columns of ``docs`` (with its ``text``) and two more. A column of the same name is replaced."""
    rows = docs.drop(lang_as, score_as)
    schema = T.StructType([*rows.schema.fields, T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            n = len(batch)
            lettered, sizes = np.zeros(n, bool), np.zeros(n)
            languages, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
            if model is not None:
                presence, begun = np.zeros((block, len(model.vocabulary)), np.float32), 0
                for k, points in enumerate(grams.each_text(batch.column("text"), grams.fold_letters)):
                    lettered[k] = bool((points != 32).any())
                    hashes = grams.gram_hashes(points, SIZES, BITS)
                    for h in hashes:
                        seen[h] = True
                    sizes[k] = np.count_nonzero(seen)
                    presence[k - begun] = seen[model.vocabulary]
                    for h in hashes:
                        seen[h] = False
                    if k + 1 - begun == block or k + 1 == n:
                        out = model.scores(presence[: k + 1 - begun], sizes[begun : k + 1])
                        best = np.round(out, 5).argmax(axis=1)
                        languages[begun : k + 1] = np.array(model.languages, object)[best]
                        scores[begun : k + 1] = np.clip((np.round(out.max(axis=1).astype(np.float64), 5) + 1) / 2, 0, 1)
                        begun = k + 1
                languages[~lettered], scores[~lettered] = UNDETERMINED, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, pa.string()), pa.array(scores)], names=[*batch.schema.names, lang_as, score_as])

    return common.map_arrow(rows, run, schema)


def keep_identified(docs: DataFrame, learn: Column, min_score: float = 0.52, min_letters: int = 200, lang_col: str = "lang") -> DataFrame:
    """The rows whose language is determined, columns as they were, a null language filled in with the predicted one.

    A row goes if its text is null or has no letter. It also goes if its score is below ``min_score``, about where all
    one-versus-rest outputs are near zero and no language claims it, and it has ``min_letters`` letters or more: the outputs of
    shorter texts are near zero in any language (of labelled held-out texts of that length one in a thousand has a
    lower score). With no labelled row at all nothing can be told and every row stays.
    """
    model = fit(docs, learn, lang_col)
    if model is None:
        return docs
    name, score = common.fresh("lang_pred", docs), common.fresh("lang_score", docs)
    short = F.length(F.regexp_replace(F.col("text"), r"[^\p{L}]+", "")) < min_letters
    kept = predict(docs, model, name, score).filter((F.col(name) != UNDETERMINED) & ((F.col(score) >= min_score) | short))
    return kept.select(*[F.coalesce(F.col(c), F.col(name)).alias(c) if c == lang_col else F.col(f"`{c}`") for c in docs.columns])
