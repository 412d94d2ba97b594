"""Hard negatives by a secondary sort: scores of stated anchors against all rows, in blocks of both.

A pair of an anchor and a block of rows leaves the block only where it can still count: the block's first rows of the anchor's
label, then, with the positives known, the block's first rows in each positive's window. Both are exact, as what is first
among all rows is first in its block. The pairs left are shuffled by anchor and sorted by (anchor, descending score, id); an
iterator over that order opens a window at each positive and fills it, and holds no anchor's rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curaspark.llm import common

ROWS, ANCHORS = 4096, 512
_LONG = np.iinfo(np.int64)
_PAIRS = "anchor_id long, score long, id long"
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, vec): rows with an id, a label and a vector of finite numbers; components become floor(scale * x)."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    kept = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
    return kept.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("vec"))


# ---- blocks ----


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of a list column as rows; shorter ones end in zeros."""
    lengths = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.asarray(lists.flatten())
    return out


def _packed(table: pa.Table, columns: tuple[str, ...] = ()) -> dict[str, list]:
    """One row: ids, labels and vectors of a table as bytes, ids ascending."""
    table = table.combine_chunks().sort_by("id")
    vec = table["vec"].combine_chunks()
    vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
    matrix = _matrix(vec)
    row = {"ids": np.asarray(table["id"]).astype(np.int64).tobytes(), "labels": np.asarray(table["label"]).astype(np.int64).tobytes(), "matrix": matrix.tobytes(), "n": len(table)}
    for name in columns:
        lists = table[name].combine_chunks()
        row[name] = _windows(lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists).tobytes()
    return {k: [v] for k, v in row.items()}


def _windows(lists: pa.Array) -> np.ndarray:
    """Positive scores of each anchor, a row each; the gaps of shorter lists hold the smallest number."""
    lengths = np.diff(np.asarray(lists.offsets))
    out = np.full((len(lists), int(lengths.max(initial=0))), _LONG.min, np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.asarray(lists.flatten())
    return out


def _pack_rows(batches, size: int):
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            if n + part.num_rows > size:
                yield pa.RecordBatch.from_pydict(_packed(pa.Table.from_batches(held)))
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield pa.RecordBatch.from_pydict(_packed(pa.Table.from_batches(held)))


_BLOCK = "ids binary, labels binary, matrix binary, n long"


def _row_blocks(rows: DataFrame) -> DataFrame:
    return common.map_arrow(rows.select("id", "label", "vec"), partial(_pack_rows, size=ROWS), _BLOCK)


def _anchor_blocks(anchors: DataFrame, n: int, *columns: str) -> DataFrame:
    """About ``ANCHORS`` in a row, dealt by id."""
    count = max(1, -(-n // ANCHORS))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        return pa.table(_packed(table, columns) | {"block": pa.array([table["block"][0].as_py()], pa.int32())})

    schema = _BLOCK + "".join(f", {c} binary" for c in columns) + ", block int"
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    common.ship(anchors.sparkSession)
    packed = dealt.groupBy("block").applyInArrow(lambda t: run(t).select(names), schema)
    return packed.select(*[F.col(c).alias(f"a_{c}") for c in names if c != "block"], "block")


def _joined(rows: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """Each block of anchors beside each block of rows, dealt over ``spread`` times as many keys as there are anchor blocks."""
    count = max(1, -(-n // ANCHORS))
    spread = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // count)
    keyed = rows.withColumn("spread", F.pmod(F.xxhash64("ids"), F.lit(spread)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    copied = anchors.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return keyed.join(copied, ["block", "spread"])


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices; beyond 64 bits the nearest 64-bit number."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    most = width * max(map(abs, (int(a.min(initial=0)), int(a.max(initial=0))))) * max(map(abs, (int(b.min(initial=0)), int(b.max(initial=0)))))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


def _first(mask: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first n marked columns of each row, by descending score, then column."""
    if mask.shape[1] > n:
        held = np.where(mask, scores, _LONG.min)
        least = np.partition(held, mask.shape[1] - n, axis=1)[:, mask.shape[1] - n]
        mask = mask & (scores >= least[:, None])
    row, column = np.nonzero(mask)
    order = np.lexsort((column, _descending(scores[row, column]), row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < n
    return row[kept], column[kept]


def _descending(scores: np.ndarray) -> np.ndarray:
    """A key that falls as scores rise; -score of the smallest number would not fit."""
    return ~scores


def _blocks(batches):
    for batch in batches:
        for r in batch.to_pylist():
            a_ids, a_labels, ids, labels = (np.frombuffer(r[c], np.int64) for c in ("a_ids", "a_labels", "ids", "labels"))
            a, b = np.frombuffer(r["a_matrix"], np.int64).reshape(len(a_ids), -1), np.frombuffer(r["matrix"], np.int64).reshape(len(ids), -1)
            yield r, a_ids, ids, a_labels[:, None] == labels[None, :], _scores(a, b)


def _pairs(a_ids, ids, scores, row, column) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"anchor_id": a_ids[row], "score": scores[row, column], "id": ids[column]})


def _block_positives(batches, n: int):
    for _, a_ids, ids, same, scores in _blocks(batches):
        yield _pairs(a_ids, ids, scores, *_first(same & (a_ids[:, None] != ids[None, :]), scores, n))


def _bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score with low * p <= 100 * s <= high * p, for each positive score p; none for a gap."""
    known = [[int(x) for x in row] for row in positive]
    least = [[min(-(-low * x // 100), _LONG.max) if x != _LONG.min else _LONG.max for x in row] for row in known]
    most = [[max(high * x // 100, _LONG.min) if x != _LONG.min else _LONG.min for x in row] for row in known]
    return np.array(least, np.int64).reshape(positive.shape), np.array(most, np.int64).reshape(positive.shape)


def _block_negatives(batches, n: int, low: int, high: int):
    for r, a_ids, ids, same, scores in _blocks(batches):
        least, most = _bounds(np.frombuffer(r["a_positive"], np.int64).reshape(len(a_ids), -1), low, high)
        found: set[tuple[int, int]] = set()
        for k in range(least.shape[1]):
            inside = ~same & (scores >= least[:, k, None]) & (scores <= most[:, k, None])
            found.update(zip(*(x.tolist() for x in _first(inside, scores, n))))
        row, column = (np.array(x, np.int64) for x in zip(*sorted(found))) if found else (np.zeros(0, np.int64),) * 2
        yield _pairs(a_ids, ids, scores, row, column)


# ---- the sorted iterator ----


def _open_windows(batches, n: int, low: int, high: int):
    """Rows in the order (anchor, descending score, positives first, id): at a positive a window opens, a negative goes to each open
    window that it satisfies and that has room; what lies below a window closes it."""
    anchor, windows = None, []
    for batch in batches:
        out = []
        for a, score, negative, key in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "score", "negative", "id"))):
            if a != anchor:
                anchor, windows = a, []
            if not negative:
                windows.append([key, score, 0])
                continue
            for w in windows:
                if w[2] < n and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((a, w[0], w[2], key, w[1], score))
            windows = [w for w in windows if w[2] < n and low * w[1] <= 100 * score]
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both tables are (id long, label long, vec array<long>), as ``quantised`` returns them; other columns are left alone. A score is the
    inner product of two vectors; a shorter vector ends in zeros. An anchor's positives are its first rows of its label,
    by descending score and ascending id, without rows of its own id; a positive's negatives are the first rows of other labels with
    ``low * positive <= 100 * negative <= high * positive`` in scores, so a negative positive score has none. Repeated rows
    count as often as they stand; an id that is an anchor more than once is so with its smallest label and vector.
    Rows with a null in id, label or vector take no part, and empty tables have no pairs. high is at most 100.
    """
    spark = rows.sparkSession
    known = lambda df: df.select("id", "label", "vec").filter("id is not null and label is not null and vec is not null")
    rows = known(rows)
    anchors = common.stored(known(anchors).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("s")).select("id", "s.label", "s.vec"))
    n = anchors.count()
    if n == 0:
        return spark.createDataFrame([], _FOUND)
    blocks = _row_blocks(rows)
    near = common.map_arrow(_joined(blocks, _anchor_blocks(anchors, n), n), partial(_block_positives, n=positives), _PAIRS)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = common.stored(near.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= positives).drop("_k"))
    scores = best.groupBy("anchor_id").agg(F.collect_set("score").alias("positive"))
    asking = anchors.join(scores.withColumnRenamed("anchor_id", "id"), "id")
    far = common.map_arrow(_joined(blocks, _anchor_blocks(asking, n, "positive"), n), partial(_block_negatives, n=negatives, low=low, high=high), _PAIRS)
    pairs = best.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))
    dealt = pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "negative", "id")
    return common.map_arrow(dealt, partial(_open_windows, n=negatives, low=low, high=high), _FOUND)


#: The same by a plain join of anchors with all rows.
NEGATIVES_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
 FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
