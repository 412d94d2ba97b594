"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased, with ASCII punctuation as spaces. Inverse document frequencies (of hashed words) are
counted over all documents. The benchmark's passages are TF-IDF rows; a distributed randomised
singular value decomposition (sketch, power step and projection are sums over the passages'
partitions) gives a latent space and a vector for each passage. Every window of every document, at
several lengths with overlaps, is folded into that space and compared with all passages of its length
by cosine. Two exact bounds come first: a document that lacks too many of a passage's rarest words can't
hold enough of it, nor can a window whose surroundings hold too few of the passage's words, each counted
as often as in the passage; so most windows need no vector. All others are verified on the words themselves, those of a high
cosine first: the longest common subsequence of
the passage and the surroundings of the window must hold ``similar`` of the passage; below ``sure`` the
passage's rarest words, its answer, must be there too. No window is dropped by its cosine: foreign words
in it and frequencies that grow with the contamination lower it for exact copies too.

Bounds: passages are taken in blocks, counted before they are used, of at most ``block`` items, ``max_words`` words and
``max_terms`` different words (or of one passage), each with vectors of at most ``rank`` numbers: what the driver takes and
broadcasts is at most max_terms x rank x 4 bytes for the space (67 MB) and about as much for the passages. A
benchmark of any size is searched, block after block, with one pass over the documents for each. Sums, products and the
orthonormalisation of the decomposition run on tables; the driver sees matrices of rank x rank numbers. Documents are
never grouped or joined, so neither hot sources nor passages that many documents share matter.

Defined results: repeated rows of documents give repeated rows; equal passages of one item are one; null or empty documents match nothing, nor do passages without words; no passages, no
rows; of several places in a document the best one of each passage is reported, the first of equals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curaspark.llm import common

BITS = 16
_PLAIN = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalnum():
        _PLAIN[_b] = 32


def plain_words(texts: pa.Array):
    """(first row, last row, hashes, offsets) of runs of texts, punctuation as spaces.

    Runs are lower-cased and hashed one after the other, so that a large batch costs no copies of itself.
    """
    for i, j, own in common.runs_of(texts, common.RUN_BYTES):
        raw, offsets = common.text_buffer(pc.utf8_lower(own))
        yield i, j, *common.hashed_words(_PLAIN[raw], offsets)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log(documents / documents with a word of the hash bucket), over all documents."""

    def run(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for i, j, hashed, at in plain_words(batch.column("text")):
                n += j - i
                owner = np.repeat(np.arange(j - i, dtype=np.int64), np.diff(at))
                total += np.bincount(np.unique(owner << BITS | (hashed >> np.uint64(64 - BITS)).astype(np.int64)) & (1 << BITS) - 1, minlength=1 << BITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(total[some], n))], ["bucket", "n"])

    # at most 2**16 + 1 rows, whatever the number of documents
    rows = common.map_arrow(docs.select("text"), run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r.bucket: r.n for r in rows}
    df = np.array([found.get(b, 0) for b in range(1 << BITS)], np.float64)
    return np.log((1.0 + found.get(-1, 0)) / (1.0 + df)).astype(np.float32) + np.float32(0.1)


@dataclass
class PassageIndex:
    idf: np.ndarray
    vocabulary: np.ndarray
    space: np.ndarray
    ids: list
    words: list[np.ndarray]
    latent: np.ndarray
    least: np.ndarray
    scale: np.ndarray
    answers: list[np.ndarray]
    #: per term (offsets) the passages for which it is an anchor, how often, and how many anchors a passage needs
    posted: np.ndarray
    posted_item: np.ndarray
    posted_times: np.ndarray
    needed: np.ndarray
    #: the same by passage: offsets and terms
    anchored: np.ndarray
    anchors: np.ndarray

    def holders(self, term: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sorted row * passages + passage of the pairs that may match."""
        n = len(self.words)
        row = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))[term >= 0]
        pair = np.unique(row * len(self.vocabulary) + term[term >= 0])
        row, own = pair // len(self.vocabulary), pair % len(self.vocabulary)
        many = self.posted[own + 1] - self.posted[own]
        spot = np.repeat(self.posted[own] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        keys, where = np.unique(np.repeat(row, many) * n + self.posted_item[spot], return_inverse=True)
        return keys[np.bincount(where, weights=self.posted_times[spot], minlength=len(keys)) >= self.needed[keys % n]]


def _anchors(words: list[np.ndarray], terms: np.ndarray, idf: np.ndarray, similar: float) -> tuple:
    """The rarest seven tenths of each passage's words: of them at most what a match may lack is absent."""
    term, item, times, needed = [], [], [], np.zeros(len(words))
    for k, own in enumerate(words):
        weight = idf[(own >> np.uint64(64 - BITS)).astype(np.int64)]
        chosen = own[np.argsort(-weight, kind="stable")[: -(-7 * len(own) // 10)]]
        lacking = len(own) - int(np.ceil(similar * len(own)))
        needed[k] = max(1, len(chosen) - lacking)
        distinct, n = np.unique(chosen, return_counts=True)
        term.append(np.searchsorted(terms, distinct))
        item.append(np.full(len(distinct), k))
        times.append(n)
    term, item, times = np.concatenate(term), np.concatenate(item), np.concatenate(times)
    order = np.argsort(term, kind="stable")
    by_item = np.searchsorted(item, np.arange(len(words) + 1))
    return np.searchsorted(term[order], np.arange(len(terms) + 1)), item[order], times[order], needed, by_item, term


def _scales(lengths: np.ndarray) -> np.ndarray:
    return np.maximum(8, 2 ** np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))


def _decomposed(rows: DataFrame, idf: np.ndarray, rank: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, right singular vectors) of the normalised TF-IDF rows of a table (item_id, words)."""
    spark = rows.sparkSession
    held_idf = spark.sparkContext.broadcast(idf)
    table = "term bigint, v binary"

    def weights(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        terms, times = np.unique(words, return_counts=True)
        w = times * idf[(terms >> np.uint64(64 - BITS)).astype(np.int64)]
        return terms, w / max(float(np.linalg.norm(w)), 1e-9)

    def batch_of(keys, vectors, name="term", kind=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, kind or pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())], [name, "v"])

    def added(key: str):
        def add(frame: pd.DataFrame) -> pd.DataFrame:
            out = frame.groupby(key)["v"].agg(lambda v: np.sum([np.frombuffer(x) for x in v], axis=0).tobytes()).reset_index()
            return out[[key, "v"]]

        return add

    def product(model) -> DataFrame:
        """The rows of A'A times a matrix over the terms; None: the random sketch, made from each term's hash."""
        held = spark.sparkContext.broadcast(model)

        def run(batches):
            model, idf = held.value, held_idf.value
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for words in batch.column("words").to_pylist():
                    terms, w = weights(np.array(words, np.int64).view(np.uint64), idf)
                    if model is None:
                        right = np.stack([np.random.default_rng(int(t)).standard_normal(rank) for t in terms])
                    else:
                        right = model[1][np.searchsorted(model[0], terms)]
                    y = (w @ right).astype(np.float64)
                    for t, x in zip(terms.view(np.int64).tolist(), w.tolist()):
                        sums[t] = sums[t] + x * y if t in sums else x * y
            yield batch_of(list(sums), sums.values())

        parts = common.map_arrow(rows, run, table)
        return common.stored(parts.groupBy(F.pmod("term", F.lit(64)).alias("part")).applyInPandas(added("term"), table))

    def orthonormal(sums: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Orthonormal columns by the inverse root of the Gram matrix, which is added up over the tasks."""

        def gram(batches):
            total = 0
            for batch in batches:
                own = np.stack([np.frombuffer(v) for v in batch.column("v").to_pylist()]) if len(batch) else np.zeros((0, rank))
                total = total + own.T @ own
            if not isinstance(total, int):
                yield batch_of(range(rank), total, "row", pa.int32())

        matrix = np.zeros((rank, rank))
        # rank rows of rank numbers
        for r in common.map_arrow(sums, gram, "row int, v binary").groupBy(F.pmod("row", F.lit(16)).alias("part")).applyInPandas(added("row"), "row int, v binary").collect():
            matrix[r.row] = np.frombuffer(r.v)
        values, vectors = np.linalg.eigh(matrix)
        kept = values > 1e-10 * max(values[-1], 1e-300)
        held = spark.sparkContext.broadcast(vectors[:, kept] / np.sqrt(values[kept]))

        def turn(batches):
            for batch in batches:
                own = [(np.frombuffer(v) @ held.value).astype(np.float32) for v in batch.column("v").to_pylist()]
                yield batch_of(batch.column("term").to_pylist(), own)

        # at most max_terms rows of rank numbers
        out = common.map_arrow(sums, turn, table).toArrow()
        terms = out.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        space = np.frombuffer(b"".join(out.column("v").to_pylist()), np.float32).reshape(len(terms), -1)
        return terms[order], space[order]

    model = orthonormal(product(None))
    for _ in range(power):
        model = orthonormal(product(model))
    return model


def passage_words(passages: DataFrame) -> DataFrame:
    """(item_id, words) of the passages that have words, equal ones once, as a stored table."""

    def run(batches):
        for batch in batches:
            for i, j, hashed, at in plain_words(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(i, j - i), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashed.view(np.int64)))], ["item_id", "words"])

    kind = passages.schema["item_id"].dataType.simpleString()
    return common.stored(common.map_arrow(passages.select("item_id", "text"), run, f"item_id {kind}, words array<bigint>").filter(F.size("words") > 0).distinct())


def blocks_of(rows: DataFrame, block: int, max_words: int, max_terms: int) -> list[DataFrame]:
    """The passages in as many parts, by hash, as it takes for each to keep the bounds (or to be one passage)."""
    n = 1
    while True:
        parts = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(n)))
        sizes = parts.groupBy("part").agg(F.count("*").alias("items"), F.sum(F.size("words")).alias("words"))
        terms = parts.select("part", F.explode("words").alias("term")).distinct().groupBy("part").agg(F.count("*").alias("terms"))
        over = sizes.join(terms, "part").filter(F.col("items") > 1).agg(F.max(F.greatest(F.col("items") / block, F.col("words") / max_words, F.col("terms") / max_terms)).alias("over")).first().over or 0.0
        if over <= 1:
            return [parts.filter(F.col("part") == k).drop("part") for k in range(n)]
        n *= 2 ** max(1, int(over).bit_length() - 1)


def fit(passages: DataFrame, idf: np.ndarray, rank: int = 256, cosine: float = 0.45, power: int = 1, similar: float = 0.6) -> PassageIndex | None:
    """Index one block of passages (item_id, text)."""
    return fit_words(passage_words(passages), idf, rank, cosine, power, similar)


def fit_words(rows: DataFrame, idf: np.ndarray, rank: int = 256, cosine: float = 0.45, power: int = 1, similar: float = 0.6) -> PassageIndex | None:
    """Index one block of passages (item_id, words)."""
    held = rows.toArrow()
    ids = held.column("item_id").to_pylist()
    lists = [np.array(w.values, np.int64) for w in held.column("words")]
    order = sorted(range(len(ids)), key=lambda k: (str(ids[k]), lists[k].tolist()))
    if not order:
        return None
    rank = min(rank, len(order))
    terms, space = _decomposed(rows, idf, rank, power)
    ids, words = [ids[k] for k in order], [lists[k].view(np.uint64) for k in order]
    latent, kept, answers = np.zeros((len(words), space.shape[1]), np.float32), np.zeros(len(words)), []
    for k, own in enumerate(words):
        w = idf[(own >> np.uint64(64 - BITS)).astype(np.int64)]
        latent[k] = (space[np.searchsorted(terms, own)] * w[:, None]).sum(axis=0)
        distinct, times = np.unique(own, return_counts=True)
        weight = idf[(distinct >> np.uint64(64 - BITS)).astype(np.int64)]
        kept[k] = np.linalg.norm(latent[k]) / max(float(np.linalg.norm(times * weight)), 1e-9)
        answers.append(distinct[np.argsort(-weight, kind="stable")[:6]])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return PassageIndex(idf, terms, space, ids, words, latent, (cosine * np.minimum(kept, 1)).astype(np.float32), _scales(np.array([len(w) for w in words])), answers, *_anchors(words, terms, idf, similar))


def common_subsequence(pattern: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, a machine word's bits at a time."""
    masks: dict[int, int] = {}
    for k, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(pattern)) - 1
    row = full
    for word in text:
        mask = masks.get(word)
        if mask:
            low = row & mask
            row = (row + low | row - low) & full
    return len(pattern) - row.bit_count()


def _windows(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of overlapping windows over n words; the last one ends with them."""
    step = max(size // 4, 1)
    start = np.minimum(np.arange(max(-(-(n - size) // step), 0) + 1) * step, max(n - size, 0))
    return start, np.minimum(start + size, n)


def _best_place(index: PassageIndex, item: int, words: np.ndarray, term: np.ndarray, weight: np.ndarray, similar: float, sure: float):
    """(similarity, cosine, first word) of the best verified window of one text for one passage."""
    size, own = int(index.scale[item]), index.words[item]
    start, end = _windows(len(words), size)
    anchor = np.zeros(len(index.vocabulary) + 1, bool)  # the last place is for other words, whose term is -1
    anchor[index.anchors[index.anchored[item] : index.anchored[item + 1]]] = True
    marked = np.concatenate([[0], np.cumsum(anchor[term])])
    enough = marked[np.minimum(end + size // 2, len(words))] - marked[np.maximum(start - size // 2, 0)] >= index.needed[item]
    if not enough.any():
        return None
    # no more words of the passage than its region holds can be in common, each as often as in the passage
    low, high = np.maximum(start - len(own) // 2, 0), np.minimum(end + len(own) // 2, len(words))
    distinct, times = np.unique(own, return_counts=True)
    place = np.full(len(index.vocabulary) + 1, len(distinct))
    place[np.searchsorted(index.vocabulary, distinct)] = np.arange(len(distinct))
    local = place[term]
    held = np.concatenate([[0], np.cumsum(local < len(distinct))])
    open_windows = []
    for w in np.flatnonzero(enough & ((held[high] - held[low]) / len(own) >= similar)).tolist():
        most = float(np.minimum(np.bincount(local[low[w] : high[w]], minlength=len(distinct) + 1)[:-1], times).sum()) / len(own)
        if most < similar:
            continue
        known, weights = term[start[w] : end[w]], weight[start[w] : end[w]].astype(np.float64)
        folded = weights[known >= 0] @ index.space[known[known >= 0]]
        cosine = float(folded @ index.latent[item]) / max(float(weights @ weights), 1e-9) ** 0.5
        open_windows.append((cosine < index.least[item], -most, w, cosine))
    best = None
    pattern = own.tolist()
    for _, most, w, cosine in sorted(open_windows):
        if best is not None and -most < best[0]:
            continue
        region = words[low[w] : high[w]]
        shared = common_subsequence(pattern, region.tolist()) / len(own)
        if shared < similar or shared < sure and np.isin(index.answers[item], region).mean() < 0.5:
            continue
        if best is None or (shared, cosine, -int(start[w])) > (best[0], best[1], -best[2]):
            best = (shared, cosine, int(start[w]))
    return best


def _matches(index: PassageIndex, hashed: np.ndarray, at: np.ndarray, flags: np.ndarray, similar: float, sure: float):
    """(row, item, similarity, cosine, first word) of the verified places of a run of texts."""
    bucket = (hashed >> np.uint64(64 - BITS)).astype(np.int64)
    maybe = np.flatnonzero(flags[bucket])
    term = np.full(len(hashed), -1, np.int64)
    place = np.minimum(np.searchsorted(index.vocabulary, hashed[maybe]), len(index.vocabulary) - 1)
    same = index.vocabulary[place] == hashed[maybe]
    term[maybe[same]] = place[same]
    found = []
    for pair in index.holders(term, at).tolist():
        row, item = divmod(pair, len(index.words))
        a, b = int(at[row]), int(at[row + 1])
        best = _best_place(index, item, hashed[a:b], term[a:b], index.idf[bucket[a:b]], similar, sure)
        if best:
            found.append((row, item, *best))
    return found


def find_passages(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = 0.6, sure: float = 0.8,
    block: int = 20_000, max_words: int = 4_000_000, max_terms: int = 65_536, rank: int = 256,
) -> DataFrame:
    """(doc_id, item_id, similarity, cosine, first_word) of every benchmark passage in every document.

    ``first_word`` is the number of the first word of the window that was compared, which may begin some words before the
    passage. Identifiers keep their types. Null texts hold nothing; a document with a null id is told with a null id.
    """
    docs = common.id_and_text(docs, id_col, text_col)
    passages = passage_words(benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null"))
    doc_kind, item_kind = docs.schema["doc_id"].dataType, passages.schema["item_id"].dataType
    schema = f"doc_id {doc_kind.simpleString()}, item_id {item_kind.simpleString()}, similarity double, cosine double, first_word bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    some = passages.limit(1).count() > 0
    idf = inverse_frequencies(docs) if some else None
    for number, part in enumerate(blocks_of(passages, block, max_words, max_terms) if some else []):
        index = fit_words(part, idf, rank, similar=similar)
        if index is None:
            continue
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            index = held.value
            flags = np.zeros(1 << BITS, bool)
            flags[(index.vocabulary >> np.uint64(64 - BITS)).astype(np.int64)] = True
            for batch in batches:
                for i, _, hashed, at in plain_words(batch.column("text")):
                    rows = _matches(index, hashed, at, flags, similar, sure)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([i + r[0] for r in rows], pa.int64())),
                            pa.array([index.ids[r[1]] for r in rows], to_arrow_type(item_kind)),
                            *[pa.array([float(r[k]) for r in rows], pa.float64()) for k in (2, 3)],
                            pa.array([r[4] for r in rows], pa.int64()),
                        ],
                        ["doc_id", "item_id", "similarity", "cosine", "first_word"],
                    )

        own = common.map_arrow(docs, run, schema)
        found = own if number == 0 else found.unionByName(own)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **rules) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, columns as they were. A row with a null id can't be told by it and stays."""
    name = common.fresh("leak", docs)
    leaks = common.stored(find_passages(docs, benchmark, **rules).select(F.col("doc_id").alias(name)).distinct())
    return docs.join(common.if_small(leaks), F.col("doc_id") == F.col(name), "left_anti")
