"""Exact repeats of ``window`` words and more, found by anchors: non-overlapping blocks of half a window.

Every stretch of ``window`` words holds a whole block of the earlier copy, so a repeat can't start anywhere but around a rolling
window of a block's length that is the same as some block elsewhere. ``anchored`` finds those places; ``repeated`` extends
them: all windows of full length over an anchor, exact by 96 bits, of which the first in order stays; overlapping ones
merge to maximal repeats, as intervals of words for each document.

What tasks exchange is packed: a run of documents (a chunk) sends each of ``parts`` parts of the hash range one row with the hashes
that lie there and their places. A hash leaves a chunk once, however often it stands there, so a passage that a third of all
documents share costs each part one entry a chunk. Answers go back by chunk, where a header row knows the documents.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common

WINDOW = 20
#: Words of a chunk, and bytes of text for which there is a part of the hash range.
CHUNK, PART_BYTES = 1 << 20, 8 << 20
#: Interval ends up to which a counted table of intervals may be broadcast (16 MB or so).
SMALL = 1_000_000
_ASK, _PLACES, _HEAD = 0, 1, 2
_ROW = "part int, chunk long, kind int, hashes binary, ids binary, places binary"
_NAMES = [f.split(" ")[0] for f in _ROW.split(", ")]
_SPANS = "doc_id long, body long, starts array<int>, ends array<int>"
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


# ---- packing ----


def _pack(values: np.ndarray) -> bytes:
    """Numbers as differences, the bytes of equal weight together: rising ones are mostly zeros, which the shuffle compresses."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel())


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def _rolling(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A hash of the n words from each place on; the last n - 1 places run over the end and mean nothing."""
    out = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in reversed(range(n)):
            out *= base
            out[: len(words) - k] += words[k:]
    return common.mix64(out)


class _Chunk:
    """Word hashes of a run of documents: ``at`` holds the ends of each, ``start`` and ``end`` of each word's document."""

    def __init__(self, ids: list, bodies: list, words: list[np.ndarray], spans: list):
        counts = np.array([len(w) for w in words], np.int64)
        self.words, self.at, self.spans = np.concatenate(words) if words else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)]), spans
        self.ids, self.bodies = np.array(ids, np.int64), np.array(bodies, np.int64)
        self.doc = np.repeat(np.arange(len(ids)), counts)
        self.start, self.end = self.at[:-1][self.doc], self.at[1:][self.doc]
        told = hashlib.blake2b(self.ids.tobytes() + self.bodies.tobytes() + self.at.tobytes(), digest_size=8)
        self.name = int.from_bytes(told.digest(), "little", signed=True)

    def head(self, parts: int) -> tuple:
        return (self.name % parts, self.name, _HEAD, self.bodies.tobytes(), self.ids.tobytes(), self.at.astype(np.int64).tobytes())


def _chunks(batches):
    """Documents (doc_id, body, text, and starts and ends where intervals are given) by about ``CHUNK`` words."""
    ids, bodies, words, spans, n = [], [], [], [], 0
    for batch in batches:
        raw, offsets = common.text_buffer(batch.column("text"))
        given = list(zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist())) if "starts" in batch.schema.names else [None] * batch.num_rows
        keys, texts = batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()
        for i, j, part, at in common.chunks(raw, offsets):
            hashed, cut = common.hashed_words(part, at, lower=False)
            for k in range(i, j):
                ids.append(keys[k])
                bodies.append(texts[k])
                spans.append(given[k])
                words.append(hashed[cut[k - i] : cut[k - i + 1]])
                n += len(words[-1])
            if n >= CHUNK:
                yield _Chunk(ids, bodies, words, spans)
                ids, bodies, words, spans, n = [], [], [], [], 0
    if ids:
        yield _Chunk(ids, bodies, words, spans)


def _asked(chunk: _Chunk, parts: int, part: np.ndarray, places: np.ndarray, hashes, ids=None):
    """A row for each part with the hashes that lie there, in the order of their places."""
    order = np.lexsort((places, part))
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = order[a:b]
        yield (int(part[own[0]]), chunk.name, _ASK, hashes(own), _pack(ids[own]) if ids is not None else b"", _pack(places[own]))


def _exchange(docs: DataFrame, ask, answer, gather, parts: int) -> DataFrame:
    """Chunks ask the parts of the hash range, each part answers with places in chunks, each chunk gathers its answers."""
    common.ship(docs.sparkSession)
    asked = docs.mapInArrow(partial(ask, parts=parts), _ROW)
    answered = asked.groupBy("part").applyInArrow(lambda rows: _answered(rows, answer), _ROW)
    return answered.groupBy("chunk").applyInArrow(lambda rows: _gathered(rows, gather), _SPANS)


def _answered(table: pa.Table, answer) -> pa.Table:
    """Rows that ask become the places that ``answer`` marks; others pass."""
    rows = table.select(_NAMES).to_pylist()
    asking = [r for r in rows if r["kind"] == _ASK]
    out = [tuple(r[n] for n in _NAMES) for r in rows if r["kind"] != _ASK]
    if asking:
        places = [_unpack(r["places"]) for r in asking]
        marked = answer(asking, places)
        at = np.cumsum([0, *map(len, places)])
        for r, own, a, b in zip(asking, places, at[:-1], at[1:]):
            found = own[marked[a:b]] >> 2
            if len(found):
                out.append((r["part"], r["chunk"], _PLACES, b"", b"", _pack(found)))
    return pa.Table.from_batches([_rows(out)])


def _gathered(table: pa.Table, gather) -> pa.Table:
    rows = table.select(_NAMES).to_pylist()
    head = next(r for r in rows if r["kind"] == _HEAD)
    ids, bodies, at = (np.frombuffer(head[c], np.int64) for c in ("ids", "hashes", "places"))
    found = [_unpack(r["places"]) for r in rows if r["kind"] == _PLACES]
    out: dict[str, list] = {"doc_id": [], "body": [], "starts": [], "ends": []}
    if found:
        places = np.unique(np.concatenate(found))
        doc = np.searchsorted(at, places, side="right") - 1
        first, last = gather(places, at[doc], at[doc + 1])
        kept = first < last
        edge = np.zeros(int(at[-1]) + 1, np.int64)
        np.add.at(edge, first[kept], 1)
        np.add.at(edge, last[kept], -1)
        inside = np.cumsum(edge) > 0
        # intervals end with their document
        turn = np.diff(inside.astype(np.int8), prepend=0)
        cut = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < at[-1])]
        cut = np.unique(cut[inside[cut] & inside[cut - 1]])
        starts, ends = (np.sort(np.concatenate([np.flatnonzero(turn == k), cut])) for k in (1, -1))
        owner = np.searchsorted(at, starts, side="right") - 1
        for d in np.unique(owner):
            own = owner == d
            for name, value in zip(out, (int(ids[d]), int(bodies[d]), (starts[own] - at[d]).tolist(), (ends[own] - at[d]).tolist())):
                out[name].append(value)
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})


# ---- anchors: blocks of half a window ----


def _ask_blocks(batches, window: int, parts: int):
    n = max(1, window // 2)
    for c in _chunks(batches):
        rows = [c.head(parts)]
        place = np.flatnonzero(c.end - np.arange(len(c.words)) >= n)
        h = _rolling(c.words, n, _BASES[0])[place]
        block = (place - c.start[place]) % n == 0
        order = np.argsort(h, kind="stable")
        new = np.diff(h[order], prepend=~h[order][:1]) != 0
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        many = np.bincount(run, minlength=len(first)) > 1
        blocks = np.zeros(len(first), bool)
        np.logical_or.at(blocks, run, block[order])
        own = np.sort(place[order][many[run]]) if len(first) else place
        if len(own):
            rows.append((c.name % parts, c.name, _PLACES, b"", b"", _pack(own)))
        entry = order[first]
        value, prints = (place[entry] << 2) | (blocks.astype(np.int64) | (many.astype(np.int64) << 1)), h[entry]
        part = ((prints >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        rows += _asked(c, parts, part, value, lambda own, p=prints: p[own].astype(np.uint32).tobytes())
        yield _rows(rows)


def _answer_blocks(asking: list[dict], places: list[np.ndarray]) -> np.ndarray:
    """Places whose hash is a block's and stands at two places or more. 32 bits within a part: a few more are harmless here."""
    prints, code = np.concatenate([np.frombuffer(r["hashes"], np.uint32) for r in asking]), np.concatenate(places) & 3
    _, run = np.unique(prints, return_inverse=True)
    n = np.bincount(run, weights=1 + (code >> 1))
    block = np.bincount(run, weights=code & 1) > 0
    return (block & (n > 1))[run] & (code < 2)


def _around(places, start, end, window: int):
    """Starts of whole windows over a block at each place, as [first, last)."""
    return np.maximum(places - (window - max(1, window // 2)), start), np.minimum(places, end - window) + 1


# ---- whole windows ----


def _ask_windows(batches, window: int, parts: int):
    for c in _chunks(batches):
        rows = [c.head(parts)]
        edge = np.zeros(len(c.words) + 1, np.int64)
        for d, span in enumerate(c.spans):
            a = np.clip(np.array(span[0], np.int64), 0, c.at[d + 1] - c.at[d]) + c.at[d]
            b = np.clip(np.array(span[1], np.int64), 0, c.at[d + 1] - c.at[d]) + c.at[d]
            np.add.at(edge, a, 1)
            np.add.at(edge, b, -1)
        place = np.flatnonzero((np.cumsum(edge)[:-1] > 0) & (c.end - np.arange(len(c.words)) >= window))
        h, g = (_rolling(c.words, window, base)[place] for base in _BASES)
        g = g.astype(np.uint32)
        doc = c.doc[place]
        ids, bodies = c.ids[doc], c.bodies[doc]
        order = np.lexsort((place, doc, bodies, ids, g, h))
        same = (np.diff(h[order], prepend=~h[order][:1]) == 0) & (np.diff(g[order].astype(np.int64), prepend=-1) == 0)
        first = np.flatnonzero(~same)
        run = np.cumsum(~same) - 1
        least = ids[order][first][run] if len(first) else ids
        again = same & (np.diff(ids[order], prepend=0) == 0) & (np.diff(bodies[order], prepend=0) == 0) & (np.diff(doc[order], prepend=-1) == 0)
        gone = (ids[order] > least) | again
        if gone.any():
            rows.append((c.name % parts, c.name, _PLACES, b"", b"", _pack(np.sort(place[order][gone]))))
        entry = order[~gone]
        value, hh, gg = place[entry] << 2, h[entry], g[entry]
        part = ((hh >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        rows += _asked(c, parts, part, value, lambda own, hh=hh, gg=gg: hh[own].tobytes() + gg[own].tobytes(), ids[entry])
        yield _rows(rows)


def _answer_windows(asking: list[dict], places: list[np.ndarray]) -> np.ndarray:
    """Places whose window stands in a smaller document too."""
    n = [len(p) for p in places]
    h = np.concatenate([np.frombuffer(r["hashes"], np.uint64, k) for r, k in zip(asking, n)])
    g = np.concatenate([np.frombuffer(r["hashes"], np.uint32, k, 8 * k) for r, k in zip(asking, n)])
    ids = np.concatenate([_unpack(r["ids"]) for r in asking])
    order = np.lexsort((ids, g, h))
    new = np.diff(h[order], prepend=~h[order][:1]) != 0
    new |= np.diff(g[order].astype(np.int64), prepend=-1) != 0
    marked = np.zeros(len(ids), bool)
    marked[order] = ids[order] > ids[order][new][np.cumsum(new) - 1]
    return marked


def _covered(places, start, end, window: int):
    return places, places + window


# ---- documents ----


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = common.id_and_text(docs, id_col, text_col)
    return plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text")


def _one_each(spans: DataFrame) -> DataFrame:
    """A row for each document and text; repeated rows bring the same intervals more than once."""
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
    return spans.groupBy("doc_id", "body").agg(flat("starts"), flat("ends"))


def _beside(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Documents with their stored intervals: broadcast where these are few by count, dealt by document beyond."""
    n = spans.agg(F.sum(F.size("starts") + 1)).first()[0] or 0
    return docs.join(F.broadcast(spans) if n <= SMALL else spans, ["doc_id", "body"], how)


def repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, starts, ends): maximal runs of words, as intervals of word numbers, that windows cover which also start
    earlier (in a smaller document, or earlier in the same text). ``body`` is xxhash64 of the text. Documents without are left out.

    Null ids and null texts take no part. Rows of one id with different texts are no copies of each other; repeated rows are one.
    """
    all_docs = _prepared(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    size = all_docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    ask, around = partial(_ask_blocks, window=window), partial(_around, window=window)
    anchored = common.stored(_one_each(_exchange(all_docs, ask, _answer_blocks, around, parts)))
    ask, covered = partial(_ask_windows, window=window), partial(_covered, window=window)
    return _one_each(_exchange(_beside(all_docs, anchored, "inner"), ask, _answer_windows, covered, parts))


def _cut(batches, texts: bool):
    for batch in batches:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        columns = (batch.column(c).to_pylist() for c in ("text", "starts", "ends"))
        for text, starts, ends in zip(*columns):
            words = (text or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for a, b in zip(starts or [], ends or []):
                gone[a] += 1
                gone[b] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if gone.any() else b" ".join(words)
            for name, value in zip(out, (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept if texts else None)):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.binary())], ["doc_id", *out])


def drop_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, text): each row's words ``[^\\x20\\x09-\\x0D]+`` without those that ``repeats`` tells,
    joined by one space. ``texts=False`` leaves the text null.

    One row for each row of docs; a null text has no words, a row with a null id keeps all of its own. No documents, no rows.
    """
    found = common.stored(repeats(docs, window, id_col, text_col))
    joined = _beside(_prepared(docs, id_col, text_col), found, "left")
    cut = common.map_arrow(joined.select("doc_id", "text", "starts", "ends"), partial(_cut, texts=texts), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256", F.decode("kept", "UTF-8").alias("text"))


#: The same by comparing the texts of all windows.
REPEATS_SQL = """WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS s FROM d),
v AS (SELECT doc_id, s, l[s] AS word, CASE WHEN s + 19 <= len(l) THEN array_to_string(l[s:s + 19], ' ') END AS win FROM w),
r AS (SELECT doc_id, s, word, CASE WHEN win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, s) > 1 THEN 1 ELSE 0 END AS again FROM v),
c AS (SELECT doc_id, s, word, max(again) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
k AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY s) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(l) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""
