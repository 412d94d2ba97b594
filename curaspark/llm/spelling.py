"""Spelling variants of a vocabulary: words one insertion, deletion or replacement apart.

Two such words differ at the end of their common prefix. So every word is put into groups by what it has outside of a window
of places (first half or second half); two near words meet in just one group, that whose window holds the place where they
part. A group beyond ``split`` words is divided into those of half its window, until a window is one place wide, so that no
group grows with the vocabulary and no pair is met twice. Groups are scanned in sorted order: each level of prefixes extends
the banded rows of the edit matrix of the level before, which neighbours share as far as their common prefix goes, and a
prefix more than one edit away from a query takes all words below it off that query's list.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a group before it is divided, and of the groups that are scanned together.
SPLIT, TOGETHER = 2000, 20_000
_GROUP = ("size", "first", "last", "outside")


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: int = 1) -> DataFrame:
    """(doc_id, run): the maximal runs of letters ``[A-Za-z\\u00C0-\\u00FF]+`` of that length, A-Z lower-cased."""
    found = common.id_and_text(docs, id_col, text_col)
    runs = found.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("r")).filter(F.length("r") >= at_least)
    return runs.select("doc_id", F.when(F.length("r") == F.octet_length("r"), F.lower("r")).otherwise(F.translate("r", _UPPER, _LOWER)).alias("run"))


def without_letter(word: Column, at: Column) -> Column:
    """A word without its code point ``at`` (from 0)."""
    at = at.cast("int")
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))


def count_words(words: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words that are long and frequent enough. Counts are summed in each task before they are shuffled."""
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# ---- groups ----


def _outside(first: Column, last: Column, size: Column) -> Column:
    """A hash of a word's text before and behind a window of places of the shorter word's ``size``."""
    word, behind = F.col("word"), F.greatest(size - last, F.lit(0))
    return F.xxhash64(F.substring(word, F.lit(1), first), F.substring(word, F.length("word") - behind + 1, behind))


def _placed(rows: DataFrame, windows: Column) -> DataFrame:
    """A row for each (size, first, last) of an array."""
    each = rows.withColumn("w", F.explode(windows)).select("word", "n", "w.size", "w.first", "w.last")
    return each.withColumn("outside", _outside(F.col("first"), F.col("last"), F.col("size")))


def _window(size: Column, first: Column, last: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), first.cast("int").alias("first"), last.cast("int").alias("last"))


def _grouped(words: DataFrame, split: int) -> DataFrame:
    """(word, n, size, first, last, outside): a word as the shorter or an equal one (size: its length) and as the longer one (one less)."""
    length = F.length("word")
    halves = [w for size in (length, length - 1) for half in [F.floor(size / 2)] for w in (_window(size, F.lit(0), half), _window(size, half, size + 1))]
    rows = common.stored(_placed(words, F.filter(F.array(*halves), lambda w: (w["size"] > 0) & (w["first"] < w["last"]))))
    done = None
    while True:
        hot = common.stored(rows.groupBy(*_GROUP).agg(F.count("*").alias("_n")).filter((F.col("_n") > split) & (F.col("last") - F.col("first") > 1)).drop("_n"))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        few = common.if_small(hot)
        calm = rows.join(few, list(_GROUP), "left_anti")
        done = calm if done is None else done.unionByName(calm)
        half = F.floor((F.col("first") + F.col("last")) / 2)
        cut = F.array(_window(F.col("size"), F.col("first"), half), _window(F.col("size"), half, F.col("last")))
        rows = common.stored(_placed(rows.join(few, list(_GROUP), "left_semi"), cut))


# ---- the scan ----


def _near(words: list[str], group: np.ndarray, size: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, found): numbers of words one edit apart within a group, where the edit lies in the group's window.

    ``words`` ascend in each group. A node is a prefix and the run of words that have it; pairs of a node and a query carry
    three cells of the edit matrix (one character less, as many, one more), capped at two.
    """
    length = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    base = np.cumsum(length) - length

    def letter(word, at):
        inside = (at >= 0) & (at < length[word])
        return np.where(inside, flat[np.where(inside, base[word] + at, 0)] if len(flat) else 0, -1)

    # the root of each group: what stands before the window is shared
    rows = np.arange(len(words))
    node = group.copy()
    depth = first.astype(np.int64)
    query, at = rows, group
    x, y, z = np.where(depth > 0, 1, 2), np.zeros(len(words), np.int64), np.where(length > depth, 1, 2)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(query):
        # words that end at this depth, at most one for each node
        ending = np.full(int(node.max(initial=-1)) + 1, -1)
        ends = length[rows] == depth[rows]
        ending[node[ends]] = rows[ends]
        r = ending[at]
        hit = np.flatnonzero(r >= 0)
        q, e = query[hit], r[hit]
        more = length[q] - length[e]
        cell = np.select([more == -1, more == 0, more == 1], [x[hit], y[hit], z[hit]], 2)
        good = (cell == 1) & (np.minimum(length[q], length[e]) == size[q])
        found.append((q[good], e[good]))
        # children: words of a node that go on with the same letter
        going = ~ends
        rows, parent = rows[going], node[going]
        if not len(rows):
            break
        char = letter(rows, depth[rows])
        new = (np.diff(parent, prepend=-1) != 0) | (np.diff(char, prepend=-2) != 0)
        node = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        child_char, child_parent, child_depth = char[begin], parent[begin], depth[rows[begin]]
        low = np.searchsorted(child_parent, at, side="left")
        n = np.searchsorted(child_parent, at, side="right") - low
        pair = np.repeat(np.arange(len(at)), n)
        child = low[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        q, c, d = query[pair], child_char[child], child_depth[child]
        px, py, pz = x[pair], y[pair], z[pair]
        nx = np.where(d <= length[q], np.minimum(px + (c != letter(q, d - 1)), py + 1), 2)
        ny = np.where(d + 1 <= length[q], np.minimum(np.minimum(py + (c != letter(q, d)), pz + 1), nx + 1), 2)
        nz = np.where(d + 2 <= length[q], np.minimum(pz + (c != letter(q, d + 1)), ny + 1), 2)
        # more than one edit away, or the same beyond the window: that pair is another group's
        kept = (np.minimum(np.minimum(nx, ny), nz) <= 1) & ~((ny == 0) & (d + 1 >= last[q]))
        query, at, x, y, z = q[kept], child[kept], *(np.minimum(m[kept], 2) for m in (nx, ny, nz))
        depth = depth + 1
    return tuple(np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def _scanned(rows: list[pa.Table]) -> pa.RecordBatch:
    table = pa.concat_tables(rows).combine_chunks()
    keys = np.stack([np.asarray(table[c]).astype(np.int64) for c in _GROUP])
    new = np.ones(table.num_rows, bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    table, keys, group = table.filter(pa.array(several)), keys[:, several], np.unique(group[several], return_inverse=True)[1]
    words, n = table["word"].to_pylist(), np.asarray(table["n"]).astype(np.int64)
    query, found = _near(words, group, *keys[:3])
    text = pa.array(words, pa.string())
    return pa.RecordBatch.from_pydict({"word": text.take(pa.array(query)), "near": text.take(pa.array(found)), "near_n": pa.array(n[found])})


def _scan(batches, together: int):
    """Whole groups, about ``together`` words at a time, of rows that come sorted by group and word."""
    held, n = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held.append(table)
        n += table.num_rows
        if n >= together and table.num_rows:
            keys = np.stack([np.asarray(table[c]).astype(np.int64) for c in _GROUP])
            turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            if len(turns):  # the last group may go on in the next batch
                at = int(turns[-1]) + 1
                yield _scanned([*held[:-1], table.slice(0, at)])
                held, n = [table.slice(at)], table.num_rows - at
    if n:
        yield _scanned(held)


def near_words(words: DataFrame, split: int | None = None) -> DataFrame:
    """(word, near, near_n): both orders of every two words of a table (word, n) that are one edit apart."""
    rows = _grouped(words, SPLIT if split is None else split)
    dealt = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "word")
    return common.map_arrow(dealt.select("word", "n", *_GROUP), partial(_scan, together=TOGETHER), "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): forms are followed to the last, twice as far each round. n rises
    from form to form, so chains end and are short."""
    reached = common.stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = common.stored(reached.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        reached = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return reached


def spelling_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a table (word, n) of different words.

    ``n_near`` counts the words one edit away. A word's form is the most frequent of these (ties: the smallest by code point), if it has at
    least ``ratio`` times the word's n (ratio above 1); its root is the last form of the chain, itself without a form. Null words
    and counts take no part; an empty vocabulary has no rows; other columns are left alone.
    """
    words = common.stored(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).filter("word is not null and n is not null"))
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("b"))
    joined = words.join(best, "word", "left")
    strong = -F.col("b.m") >= ratio * F.col("n")
    told = common.stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("b.near")).alias("form"), F.when(strong, -F.col("b.m")).alias("form_n")))
    roots = _roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
