"""Spelling variants, exact repeats and hard negatives against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from oracle import connect, oracle_rows, rows_of
from pyspark.sql import functions as F

from curaspark.llm import hard_negatives, queries, spelling, substring_dedup

EXTRA = ("word", "near", "n", "size", "first", "body", "starts", "ends", "kept", "chunk", "part", "id", "vec", "score", "negative", "block")


def clashing(df):
    for name in EXTRA:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


# ---- 11: spelling variants ----


def spelling_by_hand(rows, damage=199, min_length=6, min_count=5, ratio=5):
    n = collections.Counter()
    for d, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            if h % damage == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            n[r] += 1
    words = {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}
    return groups_by_hand(words, ratio)


def groups_by_hand(words, ratio=5):
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            if w[:k] + w[k + 1 :] in words:
                near[w].add(w[:k] + w[k + 1 :])
                near[w[:k] + w[k + 1 :]].add(w)
    for a in words:
        for b in words:
            if len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1:
                near[a].add(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), k, len(near[w]), words[form[w]] if w in form else None) for w, k in words.items()}


def groups(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


@pytest.mark.parametrize("split", [1, 3, 1000])
def test_spelling_groups_of_random_words(spark, monkeypatch, split):
    monkeypatch.setattr(spelling, "SPLIT", split)
    rng = random.Random(split)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))): 5 ** rng.randrange(5) for _ in range(150)}
    words |= {"x" * 40: 3, "x" * 41: 30, "x" * 39 + "y": 300, "ÿ×÷ÿ×÷": 2, "ÿ×÷ÿ×": 40}
    df = clashing(spark.createDataFrame([*words.items(), (None, 4), ("abab", None)] if "abab" not in words else [*words.items(), (None, 4)], "word string, n long"))
    assert groups(spelling.spelling_groups(df)) == groups_by_hand(words)


def test_spelling_of_an_empty_vocabulary(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0


def test_letter_runs_lower_only_ascii(spark):
    docs = clashing(spark.createDataFrame([(1, "ÀB-cD É1é×a"), (2, None), (None, "Zz"), (3, "")], "doc_id long, text string"))
    assert {tuple(r) for r in spelling.letter_runs(docs).collect()} == {(1, "Àb"), (1, "cd"), (1, "É"), (1, "é×a"), (None, "zz")}


def test_op11_on_whole_small_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert groups(queries.op11_spelling(spark, sf)) == spelling_by_hand(rows)


# ---- 12: exact repeats ----


def repeats_by_hand(rows, window):
    seen = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in sorted((r for r in split if r[0] is not None), key=lambda r: r[0]):
        for s in range(len(words) - window + 1):
            seen.setdefault(tuple(words[s : s + window]), (d, s))
    out = []
    for d, words in split:
        gone = set()
        for s in range(len(words) - window + 1 if d is not None else 0):
            if seen[tuple(words[s : s + window])] < (d, s):
                gone.update(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "chunk"), [(4, 40), (5, 1), (20, 1 << 20)])
def test_repeats_of_random_texts(spark, monkeypatch, window, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab") + str(rng.randrange(3)) for _ in range(rng.randrange(120))) for _ in range(40)]
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [f"{k} {passage}\t{k}" for k in range(25)] + [texts[0], texts[1], "", " \n ", None, "a " * 500, "a " * 501, passage + " tail", "é " + passage, "  " + passage]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, passage)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = substring_dedup.drop_repeats(df, window)
    assert sorted((tuple(r) for r in got.collect()), key=str) == repeats_by_hand(rows, window)


def test_repeated_rows_are_one_document(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(5, text), (5, text), (5, "other " + text), (9, text), (7, text + " " + text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.drop_repeats(df, 20, texts=False).collect())
    assert got == [(5, 30, 0), (5, 30, 0), (5, 31, 0), (7, 60, 60), (9, 30, 30)]


def test_repeats_by_dealing_instead_of_broadcasting(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SMALL", 0)
    rows = [(k, " ".join(map(str, range(k % 3, 40)))) for k in range(30)]
    got = substring_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == repeats_by_hand(rows, 20)


def test_no_documents_no_repeats(spark):
    assert substring_dedup.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op12_equals_sql(spark, sf):
    df = queries.op12_substring_dedup(spark, sf)
    columns = sorted(df.columns)
    assert rows_of(df, columns) == oracle_rows(connect(sf), substring_dedup.REPEATS_SQL, columns)


# ---- 13: hard negatives ----


def negatives_by_hand(rows, anchors, k=5, low=80, high=100):
    out = []
    for a, label, vec in anchors:
        def score(other):
            return sum(x * y for x, y in zip(vec, other))

        scored = sorted(((-score(v), i, la) for i, la, v in rows if i != a), key=lambda s: s[:2])
        for p, i, _ in [s for s in scored if s[2] == label][:k]:
            fits = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:k]
            out += [(a, i, rank, n[1], -p, -n[0]) for rank, n in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize(("rows_in", "anchors_in", "reach", "high"), [(4096, 512, 3, 100), (7, 2, 3, 100), (5, 3, 1 << 33, 95)])
def test_hard_negatives_of_random_vectors(spark, monkeypatch, rows_in, anchors_in, reach, high):
    monkeypatch.setattr(hard_negatives, "ROWS", rows_in)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors_in)
    rng = random.Random(rows_in)
    rows = [(k, rng.randrange(3), [rng.randrange(-reach, reach + 1) // (1 if reach < 9 else 9) for _ in range(rng.choice([4, 4, 4, 2, 0]))]) for k in range(90)]
    rows += [(100 + k, k % 2, [3, 3, 3, 3]) for k in range(40)] + [(200, 7, [1, 1, 1, 1])]
    df = clashing(spark.createDataFrame([*rows, (None, 1, [1]), (300, None, [1]), (301, 1, None)], "id long, label long, vec array<long>").repartition(3))
    anchors = [r for r in rows if r[0] % 9 == 0 or r[0] == 200]
    got = hard_negatives.hard_negatives(df, df.filter("id % 9 = 0 or id = 200"), high=high)
    assert sorted(tuple(r) for r in got.collect()) == negatives_by_hand(rows, anchors, high=high)


def test_no_anchors_or_rows_no_negatives(spark):
    none = spark.createDataFrame([], "id long, label long, vec array<long>")
    one = spark.createDataFrame([(1, 1, [1])], none.schema)
    for rows, anchors in ((none, none), (one, none), (none, one), (one, one)):
        assert hard_negatives.hard_negatives(rows, anchors).count() == 0


def test_quantised_leaves_out_what_is_not_finite(spark):
    data = [(1, 2, [0.5, -0.001]), (2, 2, [math.nan]), (3, 2, [math.inf]), (4, None, [1.0]), (5, 1, None), (None, 1, [1.0]), (6, 1, [None, 1.0]), (7, 1, [])]
    df = clashing(spark.createDataFrame(data, "vec_id long, label int, embedding array<float>"))
    assert sorted(tuple(r) for r in hard_negatives.quantised(df).collect()) == [(1, 2, [128, -1]), (7, 1, [])]


def test_op13_equals_sql(spark, sf):
    df = queries.op13_hard_negatives(spark, sf)
    columns = sorted(df.columns)
    assert rows_of(df, columns) == oracle_rows(connect(sf), hard_negatives.NEGATIVES_SQL, columns)
