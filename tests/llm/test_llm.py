"""Corpus operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, oracle_rows, rows_of
from pyspark.sql import functions as F

from curaspark.llm import common, components, decontam, gif, langid, line_dedup, mixing, ngram_join, pii, quality, queries, secret_scan, spans, tool_calls

DOC = "doc_id long, text string"
ODD = [None, "", "   ", "a", "\n\n", "É é", "word " * 5000, "x" * 70_000, "\u0000b", "日本語 テキスト", "A,b;C|d #1 @x.y 1.2.3.4"]


def docs_of(spark, texts, extra=False):
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC)
    if extra:
        for name in ("score", "lang_pred", "held_out", "n", "rep", "page", "label", "found", "spans", "_id", "rate", "frames"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


# ---- shared ----


def test_hashed_words_are_the_words(spark):
    raw, offsets = common.text_buffer(pa.array(ODD))
    hashed, at = common.hashed_words(raw, offsets)
    wanted = [words_of(t) for t in ODD]
    assert np.diff(at).tolist() == [len(w) for w in wanted]
    names = {}
    for word, h in zip((w for ws in wanted for w in ws), hashed.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_runs_of_texts_hold_every_row_once(kind):
    texts = [*ODD, None, "", "x" * 900, "é ß " * 40] * 3
    for column in (pa.array(texts, kind), pa.array(["before", None, *texts, "after"], kind).slice(2, len(texts))):
        for size in (1, 100, 1 << 20):
            runs = list(common.runs_of(column, size))
            assert [t for _, _, own in runs for t in own.to_pylist()] == texts
            assert [i for i, _, _ in runs] == [0, *(j for _, j, _ in runs[:-1])] and runs[-1][1] == len(texts)
            assert all(j - i == 1 or sum(len((t or "").encode()) for t in own.to_pylist()) <= size for i, j, own in runs)
    assert list(common.runs_of(pa.array([], kind), 100)) == []


def test_words_of_a_large_batch_take_little_memory_beside_it(spark):
    texts = pa.array([f"Word{k} Of A Text, " * 200 for k in range(8_000)])
    assert texts.nbytes > 24 << 20
    before, most, n = pa.total_allocated_bytes(), 0, 0
    tracemalloc.start()
    for i, j, _, at in decontam.plain_words(texts):
        most, n = max(most, pa.total_allocated_bytes() - before), n + int(at[-1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 8_000 * 800 and most < 4 << 20 and peak < 40 << 20


def test_components_of_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + k, 201 + k) for k in range(40)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for pair in links for x in pair if pair[0] != pair[1]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1: GIF ----


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=3000), st.sampled_from([1, 3, 16, 256]))
def test_lzw_round_trip(data, letters):
    data = bytes(b % letters for b in data)
    assert gif.lzw_decode(gif.lzw_encode(data), 8, len(data)).tobytes() == data


def test_lzw_over_full_tables_and_frames():
    data = random.Random(2).randbytes(gif.ROW_BYTES * 700)
    frames = gif.decode_gif(gif.encode_grey(data, max_rows=300))
    assert [f["height"] for f in frames] == [300, 300, 100]
    assert b"".join(f["pixels"][: f["height"] * gif.ROW_BYTES] for f in frames) == data


def _image(frames, palette, wide, high):
    """A GIF of (pixels, left, top, width, height, disposal, transparent, interlaced) frames."""
    import struct

    out = [b"GIF89a", struct.pack("<HHBBB", wide, high, 0xF1, 0, 0), bytes(palette)]
    for pixels, left, top, w, h, disposal, clear, woven in frames:
        stream = gif.lzw_encode(bytes(pixels), 2)
        out += [b"\x21\xf9\x04", struct.pack("<BHB", disposal << 2 | (clear is not None), 7, clear or 0), b"\0\x2c", struct.pack("<HHHHB", left, top, w, h, 0x40 * woven), b"\x02"]
        out += [bytes([len(stream)]), stream, b"\0"]
    return b"".join([*out, b"\x3b"])


def test_palette_disposal_transparency_and_interlace(spark):
    palette = [255, 0, 0, 0, 255, 0, 0, 0, 255, 9, 9, 9]
    image = _image([([0] * 16, 0, 0, 4, 4, 1, None, False), ([1, 3, 3, 1], 1, 1, 2, 2, 3, 3, False), ([2] * 4, 0, 0, 2, 2, 2, None, False), ([0, 1, 2, 0, 1], 0, 0, 1, 4, 0, None, False)][:3], palette, 4, 4)
    frames = gif.decode_gif(image)
    red, green, blue = [255, 0, 0], [0, 255, 0], [0, 0, 255]
    show = lambda f: [list(f["pixels"][3 * k : 3 * k + 3]) for k in range(16)]
    second = [red] * 16
    second[5] = second[10] = green
    third = [red] * 16
    third[0] = third[1] = third[4] = third[5] = blue
    assert [f["delay_ms"] for f in frames] == [70, 70, 70] and {f["mode"] for f in frames} == {"RGB"}
    assert show(frames[0]) == [red] * 16 and show(frames[1]) == second and show(frames[2]) == third
    assert sum(frames[1]["hist_rgb"]) == 16 and frames[1]["hist_rgb"][0b001100] == 2
    woven = gif.decode_gif(_image([([0, 1, 2, 3], 0, 0, 1, 4, 0, None, True)], palette, 1, 4))[0]
    assert [list(woven["pixels"][3 * k : 3 * k + 3]) for k in range(4)] == [red, blue, green, [9, 9, 9]]
    rows = spark.createDataFrame([(1, bytearray(image)), (2, bytearray(b"GIF89a")), (3, None), (4, bytearray(image[:-9]))], "id long, g binary")
    got = {r.id: (len(r.frames), r.error) for r in gif.gif_frames(rows, "id", "g").collect()}
    assert got[1] == (3, None) and got[2][0] == 0 and got[2][1] and got[3] == (0, "null") and got[4][0] == 0


def test_hostile_images_are_errors(spark):
    import struct

    huge = b"GIF89a" + struct.pack("<HHBBB", 65000, 65000, 0xF1, 0, 0) + bytes(12) + b"\x3b"
    many = _image([([0] * 16, 0, 0, 4, 4, 1, None, False)] * 50, [255, 0, 0, 0, 255, 0, 0, 0, 255, 9, 9, 9], 4, 4)
    rows = spark.createDataFrame([(1, bytearray(huge)), (2, bytearray(many)), (2, bytearray(many))], "id long, g binary").withColumn("error", F.lit("clash"))
    got = gif.gif_frames(rows, "id", "g", max_bytes=1000).collect()
    assert len(got) == 3 and all(r.frames == [] and "beyond" in r.error for r in got)
    assert {(r.id, len(r.frames)) for r in gif.gif_frames(rows, "id", "g").collect()} == {(1, 0), (2, 50)}


def test_op1_digest_equals_the_texts(spark):
    texts = [t for t in ODD if t is None or "\u0000" not in t]
    got = {r.doc_id: r for r in gif.gif_digest(gif.texts_as_gif(docs_of(spark, texts, extra=True))).collect()}
    for k, text in enumerate(texts):
        data = (text or "").encode()
        padded = data.ljust(max(192, -(-len(data) // 192) * 192))
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(padded), hashlib.sha256(padded).hexdigest())
        assert r.tail_crc32 == zlib.crc32(padded[-16:]) and r.media_sha256 == hashlib.sha256(gif.encode_grey(padded)).hexdigest()
    assert gif.texts_as_gif(docs_of(spark, [])).count() == 0


# ---- 3 and 4: classifiers ----


def test_language_on_held_out_rows(spark, sf):
    found = queries.op3_language(spark, sf).join(common.documents(spark, sf).select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    rows = found.filter("held_out and n > 40").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, sf):
    docs = common.documents(spark, sf)
    model = langid.fit(docs, ~common.held_out())
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs_of(spark, ODD + ODD, extra=True), model).select("doc_id", "lang_pred", "score").collect()}
    for k, text in enumerate(ODD):
        assert got[k] == got[k + len(ODD)]
        if not any(c.isalpha() for c in text or ""):
            assert got[k] == ("und", 0.0)
    assert langid.fit(docs.filter("false"), ~common.held_out()) is None
    assert {r.lang_pred for r in langid.predict(docs_of(spark, ODD), None).collect()} == {"und"}


def test_presence_kernel_by_hand(spark, sf):
    docs = common.documents(spark, sf).limit(40)
    model = langid.fit(docs, ~common.held_out())
    from curaspark.llm import grams

    seen = np.zeros(1 << langid.BITS, bool)
    text = "The thing of and"
    own = grams.distinct(grams.fold_letters(np.array([ord(c) for c in text], np.uint32)), langid.SIZES, langid.BITS, seen)
    marks = [set(model.vocabulary[row > 0].tolist()) for row in model.landmarks]
    kernel = np.array([len(m & set(own.tolist())) / np.sqrt(len(own) * len(m)) for m in marks])
    wanted = kernel @ model.weights
    got = model.scores(np.isin(model.vocabulary, own)[None, :].astype(np.float32), np.array([len(own)]))[0]
    assert np.allclose(got, wanted, atol=1e-4)


def test_language_fit_by_brute_force(spark, sf):
    """Nyström ridge regression solved directly in the landmarks' kernel."""
    from curaspark.llm import grams

    docs = common.documents(spark, sf).filter("lang is not null and length(text) between 30 and 3000").limit(60)
    model = langid.fit(docs, F.lit(True), landmarks=6, ridge=0.05)
    seen = np.zeros(1 << langid.BITS, bool)
    rows = sorted(docs.collect(), key=lambda r: (r.lang, r.doc_id))
    sets = [set(grams.distinct(grams.fold_letters(np.array([ord(c) for c in r.text], np.uint32)), langid.SIZES, langid.BITS, seen).tolist()) for r in rows]
    languages = sorted({r.lang for r in rows})
    marks = [m for lang in languages for m in sorted((k for k, r in enumerate(rows) if r.lang == lang), key=lambda k: (-min(len(sets[k]), 800), rows[k].doc_id))[:6]]
    kernel = lambda one, two: np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in two] for a in one])
    inner, across = kernel([sets[m] for m in marks], [sets[m] for m in marks]), kernel(sets, [sets[m] for m in marks])
    target = np.array([[1.0 if r.lang == lang else -1.0 for lang in languages] for r in rows])
    weights = np.linalg.solve(across.T @ across + 0.05 * inner, across.T @ target)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    for r, out in zip(rows, across @ weights):
        assert got[r.doc_id][0] == languages[int(out.argmax())] and abs(got[r.doc_id][1] - np.clip((out.max() + 1) / 2, 0, 1)) < 5e-3


def test_language_stage_drops_what_no_language_claims_and_fills_in_names(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.documents(spark, sf)
    odd = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(["xqzk wvxq kqxz " * 30, "12345 67890", None, "Ж Щ Ю Э Ъ " * 60])], DOC)
    both = docs.unionByName(odd, allowMissingColumns=True).withColumn("_lang_pred", F.lit("mine"))
    kept = langid.keep_identified(both, ~common.held_out())
    assert kept.columns == both.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert not any(k >= 10**9 for k in rows) and all(r.lang for r in rows.values()) and {r["_lang_pred"] for r in rows.values()} == {"mine"}
    assert len(rows) >= 0.97 * docs.count()
    assert langid.keep_identified(both, F.lit(False)).count() == both.count()


def test_repeated_ids_are_learned_once(spark, sf):
    docs, labels = common.documents(spark, sf).limit(80), spark.read.parquet(f"{sf}/labels.parquet")
    again = docs.union(docs).union(docs)
    one, two = langid.fit(docs, F.lit(True)), langid.fit(again, F.lit(True))
    assert one.languages == two.languages and np.allclose(one.weights, two.weights, atol=1e-3)
    assert quality.fit(again, labels, F.lit(True)).vectors.shape == quality.fit(docs, labels, F.lit(True)).vectors.shape
    sample = langid.labelled_sample(again, F.col("lang"), 10, 25)
    assert sample.count() <= 25 and sample.distinct().count() == sample.count()


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op4_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    above = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert above >= 0.9, above


def test_quality_votes_by_brute_force(spark, sf):
    docs, labels = common.documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels, ~common.held_out())
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.01, (5, quality.TERMS)).astype(np.float32)
    got = model.score(counts)
    for row, score in zip(counts, got):
        similar = np.round(model.latent(row[None, :]) @ model.vectors.T, 4)[0]
        near = similar >= sorted(similar)[-model.neighbours]
        weight = np.maximum(similar[near], 0).astype(float)
        assert abs(score - (weight * model.labels[near]).sum() / weight.sum()) < 1e-4
    odd = {r.doc_id: r.score for r in quality.score(docs_of(spark, ODD, extra=True), model).select("doc_id", "score").collect()}
    assert odd[0] == odd[1] == pytest.approx(model.prior)
    none = quality.fit(docs, labels.filter("false"), ~common.held_out())
    assert {r.score for r in quality.score(docs_of(spark, ODD), none).collect()} == {0.5}


# ---- 5: lines ----


def test_sql_queries_equal_their_oracle(spark, sf):
    con = connect(sf)
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, sf)
        columns = sorted(df.columns)
        assert rows_of(df, columns) == oracle_rows(con, sql, columns), name


def test_templates_with_variable_fields_are_dropped_but_for_the_first(spark):
    rng = random.Random(4)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(9))
    people = ["ann", "bob", "eve", "joe", "kim", "lee", "max", "pat", "sue", "tom", "una", "vic"]
    texts = [f"{own()}\nThis page was made by {p} on day {k} of the year now" for k, p in enumerate(people)]
    got = {r.doc_id: r for r in line_dedup.drop_recurring(docs_of(spark, texts, extra=True)).collect()}
    assert got[0].text == texts[0]
    for k in range(1, 12):
        assert got[k].text == texts[k].split("\n")[0] and got[k]._n_dropped == 1


def _planted_templates(seed, per_template, n_templates):
    """Texts with one line each of formats that share length and leading tokens, among own lines of the same beginning."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    formats = [["All", "of", "this", *(word() for _ in range(7))] for _ in range(n_templates)]
    texts, planted = [], []
    for k, form in enumerate(formats):
        varied = rng.sample(range(3, 10), 1 + k % 3)
        for _ in range(per_template):
            line = [word() if at in varied else w for at, w in enumerate(form)]
            texts.append(f"{' '.join(word() for _ in range(9))}\n{' '.join(line)}")
            planted.append(k)
    for _ in range(100):
        texts.append("All of this " + " ".join(word() for _ in range(7)))
        planted.append(None)
    return texts, planted


def test_many_templates_of_one_leaf_are_found(spark):
    texts, planted = _planted_templates(5, 12, 20)
    got = {r.doc_id: r for r in line_dedup.drop_recurring(docs_of(spark, texts)).collect()}
    firsts = {planted.index(k) for k in range(20)}
    wanted = {i for i, k in enumerate(planted) if k is not None and i not in firsts}
    found = {i for i, r in got.items() if r._n_dropped}
    assert found <= wanted and len(found) >= 0.9 * len(wanted)
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    mixed = spark.createDataFrame([(i, texts[i]) for i in order], DOC).repartition(7)
    assert {r.doc_id for r in line_dedup.drop_recurring(mixed).collect() if r._n_dropped} == found


def test_long_passages_recur_from_three_texts_and_short_lines_from_ten(spark):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    lines = {(n, k): words(n) for n in (6, 60) for k in (2, 3, 9, 10)}
    texts, wanted = [], set()
    for (n, k), line in lines.items():
        for j in range(k):
            if j and k >= (3 if n == 60 else 10):
                wanted.add(len(texts))
            texts.append(f"{words(12)}\n{line}")
    got = line_dedup.drop_recurring(docs_of(spark, texts)).collect()
    assert {r.doc_id for r in got if r._n_dropped} == wanted and all(r._n_dropped <= 1 for r in got)


def test_line_dedup_with_clashing_columns_and_repeated_ids(spark):
    rng = random.Random(13)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    same = words(30)
    rows = [(k, f"{words(5)}\n{same}") for k in range(4)] + [(7, f"{same}\n{words(5)}"), (7, "another text\nof this id"), (None, f"{words(4)}\n{same}")]
    docs = spark.createDataFrame(rows, DOC)
    for name in ("_n_lines", "_n_dropped", "__id", "__rest", "_own", "_body", "_places", "_rest", "pos", "body", "leaf"):
        docs = docs.withColumn(name, F.lit("clash"))
    kept = line_dedup.clean_lines(docs)
    assert kept.columns == docs.columns and {r["__rest"] for r in kept.collect()} == {"clash"}
    got = {(r.doc_id, r.text) for r in kept.collect()}
    assert got == {(k, t if k == 0 or k is None else "another text\nof this id" if t.startswith("another") else t.replace(same, "").strip("\n")) for k, t in rows}


def test_copies_do_not_empty_documents_and_odd_texts_pass(spark):
    same = ["one line here\nand another"] * 30
    got = line_dedup.drop_recurring(docs_of(spark, same + ODD)).orderBy("doc_id").collect()
    assert [r.text for r in got] == same + ODD
    assert line_dedup.drop_recurring(docs_of(spark, [])).count() == 0


# ---- 6 and 7: spans ----


def _joined(found, order):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (s[1], order.index(s[0]))))


def brute_secrets(t):
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return found + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]


def brute_personal(t):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    return found + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.@- +(25ſK:=token\"", max_size=60))
def test_base_spans_of_random_texts(text):
    assert sorted(pii.base_spans(text)) == sorted(brute_personal(text))
    text = text.replace("1", "token=").replace("2", "AKIA" + "Z" * 12).replace("5", "abcdef01" * 4)
    assert sorted(secret_scan.base_spans(text)) == sorted(brute_secrets(text))


@pytest.mark.parametrize("query,brute,kinds", [(queries.op6_secrets, brute_secrets, ("assign", "access", "hex")), (queries.op7_personal_data, brute_personal, ("email", "ip", "card", "phone"))])
def test_span_queries_by_brute_force(spark, query, brute, kinds):
    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    some = False
    for r in query(spark, sf).collect():
        base = brute(texts[r.doc_id] or "")
        some = some or bool(base)
        assert r.base_sha256 == hashlib.sha256(_joined(base, kinds).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in base) for k in kinds]
        assert set(_joined(base, kinds).split(",")) <= set(r.spans.split(","))
    assert some


def test_grammar_finds_credentials_outside_the_patterns(spark):
    rng = random.Random(6)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(28))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(16, 30)))
    hidden = key()
    texts = [f'x token = "{key()}" y' for _ in range(60)] + [f"{word()} {word()}" for _ in range(60)] + [f"here {hidden} it is", "page_1_of_an_ordinary_name_2"] + ODD
    docs = docs_of(spark, texts, extra=True)
    got = {r.doc_id: r for r in secret_scan.find_secrets(docs, secret_scan.learn(docs)).collect()}
    assert got[120].spans == f"grammar:5:{5 + len(hidden)}" and got[121].spans == ""
    assert all(got[k].spans == "" for k in range(60, 120))
    empty = docs_of(spark, [])
    assert secret_scan.find_secrets(empty, secret_scan.learn(empty)).count() == 0


def test_grammar_scores_short_dotted_and_digitless_candidates(spark):
    rng = random.Random(16)
    of = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    word = lambda: of("abcdefghijklmnopqrstuvwxyz", rng.randrange(8, 20))
    formats = [lambda: of("0123456789ABCDEF", 12), lambda: ".".join(of("GHJKLMNP2345", 6) for _ in range(3)), lambda: of("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 20)]
    for key in formats:
        hidden = key()
        texts = [f'x token = "{key()}" y' for _ in range(80)] + [f"{word()} {word()}, {word()}" for _ in range(200)] + [f"here {hidden} it is"]
        docs = docs_of(spark, texts)
        got = {r.doc_id: r.spans for r in secret_scan.find_secrets(docs, secret_scan.learn(docs)).collect()}
        assert got[280] == f"grammar:5:{5 + len(hidden)}"
        assert all(got[k] == "" for k in range(80, 280))


def test_background_has_seen_ordinary_numbers(spark):
    rng = random.Random(17)
    of = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [f'x token = "{of("0123456789abcdef", 28)}" y' for _ in range(100)] + [f"number {of('0123456789', rng.randrange(16, 24))} of the list" for _ in range(200)]
    docs = docs_of(spark, texts)
    model = secret_scan.learn(docs)
    assert all(r.spans == "" for r in secret_scan.find_secrets(docs, model).filter("doc_id >= 100").collect())
    assert secret_scan.infer([secret_scan.classes(w) for w in ("ab1" * 5000, "ab1" * 5000 + "c")]).moves


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), max_size=12), st.integers(0, 45), st.integers(1, 9))
def test_cover_meets_what_overlaps(pairs, start, length):
    taken = [("x", a, a + n) for a, n in pairs]
    assert spans.Cover(taken).meets(start, start + length) == any(a < start + length and start < b for _, a, b in taken)


def test_inferred_automaton_is_small_and_tells_formats_apart():
    rng = random.Random(8)
    words = [secret_scan.classes("".join(rng.choice("0123456789abcdef") for _ in range(40))) for _ in range(200)]
    automaton = secret_scan.infer(words)
    assert len(automaton.moves) < 40
    likely, unlikely = automaton.score(secret_scan.classes("0a1b" * 10)), automaton.score(secret_scan.classes("zyxw" * 10))
    assert likely > unlikely + 20


def test_labelers_and_classifier(spark):
    texts = ["card 4111 1111 1111 1111 ok"] * 30 + ["+1 (212) 555-0100 x"] * 30 + [f"mail a{k}@b.com, host 10.0.0.{k}" for k in range(30)] + ["id 1234 5678 1234 5678", "call 212-555-0101 now"] + ODD
    docs = docs_of(spark, texts, extra=True)
    model = pii.learn(docs)
    assert set(model.reliabilities) == {"email", "ip", "card", "phone"}
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs, model).collect()}
    assert got[0] == "card:5:24" and got[30] == "phone:0:17" and got[60] == "email:5:13,ip:20:28"
    assert "card" not in got[90]


def test_written_out_addresses_and_learned_gazetteers(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    tail = lambda: " ".join(word() for _ in range(20))
    texts = [f"{word()} zuschrift an {word()}@{word()}.museum, {tail()}" for _ in range(60)] + [f"{word()} {word()} at {word()}. dot {word()}" for _ in range(60)]
    hidden = [f"{word()} {rng.choice(['(at)', '[at]'])} {word()} {rng.choice(['(dot)', '[dot]'])} museum" for _ in range(40)]
    texts += [f"{word()} zuschrift an {h} {tail()}" for h in hidden]
    plain = len(texts)
    texts += [f"look (at) {word()} [dot] {word()} now" for _ in range(40)]
    docs = docs_of(spark, texts)
    model = pii.learn(docs)
    assert "museum" in model.known.domains and "zuschrift" in model.known.cues["email"]
    got = {r.doc_id: r.spans for r in pii.find_personal_data(docs, model).collect()}
    found = 0
    for k, h in enumerate(hidden):
        at = texts[120 + k].index(h)
        found += got[120 + k] == f"more_email:{at}:{at + len(h)}"
    assert found >= 0.9 * len(hidden)
    assert all("email" not in got[k] for k in range(60, 120)) and all("email" not in got[k] for k in range(plain, len(texts)))


# ---- 8: calls ----

CALL = "conv_id long, turn long, call_id string, after string, name string, arguments string"


def test_calls_results_positions_and_errors(spark):
    calls = spark.createDataFrame(
        [(1, 0, "a", None, "f", '{"y": "t", "x": 1}'), (1, 2, "b", "a", "f", '{"x": "1"}'), (1, 4, "c", "b", "g", "{}"), (1, 6, "d", "e", "f", "broken"), (1, 7, "e", "d", "f", None), (1, 9, "a", None, "f", '{"x": 2}'), (1, 8, None, None, "f", '{"x": 3, "z": [1]}')],
        CALL,
    )
    results = spark.createDataFrame([(1, 1, "a", "r1"), (1, 3, "a", "r0"), (1, 5, "q", "lost"), (1, 5, None, None)], "conv_id long, turn long, call_id string, content string")
    schemas = spark.sql("select 'f' as name, array(named_struct('key', 'x', 'type', 'integer', 'required', true), named_struct('key', 'y', 'type', 'string', 'required', false)) as properties")
    got = {(r.call_id, r.turn): r for r in tool_calls.link_calls(calls, results, schemas).collect()}
    assert got["a", 0].json == '{"arguments":{"x":1,"y":"t"},"call_id":"a","content":"r1","errors":[],"name":"f","position":0}'
    assert (got["b", 2].position, got["b", 2].status, got["b", 2].errors) == (1, "open", ["type x"])
    assert (got["c", 4].position, got["c", 4].errors) == (2, ["unknown tool"])
    assert got["d", 6].position == -1 and got["d", 6].errors == ["broken arguments", "circle"] and got["e", 7].position == -1
    assert got["a", 9].errors == ["duplicate"] and got[None, 8].errors == ["unknown z", "no identifier"]
    assert got["q", 5].status == "orphan" and len(got) == 10
    assert (got["a", 3].status, got["a", 3].errors) == ("surplus", ["second result"]) and '"content":"r0"' in got["a", 3].json
    assert got["a", 9].status == "duplicate" and "content" not in got["a", 9].json


def test_calls_lose_nothing_silently(spark):
    texts = ['{"x":1,"x":2}', '{"x":1.0}', '{"x":1.5}', '{"x":' + "1" * 60 + "}", '{"x":3,"y":"' + "z" * 200_000 + '"}']
    calls = spark.createDataFrame([(1, k, f"c{k}", None, "f", a) for k, a in enumerate(texts)], CALL)
    results = spark.createDataFrame([(1, 9, "c1", "same")] * 3 + [(1, 8, "c1", "first"), (1, 9, "c1", None)], "conv_id long, turn long, call_id string, content string")
    schemas = spark.sql("select 'f' as name, array(named_struct('key', 'x', 'type', 'integer', 'required', true), named_struct('key', 'y', 'type', 'string', 'required', false)) as properties")
    rows = tool_calls.link_calls(calls, results, schemas).collect()
    got = {r.call_id: r for r in rows if r.status != "surplus"}
    assert got["c0"].errors == ["broken arguments"] and got["c1"].errors == [] and '"x":1}' in got["c1"].json and got["c2"].errors == ["type x"]
    assert "first" in got["c1"].json and got["c4"].errors == [] and "z" * 200_000 in got["c4"].json
    assert sorted(str(r.json) for r in rows if r.status == "surplus") == ['{"call_id":"c1","content":"same","errors":["second result"]}'] * 3 + ['{"call_id":"c1","errors":["second result"]}']


@pytest.mark.parametrize("kinds", [("int", "smallint"), ("string", "int"), ("bigint", "string")])
def test_leaks_with_ids_of_any_type(spark, kinds):
    rng = random.Random(3)
    passage = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40))
    docs = spark.createDataFrame([("1", f"before it {passage} behind"), ("2", "nothing here"), ("3", None)], "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kinds[0]))
    bench = spark.createDataFrame([("7", passage)], "item_id string, text string").withColumn("item_id", F.col("item_id").cast(kinds[1]))
    assert [(str(r.doc_id), str(r.item_id)) for r in decontam.find_passages(docs, bench).collect()] == [("1", "7")]
    assert sorted(str(r.doc_id) for r in decontam.drop_contaminated(docs, bench).collect()) == ["2", "3"]


def test_calls_of_two_conversations_with_one_identifier(spark):
    calls = spark.createDataFrame([(1, 0, "c1", None, "f", "{}"), (2, 0, "c1", None, "f", "{}"), (2, 2, "c2", "c1", "f", "{}"), (3, 0, "c2", "c1", "f", "{}"), (None, 0, "c1", None, "f", "{}"), (1, 0, "c1", None, "f", "{}")], CALL)
    for name in ("answer", "again", "position", "errors", "values", "known", "jump"):
        calls = calls.withColumn(name, F.lit("clash"))
    results = spark.createDataFrame([(1, 1, "c1", "one"), (2, 1, "c1", "two"), (3, 1, "c1", "lost"), (None, 1, "c1", "none")], "conv_id long, turn long, call_id string, content string").withColumn("first", F.lit(1))
    schemas = spark.sql("select 'f' as name, cast(array() as array<struct<key:string,type:string,required:boolean>>) as properties")
    rows = tool_calls.link_calls(calls, results, schemas).collect()
    got = {(r.conv_id, r.call_id): r for r in rows}
    assert len(rows) == 7
    assert '"content":"one"' in got[1, "c1"].json and '"content":"two"' in got[2, "c1"].json
    assert (got[2, "c2"].position, got[3, "c2"].position) == (1, 0) and got[1, "c1"].errors == [] == got[2, "c1"].errors
    assert got[3, "c1"].status == "orphan" and sorted(r.status for r in rows if r.conv_id is None) == ["open", "orphan"]
    empty = tool_calls.link_calls(calls.filter("false"), results.filter("false"), schemas)
    assert empty.count() == 0


def test_a_long_chain_is_ordered(spark):
    calls = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("c"), "id").alias("call_id"), F.concat(F.lit("c"), F.col("id") - 1).alias("after"))
    got = {r.call_id: r.position for r in tool_calls.positions(calls).collect()}
    assert got == {f"c{k}": k for k in range(300)}


# ---- 9: leaks ----


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=70), st.lists(st.integers(0, 5), max_size=90))
def test_common_subsequence(a, b):
    assert decontam.common_subsequence(a, b) == lcs(a, b)


def test_leaks_exact_edited_and_none(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    common_words = [word() for _ in range(30)]
    text = lambda n: [rng.choice(common_words) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [text(rng.randrange(12, 70)) for _ in range(40)]
    docs, planted = [], set()
    for k in range(200):
        body = text(rng.randrange(1, 900))
        if k % 4 == 0:
            j = rng.randrange(40)
            passage = list(items[j])
            if k % 8 == 0:  # a paraphrase: every eighth word is another one
                passage = [word() if i % 8 == 7 else w for i, w in enumerate(passage)]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + "!" if k % 3 == 0 else w for w in passage]
            planted.add((k, j))
        docs.append((k, " ".join(body)))
    docs += [(200 + k, t) for k, t in enumerate(ODD)]
    bench = spark.createDataFrame([(j, " ".join(i)) for j, i in enumerate(items)] + [(99, None), (98, "...")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_passages(spark.createDataFrame(docs, DOC), bench).collect()}
    assert got == planted
    blocks = {(r.doc_id, r.item_id) for r in decontam.find_passages(spark.createDataFrame(docs, DOC), bench, block=15).collect()}
    assert blocks == planted
    kept = decontam.drop_contaminated(spark.createDataFrame(docs, DOC), bench)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - {k for k, _ in planted}
    assert decontam.find_passages(spark.createDataFrame(docs, DOC), bench.filter("false")).count() == 0
    assert decontam.find_passages(docs_of(spark, []), bench).count() == 0


def test_a_passage_in_a_third_of_the_documents_is_found_in_all_of_them(spark):
    rng = random.Random(19)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    items = [[word() for _ in range(n)] for n in (33, 20, 40)]
    docs, planted = [], set()
    for k in range(150):
        body = [word() for _ in range(200)]
        if k % 3 == 0:
            at = rng.randrange(201)
            body[at:at] = items[0]
            planted.add((k, 0))
        docs.append((k, " ".join(body)))
    bench = spark.createDataFrame([(j, " ".join(i)) for j, i in enumerate(items)], "item_id long, text string")
    got = decontam.find_passages(spark.createDataFrame(docs, DOC), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert all(r.similarity == 1.0 for r in got)


def test_bounds_lose_no_window(spark):
    """Every window of every document against every passage, without any bound."""
    rng = random.Random(29)
    vocabulary = [f"v{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 30))] for _ in range(12)]
    docs = []
    for k in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        part = [w for w in rng.choice(items) if rng.random() < rng.choice([0.6, 0.75, 0.9, 1])]
        at = rng.randrange(len(body) + 1)
        body[at:at] = part
        docs.append((k, " ".join(body)))
    docs += docs[:3]
    table = spark.createDataFrame(docs, DOC).withColumn("_leak", F.lit("clash")).withColumn("item_id", F.lit(-1))
    bench = spark.createDataFrame([(j, " ".join(i)) for j, i in enumerate(items)] * 2, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontam.find_passages(table, bench).collect())
    index = decontam.fit(bench, decontam.inverse_frequencies(table))
    wanted = []
    for k, text in docs:
        ((_, _, hashed, at),) = list(decontam.plain_words(pa.array([text])))
        words = hashed[at[0] : at[1]]
        for item, own in enumerate(index.words):
            best = 0.0
            for a, b in zip(*decontam._windows(len(words), int(index.scale[item]))):
                region = words[max(a - len(own) // 2, 0) : min(b + len(own) // 2, len(words))].tolist()
                shared = lcs(own.tolist(), region) / len(own)
                if shared >= 0.8 or shared >= 0.6 and np.isin(index.answers[item], region).mean() >= 0.5:
                    best = max(best, shared)
            if best:
                wanted.append((k, index.ids[item], round(best, 9)))
    assert got == sorted(wanted) and len(wanted) > 20
    kept = decontam.drop_contaminated(table, bench)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - {k for k, _, _ in wanted}


def test_randomised_decomposition_spans_the_passages(spark):
    words = [[f"w{(j * 7 + i * i) % 50}" for i in range(20)] for j in range(12)]
    bench = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(words)], "item_id long, text string")
    index = decontam.fit(bench, decontam.inverse_frequencies(bench.withColumnRenamed("item_id", "doc_id")), rank=12)
    assert np.allclose(index.space.T @ index.space, np.eye(index.space.shape[1]), atol=1e-4)
    # full rank: every passage lies in the space, so the thresholds are not lowered
    assert np.allclose(index.least, 0.45, atol=1e-3)


# ---- 10: near copies ----


def brute_components(texts, words, num, den):
    sets = {}
    for k, t in enumerate(texts):
        w = words_of(t)
        sets[k] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < words else frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = defaultdict(int)
    for a in sets:
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80), (1, 80), (3, 85)])
def test_near_copies_by_brute_force(spark, words, num):
    rng = random.Random(words * 100 + num)
    vocabulary = [f"w{k}" for k in range(3000)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(45):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 15, 33, 80, 200, 500]))]
        if rng.random() < 0.4:
            base += shared
        for _ in range(rng.choice([1, 1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                i = rng.randrange(len(copy) + 1)
                edit = rng.random()
                if edit < 0.5 and i < len(copy):
                    copy[i] = rng.choice(vocabulary)
                elif edit < 0.75:
                    copy.insert(i, rng.choice(vocabulary))
                elif len(copy) > 1:
                    del copy[min(i, len(copy) - 1)]
            texts.append(" ".join(copy))
    texts += ODD
    docs = docs_of(spark, texts, extra=True)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, words=words, num=num).collect()}
    assert got == brute_components(texts, words, num, 100)


def test_a_chain_of_near_copies_is_one_component_and_empties_link_nothing(spark):
    words = [f"w{k}" for k in range(200)]
    chain = []
    for k in range(30):
        words = words[4:] + [f"n{k}_{i}" for i in range(4)]
        chain.append(" ".join(words))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs_of(spark, chain + ["", None, " "])).collect()}
    assert got == {**{k: 0 for k in range(30)}, 30: 30, 31: 31, 32: 32}
    kept = ngram_join.keep_one(docs_of(spark, chain + ["", None])).collect()
    assert {r.doc_id for r in kept} == {0, 30, 31}
    assert ngram_join.jaccard_components(docs_of(spark, [])).count() == 0


def test_repeated_rows_and_several_texts_of_an_id(spark):
    base = " ".join(f"w{k}" for k in range(100))
    near = base.replace("w99", "x")
    rows = [(1, base), (2, near), (2, near), (2, near), (3, "other words here now"), (3, base), (None, base), (4, base), (4, base)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, DOC)).collect())
    assert got == [(1, 98, 1), (2, 98, 1), (3, 2, 3), (3, 98, 1), (4, 98, 1)]
    kept = sorted((r.doc_id or 0, r.text) for r in ngram_join.keep_one(spark.createDataFrame(rows, DOC)).collect())
    assert kept == [(0, base), (1, base), (3, "other words here now"), (3, base)]


def test_ids_may_be_texts(spark):
    base = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([("b", base), ("a", base.replace("w5 ", "v ")), ("c", "alone it is"), ("d", base)], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()} == {"a": "a", "b": "a", "c": "c", "d": "a"}


@pytest.mark.parametrize("words,num", [(3, 90), (5, 80)])
def test_a_large_group_of_near_copies_that_one_hub_does_not_link(spark, words, num):
    """Copies of one base with ever more edits: some link to it, some to each other, most to nothing."""
    rng = random.Random(words)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(500):
        copy = list(base)
        for _ in range(rng.randrange(0, 26)):
            i = rng.randrange(len(copy))
            edit = rng.random()
            if edit < 0.4:
                copy[i] += rng.choice("abcdefgh")
            elif edit < 0.7:
                del copy[i]
            else:
                copy.insert(i, f"w{rng.randrange(150)}")
        texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs_of(spark, texts), words=words, num=num).collect()}
    assert got == brute_components(texts, words, num, 100)


# ---- 2: mixing ----


def test_rates_meet_the_targets_and_equal_a_dense_solution(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.dirichlet([0.5, 0.5, 0.5], 200), 3)
    p[:, 0] = np.round(1 - p[:, 1] - p[:, 2], 3)
    n = rng.integers(10, 500, 200).astype(float)
    targets = [0.4 * n.sum(), 0.05 * n.sum(), 0.02 * n.sum()]
    masses = spark.createDataFrame([(x.tolist(), float(m)) for x, m in zip(p, n)], "p array<double>, tokens double")
    rates = {tuple(r.p): r.rate for r in mixing.fit_rates(masses, targets, 0.5, steps=200).collect()}
    r = np.array([rates[tuple(x.tolist())] for x in p])
    assert (r >= 0).all()
    assert np.allclose((n * r) @ p, targets, rtol=2e-3)
    z = np.full(200, 0.5)
    w = 1 / np.array(targets) ** 2
    step = 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p * np.sqrt(np.outer(w, w))).max()
    # plain steps are slow: after 6,000 of them the first total still is 1.4 % off its target
    for _ in range(400_000):
        z = np.maximum(0, z - step * p @ (((n * z) @ p - targets) * w))
        if _ % 1000 == 0 and np.allclose((n * z) @ p, targets, rtol=1e-4):
            break
    assert np.abs((n * (z - r)) @ p).max() < 3e-3 * n.sum()


def test_rates_are_met_at_default_steps_and_unreachable_targets_are_reported(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.dirichlet([0.5, 0.5, 0.5], 200), 3)
    n = rng.integers(10, 500, 200).astype(float)
    masses = spark.createDataFrame([(x.tolist(), float(m)) for x, m in zip(p, n)], "p array<double>, tokens double")
    for parts in ([0.4, 0.05, 0.02], [0.01, 0.45, 0.04], [0.05, 0.3, 0.4]):
        targets = [part * n.sum() for part in parts]
        rates = {tuple(r.p): r.rate for r in mixing.fit_rates(masses, targets, 0.5).collect()}
        r = np.array([rates[tuple(x.tolist())] for x in p])
        assert (r >= 0).all() and np.allclose((n * r) @ p, targets, rtol=1e-3)
    only = spark.createDataFrame([([1.0, 0.0, 0.0], 10.0)], "p array<double>, tokens double")
    with pytest.warns(UserWarning, match="targets not met"):
        (row,) = mixing.fit_rates(only, [5.0, 5.0, 0.0], 0.1).collect()
    assert row.rate == pytest.approx(0.5)


def test_memberships_and_mixture(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = mixing.mix(common.documents(spark, sf), labels).cache()
    rows = found.join(labels, "doc_id").collect()
    best = [max(mixing.DOMAINS, key=lambda d: r[f"p_{d}"]) for r in rows]
    truth = ["toxic" if r.toxic else "low" if not r.quality else "high" for r in rows]
    assert np.mean([a == b for a, b in zip(best, truth)]) > 0.8
    total = found.agg(*[F.sum(F.col("expected_tokens") * F.col(f"p_{d}")).alias(d) for d in mixing.DOMAINS], F.sum("n_tokens").alias("n")).first()
    for d, w in mixing.TARGETS.items():
        assert total[d] == pytest.approx(0.5 * w * total.n, rel=0.02)
    again = mixing.mix(common.documents(spark, sf).limit(50).union(common.documents(spark, sf).limit(50)), labels.union(labels))
    assert again.count() == 100 and again.dropDuplicates(["doc_id"]).count() == 50
    odd = mixing.mix(docs_of(spark, ODD, extra=True), labels.filter("false")).collect()
    assert all(r.rate >= 0 and abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 for r in odd) and len(odd) == len(ODD)
    assert mixing.mix(docs_of(spark, []), labels).count() == 0


# ---- the pipeline ----


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = common.documents(spark, sf)
    columns, clean = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.stored(stage(spark, docs, sf))
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= clean
        if name != "mixing":
            assert docs.columns == columns and docs.schema == before.schema
        if name == "ngram_jaccard_join":
            texts = before.orderBy("doc_id").collect()
            wanted = brute_components([r.text for r in texts], 5, 80, 100)
            assert kept == {texts[k].doc_id for k, (_, top) in wanted.items() if top == k}
        if name == "benchmark_decontamination":
            passages = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not [r for r in docs.collect() if any(p in r.text for p in passages)]
            assert len(clean) - len(kept) < 0.1 * len(clean)
        clean = kept


def test_pipeline_stages_on_odd_and_empty_documents(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = common.documents(spark, sf)
    base = " ".join(f"the word{k} of" for k in range(60))
    odd = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate([*ODD, base, base, base.replace("word7 ", "other ")])] + [(10**9 + len(ODD), base), (None, "a text without an id")], DOC)
    both = docs.unionByName(odd, allowMissingColumns=True).withColumn("_gone", F.lit("clash")).withColumn("_leak", F.lit("clash"))
    stages = dict(corpus_pipeline.STAGES)
    first = common.stored(stages["language_id"](spark, both, sf))
    ids = sorted(r.doc_id - 10**9 for r in first.filter("doc_id >= 1000000000").select("doc_id").collect())
    assert first.columns == both.columns and {0, 1, 2, 4}.isdisjoint(ids) and ids.count(len(ODD)) == 2
    rows = first
    for name in ("line_dedup", "ngram_jaccard_join", "benchmark_decontamination"):
        rows = common.stored(stages[name](spark, rows, sf))
        assert rows.columns == both.columns and {r["_gone"] for r in rows.select("_gone").distinct().collect()} == {"clash"}, name
        assert rows.filter("doc_id is null").count() == 1, name
    left = {r.doc_id - 10**9 for r in rows.filter("doc_id >= 1000000000").select("doc_id").collect()}
    assert len(ODD) in left and len(ODD) + 1 not in left and len(ODD) + 2 not in left
    assert stages["mixing"](spark, rows, sf).count() == rows.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, both.filter("false"), sf).count() == 0, name
