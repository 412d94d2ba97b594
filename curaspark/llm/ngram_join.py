"""N-gram Jaccard self-join over count vectors, exact, with one row for each document.

Distinct word shingles are hashed into groups; a document is the point of its group counts. The
overlap of two documents is at most the sum of the smaller coordinates of their points. Boxes of
neighbouring points alone are no use as the way in: with as many groups as it takes to tell documents
apart, the coordinate maxima of any few unrelated documents of one size are so large that nearly no pair of
boxes is ruled out (figures in the README), and the tree would compare all its leaves. So the tree has an addressed
root and boxes below it:

* Root: shingles are ordered by how popular they are in the corpus (a bounded sketch of counts), then by hash. Two
  documents that link share a shingle among their rarest ones, at places that their sizes bound; a page
  holds the documents that have one such shingle there. Shared passages and the common stock of a group of
  near copies are popular and stand last, so a page of them holds only documents that are little else.
* Nodes: in a page, members of one size cell and one component so far form a node with its range of sizes and its
  coordinate maxima. A pair of nodes is descended only if the sum of the smaller maxima is large enough.
* Points: pairs of members that are left are bounded by their own finer group counts.
* Surviving pairs are verified on the shingle sets.

Equal shingle sets form a class and only its smallest document takes part. Before nodes are made, all members of a
page are compared with a few hubs (the members with most company, later with most links), in rounds of more hubs
for the pages that still hold several components and many pairs; a page whose members are one component needs no nodes. No pair
that links is lost to a bound, and no group's pairs are written out.

Defined results: a null, empty or blank text has no shingles and is a component of its own; a text of
fewer words than a shingle is one shingle; equal rows count once; several texts of one id take part each for
itself and give a row each where their sets differ; rows with a null id are no documents; ids may be numbers or
texts; order never matters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.llm import common, components

_STEPS = tuple(int(x) for x in common.mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1))
#: Buckets of the popularity sketch (as a power of two), and in how many parts it is added up.
SKETCH_BITS, PARTS = 20, 256
#: Coordinates of the points that nodes are made of.
COARSE_BITS = 4


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, and n + 1 offsets."""
    hashed, at = common.hashed_words(raw, offsets)
    counts = np.diff(at)
    with np.errstate(over="ignore"):
        if len(hashed) >= words:
            windows = np.zeros(len(hashed) - words + 1, np.uint64)
            for k in range(words):
                windows += hashed[k : len(hashed) - words + 1 + k] * np.uint64(_STEPS[k])
            windows = common.mix64(windows)
        else:
            windows = np.zeros(0, np.uint64)
        sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
        ends = np.cumsum(sizes)
        begins = ends - sizes
        found = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
        for a, b, first, n in zip(begins.tolist(), ends.tolist(), at[:-1].tolist(), counts.tolist()):
            if n >= words:
                found[a:b] = windows[first : first + b - a]
                found[a:b].sort()
            elif n:
                total = n
                for k in range(n):
                    total += int(hashed[first + k]) * _STEPS[k]
                found[a] = common.mix64(np.array([total & (1 << 64) - 1], np.uint64) ^ np.uint64(_STEPS[32 + n]))[0]
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[begins[sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return found[new], np.concatenate([[0], kept[ends]]) if len(ends) else np.zeros(1, np.int64)


def _points(found: np.ndarray, at: np.ndarray, coarser: int) -> tuple[np.ndarray, np.ndarray]:
    """Group counts of each text, with 8 to 16 shingles in a group on average, and n + 1 offsets.

    Groups are ranges of the hash, so that the counts of half as many groups are sums of neighbours.
    """
    n = np.diff(at)
    bits = np.maximum(np.log2(np.maximum(n, 16)).astype(np.int64) - 3 - coarser, 0)
    begins = np.concatenate([[0], np.cumsum(1 << bits)])
    group = (found >> (np.uint64(63) - np.repeat(bits, n).astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
    return np.bincount(np.repeat(begins[:-1], n) + group, minlength=int(begins[-1])).astype(np.int32), begins


def _mixed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of scrambled values between consecutive offsets."""
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix64(values), dtype=np.uint64)])
        return running[at[1:]] - running[at[:-1]]


def popularity(docs: DataFrame, words: int) -> np.ndarray:
    """How many documents hold a shingle of each hash bucket, over all documents, up to 2**32 - 1.

    Each task hands on one array in parts of a few kB; parts are added as they come in, so neither a task nor the
    driver holds more than one array of 2**SKETCH_BITS numbers.
    """
    width = (1 << SKETCH_BITS) // PARTS

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, own in common.runs_of(batch.column("text"), common.RUN_BYTES):
                np.add.at(total, (shingles(*common.text_buffer(own), words)[0] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            counts = np.minimum(total, 0xFFFF).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([counts[k * width : (k + 1) * width].tobytes() for k in range(PARTS)], pa.binary())], ["part", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, np.uint16).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    # PARTS rows, 4 MB in all, whatever the input
    rows = common.map_arrow(common.map_arrow(docs.select("text"), count, schema).repartition("part"), add, schema).collect()
    found = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in rows:
        found[r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, np.uint32)
    return found


def _rarest(found: np.ndarray, at: np.ndarray, popular: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text that may be the first one shared with a partner, rarest first, and n + 1 offsets."""
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n), dtype=np.int64), n)
    # hashes are in order already, so a stable sort leaves equal counts in the order of their hashes
    order = np.argsort(doc << 32 | popular[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64), kind="stable")
    places = np.arange(len(found)) - np.repeat(at[:-1], n)
    # the smallest partner has num / den of the size, all of it shared
    most = np.where(n > 0, n - -(-num * n // den) + 1, 0)
    return found[order[places < np.repeat(most, n)]].view(np.int64), np.concatenate([[0], np.cumsum(most)])


def index(docs: DataFrame, popular: np.ndarray, words: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, set_a, set_b, point, half, coarse, tokens) of every text; half has half as many groups as point."""
    held = docs.sparkSession.sparkContext.broadcast(popular)

    def lists(values, at):
        return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))

    def run(batches):
        popular = held.value
        for batch in batches:
            for i, j, own in common.runs_of(batch.column("text"), common.RUN_BYTES):
                found, at = shingles(*common.text_buffer(own), words)
                n = np.diff(at)
                coarse = np.bincount((np.repeat(np.arange(j - i), n) << COARSE_BITS) + (found >> np.uint64(64 - COARSE_BITS)).astype(np.int64), minlength=(j - i) << COARSE_BITS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(n),
                        pa.array(_mixed(found, at).view(np.int64)),
                        pa.array(_mixed(found ^ np.uint64(_STEPS[41]), at).view(np.int64)),
                        lists(*_points(found, at, 0)),
                        lists(*_points(found, at, 1)),
                        lists(coarse.astype(np.int32), np.arange(j - i + 1) << COARSE_BITS),
                        lists(*_rarest(found, at, popular, num, den)),
                    ],
                    ["doc_id", "n", "set_a", "set_b", "point", "half", "coarse", "tokens"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(docs, run, f"doc_id {kind}, n bigint, set_a bigint, set_b bigint, point array<int>, half array<int>, coarse array<int>, tokens array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) with sorted arrays of hashes, one row for each different text of an id."""

    def run(batches):
        for batch in batches:
            for i, j, own in common.runs_of(batch.column("text"), common.RUN_BYTES):
                found, at = shingles(*common.text_buffer(own), words)
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(_mixed(found, at).view(np.int64)), sets], ["doc_id", "set_a", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = common.map_arrow(docs, run, f"doc_id {kind}, set_a bigint, shingles array<bigint>")
    return rows.groupBy(F.struct(F.col("doc_id").alias("id"), F.col("set_a").alias("sig")).alias("rep")).agg(F.first("shingles").alias("shingles"))


def _needed(num: int, den: int) -> str:
    """The least overlap of two sets of sizes n_a and n_b that link."""
    return f"((n_a + n_b) * {num} + {den + num - 1}) div {den + num}"


def _places(num: int, den: int) -> Column:
    """Whether a shared shingle at places pos_a and pos_b may be the first of enough, and the sizes may link."""
    return F.expr(f"{den} * least(n_a, n_b) >= {num} * greatest(n_a, n_b) and pos_a <= n_a - {_needed(num, den)} and pos_b <= n_b - {_needed(num, den)}")


def _minima(one: str, two: str) -> str:
    return f"aggregate(zip_with({one}, {two}, (x, y) -> least(x, y)), 0L, (t, x) -> t + x)"


def _overlap(num: int, den: int) -> Column:
    """The bound by the smaller coordinates of point_a and point_b.

    Sizes that may link have as many groups or half as many; the finer point then gives its half.
    """
    return F.expr(f"{den + num} * {_minima('if(size(point_a) > size(point_b), half_a, point_a)', 'if(size(point_b) > size(point_a), half_b, point_b)')} >= {num} * (n_a + n_b)")


def _sided(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(side if c == "rep" else f"{c}_{side}") for c in columns])


def _cell(size: str) -> Column:
    """Sizes in cells of three hundredths; monotone, so a range of sizes is a range of cells."""
    return F.floor(F.log(F.expr(size).cast("double")) * 32).cast("int")


def _verified(pairs: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose shingle sets are similar enough."""
    wanted = common.stored(pairs.select(F.col("a.id").alias("doc_id")).union(pairs.select("b.id")).distinct())
    sets = shingle_sets(docs.join(common.if_small(wanted), "doc_id", "left_semi"), words)
    one, two = (sets.select(F.col("rep").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.filter(F.expr(f"{den + num} * size(array_intersect(set_a, set_b)) >= {num} * (n_a + n_b)")).select("a", "b")


#: How many hubs a page has in each round, and how many pairs a page member may leave on average before another round.
HUBS, FEW_PAIRS = (8, 16, 32), 20


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count("*").alias("n_links"))


def _merged(labels: DataFrame | None, more: DataFrame) -> DataFrame:
    """(rep, component) after more links, as a stored table; only components that they touch are put together anew."""
    if labels is None:
        return common.stored(components.components(more).withColumnRenamed("node", "rep"))
    ends = more
    for side in "ab":
        ends = ends.join(_sided(labels, side, "rep", "component"), side, "left").withColumn(side, F.coalesce(f"component_{side}", side)).drop(f"component_{side}")
    tops = common.stored(components.components(ends.select("a", "b").distinct()).select(F.col("node").alias("component"), F.col("component").alias("top")))
    known = labels.join(common.if_small(tops), "component", "left").select("rep", F.coalesce("top", "component").alias("component"))
    fresh = tops.select(F.col("component").alias("rep"), F.col("top").alias("component")).join(labels, "rep", "left_anti")
    return common.stored(known.union(fresh))


def _open(paged: DataFrame, labels: DataFrame, links: DataFrame) -> DataFrame:
    """The members of pages that hold more than one component, with components and links so far, as a stored table."""
    known = common.stored(labels.join(_degrees(links), "rep"))
    labelled = paged.join(common.if_small(known), "rep", "left").withColumn("component", F.coalesce("component", "rep")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    ends = [f(f"component.{c}").alias(f"{c}_{s}") for c in ("id", "sig") for s, f in (("low", F.min), ("high", F.max))]
    split = labelled.groupBy("page").agg(*ends).filter("id_low <> id_high or sig_low <> sig_high").select("page")
    return common.stored(labelled.join(split, "page"))


def _hubs(rest: DataFrame, used: DataFrame | None, many: int) -> DataFrame:
    """(page, hub, own, n_a, pos_a): of each page the members with most links so far, then with most company, that were no hubs yet."""
    order = Window.partitionBy("page").orderBy(F.col("n_links").desc(), F.col("company").desc(), "rep")
    free = rest if used is None else rest.join(used.select("page", F.col("hub").alias("rep")), ["page", "rep"], "left_anti")
    ranked = free.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= many)
    return common.stored(ranked.select("page", F.col("rep").alias("hub"), F.col("component").alias("own"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a")))


def _starred(rest: DataFrame, hubs: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the hubs of each page and its members of other components."""
    met = rest.withColumnsRenamed({"n": "n_b", "pos": "pos_b"}).join(hubs, "page").filter("component <> own").filter(_places(num, den))
    return met.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def _apart(rest: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of members of different components that some page may still link, by the nodes of that page."""
    # the smaller of two partners stands in the cell of its own size, the larger in those of all sizes it may meet
    small = rest.filter(F.expr(f"pos <= {den - num} * n div {den + num}")).withColumn("cell", _cell("n"))
    # a larger one needs no cell beyond the sizes that its page's smaller ones have
    sizes = common.stored(small.groupBy("page").agg(F.min("n").alias("n_low"), F.max("n").alias("n_high")))
    least, most = f"greatest(({num} * n + {den - 1}) div {den}, n_low)", f"least(n, ({den} * n - {den + num} * pos) div {num}, n_high)"
    large = rest.join(common.if_small(sizes), "page").filter(F.expr(f"{least} <= {most}")).withColumn("cell", F.explode(F.sequence(_cell(least), _cell(most)))).drop("n_low", "n_high")
    # cells where both kinds and two components meet
    ends = [f(f"component.{c}").alias(f"{c}_{s}") for c in ("id", "sig") for s, f in (("low", F.min), ("high", F.max))]
    both = small.select("page", "cell", "component", F.lit(1).alias("own")).union(large.select("page", "cell", "component", F.lit(0)))
    cells = both.groupBy("page", "cell").agg(F.max("own").alias("own"), *ends).filter("own = 1 and (id_low <> id_high or sig_low <> sig_high)").select("page", "cell")
    cells = common.stored(cells)
    columns = ["page", "cell", "component", "rep", "n", "pos"]
    small, large = (common.stored(side.join(cells, ["page", "cell"]).select(*columns)) for side in (small, large))

    def nodes(rows: DataFrame, side: str) -> DataFrame:
        boxed = rows.join(points.select("rep", "coarse"), "rep").groupBy("page", "cell", "component").agg(F.min("n").alias(f"n_{side}"), *[F.max(F.col("coarse")[k]).alias(f"c{k}") for k in range(1 << COARSE_BITS)])
        return boxed.select("page", "cell", F.col("component").alias(f"component_{side}"), f"n_{side}", F.array(*[f"c{k}" for k in range(1 << COARSE_BITS)]).alias(f"box_{side}"))

    met = nodes(small, "a").join(nodes(large, "b"), ["page", "cell"]).filter("component_a <> component_b")
    met = common.stored(met.filter(F.expr(f"{den + num} * {_minima('box_a', 'box_b')} >= {num} * (n_a + n_b)")).select("page", "cell", "component_a", "component_b"))
    one = small.select("page", "cell", F.col("component").alias("component_a"), F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("pos_a"))
    two = large.select("page", "cell", F.col("component").alias("component_b"), F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"))
    below = one.join(met, ["page", "cell", "component_a"]).join(two, ["page", "cell", "component_b"]).filter(F.expr("n_a <= n_b") & _places(num, den))
    return below.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for documents that link when den * overlap >= num * union.

    ``n_links`` counts the links of the document's class that were verified.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
    base = common.stored(index(docs, popularity(docs, words), words, num, den))
    sets = ["n", "set_a", "set_b"]
    slim = base.select("doc_id", *sets)
    many = common.stored(slim.filter("n > 0").groupBy(*sets).agg(F.min("doc_id").alias("low"), F.count("*").alias("size")).filter("size > 1").drop("size"))
    found = common.stored(slim.join(common.if_small(many), sets, "left").select("doc_id", *sets, F.coalesce("low", "doc_id").alias("low")).distinct())
    copies = common.stored(found.filter("doc_id <> low").select("doc_id", *sets))
    reps = base.join(common.if_small(copies), ["doc_id", *sets], "left_anti")
    keyed = reps.select(F.col("doc_id").alias("id"), F.col("set_a").alias("sig"), "n", F.posexplode("tokens").alias("pos", "page")).repartition("page")
    # one of two partners must have the page's shingle among its rarer half; both uses of ``keyed`` read all of
    # its columns, so that they share one exchange
    full = keyed.groupBy("page").agg(F.count("*").alias("members"), *[f(c).alias(f"{c}_{s}") for c in ("id", "sig") for s, f in (("low", F.min), ("high", F.max))], F.min("pos").alias("pos_low"), F.max("n").alias("n_high"))
    full = full.filter(F.expr(f"(id_low <> id_high or sig_low <> sig_high) and pos_low <= {den - num} * n_high div {den + num}"))
    paged = common.stored(keyed.join(full.select("page", "members"), "page").select("page", F.struct("id", "sig").alias("rep"), "n", "pos", "members").distinct())
    wanted = common.stored(paged.select(F.col("rep.id").alias("doc_id")).distinct())
    points = base.join(common.if_small(wanted), "doc_id", "left_semi").select(F.struct(F.col("doc_id").alias("id"), F.col("set_a").alias("sig")).alias("rep"), "n", "point", "half", "coarse")
    points = common.stored(points.join(paged.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep"]))
    company = paged.groupBy("rep").agg(F.sum("members").alias("company"))
    paged = common.stored(paged.join(company, "rep"))
    total = paged.count()

    def compared(pairs: DataFrame) -> DataFrame:
        near = pairs.join(_sided(points, "a", "rep", "n", "point", "half"), "a").join(_sided(points, "b", "rep", "n", "point", "half"), "b").filter(_overlap(num, den)).select("a", "b", "n_a", "n_b")
        return common.stored(_verified(common.stored(near), docs, words, num, den))

    past, links, used, labels = 0, None, None, None
    rest = paged.withColumn("component", F.col("rep")).withColumn("n_links", F.lit(0))
    for many in HUBS:
        hubs = _hubs(rest, used, many)
        more = compared(_starred(rest, hubs, num, den))
        links = more if links is None else links.union(more).distinct()
        used = hubs if used is None else used.union(hubs)
        past += many
        labels = _merged(labels, more)
        # a page with no more members than it has had hubs, and one, is done
        rest = _open(paged.filter(F.col("members") > past + 1), labels, links)
        pairs = rest.groupBy("page").agg(F.count("*").alias("m")).agg(F.sum(F.expr("cast(m as decimal(20, 0)) * m / 2"))).first()[0] or 0
        if pairs <= FEW_PAIRS * total:
            break
    if pairs:
        more = compared(_apart(rest, points, num, den))
        if more.limit(1).count():
            links = links.union(more).distinct()
            labels = _merged(labels, more)
    labels = common.stored(labels.join(_degrees(links), "rep", "left"))
    rows = found.withColumn("rep", F.struct(F.col("low").alias("id"), F.col("set_a").alias("sig"))).join(common.if_small(labels), "rep", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component.id", "rep.id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, columns as they were.

    All rows of an id stay or go together: they stay if one of its texts has the smallest id of its component. Rows with a null id stay.
    """
    found = jaccard_components(docs, words=words, num=num, den=den)
    first = found.groupBy("doc_id").agg(F.max((F.col("component_id") == F.col("doc_id")).cast("int")).alias("first"))
    gone = common.stored(first.filter("first = 0").select(F.col("doc_id").alias(common.fresh("gone", docs))))
    return docs.join(common.if_small(gone), F.col("doc_id") == F.col(gone.columns[0]), "left_anti")
