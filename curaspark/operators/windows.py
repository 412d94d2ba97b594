"""Seeds in sequences of any length: k-mers, where a barcode lies, windows around hits, and calls from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.functions.sequences import reverse_complement


def kmers(df: DataFrame, name: str, seq: str, k: int, step: int = 1, as_: str = "kmer") -> DataFrame:
    """(name, pos, kmer) of all k-mers of plain bases, the first position is 0."""
    last = F.length(seq) - k
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    rows = df.select(F.col(name), F.upper(seq).alias("_seq"), F.explode(starts).alias("pos"))
    return rows.select(name, "pos", F.substring("_seq", F.col("pos") + 1, F.lit(k)).alias(as_)).filter(~F.col(as_).rlike("[^ACGT]"))


def both_strands(df: DataFrame, name: str, seq: str) -> DataFrame:
    return df.select(name, F.lit("+").alias("strand"), F.upper(seq).alias(seq)).union(df.select(name, F.lit("-"), reverse_complement(F.col(seq))))


def locate_window(queries: DataFrame, references: DataFrame, k: int = 12, name: str = "name", seq: str = "seq", top: int = 1) -> DataFrame:
    """(query, strand, offset, votes): where a query lies in the frame of the references, by seeds that vote for offsets.

    Seeds of all references at one place of the frame are one entry, so that a frequent seed votes once; votes are
    added up by (query, strand, offset) and the best offsets of a query are kept, more votes first, then forward, then smaller.
    """
    seeds = kmers(references, name, seq, k).select("kmer", F.col("pos").alias("at")).distinct()
    asked = both_strands(queries, name, seq)
    own = kmers(asked.withColumn("_id", F.struct(name, "strand")), "_id", seq, k)
    votes = own.join(seeds, "kmer").groupBy(F.col(f"_id.{name}").alias("query"), F.col("_id.strand").alias("strand"), (F.col("at") - F.col("pos")).alias("offset")).agg(F.count("*").alias("votes"))
    best = Window.partitionBy("query").orderBy(F.col("votes").desc(), "strand", "offset")
    return votes.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= top).drop("_r")


def informative_kmers(references: DataFrame, k: int, name: str = "name", seq: str = "seq") -> DataFrame:
    """Distinct k-mers of the references on both strands."""
    return kmers(both_strands(references, name, seq), name, seq, k).select("kmer").distinct()


def hit_windows(contigs: DataFrame, index: DataFrame, k: int, margin: int, name: str = "name", seq: str = "seq") -> DataFrame:
    """(contig, first, last, hits): stretches around hits, joined where they overlap.

    Islands by the furthest end so far, in the order of a contig's hits.
    """
    hits = kmers(contigs, name, seq, k).join(index, "kmer", "left_semi").select(F.col(name).alias("contig"), F.greatest(F.col("pos") - margin, F.lit(0)).alias("first"), (F.col("pos") + k + margin).alias("last"))
    ordered = Window.partitionBy("contig").orderBy("first", "last")
    reach = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = hits.withColumn("_new", F.when(reach.isNull() | (F.col("first") > reach), 1).otherwise(0))
    islands = marked.withColumn("_island", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("contig", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("hits")).drop("_island")


def genome_call(hits: DataFrame, least: int) -> DataFrame:
    """(contig, call, name, rivals) from hits (contig, name, mismatches, comparable): exact without a rival reading, near, or none.

    A rival agrees just as well; a hit that compares fewer than ``least`` positions is never exact.
    """
    order = F.struct((-F.col("comparable")).alias("c"), F.col("name"))
    exact = (F.col("mismatches") == 0) & (F.col("comparable") >= least)
    summed = hits.groupBy("contig").agg(F.sum(exact.cast("long")).alias("n"), F.min(F.when(exact, order)).alias("e"), F.min(F.struct("mismatches", order.alias("o"))).alias("any"))
    call = F.when(F.col("n") == 1, "exact").when(F.col("n") > 1, "several").otherwise("near")
    return summed.select("contig", call.alias("call"), F.coalesce("e.name", "any.o.name").alias("name"), F.greatest(F.col("n") - 1, F.lit(0)).alias("rivals"))


def cytb_check(records: DataFrame, found: DataFrame) -> DataFrame:
    """(accession, verdict): does the barcode in a record (accession, lineage) match the lineage it is filed under?"""
    seen = found.groupBy("accession").agg(F.collect_set("name").alias("_names"))
    joined = records.join(seen, "accession", "left")
    verdict = F.when(F.col("_names").isNull(), "no barcode").when(F.array_contains("_names", F.col("lineage")), "agrees").otherwise("another lineage")
    return joined.select("accession", verdict.alias("verdict"))


def misframed(placed: DataFrame, width: int, seq: str = "seq", offset: str = "offset") -> DataFrame:
    """Rows that lose real bases when they are placed in the window, with how many before and behind it."""
    before = F.length(F.regexp_replace(F.substring(F.upper(seq), F.lit(1), F.greatest(-F.col(offset), F.lit(0)).cast("int")), "[^ACGT]", ""))
    beyond = F.greatest(F.col(offset) + F.length(seq) - width, F.lit(0)).cast("int")
    behind = F.length(F.regexp_replace(F.right(F.upper(seq), beyond), "[^ACGT]", ""))
    return placed.withColumn("lost_before", before).withColumn("lost_behind", F.when(beyond > 0, behind).otherwise(0)).filter("lost_before + lost_behind > 0")


def unusual_bases(queries: DataFrame, profile: DataFrame, rare: float = 0.01, name: str = "name", seq: str = "seq") -> DataFrame:
    """(name, position, base, kind): bases that no reference has at a place, at a place where all agree, or few have.

    ``profile`` is (position, n_A, n_C, n_G, n_T); shares are smoothed by one count.
    """
    cells = queries.select(name, F.posexplode(F.split(F.upper(seq), "")).alias("position", "base")).filter(F.col("base").isin(*"ACGT"))
    total = sum((F.col(f"n_{b}") for b in "ACGT"), F.lit(0))
    own = F.lit(0)
    for b in "ACGT":
        own = F.when(F.col("base") == b, F.col(f"n_{b}")).otherwise(own)
    kinds = sum(((F.col(f"n_{b}") > 0).cast("int") for b in "ACGT"), F.lit(0))
    joined = cells.join(profile, "position")
    kind = F.when((own == 0) & (kinds == 1), "changes an invariant site").when(own == 0, "never seen").when((own + 1) / (total + 4) < rare, "rare")
    return joined.select(name, F.col("position").cast("long").alias("position"), "base", kind.alias("kind")).filter("kind is not null")


def local_hits(queries: DataFrame, references: DataFrame, k: int = 12, match: int = 1, mismatch: int = 2, drop: int = 20) -> DataFrame:
    """(query, strand, name, offset, matches, length, score): ungapped alignments of sequences of any length (name, seq), seeded by common k-mers.

    References of one text are one reference, told with its smallest name. Queries are cut into k-mers side by side, references into all
    of theirs, so an exact stretch of 2k - 1 bases has a seed; seeds of one diagonal are one extension. It runs along the
    diagonal and keeps the best stretch: a stretch ends where its score falls below zero or by more than ``drop`` from its best.
    """
    texts = references.select(F.upper("seq").alias("seq"), "name").groupBy("seq").agg(F.min("name").alias("name"))
    index = kmers(texts, "name", "seq", k).select("kmer", "name", F.col("pos").alias("at"))
    asked = both_strands(queries, "name", "seq")
    own = kmers(asked.withColumn("_id", F.struct("name", "strand")), "_id", "seq", k, step=k)
    seeds = own.join(index, "kmer").select(F.col("_id.name").alias("query"), F.col("_id.strand").alias("strand"), "name", (F.col("at") - F.col("pos")).alias("offset")).distinct()
    pairs = seeds.join(asked.select(F.col("name").alias("query"), "strand", F.col("seq").alias("q")), ["query", "strand"]).join(texts.select("name", F.col("seq").alias("r")), "name")
    first = F.greatest(F.lit(0), F.col("offset")).cast("int")
    width = (F.least(F.length("r"), F.length("q") + F.col("offset")) - first).cast("int")
    steps = F.zip_with(F.split(F.substring("q", first - F.col("offset").cast("int") + 1, width), ""), F.split(F.substring("r", first + 1, width), ""), lambda a, b: F.when((a == b) & a.isin(*"ACGT"), 1).otherwise(0))
    zero = F.lit(0)
    nothing = F.struct(*[zero.alias(n) for n in ("score", "length", "matches", "peak", "best", "best_length", "best_matches")])

    def step(s: Column, hit: Column) -> Column:
        score = s["score"] + F.when(hit == 1, match).otherwise(-mismatch)
        ended = (score < 0) | (score < s["peak"] - drop)
        now, length, matches = F.when(ended, 0).otherwise(score), F.when(ended, 0).otherwise(s["length"] + 1), F.when(ended, 0).otherwise(s["matches"] + hit)
        better = now > s["best"]
        kept = lambda new, old: F.when(better, new).otherwise(s[old])
        return F.struct(now.alias("score"), length.alias("length"), matches.alias("matches"), F.when(ended, 0).otherwise(F.greatest(s["peak"], score)).alias("peak"), kept(now, "best").alias("best"), kept(length, "best_length").alias("best_length"), kept(matches, "best_matches").alias("best_matches"))

    run = pairs.select("query", "strand", "name", "offset", F.aggregate(steps, nothing, step).alias("x"))
    return run.select("query", "strand", "name", "offset", F.col("x.best_matches").alias("matches"), F.col("x.best_length").alias("length"), F.col("x.best").alias("score"))


def novelty_vs_db(candidates: DataFrame, references: DataFrame, identity: float = 0.9, least: int = 200, shortest: int = 28, k: int = 12) -> DataFrame:
    """(name, paper, verdict, lineage, identity, length): candidates (name, seq, paper) against a store (name, seq).

    The best hit of a candidate has the highest identity, then the greatest length, then the smallest name, among those of at least ``identity``
    over ``shortest`` bases. known if it is identical over ``least`` bases or more, else novel; no hit without one.
    """
    hits = local_hits(candidates.select("name", "seq"), references, k).withColumn("identity", F.col("matches") / F.col("length"))
    good = hits.filter((F.col("identity") >= identity) & (F.col("length") >= shortest))
    best = good.groupBy(F.col("query").alias("name")).agg(F.min(F.struct((-F.col("identity")).alias("i"), (-F.col("length")).alias("l"), F.col("name").alias("n"))).alias("b"))
    joined = candidates.select("name", "paper").join(best, "name", "left")
    verdict = F.when(F.col("b").isNull(), "no hit").when((F.col("b.i") == -1) & (-F.col("b.l") >= least), "known").otherwise("novel")
    return joined.select("name", "paper", verdict.alias("verdict"), F.col("b.n").alias("lineage"), (-F.col("b.i")).alias("identity"), (-F.col("b.l")).cast("long").alias("length"))


def novelty_by_paper(verdicts: DataFrame) -> DataFrame:
    """(paper, known, novel, no_hit, names): what each paper brings, with the candidates that a curator has to look at."""
    n = lambda v: F.count(F.when(F.col("verdict") == v, 1))
    return verdicts.groupBy("paper").agg(n("known").alias("known"), n("novel").alias("novel"), n("no hit").alias("no_hit"), F.array_sort(F.collect_list(F.when(F.col("verdict") != "known", F.col("name")))).alias("names"))
