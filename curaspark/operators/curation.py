"""Ingest helpers: back-fills, claims, runs, fills, gates and placement of sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.operators.keys import row_numbers


def backfill(rows: DataFrame, store: DataFrame, exact: list[str], coarse: list[str], value: str, order: str, as_: str) -> DataFrame:
    """The store's value for the exact key, else for the coarser one; the first row of each key wins."""
    fine = store.filter(F.col(value) != "").groupBy(*exact).agg(F.min_by(value, F.struct(order, value)).alias("_fine"))
    wide = store.filter(F.col(value) != "").groupBy(*coarse).agg(F.min_by(value, F.struct(order, value)).alias("_wide"))
    return rows.join(fine, exact, "left").join(wide, coarse, "left").withColumn(as_, F.coalesce("_fine", "_wide", F.lit(""))).drop("_fine", "_wide")


def earliest_claim(claims: DataFrame, name: str, order: list[str], owner: str) -> DataFrame:
    """(name, holder, others): the first claim of a name holds it, the other owners collide."""
    first = claims.groupBy(name).agg(F.min_by(owner, F.struct(*order)).alias("holder"), F.count_distinct(owner).alias("_n"))
    return first.select(name, "holder", (F.col("_n") - 1).alias("others"))


def next_free_number(names: DataFrame, column: str) -> DataFrame:
    """(acronym, taken, next_free) of names that are a stem and a number."""
    parts = names.select(F.regexp_extract(column, "^([A-Z]+)[0-9]+$", 1).alias("acronym"), F.regexp_extract(column, "([0-9]+)$", 1).try_cast("long").alias("n")).filter("acronym <> ''").distinct()
    return parts.groupBy("acronym").agg(F.count("*").alias("taken"), (F.max("n") + 1).alias("next_free"))


def runs(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """(group, run, value, n): stretches of consecutive rows with one value."""
    ordered = Window.partitionBy(*group).orderBy(*order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(ordered))).cast("int")
    marked = rows.withColumn("_new", changed).withColumn("run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*group, "run", value).agg(F.count("*").alias("n"))


def best_hit(hits: DataFrame, query: str, order: list[Column], value: str) -> DataFrame:
    """(query, best): the first hit in an order, by an aggregate."""
    return hits.groupBy(query).agg(F.min_by(value, F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])).alias("best"))


def propose_fills(rows: DataFrame, records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, ours, theirs, verdict): fill a blank, same, conflict, or none."""
    theirs = records.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("ours"), F.col(f"_{c}").cast("string").alias("theirs")) for c in columns])
    long = rows.join(theirs, key).select(key, F.explode(cells).alias("x")).select(key, "x.*")
    ours, other = F.coalesce("ours", F.lit("")), F.coalesce("theirs", F.lit(""))
    verdict = F.when(other == "", "none").when(ours == "", "fill").when(F.lower(ours) == F.lower(other), "same").otherwise("conflict")
    return long.withColumn("verdict", verdict)


def dedup_rows(rows: DataFrame, identity: list[str], block: str) -> DataFrame:
    """(identity, blocks, dropped): identical claims collapse and remember where they stood."""
    return rows.groupBy(*identity).agg(F.array_sort(F.collect_set(block)).alias("blocks"), (F.count("*") - 1).alias("dropped"))


def release_gate(inventory: DataFrame, states: DataFrame, exempt: str) -> DataFrame:
    """(source, n_rows, verdict): a source is exempt, publishable by its ledger state, or refused."""
    joined = inventory.join(states.select(F.col("submission").cast("string").alias("source"), "state"), "source", "left")
    verdict = (
        F.when(F.col("source") == exempt, "exempt")
        .when(F.col("source") == "", "refused: no source")
        .when(F.col("state").isNull(), "refused: not in the ledger")
        .when(F.col("state") == "approved", "publishing")
        .otherwise(F.concat(F.lit("refused: "), "state"))
    )
    return joined.select("source", "n_rows", verdict.alias("verdict"))


def exact_resolve(queries: DataFrame, references: DataFrame, width: int, anchors: int = 4, least: int = 1) -> DataFrame:
    """(query, verdict, names) of sequences that agree with references wherever both are determined."""
    from curaspark.operators.sequences import compatible_references

    pairs = compatible_references(queries, references, width, anchors, least)
    best = pairs.groupBy("query").agg(F.max(F.struct("comparable")).alias("top"), F.collect_list(F.struct("comparable", "names")).alias("all"))
    full = F.filter("all", lambda x: x["comparable"] == F.col("top.comparable"))
    named = best.select("query", F.array_sort(F.array_distinct(F.flatten(F.transform(full, lambda x: x["names"])))).alias("names"))
    rows = queries.select(F.col("name").alias("query")).join(named, "query", "left")
    return rows.select("query", F.when(F.col("names").isNull(), "none").when(F.size("names") > 1, "ambiguous").otherwise("exact").alias("verdict"), F.coalesce("names", F.array().cast("array<string>")).alias("names"))


def register_offset(rows: DataFrame, name: str, seq: str, reference: Column, most: int, overlap: int, limit: float = 0.35) -> DataFrame:
    """(name, offset, mismatches, comparable): the best shift of each sequence along a reference, null where none fits.

    All shifts of a row are one array expression, so nothing is multiplied or shuffled.
    """

    def at(shift: Column) -> Column:
        own = F.substring(F.col(seq), F.greatest(F.lit(1), 1 - shift), F.length(F.col(seq)))
        there = F.substring(reference, F.greatest(F.lit(1), 1 + shift), F.length(own))
        pairs = F.zip_with(F.split(F.substring(own, F.lit(1), F.length(there)), ""), F.split(there, ""), lambda x, y: F.when(x.isin(*"ACGT") & y.isin(*"ACGT"), F.when(x == y, 0).otherwise(1)))
        known = F.filter(pairs, lambda v: v.isNotNull())
        return F.struct(F.aggregate(known, F.lit(0), lambda t, v: t + v).alias("mismatches"), F.size(known).alias("comparable"), shift.alias("offset"))

    tried = F.transform(F.sequence(F.lit(-most), F.lit(most)), at)
    good = F.filter(tried, lambda x: (x["comparable"] >= overlap) & (x["mismatches"] <= x["comparable"] * limit))
    ranked = F.array_min(F.transform(good, lambda x: F.struct((x["mismatches"] / x["comparable"]).alias("rate"), (-x["comparable"]).alias("less"), F.abs(x["offset"]).alias("far"), x["offset"].alias("offset"), x["mismatches"].alias("mismatches"))))
    out = rows.select(F.col(name).alias("name"), ranked.alias("best"))
    return out.select("name", F.col("best.offset").cast("long").alias("offset"), F.col("best.mismatches").cast("long").alias("mismatches"), (-F.col("best.less")).cast("long").alias("comparable"))


def canonical_host(rows: DataFrame, names: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(name, canonical, rule): exact, without its third word, by a genus synonym, or unmatched."""
    known = names.select(F.col("name").alias("_k")).distinct()
    words = F.split("name", " ")
    rows = rows.select("name").distinct().withColumn("_two", F.concat_ws(" ", words[0], F.get(words, 1)))
    joined = rows.join(known.withColumnRenamed("_k", "_exact"), F.col("name") == F.col("_exact"), "left").join(known.withColumnRenamed("_k", "_trim"), F.col("_two") == F.col("_trim"), "left")
    joined = joined.join(synonyms.select(F.col("old").alias("_old"), F.col("new").alias("_new")), words[0] == F.col("_old"), "left")
    joined = joined.withColumn("_other", F.concat_ws(" ", "_new", F.get(F.split("_two", " "), 1))).join(known.withColumnRenamed("_k", "_syn"), F.col("_other") == F.col("_syn"), "left")
    rule = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_trim").isNotNull(), "trimmed").when(F.col("_syn").isNotNull(), "genus synonym").otherwise("unmatched")
    return joined.select("name", F.coalesce("_exact", "_trim", "_syn").alias("canonical"), rule.alias("rule"))


def mine_terms(docs: DataFrame, vocabulary: DataFrame, longest: int = 3) -> DataFrame:
    """(doc_id, term, n): whole-word terms of up to ``longest`` words, by a join instead of one pattern each."""
    words = F.filter(F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}0-9]+", " "), " "), lambda w: w != "")
    rows = docs.select("doc_id", words.alias("w"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
        return F.transform(starts, lambda i: F.when(i + n <= F.size("w"), F.array_join(F.slice("w", i + 1, F.lit(n)), " ")))

    grams = F.flatten(F.array(*[of(n) for n in range(1, longest + 1)]))
    terms = vocabulary.select(F.col("term"), F.lower("term").alias("_t")).distinct()
    return rows.select("doc_id", F.explode(grams).alias("_t")).join(terms, "_t").groupBy("doc_id", "term").agg(F.count("*").alias("n"))


def propose_merges(pairs: DataFrame, profiles: DataFrame, floor: int, small: int) -> DataFrame:
    """(a, b, rule, target) of compatible pairs: too little shared, duplicate, contained, small or ambiguous."""
    side = lambda s: profiles.select(F.col("LINEAGE_NAME").alias(s), F.col("records").alias(f"r_{s}"), F.col("first_year").alias(f"y_{s}"))
    rows = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    key = lambda s: F.struct((-F.coalesce(f"r_{s}", F.lit(0))).alias("r"), F.coalesce(f"y_{s}", F.lit(9999)).alias("y"), F.col(s).alias("n"))
    survivor = F.when(key("a") < key("b"), F.col("a")).otherwise(F.col("b"))
    whole = F.when(F.col("a_private") == 0, F.col("b")).otherwise(F.col("a"))
    rule = F.when(F.col("comparable") < floor, "too little shared").when(F.col("kind") == "duplicate", "duplicate").when(F.col("kind") == "contained", "contained").when(F.least("a_private", "b_private") <= small, "small difference").otherwise("ambiguous")
    return rows.select("a", "b", rule.alias("rule"), F.when(rule == "duplicate", survivor).when(rule == "contained", whole).alias("target"))


# Kinds of pairs in reading order.
REVIEW_KINDS = ("duplicate", "contained", "ambiguous")


def review_order(pairs: DataFrame) -> DataFrame:
    """``pairs`` (kind, a, b) with ``position`` in reading order: duplicates, then contained, then ambiguous, other kinds last, by names within."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(k) for k in REVIEW_KINDS]), F.col("kind")), F.lit(0)), F.lit(len(REVIEW_KINDS) + 1))
    return row_numbers(pairs.withColumn("_place", place), ["_place", "kind", "a", "b"], "position").drop("_place")
