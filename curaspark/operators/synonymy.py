"""Synonymy: the table in which curators decide about names that share a sequence, its summary, and the published groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import sequences as S
from curaspark.operators.history import duplicate_groups, groups
from curaspark.operators.keys import first_wins
from curaspark.operators.sequences import all_pairs_compatible

#: What a side of a pair is told by: counts, then texts.
COUNTS = ("BASES", "HOST_RECORDS", "VECTOR_RECORDS", "HOSTS", "REFERENCES", "COUNTRIES", "MORPHO_LINKS", "ALT_NAMES")
SIDE = ("GENUS", "ACCESSION", "SEQ_CLASS", *COUNTS, "FIRST_YEAR", "REFERENCE_NAMES")


def profiles(lineages: DataFrame, hosts: DataFrame, vectors: DataFrame, references: DataFrame, morphology: DataFrame, alternatives: DataFrame) -> DataFrame:
    """One row a lineage with the columns of :data:`SIDE` and its ``seq``; of a name stored twice, the first row by accession and sequence counts.

    Records, hosts, countries and studies are counted over ``hosts`` and ``vectors`` (LINEAGE_NAME, SPECIES_NAME or VECTOR_SPECIES, COUNTRY_NAME,
    REFERENCE_NAME); every table is aggregated by lineage before it is joined. Blanks are not counted.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    base = first_wins(lineages.filter("LINEAGE_NAME <> ''").select("LINEAGE_NAME", "GENUS_NAME", "GENBANK_ACC", "SEQ_LENGTH", F.upper(F.coalesce("SEQUENCE", F.lit(""))).alias("seq")), ["LINEAGE_NAME"], ["GENBANK_ACC", "seq"])
    seen = hosts.select("LINEAGE_NAME", F.col("SPECIES_NAME").alias("_host"), "COUNTRY_NAME", "REFERENCE_NAME", F.lit(1).alias("_h"), F.lit(0).alias("_v")).union(
        vectors.select("LINEAGE_NAME", F.lit(""), "COUNTRY_NAME", "REFERENCE_NAME", F.lit(0), F.lit(1))
    )
    told = seen.groupBy("LINEAGE_NAME").agg(
        F.sum("_h").alias("HOST_RECORDS"), F.sum("_v").alias("VECTOR_RECORDS"), F.count_distinct(filled("_host")).alias("HOSTS"),
        F.count_distinct(filled("COUNTRY_NAME")).alias("COUNTRIES"), F.count_distinct(filled("REFERENCE_NAME")).alias("REFERENCES"),
    )
    cited = seen.filter("REFERENCE_NAME <> ''").select("LINEAGE_NAME", "REFERENCE_NAME").distinct()
    years = cited.join(references.select("REFERENCE_NAME", "PUBLICATION_YEAR"), "REFERENCE_NAME", "left").groupBy("LINEAGE_NAME").agg(F.min("PUBLICATION_YEAR").alias("FIRST_YEAR"), F.array_join(F.array_sort(F.collect_set("REFERENCE_NAME")), "; ").alias("REFERENCE_NAMES"))
    linked = morphology.groupBy("LINEAGE_NAME").agg(F.count_distinct(filled("SPECIES_NAME")).alias("MORPHO_LINKS"))
    named = alternatives.groupBy("LINEAGE_NAME").agg(F.count_distinct(filled("ALT_NAME")).alias("ALT_NAMES"))
    rows = base.withColumn("BASES", F.length(F.regexp_replace("seq", "[^ACGT]", "")))
    for part in (told, years, linked, named):
        rows = rows.join(part, "LINEAGE_NAME", "left")
    text = lambda c, name: F.coalesce(F.col(c), F.lit("")).alias(name)
    return rows.select("LINEAGE_NAME", "seq", text("GENUS_NAME", "GENUS"), text("GENBANK_ACC", "ACCESSION"), text("SEQ_LENGTH", "SEQ_CLASS"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], "FIRST_YEAR", text("REFERENCE_NAMES", "REFERENCE_NAMES"))


def _side(known: DataFrame, prefix: str) -> DataFrame:
    return known.select(F.col("LINEAGE_NAME").alias(prefix), F.col("seq").alias(f"_{prefix}"), *[F.col(c).alias(f"{prefix}_{c}") for c in SIDE])


def _proposal(floor: int, small: int) -> Column:
    """What is proposed, by the first rule that holds; only the two that begin with 'merge' name a target."""
    records = lambda side: F.col(f"{side}_HOST_RECORDS") + F.col(f"{side}_VECTOR_RECORDS")
    contained = F.col("KIND") == "contained"
    return (
        F.when((F.col("LINEAGE_GENUS") != "") & (F.col("OTHER_GENUS") != "") & (F.col("LINEAGE_GENUS") != F.col("OTHER_GENUS")), "decide: genera differ")
        .when(F.col("COMPARABLE") < floor, "none: too little shared")
        .when(F.col("KIND") == "duplicate", "merge: one sequence")
        .when(contained & (F.col("N_CONTAINERS") > 1), "decide: several hold it")
        .when(contained & (records("LINEAGE") <= small), "merge: adds little")
        .when(contained & (records("LINEAGE") > records("OTHER")), "decide: better established")
        .when(contained, "decide: records would move")
        .otherwise("by hand: each has positions of its own")
    )


def synonymy_review(known: DataFrame, width: int, alternatives: DataFrame, decisions: DataFrame, floor: int = 300, small: int = 1, shared: int = 1) -> DataFrame:
    """The review table, one row a compatible pair of names. ``known`` is :func:`profiles`, ``decisions`` (LINEAGE_NAME, DECISION) what was decided before.

    A duplicate's weaker name (fewer records, then the later first year, then the later name) is LINEAGE, a contained one's the less complete; its
    target is the strongest name of the whole group or the one container. DECISION, INTO and CURATOR_NOTE are for the curator to fill.
    CONTAINERS are told in name order.
    """
    records = F.col("HOST_RECORDS") + F.col("VECTOR_RECORDS")
    pairs = all_pairs_compatible(known.filter("BASES > 0"), "LINEAGE_NAME", "seq", width, min_shared=shared)
    strength = known.select(F.col("LINEAGE_NAME"), records.alias("records"), F.col("FIRST_YEAR").alias("first_year"))
    rank = lambda side: strength.select(F.col("LINEAGE_NAME").alias(side), F.struct((-F.col("records")).alias("r"), F.coalesce("first_year", F.lit(9999)).alias("y"), F.col("LINEAGE_NAME").alias("n")).alias(f"_{side}"))
    ranked = pairs.join(rank("a"), "a").join(rank("b"), "b")
    turned = F.when(F.col("kind") == "duplicate", F.col("_a") < F.col("_b")).otherwise((F.col("kind") == "contained") & (F.col("a_private") > 0))
    pick = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    rows = ranked.select(F.col("kind").alias("KIND"), pick("b", "a").alias("LINEAGE"), pick("a", "b").alias("OTHER"), F.col("comparable").alias("COMPARABLE"), pick("b_private", "a_private").alias("LINEAGE_PRIVATE"), pick("a_private", "b_private").alias("OTHER_PRIVATE"))
    held = rows.filter("KIND = 'contained'").groupBy("LINEAGE").agg(F.array_sort(F.collect_set("OTHER")).alias("_in"))
    doubles = duplicate_groups(pairs.filter("kind = 'duplicate'").select("a", "b"), strength).select(F.col("member").alias("LINEAGE"), F.col("survivor").alias("_best"))
    alt = alternatives.filter("ALT_NAME <> ''").select("LINEAGE_NAME", "ALT_NAME").distinct()
    both = alt.select(F.col("LINEAGE_NAME").alias("LINEAGE"), F.col("ALT_NAME").alias("OTHER")).union(alt.select("ALT_NAME", "LINEAGE_NAME")).distinct().withColumn("ALREADY_ALT_NAME", F.lit("yes"))
    prior = decisions.groupBy("LINEAGE_NAME").agg(F.max("DECISION").alias("PRIOR_DECISION")).withColumnRenamed("LINEAGE_NAME", "LINEAGE")
    rows = rows.join(held, "LINEAGE", "left").join(doubles, "LINEAGE", "left").join(both, ["LINEAGE", "OTHER"], "left").join(prior, "LINEAGE", "left")
    rows = rows.join(_side(known, "LINEAGE"), "LINEAGE").join(_side(known, "OTHER"), "OTHER")
    mine = F.when(F.col("KIND") == "contained", F.col("_in")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({"N_CONTAINERS": F.size(mine), "CONTAINERS": F.array_join(mine, ", "), "AMBIGUITY_CODE_MATCHES": S.code_matches(F.col("_LINEAGE"), F.col("_OTHER"))})
    rows = rows.withColumn("PROPOSAL", _proposal(floor, small))
    target = F.when(F.col("PROPOSAL") == "merge: one sequence", F.col("_best")).when(F.col("PROPOSAL") == "merge: adds little", F.col("OTHER")).otherwise("")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("ALREADY_ALT_NAME", "PRIOR_DECISION")]
    sides = [f"{p}_{c}" for p in ("LINEAGE", "OTHER") for c in SIDE]
    return rows.select("KIND", "LINEAGE", "OTHER", "PROPOSAL", target.alias("PROPOSED_INTO"), F.lit("").alias("DECISION"), target.alias("INTO"), F.lit("").alias("CURATOR_NOTE"), "COMPARABLE", "LINEAGE_PRIVATE", "OTHER_PRIVATE", "AMBIGUITY_CODE_MATCHES", "N_CONTAINERS", "CONTAINERS", *blank, *sides)


def review_summary(review: DataFrame, floor: int = 300) -> DataFrame:
    """One row of counts over the review table: pairs by kind, names in pairs, contained names (and with one container), merges, pairs below the floor or across genera."""
    count = lambda test: F.count(F.when(test, 1))
    pairs = review.agg(
        F.count("*").alias("n_pairs"), *[count(F.col("KIND") == k).alias(f"n_{k}") for k in ("duplicate", "contained", "ambiguous")], count(F.col("PROPOSED_INTO") != "").alias("n_proposed_merges"),
        count(F.col("COMPARABLE") < floor).alias("n_below_floor"), count((F.col("LINEAGE_GENUS") != "") & (F.col("OTHER_GENUS") != "") & (F.col("LINEAGE_GENUS") != F.col("OTHER_GENUS"))).alias("n_cross_genus"),
        count(F.col("ALREADY_ALT_NAME") != "").alias("n_already_alt_name"), F.count_distinct(F.when(F.col("KIND") == "contained", F.col("LINEAGE"))).alias("n_contained_lineages"),
        F.count_distinct(F.when((F.col("KIND") == "contained") & (F.col("N_CONTAINERS") == 1), F.col("LINEAGE"))).alias("n_contained_unique"),
    )
    names = review.select(F.explode(F.array("LINEAGE", "OTHER")).alias("x")).agg(F.count_distinct("x").alias("n_lineages_in_pairs"))
    return pairs.join(names)  # one row each


def synonymy_report(pairs: DataFrame, lineages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((haplotype, lineage, n_names), one row of counts): names of one sequence by group, groups named by their smallest member.

    ``pairs`` (a, b, kind): duplicates make groups. Inflation is what the surplus names add, in per cent of the sequences without them.
    """
    members = groups(pairs.filter("kind = 'duplicate'").select("a", "b"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n_names"))
    rows = members.join(sizes, "group").select(F.col("group").alias("haplotype"), F.col("member").alias("lineage"), "n_names")
    counts = sizes.agg(F.coalesce(F.sum("n_names"), F.lit(0)).alias("n_names"), F.count("*").alias("n_haplotypes")).join(lineages.agg(F.count_distinct("LINEAGE_NAME").alias("n_lineages")))
    surplus = F.col("n_names") - F.col("n_haplotypes")
    return rows, counts.withColumn("pct_inflation", F.when(F.col("n_lineages") > surplus, 100.0 * surplus / (F.col("n_lineages") - surplus)))
