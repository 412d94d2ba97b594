"""Row flags, triage tiers, membership checks and plausibility against what is already known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Flags that stop a row, flags that need a look.
INCOMPLETE = ("lineage_missing", "host_missing", "vector_missing")
REVIEW = ("lineage_unresolved", "lineage_not_in_store", "lineage_accession_conflict", "host_not_in_store", "source_reprinted", "prevalence_inconsistent")
SETTLED = ("resolved", "already_named")
TIERS = ("incomplete", "review", "confirms", "new")


def known_membership(rows: DataFrame, column: str, vocabulary: DataFrame, as_: str) -> DataFrame:
    """``rows`` with a boolean: whether the value stands in the vocabulary (null vocabulary: not looked)."""
    names = vocabulary.select(F.col(vocabulary.columns[0]).alias("_v")).distinct().withColumn("_known", F.lit(True))
    return rows.join(names, F.col(column) == F.col("_v"), "left").withColumn(as_, F.coalesce("_known", F.lit(False))).drop("_v", "_known")


def held_by_others(rows: DataFrame, table: DataFrame, key: list[str], value: str, as_: str) -> DataFrame:
    """``rows`` with a boolean: whether ``table`` has the row's key under another value than the row's own.

    A key's smallest and largest value tell that, so no set of values is gathered, however many a key has. Blank values of the
    table are none; a row without a key is never held.
    """
    ends = table.filter(F.col(value) != "").groupBy(*key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    other = lambda end: F.coalesce(F.col(end) != F.col(value), F.col(end).isNotNull())
    return rows.join(ends, key, "left").withColumn(as_, other("_low") | other("_high")).drop("_low", "_high")


def row_flags(rows: DataFrame, store: DataFrame | None, species: str = "SPECIES_NAME", accessions: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``flags`` and ``tier``. Nothing is dropped; without a store its checks are skipped.

    Rows of vectors name their column in ``species``; the store's hosts and pairs say nothing about them. ``accessions`` (ACCESSION,
    LINEAGE_NAME) is what the store files each accession under. Columns lineage_resolution, source_scope and ACCESSION of the rows are
    looked at if they are there. A null is taken as blank.
    """
    have, vectors = set(rows.columns), species == "VECTOR_SPECIES"
    named = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    unresolved = F.coalesce(~F.col("lineage_resolution").isin(*SETTLED), F.lit(False)) if "lineage_resolution" in have else F.lit(False)
    looked = []
    if store is not None:
        rows = known_membership(rows, "LINEAGE_NAME", store.select("LINEAGE_NAME"), "_lineage")
        rows = known_membership(rows, "COUNTRY_NAME", store.select("COUNTRY_NAME"), "_country")
        looked += [
            F.when(named("LINEAGE_NAME") & ~unresolved & ~F.col("_lineage"), "lineage_not_in_store"),
            F.when(named("COUNTRY_NAME") & ~F.col("_country"), "country_not_in_store"),
        ]
        if not vectors:
            rows = known_membership(rows, species, store.select(species), "_host")
            rows = held_by_others(rows, store, ["LINEAGE_NAME", species], "REFERENCE_NAME", "_pair")
            looked += [
                F.when(named(species) & ~F.col("_host"), "host_not_in_store"),
                F.when(named("LINEAGE_NAME") & named(species) & F.col("_pair"), "pair_already_in_store"),
            ]
    if accessions is not None and "ACCESSION" in have:
        rows = held_by_others(rows, accessions.filter("ACCESSION <> ''"), ["ACCESSION"], "LINEAGE_NAME", "_filed")
        looked.append(F.when(named("LINEAGE_NAME") & F.col("_filed"), "lineage_accession_conflict"))
    if "source_scope" in have:
        looked += [F.when(F.col("source_scope") == "reprinted", "source_reprinted"), F.when(F.col("source_scope") == "scope_uncertain", "source_uncertain")]
    own = [
        F.when(~named("LINEAGE_NAME"), "lineage_missing").when(unresolved, "lineage_unresolved"),
        F.when(~named(species), "vector_missing" if vectors else "host_missing"),
        F.when(~named("COUNTRY_NAME"), "country_missing"),
        F.when(F.col("NUMBER_FOUND") > F.col("NUMBER_TESTED"), "prevalence_inconsistent"),
    ]
    rows = rows.withColumn("flags", F.array_compact(F.array(*own, *looked)))
    has = lambda names: F.arrays_overlap("flags", F.array(*[F.lit(n) for n in names]))
    tier = F.when(has(INCOMPLETE), "incomplete").when(has(REVIEW), "review").when(has(("pair_already_in_store",)), "confirms").otherwise("new")
    return rows.withColumn("tier", tier).drop("_lineage", "_host", "_country", "_pair", "_filed")


def tier_counts(flagged: DataFrame) -> DataFrame:
    tiers = flagged.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in TIERS])).alias("tier"))
    return tiers.join(flagged.groupBy("tier").agg(F.count("*").alias("n")), "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"))


def flag_counts(flagged: DataFrame) -> DataFrame:
    return flagged.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def known_values(rows: DataFrame, store: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct ``rows`` (key and columns, and how many each was as ``n``) with ``seen``: those columns whose value the key had in the store.

    ``seen`` holds '' where the key itself stands in the store. Both sides meet by (key, value), a column at a time, so a row is never
    held more than once and no set of a key's values is gathered.
    """
    met, seen = rows.groupBy(key, *columns).agg(F.count("*").alias("n")), []
    for k, column in enumerate(["", *columns]):
        by = [key, column] if column else [key]
        met = met.join(store.select(*by).distinct().withColumn(f"_{k}", F.lit(True)), by, "left")
        seen.append(F.when(F.col(f"_{k}"), column))
    return met.select(key, *columns, "n", F.array_compact(F.array(*seen)).alias("seen"))


def host_geo_flag(rows: DataFrame, store: DataFrame) -> DataFrame:
    """(call, n): how a row's order, family and country stand to what its lineage was known from."""
    known = known_values(rows, store, "LINEAGE_NAME", ["ORDER_NAME", "FAMILY_NAME", "COUNTRY_NAME"])
    breadth = store.groupBy("LINEAGE_NAME").agg(F.min("ORDER_NAME").alias("_low"), F.max("ORDER_NAME").alias("_high"))
    joined = known.join(breadth, "LINEAGE_NAME", "left")
    new_order, new_family, new_country = (F.col(c).isNotNull() & ~F.array_contains("seen", c) for c in ("ORDER_NAME", "FAMILY_NAME", "COUNTRY_NAME"))
    call = (
        F.when(~F.array_contains("seen", ""), "no baseline")
        .when(new_order & (F.col("_low") == F.col("_high")), "new order of a specialist")
        .when(new_order, "new order")
        .when(new_family, "new family")
        .when(new_country, "new country")
        .otherwise("known")
    )
    return joined.groupBy(call.alias("call")).agg(F.sum("n").alias("n"))


def _packed(columns: list[str]) -> Column:
    """The texts of columns as one; a null stays apart from a blank, and a text that holds a separator is written with others in its place."""

    def text(c: str) -> Column:
        written = F.replace(F.replace(F.col(c), F.lit("\x1e"), F.lit("\x1e0")), F.lit("\x1f"), F.lit("\x1e1"))
        return F.when(F.col(c).contains("\x1e") | F.col(c).contains("\x1f"), written).otherwise(F.col(c))

    return F.concat_ws("\x1f", *[F.coalesce(text(c), F.lit("\x1e")) for c in columns])


def _unpacked(packed: str, columns: list[str]) -> list[Column]:
    def text(c: Column) -> Column:
        return F.when(c.contains("\x1e"), F.replace(F.replace(c, F.lit("\x1e1"), F.lit("\x1f")), F.lit("\x1e0"), F.lit("\x1e"))).otherwise(c)

    parts = F.split(packed, "\x1f")
    return [F.when(parts[k] != "\x1e", text(parts[k])).alias(c) for k, c in enumerate(columns)]


#: Bytes of the files read for each part of a shuffle whose parts are sorted; some 280,000 rows of hosts.
PART_BYTES = 4 << 20


def _parts(df: DataFrame) -> int:
    """A stated number of parts that grows with the files read, as parts merged by size, or as few as the session's, would not be sorted in memory."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [leaves.apply(k).stats().sizeInBytes() for k in range(leaves.size())]
    # a table without files has no size, which reads as the largest number
    read = sum(x for x in sizes if x < 2**60)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(10_000, int(read // PART_BYTES)))


def plausibility(rows: DataFrame, store: DataFrame | Column) -> DataFrame:
    """(LINEAGE_NAME, SPECIES_NAME, COUNTRY_NAME, level, in_country): the closest taxon in which the lineage was seen.

    ``store`` is a table, or the condition on ``rows`` that tells the store's own. All rows are shuffled once, by lineage; whether the store
    has a value of a lineage is then the largest flag among the rows of both, a column at a time, so no set of values is gathered.
    """
    taxa = ["SPECIES_NAME", "GENUS_NAME", "FAMILY_NAME", "ORDER_NAME"]
    columns = ["LINEAGE_NAME", *taxa, "COUNTRY_NAME"]
    if isinstance(store, Column):
        told = rows.select(*columns, F.when(store, 3).otherwise(1).cast("byte").alias("_of"))
    else:
        told = rows.select(*columns, F.lit(1).cast("byte").alias("_of")).union(store.select(*columns, F.lit(2).cast("byte")))
    # one text carries a row's values, as fields of their own take half as much again
    dealt = told.select("LINEAGE_NAME", _packed(columns[1:]).alias("_row"), "_of").repartition(_parts(told), "LINEAGE_NAME")
    met = dealt.select("LINEAGE_NAME", *_unpacked("_row", columns[1:]), (F.col("_of") % 2 == 1).alias("_judged"), (F.col("_of") > 1).alias("_held"))
    seen = {}
    for name in columns:
        by = dict.fromkeys(["LINEAGE_NAME", name])
        met = met.withColumn(f"_{name}", F.max("_held").over(Window.partitionBy(*by)))
        seen[name] = F.col(f"_{name}") & F.col("LINEAGE_NAME").isNotNull() & F.col(name).isNotNull()
    level = F.when(~seen["LINEAGE_NAME"], "unknown lineage")
    for name in taxa:
        level = level.when(seen[name] & (F.col(name) != ""), name.split("_")[0].lower())
    return met.filter("_judged").select("LINEAGE_NAME", "SPECIES_NAME", "COUNTRY_NAME", level.otherwise("new").alias("level"), seen["COUNTRY_NAME"].alias("in_country")).distinct()
