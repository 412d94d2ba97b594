"""Per-lineage summaries, coverage counts and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.operators import keys

# The released region columns, in order.
REGIONS = tuple(
    "EUROPE SUB_SAHARAN_AFRICA NORTH_AFRICA_AND_MIDDLE_EAST NORTH_AMERICA HAWAI CENTRAL_AMERICA SOUTH_AMERICA ASIA"
    " AUSTRALIA_AND_NEW_ZEALAND OCEANIA ANTARCTICA UNKNOWN_REGION".split()
)


def _blank(c: Column) -> Column:
    return F.when(c == 0, "").otherwise(c.cast("string"))


def region_join(rows: DataFrame, regions: DataFrame, state: str | None = None, override: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """``rows`` with REGION: a state's own region first, else the country's; null where neither is known."""
    joined = rows.join(regions.select("COUNTRY_NAME", F.col("REGION").alias("_region")), "COUNTRY_NAME", "left")
    region = F.col("_region")
    for (country, name), value in (override or {}).items():
        region = F.when((F.col("COUNTRY_NAME") == country) & (F.col(state) == name), value).otherwise(region)
    return joined.withColumn("REGION", region).drop("_region")


def lineage_summary(lineages: DataFrame, hosts: DataFrame, vectors: DataFrame, regions: DataFrame, region_columns: list[str], flag_order: str) -> DataFrame:
    """One row for each row of ``lineages``: distinct tallies (blank for none), an order flag, region flags.

    Both record tables are aggregated by lineage before they are joined, so a lineage with very many
    records costs one row from each map task.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    tally = lambda c: F.size(F.collect_set(c)).cast("long")
    # records of one taxon are one row before the sets are made, so no column multiplies rows
    taxa = hosts.select("LINEAGE_NAME", "GENUS_NAME", "SPECIES_NAME", "FAMILY_NAME", "ORDER_NAME").distinct()
    by_host = taxa.groupBy("LINEAGE_NAME").agg(
        tally(F.when(F.col("SPECIES_NAME") != "", F.struct("GENUS_NAME", "SPECIES_NAME"))).alias("h"),
        tally(filled("GENUS_NAME")).alias("g"),
        tally(filled("FAMILY_NAME")).alias("f"),
        tally(filled("ORDER_NAME")).alias("o"),
        F.max((F.lower("ORDER_NAME") == flag_order.lower()).cast("int")).alias("flag"),
    )
    by_vector = vectors.groupBy("LINEAGE_NAME").agg(F.count_distinct(filled("VECTOR_SPECIES")).alias("v"))
    places = region_join(hosts.select("LINEAGE_NAME", "COUNTRY_NAME").union(vectors.select("LINEAGE_NAME", "COUNTRY_NAME")).distinct(), regions)
    by_region = places.groupBy("LINEAGE_NAME").agg(F.collect_set("REGION").alias("regions"))
    rows = lineages.join(by_host, "LINEAGE_NAME", "left").join(by_vector, "LINEAGE_NAME", "left").join(by_region, "LINEAGE_NAME", "left")
    count = {n: F.coalesce(F.col(c), F.lit(0)) for n, c in (("SUM_VECTORS", "v"), ("SUM_HOST", "h"), ("SUM_GENUS", "g"), ("SUM_FAMILY", "f"), ("SUM_ORDER", "o"))}
    return rows.select(
        *[c for c in lineages.columns],
        *[_blank(c).alias(n) for n, c in count.items()],
        F.coalesce("flag", F.lit(0)).cast("string").alias(flag_order.upper()),
        *[F.when(F.array_contains("regions", r), "1").otherwise("").alias(r.replace(" ", "_")) for r in region_columns],
    )


def lineage_profiles(lineages: DataFrame, hosts: DataFrame, references: DataFrame) -> DataFrame:
    """Records, distinct hosts, references, countries and the first year of each lineage."""
    years = hosts.select("LINEAGE_NAME", "REFERENCE_NAME").distinct().join(references, "REFERENCE_NAME")
    first = years.groupBy("LINEAGE_NAME").agg(F.min("PUBLICATION_YEAR").alias("first_year"))
    counts = hosts.groupBy("LINEAGE_NAME").agg(
        F.count("*").alias("records"),
        F.count_distinct(F.when(F.col("SPECIES_NAME") != "", F.col("SPECIES_NAME"))).alias("hosts"),
        F.count_distinct("REFERENCE_NAME").alias("refs"),
        F.count_distinct("COUNTRY_NAME").alias("countries"),
    )
    rows = lineages.select("LINEAGE_NAME").join(counts, "LINEAGE_NAME", "left").join(first, "LINEAGE_NAME", "left")
    return rows.select("LINEAGE_NAME", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "hosts", "refs", "countries")], "first_year")


def lineage_context(hosts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Record counts and sorted name sets of each lineage."""
    a = hosts.groupBy("LINEAGE_NAME").agg(F.count("*").alias("host_rows"), F.array_sort(F.collect_set(F.when(F.col("SPECIES_NAME") != "", F.col("SPECIES_NAME")))).alias("hosts"), F.array_sort(F.collect_set("COUNTRY_NAME")).alias("countries"))
    b = vectors.groupBy("LINEAGE_NAME").agg(F.count("*").alias("vector_rows"), F.array_sort(F.collect_set("VECTOR_SPECIES")).alias("vectors"))
    none = F.array().cast("array<string>")
    return a.join(b, "LINEAGE_NAME", "full").select("LINEAGE_NAME", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("host_rows", "vector_rows")], *[F.coalesce(c, none).alias(c) for c in ("hosts", "countries", "vectors")])


def by_reference(rows: DataFrame) -> DataFrame:
    return rows.groupBy("REFERENCE_NAME").agg(F.count("*").alias("records"), F.count_distinct("LINEAGE_NAME").alias("lineages"), F.count_distinct("COUNTRY_NAME").alias("countries"), F.count_distinct("SPECIES_NAME").alias("hosts"))


def unmapped_countries(rows: DataFrame, regions: DataFrame) -> DataFrame:
    return rows.join(regions.select("COUNTRY_NAME"), "COUNTRY_NAME", "left_anti").groupBy("COUNTRY_NAME").agg(F.count("*").alias("n"))


def infer_region_votes(hosts: DataFrame, flags: DataFrame, region_columns: list[str]) -> DataFrame:
    """Lineages of exactly one country vote their region flags for it."""
    single = hosts.groupBy("LINEAGE_NAME").agg(F.min("COUNTRY_NAME").alias("COUNTRY_NAME"), F.max("COUNTRY_NAME").alias("_other")).filter("COUNTRY_NAME = _other")
    long = flags.unpivot(["LINEAGE_NAME"], region_columns, "region", "flag").filter("flag = '1'")
    return single.join(long, "LINEAGE_NAME").groupBy("COUNTRY_NAME", "region").agg(F.count("*").alias("votes"))


def orphan_citations(references: DataFrame, *tables: DataFrame) -> DataFrame:
    """Cited names without a reference row and how often they stand; unpublished names are excused."""
    from curaspark.functions.text import ref_is_unpublished

    cited = None
    for rows in tables:
        part = rows.select("REFERENCE_NAME")
        cited = part if cited is None else cited.union(part)
    missing = cited.groupBy("REFERENCE_NAME").agg(F.count("*").alias("n")).join(references.select("REFERENCE_NAME"), "REFERENCE_NAME", "left_anti")
    return missing.filter(~ref_is_unpublished(F.col("REFERENCE_NAME")))


def refs_both_ways(references: DataFrame, cited: DataFrame) -> DataFrame:
    a, b = cited.select("REFERENCE_NAME").distinct(), references.select("REFERENCE_NAME").distinct()
    one = a.join(b, "REFERENCE_NAME", "left_anti").agg(F.count("*").alias("n")).select(F.lit("cited_not_listed").alias("side"), "n")
    return one.union(b.join(a, "REFERENCE_NAME", "left_anti").agg(F.count("*").alias("n")).select(F.lit("listed_not_cited").alias("side"), "n"))


def impossible_counts(rows: DataFrame, found: str, tested: str) -> DataFrame:
    return rows.filter(F.col(found) > F.col(tested))


def country_studies(hosts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Distinct studies of each country over both kinds of claims, by the genus of the lineage."""
    claims = hosts.select("COUNTRY_NAME", "GENUS", "REFERENCE_NAME").unionByName(vectors.select("COUNTRY_NAME", "GENUS", "REFERENCE_NAME")).distinct()
    return claims.groupBy("COUNTRY_NAME", "GENUS").agg(F.count("*").alias("studies"))


def capped_examples(df: DataFrame, group: list[str], order: list[str], limit: int) -> DataFrame:
    """The first rows of each group with its full count and whether rows were left out."""
    from pyspark.sql.window import Window

    top = df.withColumn("turn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("turn") <= limit)
    counts = df.groupBy(*group).agg(F.count("*").alias("n"))
    return top.join(counts, group).withColumn("truncated", F.col("n") > limit)


def dictionary_encode(df: DataFrame, column: str) -> DataFrame:
    """(value, code): zero-based codes of the distinct values in order, numbered by ranges."""
    values = df.select(F.col(column).alias("value")).distinct()
    return keys.row_numbers(values, ["value"], "code").withColumn("code", F.col("code") - 1)
