"""Joins, aggregations, comparisons, sequences, quality, places, text and ledger as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions import sequences as S
from curaspark.operators import cdc, geo, history, keys, ledger, mining, quality, sequences, summary
from curaspark.operators.shared import stored
from curaspark.plans.views import oracle, table

#: name: (query, the oracle's text or None)
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(sql) if sql else None)
        return f

    return add


def t(spark: SparkSession, d: str, *names: str):
    found = [table(spark, d, n) for n in names]
    return found[0] if len(found) == 1 else found


NOW = "1996-06-01 00:00:00"
_REGION_COLUMNS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# ---- summaries and checks ----

_SUMMARY = """
WITH h AS (SELECT LINEAGE_NAME, count(DISTINCT CASE WHEN SPECIES_NAME <> '' THEN GENUS_NAME || '|' || SPECIES_NAME END) AS h,
    count(DISTINCT GENUS_NAME) AS g, count(DISTINCT FAMILY_NAME) AS f, count(DISTINCT ORDER_NAME) AS o, max(CASE WHEN ORDER_NAME = 'BUILDING' THEN 1 ELSE 0 END) AS flag
  FROM {v_hosts} GROUP BY 1),
v AS (SELECT LINEAGE_NAME, count(DISTINCT VECTOR_SPECIES) AS v FROM {v_vectors} GROUP BY 1),
p AS (SELECT DISTINCT LINEAGE_NAME, REGION FROM (SELECT LINEAGE_NAME, COUNTRY_NAME FROM {v_hosts} UNION SELECT LINEAGE_NAME, COUNTRY_NAME FROM {v_vectors}) JOIN {v_region_map} USING (COUNTRY_NAME))
SELECT l.LINEAGE_NAME, l.GENUS_NAME, l.SPECIES_NAME, l.SEQ_LENGTH,
  coalesce(CAST(v AS VARCHAR), '') AS SUM_VECTORS, CASE WHEN coalesce(h.h, 0) = 0 THEN '' ELSE CAST(h.h AS VARCHAR) END AS SUM_HOST, coalesce(CAST(g AS VARCHAR), '') AS SUM_GENUS,
  coalesce(CAST(f AS VARCHAR), '') AS SUM_FAMILY, coalesce(CAST(o AS VARCHAR), '') AS SUM_ORDER, CAST(coalesce(flag, 0) AS VARCHAR) AS BUILDING, REGION_FLAGS
FROM {v_lineages} l LEFT JOIN h USING (LINEAGE_NAME) LEFT JOIN v USING (LINEAGE_NAME)
""".replace("REGION_FLAGS", ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM p WHERE p.LINEAGE_NAME = l.LINEAGE_NAME AND REGION = '{r}') THEN '1' ELSE '' END AS {r.replace(' ', '_')}" for r in _REGION_COLUMNS))


@query(_SUMMARY)
def lineage_summary(spark, d):
    lineages, hosts, vectors, regions = t(spark, d, "v_lineages", "v_hosts", "v_vectors", "v_region_map")
    return summary.lineage_summary(lineages.drop("p_partkey"), hosts, vectors, regions, _REGION_COLUMNS, "building")


@query("""WITH c AS (SELECT LINEAGE_NAME, count(*) AS records, count(DISTINCT nullif(SPECIES_NAME, '')) AS hosts, count(DISTINCT REFERENCE_NAME) AS refs, count(DISTINCT COUNTRY_NAME) AS countries FROM {v_hosts} GROUP BY 1),
y AS (SELECT LINEAGE_NAME, min(PUBLICATION_YEAR) AS first_year FROM {v_hosts} JOIN {v_references} USING (REFERENCE_NAME) GROUP BY 1)
SELECT LINEAGE_NAME, coalesce(records, 0) AS records, coalesce(hosts, 0) AS hosts, coalesce(refs, 0) AS refs, coalesce(countries, 0) AS countries, first_year FROM {v_lineages} LEFT JOIN c USING (LINEAGE_NAME) LEFT JOIN y USING (LINEAGE_NAME)""")
def lineage_profiles(spark, d):
    return summary.lineage_profiles(*t(spark, d, "v_lineages", "v_hosts", "v_references"))


@query("""WITH a AS (SELECT LINEAGE_NAME, count(*) AS host_rows, array_to_string(list_sort(list_distinct(list(nullif(SPECIES_NAME, '')))), ',') AS hosts, array_to_string(list_sort(list_distinct(list(COUNTRY_NAME))), ',') AS countries FROM {v_hosts} GROUP BY 1),
b AS (SELECT LINEAGE_NAME, count(*) AS vector_rows, array_to_string(list_sort(list_distinct(list(VECTOR_SPECIES))), ',') AS vectors FROM {v_vectors} GROUP BY 1)
SELECT coalesce(a.LINEAGE_NAME, b.LINEAGE_NAME) AS LINEAGE_NAME, coalesce(host_rows, 0) AS host_rows, coalesce(vector_rows, 0) AS vector_rows, coalesce(hosts, '') AS hosts, coalesce(countries, '') AS countries, coalesce(vectors, '') AS vectors FROM a FULL JOIN b ON a.LINEAGE_NAME = b.LINEAGE_NAME""")
def lineage_context(spark, d):
    out = summary.lineage_context(*t(spark, d, "v_hosts", "v_vectors"))
    return out.select("LINEAGE_NAME", "host_rows", "vector_rows", *[F.array_join(c, ",").alias(c) for c in ("hosts", "countries", "vectors")])


@query("""SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, count(*) AS n, array_to_string(list_sort(list(l_orderkey * 10 + l_linenumber)), ',') AS ids FROM {v_hosts} GROUP BY ALL HAVING count(*) > 1""")
def natural_key_violations(spark, d):
    rows = t(spark, d, "v_hosts").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    out = keys.natural_key_violations(rows, ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"], "id")
    return out.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query("SELECT SPECIES_NAME, count(*) AS n FROM {v_lineages} GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, d):
    return keys.duplicate_values(t(spark, d, "v_lineages"), "SPECIES_NAME")


@query("""SELECT REFERENCE_NAME, count(*) AS n FROM (SELECT REFERENCE_NAME FROM {v_hosts} UNION ALL SELECT REFERENCE_NAME FROM {v_vectors}) WHERE REFERENCE_NAME NOT IN (SELECT REFERENCE_NAME FROM {v_references}) GROUP BY 1""")
def orphan_citations(spark, d):
    hosts, vectors, refs = t(spark, d, "v_hosts", "v_vectors", "v_references")
    return summary.orphan_citations(refs, hosts, vectors)


@query("""SELECT 'cited_not_listed' AS side, count(DISTINCT REFERENCE_NAME) AS n FROM {v_hosts} WHERE REFERENCE_NAME NOT IN (SELECT REFERENCE_NAME FROM {v_references})
UNION ALL SELECT 'listed_not_cited', count(*) FROM {v_references} WHERE REFERENCE_NAME NOT IN (SELECT REFERENCE_NAME FROM {v_hosts})""")
def refs_both_ways(spark, d):
    return summary.refs_both_ways(*t(spark, d, "v_references", "v_hosts"))


@query("SELECT COUNTRY_NAME, count(*) AS n FROM {v_hosts} WHERE COUNTRY_NAME NOT IN (SELECT COUNTRY_NAME FROM {v_region_map}) GROUP BY 1")
def unmapped_countries(spark, d):
    return summary.unmapped_countries(*t(spark, d, "v_hosts", "v_region_map"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, NUMBER_FOUND, NUMBER_TESTED FROM {v_hosts} WHERE NUMBER_FOUND > NUMBER_TESTED")
def impossible_counts(spark, d):
    return summary.impossible_counts(t(spark, d, "v_hosts"), "NUMBER_FOUND", "NUMBER_TESTED").select("l_orderkey", "l_linenumber", "l_partkey", "NUMBER_FOUND", "NUMBER_TESTED")


@query("SELECT REFERENCE_NAME, count(*) AS records, count(DISTINCT LINEAGE_NAME) AS lineages, count(DISTINCT COUNTRY_NAME) AS countries, count(DISTINCT SPECIES_NAME) AS hosts FROM {v_curr} GROUP BY 1")
def by_reference(spark, d):
    return summary.by_reference(t(spark, d, "v_curr"))


_CLAIMS = "SELECT DISTINCT COUNTRY_NAME, GENUS_NAME AS GENUS, REFERENCE_NAME FROM (SELECT LINEAGE_NAME, COUNTRY_NAME, REFERENCE_NAME FROM {v_hosts} UNION ALL SELECT LINEAGE_NAME, COUNTRY_NAME, REFERENCE_NAME FROM {v_vectors}) JOIN (SELECT LINEAGE_NAME, GENUS_NAME FROM {v_lineages}) USING (LINEAGE_NAME)"


def _claims(spark, d):
    lineages, hosts, vectors = t(spark, d, "v_lineages", "v_hosts", "v_vectors")
    genus = lineages.select("LINEAGE_NAME", F.col("GENUS_NAME").alias("GENUS"))
    return [x.select("LINEAGE_NAME", "COUNTRY_NAME", "REFERENCE_NAME").join(genus, "LINEAGE_NAME") for x in (hosts, vectors)]


@query(f"SELECT COUNTRY_NAME, GENUS, count(*) AS studies FROM ({_CLAIMS}) GROUP BY ALL")
def country_studies(spark, d):
    return summary.country_studies(*_claims(spark, d))


#: The brands of the parts table.
_BRANDS = [10 * a + b for a in range(1, 6) for b in range(1, 6)]


@query("WITH k AS (" + _CLAIMS + ") SELECT COUNTRY_NAME, " + ", ".join(f"count(*) FILTER (GENUS = 'Brand#{b}') AS b{b}" for b in _BRANDS) + " FROM k GROUP BY 1")
def country_studies_pivot(spark, d):
    wide = summary.country_studies(*_claims(spark, d)).groupBy("COUNTRY_NAME").pivot("GENUS", [f"Brand#{b}" for b in _BRANDS]).agg(F.sum("studies"))
    return wide.select("COUNTRY_NAME", *[F.coalesce(F.col(f"`Brand#{b}`"), F.lit(0)).alias(f"b{b}") for b in _BRANDS])


@query(f"SELECT GENUS, count(DISTINCT COUNTRY_NAME) AS total, count(DISTINCT CASE WHEN COUNTRY_NAME IN (SELECT COUNTRY_NAME FROM {{v_region_map}}) THEN COUNTRY_NAME END) AS placed FROM ({_CLAIMS}) GROUP BY 1")
def map_coverage(spark, d):
    a, b = _claims(spark, d)
    placed = t(spark, d, "v_region_map").select("COUNTRY_NAME", F.lit(True).alias("known"))
    rows = a.unionByName(b).select("GENUS", "COUNTRY_NAME").distinct().join(placed, "COUNTRY_NAME", "left")
    return rows.groupBy("GENUS").agg(F.count("*").alias("total"), F.sum(F.coalesce("known", F.lit(False)).cast("long")).alias("placed"))


@query("""WITH one AS (SELECT LINEAGE_NAME, min(COUNTRY_NAME) AS COUNTRY_NAME FROM {v_hosts} GROUP BY 1 HAVING count(DISTINCT COUNTRY_NAME) = 1),
f AS (SELECT DISTINCT LINEAGE_NAME, REGION AS region FROM (SELECT LINEAGE_NAME, COUNTRY_NAME FROM {v_hosts} UNION SELECT LINEAGE_NAME, COUNTRY_NAME FROM {v_vectors}) JOIN {v_region_map} USING (COUNTRY_NAME))
SELECT COUNTRY_NAME, replace(region, ' ', '_') AS region, count(*) AS votes FROM one JOIN f USING (LINEAGE_NAME) GROUP BY ALL""")
def infer_region_votes(spark, d):
    flags = lineage_summary(spark, d)
    return summary.infer_region_votes(t(spark, d, "v_hosts"), flags, [r.replace(" ", "_") for r in _REGION_COLUMNS])


@query("""SELECT (SELECT count(DISTINCT LINEAGE_NAME) FROM {v_hosts}) AS lineages, (SELECT count(DISTINCT nullif(SPECIES_NAME, '')) FROM {v_hosts}) AS hosts, (SELECT count(DISTINCT COUNTRY_NAME) FROM {v_hosts}) AS countries, (SELECT count(*) FROM {v_hosts}) AS records""")
def site_totals(spark, d):
    return t(spark, d, "v_hosts").agg(F.count_distinct("LINEAGE_NAME").alias("lineages"), F.count_distinct(F.when(F.col("SPECIES_NAME") != "", F.col("SPECIES_NAME"))).alias("hosts"), F.count_distinct("COUNTRY_NAME").alias("countries"), F.count("*").alias("records"))


@query("""SELECT l.GENUS_NAME AS genus, count(DISTINCT h.LINEAGE_NAME) AS lineages, count(*) AS records, count(DISTINCT h.COUNTRY_NAME) AS countries, count(DISTINCT h.REFERENCE_NAME) AS studies FROM {v_hosts} h JOIN {v_lineages} l USING (LINEAGE_NAME) GROUP BY 1""")
def genus_breakdown(spark, d):
    lineages, hosts = t(spark, d, "v_lineages", "v_hosts")
    rows = hosts.select("LINEAGE_NAME", "COUNTRY_NAME", "REFERENCE_NAME").join(lineages.select("LINEAGE_NAME", F.col("GENUS_NAME").alias("genus")), "LINEAGE_NAME")
    return rows.groupBy("genus").agg(F.count_distinct("LINEAGE_NAME").alias("lineages"), F.count("*").alias("records"), F.count_distinct("COUNTRY_NAME").alias("countries"), F.count_distinct("REFERENCE_NAME").alias("studies"))


@query("SELECT COUNTRY_NAME AS value, row_number() OVER (ORDER BY COUNTRY_NAME) - 1 AS code FROM (SELECT DISTINCT COUNTRY_NAME FROM {v_hosts})")
def dictionary_encode(spark, d):
    return summary.dictionary_encode(t(spark, d, "v_hosts"), "COUNTRY_NAME").withColumn("code", F.col("code").cast("long"))


@query("""SELECT COUNTRY_NAME, LINEAGE_NAME, turn, n, n > 3 AS truncated FROM (SELECT COUNTRY_NAME, LINEAGE_NAME, row_number() OVER (PARTITION BY COUNTRY_NAME ORDER BY LINEAGE_NAME) AS turn, count(*) OVER (PARTITION BY COUNTRY_NAME) AS n FROM (SELECT DISTINCT COUNTRY_NAME, LINEAGE_NAME FROM {v_hosts})) WHERE turn <= 3""")
def capped_examples(spark, d):
    out = summary.capped_examples(t(spark, d, "v_hosts").select("COUNTRY_NAME", "LINEAGE_NAME").distinct(), ["COUNTRY_NAME"], ["LINEAGE_NAME"], 3)
    return out.withColumn("turn", F.col("turn").cast("long"))


@query("""SELECT LINEAGE_NAME, count(*) AS studies FROM (SELECT DISTINCT LINEAGE_NAME, REFERENCE_NAME FROM {v_hosts}) GROUP BY 1""")
def genus_stats_lineage_studies(spark, d):
    return t(spark, d, "v_hosts").groupBy("LINEAGE_NAME").agg(F.count_distinct("REFERENCE_NAME").alias("studies"))


@query("""SELECT SITE_NAME, COUNTRY_NAME, count(*) AS records, count(DISTINCT LINEAGE_NAME) AS lineages, sum(NUMBER_FOUND) AS found FROM {v_hosts} GROUP BY ALL""")
def site_points(spark, d):
    return t(spark, d, "v_hosts").groupBy("SITE_NAME", "COUNTRY_NAME").agg(F.count("*").alias("records"), F.count_distinct("LINEAGE_NAME").alias("lineages"), F.sum("NUMBER_FOUND").alias("found"))


_ORDERS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("SELECT SITE_NAME, SPECIES_NAME, " + ", ".join(f"max(CASE WHEN ORDER_NAME = '{o}' THEN NUMBER_FOUND END) AS {o}" for o in _ORDERS) + " FROM {v_hosts} GROUP BY SITE_NAME, SPECIES_NAME")
def host_lineage_matrix(spark, d):
    return t(spark, d, "v_hosts").groupBy("SITE_NAME", "SPECIES_NAME").pivot("ORDER_NAME", list(_ORDERS)).agg(F.max("NUMBER_FOUND"))


@query("""WITH s AS (SELECT l_orderkey % 7 AS source, LINEAGE_NAME, COUNTRY_NAME FROM {v_hosts}) SELECT source, count(*) AS n_rows, count(DISTINCT LINEAGE_NAME) AS lineages FROM s GROUP BY 1""")
def source_inventory(spark, d):
    return t(spark, d, "v_hosts").groupBy((F.col("l_orderkey") % 7).alias("source")).agg(F.count("*").alias("n_rows"), F.count_distinct("LINEAGE_NAME").alias("lineages"))


@query("SELECT REGION, COUNTRY_NAME, count(*) AS n FROM {v_hosts} LEFT JOIN {v_region_map} USING (COUNTRY_NAME) GROUP BY ALL")
def region_join(spark, d):
    hosts, regions = t(spark, d, "v_hosts", "v_region_map")
    return summary.region_join(hosts, regions).groupBy("REGION", "COUNTRY_NAME").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT COUNTRY_NAME, REFERENCE_NAME FROM (SELECT COUNTRY_NAME, REFERENCE_NAME FROM {v_hosts} UNION ALL SELECT COUNTRY_NAME, REFERENCE_NAME FROM {v_vectors})")
def claims_union(spark, d):
    a, b = t(spark, d, "v_hosts", "v_vectors")
    return a.select("COUNTRY_NAME", "REFERENCE_NAME").union(b.select("COUNTRY_NAME", "REFERENCE_NAME")).distinct()


@query("SELECT LINEAGE_NAME, min(COUNTRY_NAME) FILTER (k = lo) AS COUNTRY_NAME FROM (SELECT LINEAGE_NAME, COUNTRY_NAME, l_orderkey * 10 + l_linenumber AS k, min(l_orderkey * 10 + l_linenumber) OVER (PARTITION BY LINEAGE_NAME) AS lo FROM {v_hosts}) GROUP BY 1")
def first_wins(spark, d):
    rows = t(spark, d, "v_hosts").select("LINEAGE_NAME", "COUNTRY_NAME", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return keys.first_wins(rows, ["LINEAGE_NAME"], ["k", "COUNTRY_NAME"]).drop("k")


@query("SELECT h.LINEAGE_NAME, v.LINEAGE_NAME IS NOT NULL AS known, count(*) AS n FROM {v_hosts} h LEFT JOIN (SELECT DISTINCT LINEAGE_NAME FROM {v_vectors}) v USING (LINEAGE_NAME) GROUP BY ALL")
def known_membership(spark, d):
    hosts, vectors = t(spark, d, "v_hosts", "v_vectors")
    return quality.known_membership(hosts.select("LINEAGE_NAME"), "LINEAGE_NAME", vectors.select("LINEAGE_NAME"), "known").groupBy("LINEAGE_NAME", "known").agg(F.count("*").alias("n"))


@query("SELECT VECTOR_SPECIES, GENUS_NAME AS genus, count(*) AS n FROM {v_vectors} JOIN {v_lineages} USING (LINEAGE_NAME) GROUP BY ALL")
def vector_genus(spark, d):
    vectors, lineages = t(spark, d, "v_vectors", "v_lineages")
    return vectors.join(lineages.select("LINEAGE_NAME", F.col("GENUS_NAME").alias("genus")), "LINEAGE_NAME").groupBy("VECTOR_SPECIES", "genus").agg(F.count("*").alias("n"))


@query("SELECT n_name AS country, r_name AS continent FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey")
def country_continent(spark, d):
    nation, region = t(spark, d, "nation", "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_name").alias("country"), F.col("r_name").alias("continent"))


@query("SELECT LINEAGE_NAME, ORDER_NAME, FAMILY_NAME, GENUS_NAME, SPECIES_NAME, COUNTRY_NAME, CONTINENT_NAME, SITE_NAME, REFERENCE_NAME, NUMBER_FOUND, NUMBER_TESTED FROM {v_hosts}")
def export_hosts(spark, d):
    """The star join written out with the DataFrame API."""
    lineitem, orders, customer, nation, region = t(spark, d, "lineitem", "orders", "customer", "nation", "region")
    rows = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    genus = F.concat(F.lit("G"), F.col("c_custkey") % 97)
    return rows.select(
        F.concat(F.lit("P"), "l_partkey").alias("LINEAGE_NAME"), F.col("c_mktsegment").alias("ORDER_NAME"), F.col("o_orderpriority").alias("FAMILY_NAME"), genus.alias("GENUS_NAME"),
        F.when(F.col("c_custkey") % 53 == 0, "").otherwise(F.concat(genus, F.lit(" s"), F.col("c_custkey") % 11)).alias("SPECIES_NAME"), F.col("n_name").alias("COUNTRY_NAME"), F.col("r_name").alias("CONTINENT_NAME"),
        F.concat(F.lit("S"), F.col("l_suppkey") % 7).alias("SITE_NAME"), F.concat(F.lit("R"), F.col("o_orderkey") % 20).alias("REFERENCE_NAME"),
        F.col("l_quantity").cast("int").alias("NUMBER_FOUND"), (F.col("l_quantity").cast("int") + F.col("l_linenumber") - 3).alias("NUMBER_TESTED"),
    )


@query("SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, COUNTRY_NAME, n FROM (SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, COUNTRY_NAME, count(*) AS n FROM {v_curr} c WHERE NOT EXISTS (SELECT 1 FROM {v_prev} p WHERE p.LINEAGE_NAME = c.LINEAGE_NAME AND p.SPECIES_NAME = c.SPECIES_NAME AND p.SITE_NAME = c.SITE_NAME AND p.REFERENCE_NAME = c.REFERENCE_NAME) GROUP BY ALL)")
def new_rows_by_key(spark, d):
    prev, curr = t(spark, d, "v_prev", "v_curr")
    key = ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"]
    return curr.join(prev.select(*key), key, "left_anti").groupBy(*key, "COUNTRY_NAME").agg(F.count("*").alias("n"))


# ---- change data capture ----

_KEY = ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"]
_COLS = ["COUNTRY_NAME", "NUMBER_FOUND", "COMMENT"]
_K = ", ".join(_KEY)


@query(f"""WITH b AS (SELECT {_K}, COUNTRY_NAME, COMMENT, count(*) AS n FROM {{v_prev}} GROUP BY ALL), a AS (SELECT {_K}, COUNTRY_NAME, COMMENT, count(*) AS n FROM {{v_curr}} GROUP BY ALL),
d AS (SELECT {_K}, COUNTRY_NAME, COMMENT, coalesce(a.n, 0) - coalesce(b.n, 0) AS net FROM a FULL JOIN b USING ({_K}, COUNTRY_NAME, COMMENT))
SELECT CASE WHEN net < 0 THEN 'before' ELSE 'after' END AS side, {_K}, COUNTRY_NAME, COMMENT, abs(net) AS n FROM d WHERE net <> 0""")
def multiset_compare(spark, d):
    return cdc.multiset_compare(*t(spark, d, "v_prev", "v_curr"), [*_KEY, "COUNTRY_NAME", "COMMENT"])


@query(f"""WITH b AS (SELECT {_K}, count(*) AS nb, min(COUNTRY_NAME) AS b1, min(NUMBER_FOUND) AS b2, min(COMMENT) AS b3 FROM {{v_prev}} GROUP BY ALL),
a AS (SELECT {_K}, count(*) AS na, min(COUNTRY_NAME) AS a1, min(NUMBER_FOUND) AS a2, min(COMMENT) AS a3 FROM {{v_curr}} GROUP BY ALL),
j AS (SELECT {_K}, coalesce(nb, 0) AS nb, coalesce(na, 0) AS na, b1, b2, b3, a1, a2, a3 FROM b FULL JOIN a USING ({_K})),
net AS (SELECT {_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT, sum(s) AS net FROM (SELECT {_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT, -1 AS s FROM {{v_prev}} UNION ALL SELECT {_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT, 1 FROM {{v_curr}}) SEMI JOIN (SELECT {_K} FROM j WHERE na > 1 OR nb > 1) USING ({_K}) GROUP BY ALL HAVING sum(s) <> 0)
SELECT {_K}, CASE WHEN nb = 0 THEN 'added' ELSE 'removed' END AS kind, NULL AS "column", NULL AS was, NULL AS now, 1 AS n FROM j WHERE na <= 1 AND nb <= 1 AND na <> nb
UNION ALL SELECT {_K}, 'modified', 'COUNTRY_NAME', b1, a1, 1 FROM j WHERE na = 1 AND nb = 1 AND b1 IS DISTINCT FROM a1
UNION ALL SELECT {_K}, 'modified', 'NUMBER_FOUND', b2, a2, 1 FROM j WHERE na = 1 AND nb = 1 AND b2 IS DISTINCT FROM a2
UNION ALL SELECT {_K}, 'modified', 'COMMENT', b3, a3, 1 FROM j WHERE na = 1 AND nb = 1 AND b3 IS DISTINCT FROM a3
UNION ALL SELECT {_K}, CASE WHEN net > 0 THEN 'ambiguous added' ELSE 'ambiguous removed' END, NULL, NULL, NULL, CAST(sum(abs(net)) AS BIGINT) FROM net GROUP BY {_K}, net > 0""")
def diff_table(spark, d):
    return cdc.diff_table(*t(spark, d, "v_prev", "v_curr"), _KEY, _COLS)


@query("""SELECT 'rows' AS entity, (SELECT count(*) FROM {v_prev}) AS previous, (SELECT count(*) FROM {v_curr}) AS current, (SELECT count(*) FROM {v_curr}) - (SELECT count(*) FROM {v_prev}) AS delta
UNION ALL SELECT 'references', NULL, (SELECT count(*) FROM {v_references}), NULL""")
def edition_totals(spark, d):
    prev, curr, refs = t(spark, d, "v_prev", "v_curr", "v_references")
    return cdc.edition_totals({"rows": prev, "references": None}, {"rows": curr, "references": refs})


@query("""SELECT value, 'new' AS kind FROM (SELECT SPECIES_NAME AS value FROM {v_curr} WHERE SPECIES_NAME <> '' EXCEPT SELECT SPECIES_NAME FROM {v_prev})
UNION ALL SELECT value, 'retired' FROM (SELECT SPECIES_NAME AS value FROM {v_prev} WHERE SPECIES_NAME <> '' EXCEPT SELECT SPECIES_NAME FROM {v_curr})""")
def new_retired(spark, d):
    return cdc.new_retired(*t(spark, d, "v_prev", "v_curr"), "SPECIES_NAME")


def _tallies(spark, d, name):
    return t(spark, d, name).groupBy("LINEAGE_NAME").agg(F.count_distinct("SPECIES_NAME").alias("SUM_HOST"), F.count_distinct("COUNTRY_NAME").alias("COUNTRIES"))


@query("""WITH b AS (SELECT LINEAGE_NAME, count(DISTINCT SPECIES_NAME) AS h, count(DISTINCT COUNTRY_NAME) AS c FROM {v_prev} GROUP BY 1), a AS (SELECT LINEAGE_NAME, count(DISTINCT SPECIES_NAME) AS h, count(DISTINCT COUNTRY_NAME) AS c FROM {v_curr} GROUP BY 1)
SELECT 'SUM_HOST' AS "column", sum((a.h <> b.h)::BIGINT)::BIGINT AS changed FROM a JOIN b USING (LINEAGE_NAME) UNION ALL SELECT 'COUNTRIES', sum((a.c <> b.c)::BIGINT)::BIGINT FROM a JOIN b USING (LINEAGE_NAME)""")
def summary_column_diff(spark, d):
    return cdc.column_changes(_tallies(spark, d, "v_prev"), _tallies(spark, d, "v_curr"), "LINEAGE_NAME", ["SUM_HOST", "COUNTRIES"])


@query("SELECT LINEAGE_NAME || '/' || l_orderkey || '-' || l_linenumber AS record, COUNTRY_NAME AS was, 'FRANCE' AS now FROM {v_hosts} WHERE SITE_NAME = 'S3' AND REFERENCE_NAME = 'R7' AND COUNTRY_NAME <> 'FRANCE'")
def plan_correction(spark, d):
    rows = t(spark, d, "v_hosts").withColumn("record", F.concat("LINEAGE_NAME", F.lit("/"), "l_orderkey", F.lit("-"), "l_linenumber"))
    return cdc.plan_correction(rows, "record", {"SITE_NAME": "S3", "REFERENCE_NAME": "R7"}, "COUNTRY_NAME", "FRANCE")


@query("SELECT CASE WHEN SITE_NAME = 'S3' AND REFERENCE_NAME = 'R7' THEN 'FRANCE' ELSE COUNTRY_NAME END AS COUNTRY_NAME, count(*) AS n FROM {v_hosts} GROUP BY 1")
def apply_correction(spark, d):
    return cdc.apply_correction(t(spark, d, "v_hosts"), {"SITE_NAME": "S3", "REFERENCE_NAME": "R7"}, "COUNTRY_NAME", "FRANCE").groupBy("COUNTRY_NAME").agg(F.count("*").alias("n"))


@query("""SELECT 0 AS correction, count(*) FILTER (SITE_NAME = 'S3' AND COUNTRY_NAME <> 'FRANCE') AS changed FROM {v_hosts}
UNION ALL SELECT 1, count(*) FILTER ((SITE_NAME = 'S3' OR COUNTRY_NAME = 'FRANCE') AND REFERENCE_NAME = 'R7') FROM {v_hosts} UNION ALL SELECT 2, 0""")
def replay_corrections(spark, d):
    log = [
        {"where": {"SITE_NAME": "S3"}, "column": "COUNTRY_NAME", "value": "FRANCE"},
        {"where": {"COUNTRY_NAME": "FRANCE", "REFERENCE_NAME": "R7"}, "column": "COUNTRY_NAME", "value": "SPAIN"},
        {"where": {"COUNTRY_NAME": "SPAIN"}, "column": "COUNTRY_NAME", "value": "SPAIN"},
    ]
    return cdc.replay_corrections(t(spark, d, "v_hosts"), log, "LINEAGE_NAME").select(F.col("correction").cast("int").alias("correction"), "changed")


@query(f"""WITH b AS (SELECT {_K}, count(*) AS n FROM {{v_prev}} GROUP BY ALL), a AS (SELECT {_K}, count(*) AS n FROM {{v_curr}} GROUP BY ALL), j AS (SELECT coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING ({_K}))
SELECT 'kept' AS outcome, CAST(sum(least(na, nb)) AS BIGINT) AS n FROM j UNION ALL SELECT 'added', CAST(sum(greatest(na - nb, 0)) AS BIGINT) FROM j UNION ALL SELECT 'removed', CAST(sum(greatest(nb - na, 0)) AS BIGINT) FROM j""")
def pair_nth_with_nth(spark, d):
    return keys.pair_nth_with_nth(*t(spark, d, "v_prev", "v_curr"), _KEY, ["_row_no", "COUNTRY_NAME"]).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"""WITH b AS (SELECT {_K}, count(*) AS n FROM {{v_prev}} WHERE SITE_NAME <> 'S0' GROUP BY ALL), a AS (SELECT {_K}, count(*) AS n FROM {{v_curr}} WHERE SITE_NAME <> 'S0' GROUP BY ALL), j AS (SELECT coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING ({_K}))
SELECT 'replaced' AS outcome, CAST(sum(least(na, nb)) AS BIGINT) AS n FROM j UNION ALL SELECT 'added', CAST(sum(greatest(na - nb, 0)) AS BIGINT) FROM j UNION ALL SELECT 'removed', CAST(sum(greatest(nb - na, 0)) AS BIGINT) FROM j UNION ALL SELECT 'kept', count(*) FROM {{v_prev}} WHERE SITE_NAME = 'S0'""")
def replace_submission(spark, d):
    prev, curr = t(spark, d, "v_prev", "v_curr")
    existing = prev.withColumn("_source", F.when(F.col("SITE_NAME") == "S0", "seed").otherwise("sub-1"))
    return cdc.replace_source(existing, curr.filter("SITE_NAME <> 'S0'"), _KEY, ["_row_no", "COUNTRY_NAME"], "sub-1")


_SAME = f"{_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT"
_CELLS = "COUNTRY_NAME || ':' || NUMBER_FOUND || ':' || COMMENT"


@query(f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY {_SAME} ORDER BY CAST(_row_no AS VARCHAR)) AS i FROM {{v_prev}}), q AS (SELECT *, row_number() OVER (PARTITION BY {_SAME} ORDER BY _row_no) AS i FROM {{v_curr}}),
j AS (SELECT {_SAME}, p._row_no AS a, q._row_no AS b, row_number() OVER () AS u FROM p FULL JOIN q USING ({_SAME}, i)),
o AS (SELECT * FROM j WHERE b IS NULL), f AS (SELECT * FROM j WHERE a IS NULL),
k AS (SELECT {_K}, na, nb FROM (SELECT {_K}, count(*) AS na FROM o GROUP BY ALL) JOIN (SELECT {_K}, count(*) AS nb FROM f GROUP BY ALL) USING ({_K})),
c AS (SELECT {_K}, o.a, f.b, o.u AS ua, f.u AS ub, CASE WHEN o.COUNTRY_NAME = f.COUNTRY_NAME THEN 0 ELSE 1 END + CASE WHEN o.NUMBER_FOUND = f.NUMBER_FOUND THEN 0 ELSE 1 END + CASE WHEN o.COMMENT = f.COMMENT THEN 0 ELSE 1 END AS apart
  FROM o JOIN f USING ({_K}) JOIN k USING ({_K}) WHERE least(na, nb) = 1),
w AS (SELECT a, ua, ub FROM (SELECT a, ua, ub, row_number() OVER (PARTITION BY {_K} ORDER BY apart, CAST(a AS VARCHAR), b) AS i FROM c) WHERE i = 1),
m AS (SELECT {_K} FROM k WHERE least(na, nb) > 1),
r AS (SELECT {_K}, 'unchanged' AS outcome, CAST(a AS VARCHAR) || ':' || {_CELLS} AS x FROM j WHERE a IS NOT NULL AND b IS NOT NULL
  UNION ALL SELECT {_K}, 'changed', CAST(w.a AS VARCHAR) || ':' || {_CELLS} FROM f JOIN w ON w.ub = f.u
  UNION ALL SELECT {_K}, 'removed', CAST(a AS VARCHAR) || ':' || {_CELLS} FROM o ANTI JOIN m USING ({_K}) WHERE u NOT IN (SELECT ua FROM w)
  UNION ALL SELECT {_K}, 'added', ':' || {_CELLS} FROM f ANTI JOIN m USING ({_K}) WHERE u NOT IN (SELECT ub FROM w)),
z AS (SELECT {_K}, outcome, count(*) AS n, string_agg(x, ';' ORDER BY x) AS kept FROM r GROUP BY ALL
  UNION ALL SELECT {_K}, 'changed', least(na, nb), NULL FROM k WHERE least(na, nb) > 1
  UNION ALL SELECT {_K}, CASE WHEN na > nb THEN 'removed' ELSE 'added' END, abs(na - nb), NULL FROM k WHERE least(na, nb) > 1 AND na <> nb)
SELECT * FROM z""")
def merge_table(spark, d):
    """By natural key and outcome, how many rows and which kept which identity; keys with several leftovers on both sides are only counted here
    (tests hold their pairs against the greedy rule)."""
    prev, curr = t(spark, d, "v_prev", "v_curr")
    out = cdc.merge_table(prev.withColumn("RECORD_ID", F.col("_row_no").cast("string")).drop("_row_no"), curr, _KEY, [*_KEY, *_COLS], "RECORD_ID", "_row_no")
    row = F.concat_ws(":", F.coalesce("RECORD_ID", F.lit("")), "COUNTRY_NAME", "NUMBER_FOUND", "COMMENT")
    told = out.groupBy(*_KEY, "outcome").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(row)), ";").alias("kept"))
    several = told.filter("outcome = 'changed' and n > 1").select(*_KEY, F.lit(True).alias("_several"))
    marked = told.join(several, _KEY, "left")
    return marked.withColumn("kept", F.when(F.col("_several").isNull() | (F.col("outcome") == "unchanged"), F.col("kept"))).drop("_several")



@query("SELECT 'HST-' || lpad(CAST(row_number() OVER (ORDER BY p_partkey) + 100 AS VARCHAR), 6, '0') AS RECORD_ID, LINEAGE_NAME FROM {v_lineages}")
def assign_ids(spark, d):
    return keys.assign_ids(t(spark, d, "v_lineages"), ["p_partkey"], "HST", 100).select("RECORD_ID", "LINEAGE_NAME")


@query("SELECT greatest(max(p_partkey), 50) AS highest FROM {v_lineages}")
def id_high_water(spark, d):
    return keys.id_high_water(t(spark, d, "v_lineages").select(F.concat(F.lit("LIN-"), "p_partkey").alias("id")), "id", "LIN", 50)


@query("SELECT CASE WHEN p_partkey % 3 = 0 THEN 'sub-9' ELSE 'seed' END AS _source, '2026' AS _added, count(*) AS n FROM {v_lineages} GROUP BY ALL")
def stamp_provenance(spark, d):
    rows = t(spark, d, "v_lineages").withColumn("_source", F.when(F.col("p_partkey") % 3 == 0, "sub-9").otherwise(""))
    return keys.stamp_provenance(rows, "seed", "2026").groupBy("_source", "_added").agg(F.count("*").alias("n"))


@query("""SELECT LINEAGE_NAME || '' AS record, 'SPECIES_NAME' AS "column", SPECIES_NAME AS was FROM {v_lineages} WHERE p_partkey % 17 = 0 AND SPECIES_NAME <> '' UNION ALL SELECT LINEAGE_NAME, 'SEQ_LENGTH', SEQ_LENGTH FROM {v_lineages} WHERE p_partkey % 13 = 0""")
def blanked_values(spark, d):
    rows = t(spark, d, "v_lineages").select("p_partkey", "LINEAGE_NAME", "SPECIES_NAME", "SEQ_LENGTH")
    after = rows.withColumn("SPECIES_NAME", F.when(F.col("p_partkey") % 17 == 0, "").otherwise(F.col("SPECIES_NAME"))).withColumn("SEQ_LENGTH", F.when(F.col("p_partkey") % 13 == 0, "").otherwise(F.col("SEQ_LENGTH")))
    return cdc.blanked_values(rows, after, "LINEAGE_NAME", ["SPECIES_NAME", "SEQ_LENGTH"])


@query("""WITH RECURSIVE r AS (SELECT OLD_NAME AS name, NEW_NAME AS current, 1 AS hops FROM {v_chain} UNION ALL SELECT r.name, c.NEW_NAME, r.hops + 1 FROM r JOIN {v_chain} c ON c.OLD_NAME = r.current)
SELECT name, arg_max(current, hops) AS current, max(hops) AS hops FROM r GROUP BY 1""")
def current_name(spark, d):
    return history.current_name(t(spark, d, "v_chain"))


@query("SELECT coalesce(NEW_NAME, LINEAGE_NAME) AS LINEAGE_NAME, count(*) AS n FROM {v_hosts} LEFT JOIN {v_chain} ON LINEAGE_NAME = OLD_NAME GROUP BY 1")
def rename_propagate(spark, d):
    hosts, chain = t(spark, d, "v_hosts", "v_chain")
    return history.rename_propagate(hosts, chain.select(F.col("OLD_NAME").alias("old"), F.col("NEW_NAME").alias("new")), "LINEAGE_NAME").groupBy("LINEAGE_NAME").agg(F.count("*").alias("n"))


# ---- sequences ----

_PAIRS = """WITH p AS (SELECT name, i, substr(seq, i, 1) AS b, substr(seq, i, 1) IN ('A', 'C', 'G', 'T') AS k FROM {v_sequences}, range(1, 65) r(i)),
n AS (SELECT name, count(*) FILTER (k) AS own FROM p GROUP BY 1)"""


@query("""WITH s AS (SELECT name, seq FROM {v_sequences}), j AS (SELECT x.name AS a, y.name AS b, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN substr(x.seq, i, 1) <> '-' AND substr(y.seq, i, 1) <> '-' THEN 1 ELSE 0 END)) AS comparable,
  list_sum(list_transform(range(1, 65), lambda i: CASE WHEN substr(x.seq, i, 1) <> '-' AND substr(y.seq, i, 1) <> '-' AND substr(x.seq, i, 1) <> substr(y.seq, i, 1) THEN 1 ELSE 0 END)) AS m, length(replace(x.seq, '-', '')) AS na, length(replace(y.seq, '-', '')) AS nb
  FROM s x JOIN s y ON x.name < y.name AND substr(x.seq, 17, 32) = substr(y.seq, 17, 32))
SELECT a, b, CASE WHEN na = comparable AND nb = comparable THEN 'duplicate' WHEN na = comparable OR nb = comparable THEN 'contained' ELSE 'ambiguous' END AS kind, CAST(comparable AS BIGINT) AS comparable, CAST(na - comparable AS BIGINT) AS a_private, CAST(nb - comparable AS BIGINT) AS b_private FROM j WHERE m = 0""")
def all_pairs_compatible(spark, d):
    return sequences.all_pairs_compatible(t(spark, d, "v_sequences"), "name", "seq", 64, min_shared=16)


@query("""WITH q AS (SELECT * FROM {v_sequences} WHERE variant = 3 AND vec_id % 100 = 0),
j AS (SELECT q.name AS query, r.name, CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN substr(r.seq, i, 1) <> '-' AND substr(q.seq, i, 1) <> substr(r.seq, i, 1) THEN 1 ELSE 0 END)) AS BIGINT) AS mismatches, CAST(length(replace(r.seq, '-', '')) AS BIGINT) AS comparable FROM q JOIN {v_sequences} r ON q.name <> r.name)
SELECT * FROM (SELECT query, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN mismatches = 0 AND comparable >= 40 THEN 0 ELSE 1 END, CASE WHEN comparable >= 40 THEN 0 ELSE 1 END, mismatches / comparable, -comparable, name) AS rank, name, mismatches, comparable FROM j) WHERE rank <= 5""")
def nearest_neighbors(spark, d):
    rows = t(spark, d, "v_sequences")
    q = sequences.with_masks(rows.filter("variant = 3 and vec_id % 100 = 0"), "name", "seq", 64)
    return sequences.nearest_neighbors(q, sequences.with_masks(rows, "name", "seq", 64), 64, 5, covered=40)


@query("""WITH c AS (SELECT i - 1 AS position, substr(seq, i, 1) AS base, count(*) AS n, min(vec_id * 5 + variant) AS first FROM {v_sequences}, range(1, 65) r(i) GROUP BY ALL)
SELECT position, coalesce(arg_max(base, n * 1000000000 - first) FILTER (base <> '-'), 'N') AS base FROM c GROUP BY 1""")
def consensus(spark, d):
    return sequences.consensus(t(spark, d, "v_sequences").withColumn("row_no", F.col("vec_id") * 5 + F.col("variant")), "seq", "row_no")


@query("SELECT i - 1 AS position, count(*) FILTER (substr(seq, i, 1) = 'A') AS n_A, count(*) FILTER (substr(seq, i, 1) = 'C') AS n_C, count(*) FILTER (substr(seq, i, 1) = 'G') AS n_G, count(*) FILTER (substr(seq, i, 1) = 'T') AS n_T FROM {v_sequences}, range(1, 65) r(i) GROUP BY 1")
def site_profile(spark, d):
    return sequences.site_profile(t(spark, d, "v_sequences"), "seq")


@query("SELECT seq, array_to_string(list_sort(list(DISTINCT name)), ',') AS names FROM {v_sequences} GROUP BY 1 HAVING count(DISTINCT name) > 1")
def shared_sequences(spark, d):
    return sequences.shared_sequences(t(spark, d, "v_sequences"), "name", "seq").withColumn("names", F.array_join("names", ","))


@query("SELECT name, CAST(length(replace(seq, '-', '')) AS BIGINT) AS determined, CAST(length(seq) - length(replace(seq, '-', '')) AS BIGINT) AS gaps, length(replace(seq, '-', '')) < 60 AS short FROM {v_sequences}")
def lineage_qc(spark, d):
    determined = S.determined_bases(F.col("seq"))
    return t(spark, d, "v_sequences").select("name", determined.cast("long").alias("determined"), (F.length("seq") - determined).cast("long").alias("gaps"), (determined < 60).alias("short"))


@query("SELECT count(DISTINCT length(seq)) AS widths FROM {v_sequences}")
def ragged_alignment(spark, d):
    return t(spark, d, "v_sequences").agg(F.count_distinct(F.length("seq")).alias("widths"))


@query("""SELECT name AS member, 'V' || vec_id || '_0' AS survivor FROM {v_sequences}""")
def duplicate_groups(spark, d):
    rows = t(spark, d, "v_sequences")
    # variants 2 and 4 meet only through whole ones, variant 3 only through variant 2
    pairs = sequences.all_pairs_compatible(rows, "name", "seq", 64, min_shared=40).select("a", "b")
    profiles = rows.select(F.col("name").alias("LINEAGE_NAME"), F.lit(1).alias("records"), F.lit(2000).alias("first_year"))
    return history.duplicate_groups(pairs, profiles)


# ---- quality ----

_STORE = "(SELECT * FROM {v_hosts} WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00')"
_BATCH = "(SELECT * FROM {v_hosts} WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00')"


#: All rows are judged, those of the store and those without a date too.
_WHOLE = "(SELECT * FROM {v_hosts})"


def _early():
    return F.col("l_shipdate") < F.lit("1998-06-01 00:00:00").cast("timestamp")


def _store_and_batch(spark, d):
    hosts = t(spark, d, "v_hosts")
    return hosts.filter(_early()), hosts.filter(~_early())


def _store_and_whole(spark, d, *columns):
    """The store and all rows; stored, as both are read several times and the view is a join of five tables."""
    hosts = stored(t(spark, d, "v_hosts").select(*columns, "l_shipdate"))
    return hosts.filter(_early()), hosts


def _flags(batch: str) -> str:
    return f"""WITH s AS {_STORE}, b AS {batch}, f AS (SELECT b.*,
 SPECIES_NAME = '' AS host_missing, NUMBER_FOUND > NUMBER_TESTED AS prevalence_inconsistent, LINEAGE_NAME NOT IN (SELECT LINEAGE_NAME FROM s) AS lineage_not_in_store,
 SPECIES_NAME <> '' AND SPECIES_NAME NOT IN (SELECT SPECIES_NAME FROM s) AS host_not_in_store, COUNTRY_NAME NOT IN (SELECT COUNTRY_NAME FROM s) AS country_not_in_store,
 SPECIES_NAME <> '' AND EXISTS (SELECT 1 FROM s WHERE s.LINEAGE_NAME = b.LINEAGE_NAME AND s.SPECIES_NAME = b.SPECIES_NAME AND s.REFERENCE_NAME <> b.REFERENCE_NAME) AS pair_already_in_store FROM b)"""


@query(_flags(_BATCH) + " SELECT tier, coalesce(n, 0) AS n FROM (SELECT unnest(['incomplete', 'review', 'confirms', 'new']) AS tier) LEFT JOIN (SELECT CASE WHEN host_missing THEN 'incomplete' WHEN lineage_not_in_store OR host_not_in_store OR prevalence_inconsistent THEN 'review' WHEN pair_already_in_store THEN 'confirms' ELSE 'new' END AS tier, count(*) AS n FROM f GROUP BY 1) USING (tier)")
def tier_counts(spark, d):
    store, batch = _store_and_batch(spark, d)
    return quality.tier_counts(quality.row_flags(batch, store))


@query(_flags(_WHOLE) + " SELECT flag, n FROM (" + " UNION ALL ".join(f"SELECT '{x}' AS flag, count(*) FILTER ({x}) AS n FROM f" for x in ("host_missing", "prevalence_inconsistent", "lineage_not_in_store", "host_not_in_store", "country_not_in_store", "pair_already_in_store")) + ") WHERE n > 0")
def row_flags(spark, d):
    store, rows = _store_and_whole(spark, d, "LINEAGE_NAME", "SPECIES_NAME", "COUNTRY_NAME", "REFERENCE_NAME", "NUMBER_FOUND", "NUMBER_TESTED")
    return quality.flag_counts(quality.row_flags(rows, store))


@query(f"""WITH s AS {_STORE}, b AS {_BATCH}, k AS (SELECT LINEAGE_NAME, list_distinct(list(ORDER_NAME)) AS o, list_distinct(list(FAMILY_NAME)) AS f, list_distinct(list(COUNTRY_NAME)) AS c FROM s GROUP BY 1)
SELECT CASE WHEN o IS NULL THEN 'no baseline' WHEN NOT list_contains(o, ORDER_NAME) AND len(o) = 1 THEN 'new order of a specialist' WHEN NOT list_contains(o, ORDER_NAME) THEN 'new order' WHEN NOT list_contains(f, FAMILY_NAME) THEN 'new family' WHEN NOT list_contains(c, COUNTRY_NAME) THEN 'new country' ELSE 'known' END AS call, count(*) AS n FROM b LEFT JOIN k USING (LINEAGE_NAME) GROUP BY 1""")
def host_geo_flag(spark, d):
    store, batch = _store_and_batch(spark, d)
    return quality.host_geo_flag(batch, store)


@query(f"""WITH s AS {_STORE}, b AS (SELECT DISTINCT LINEAGE_NAME, SPECIES_NAME, GENUS_NAME, FAMILY_NAME, ORDER_NAME, COUNTRY_NAME FROM {_WHOLE}), k AS (SELECT LINEAGE_NAME, list(SPECIES_NAME) AS sp, list(GENUS_NAME) AS g, list(FAMILY_NAME) AS f, list(ORDER_NAME) AS o, list(COUNTRY_NAME) AS c FROM s GROUP BY 1)
SELECT DISTINCT LINEAGE_NAME, SPECIES_NAME, COUNTRY_NAME, CASE WHEN o IS NULL THEN 'unknown lineage' WHEN SPECIES_NAME <> '' AND list_contains(sp, SPECIES_NAME) THEN 'species' WHEN list_contains(g, GENUS_NAME) THEN 'genus' WHEN list_contains(f, FAMILY_NAME) THEN 'family' WHEN list_contains(o, ORDER_NAME) THEN 'order' ELSE 'new' END AS level, coalesce(list_contains(c, COUNTRY_NAME), false) AS in_country FROM b LEFT JOIN k USING (LINEAGE_NAME)""")
def plausibility(spark, d):
    return quality.plausibility(t(spark, d, "v_hosts"), _early())


# ---- places ----

_BOX = "(SELECT n_name AS admin, n_nationkey * 14.0 - 180 AS west, -60.0 AS south, n_nationkey * 14.0 - 140 AS east, 60.0 AS north FROM {nation})"


def _sites(spark, d):
    sites, nation = t(spark, d, "v_sites", "nation")
    points = sites.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("site"), F.col("n_name").alias("admin"), F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    west = F.col("n_nationkey") * 14.0 - 180
    boxes = nation.select(F.col("n_name").alias("admin"), west.alias("west"), F.lit(-60.0).alias("south"), (west + 40).alias("east"), F.lit(60.0).alias("north"))
    return points, geo.rectangles_to_edges(boxes)


@query(f"SELECT s_suppkey AS site, n_name AS admin FROM {{v_sites}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {_BOX} b ON b.admin = n_name WHERE lon >= west AND lon < east AND lat >= south AND lat < north")
def point_in_polygon(spark, d):
    return geo.point_in_polygon(*_sites(spark, d))


@query(f"""SELECT s_suppkey AS site, n_name AS admin, CASE WHEN lon >= west AND lon < east AND lat >= south AND lat < north THEN 0.0 ELSE sqrt(power(greatest(west - lon, lon - east, 0) * cos(radians(lat)) * 111.32, 2) + power(greatest(south - lat, lat - north, 0) * 111.32, 2)) END AS km FROM {{v_sites}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {_BOX} b ON b.admin = n_name""")
def distance_to_polygon(spark, d):
    return geo.distance_to_polygon(*_sites(spark, d))


@query(f"""WITH v AS (SELECT s_suppkey AS site, lon, lat, west, south, east, north, (lon >= west AND lon < east AND lat >= south AND lat < north) AS ok, sqrt(power(greatest(west - lon, lon - east, 0) * cos(radians(lat)) * 111.32, 2) + power(greatest(south - lat, lat - north, 0) * 111.32, 2)) AS km FROM {{v_sites}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {_BOX} b ON b.admin = n_name),
w AS (SELECT *, CASE WHEN ok THEN 'inside' WHEN km <= 10 THEN 'near' ELSE 'outside' END AS verdict FROM v)
SELECT site, verdict, CASE WHEN verdict = 'outside' THEN CASE WHEN lon >= west AND lon < east AND -lat >= south AND -lat < north THEN 'latitude sign' WHEN -lon >= west AND -lon < east AND lat >= south AND lat < north THEN 'longitude sign' WHEN -lon >= west AND -lon < east AND -lat >= south AND -lat < north THEN 'both signs' WHEN lat >= west AND lat < east AND lon >= south AND lon < north THEN 'swapped' END END AS fix FROM w""")
def check_site(spark, d):
    return geo.check_site(*_sites(spark, d))


# ---- text ----

_PAPERS = """(SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' Our sequences were deposited in GenBank (this study) as PV9484' || (10 + doc_id % 80) || '-' || (11 + doc_id % 80) || '. See 10.1000/x' || doc_id || ', 10.1000/y and 10.1000/x' || doc_id || '.' WHEN 1 THEN ' Sequences AB123456 were downloaded.' WHEN 2 THEN ' Found KY65381' || (doc_id % 10) || ' here.' ELSE '' END AS text FROM {documents})"""


def _papers(spark, d):
    docs = t(spark, d, "documents")
    k = F.col("doc_id") % 5
    n = F.col("doc_id") % 80
    tail = (
        F.when(k == 0, F.concat(F.lit(" Our sequences were deposited in GenBank (this study) as PV9484"), n + 10, F.lit("-"), n + 11, F.lit(". See 10.1000/x"), "doc_id", F.lit(", 10.1000/y and 10.1000/x"), "doc_id", F.lit(".")))
        .when(k == 1, " Sequences AB123456 were downloaded.")
        .when(k == 2, F.concat(F.lit(" Found KY65381"), F.col("doc_id") % 10, F.lit(" here.")))
        .otherwise("")
    )
    return docs.select("doc_id", F.concat("text", tail).alias("text"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'PV9484' || (10 + doc_id % 80) || ';PV9484' || (11 + doc_id % 80) WHEN 1 THEN 'AB123456' WHEN 2 THEN 'KY65381' || (doc_id % 10) END AS v FROM {documents} WHERE doc_id % 5 < 3")
def mine_accessions(spark, d):
    return _papers(spark, d).select("doc_id", F.array_join(mining.mine_accessions(F.col("text"), ["PV", "AB", "KY"]), ";").alias("v")).filter("v <> ''")


@query("SELECT doc_id, unnest(['PV9484' || (10 + doc_id % 80), 'PV9484' || (11 + doc_id % 80)]) AS accession FROM {documents} WHERE doc_id % 5 = 0")
def expand_ranges(spark, d):
    return _papers(spark, d).select("doc_id", F.explode(mining.expanded_ranges(mining.masked(F.col("text")))).alias("accession"))


@query("SELECT doc_id, '10.1000/x' || doc_id AS doi FROM {documents} WHERE doc_id % 5 = 0")
def modal_doi(spark, d):
    return mining.modal_doi(_papers(spark, d))


@query("""SELECT doc_id, part, CASE WHEN doc_id % 5 = 0 THEN CASE part WHEN 'text' THEN 'focal' WHEN 'other' THEN 'reprinted' ELSE 'unknown' END WHEN doc_id % 5 = 3 THEN 'scope_uncertain' ELSE 'unknown' END AS scope
FROM {documents} CROSS JOIN (SELECT unnest(['text', 'other', 'none']) AS part)""")
def classify_scope(spark, d):
    """Rows with the accessions of their paper's text, with one that no paper declares, and with none."""
    papers = _papers(spark, d).withColumn("text", F.when(F.col("doc_id") % 5 == 3, F.concat("text", F.lit(". We compiled data of earlier studies."))).otherwise(F.col("text")))
    none = F.array().cast("array<string>")
    parts = F.array(*[F.struct(F.lit(n).alias("part"), v.alias("accessions")) for n, v in (("text", mining.mine_accessions(F.col("text"), ["PV", "AB", "KY"])), ("other", F.array(F.lit("KY999999"))), ("none", none))])
    rows = papers.select("doc_id", F.inline(parts))
    return mining.classify_scope(rows, mining.declared_accessions(papers), mining.pooled_statements(papers)).select("doc_id", "part", "scope")


@query("""WITH l AS (SELECT doc_id, i - 1 AS line, string_split(text, chr(10))[i] AS s FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM {documents})),
m AS (SELECT doc_id, line, 'address' AS class, unnest(regexp_extract_all(s, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+')) AS v FROM l UNION ALL SELECT doc_id, line, 'credential', unnest(regexp_extract_all(s, '(?:token|secret|password) = "[A-Za-z0-9]+"')) FROM l UNION ALL SELECT doc_id, line, 'literal', s FROM l WHERE s IN (SELECT text FROM {benchmark}))
SELECT doc_id, line, class, substr(sha256(v), 1, 16) AS hash FROM m""")
def privacy_scan(spark, d):
    return mining.privacy_scan(*t(spark, d, "documents", "benchmark"))


_HITS = "(SELECT CASE WHEN page_id % 3 = 0 THEN 'https://doi.org/10.5/' || (page_id % 40) ELSE '' END AS doi, url AS id, 's' || (page_id % 3) AS source, 'Title ' || (page_id % 60) AS title FROM {pages} UNION ALL SELECT 'doi:10.5/' || (page_id % 40), url || '#', 'x', 'Other ' || page_id FROM {pages} WHERE page_id % 6 = 0)"


def _hits(spark, d):
    pages = t(spark, d, "pages")
    a = pages.select(F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://doi.org/10.5/"), F.col("page_id") % 40)).otherwise("").alias("doi"), F.col("url").alias("id"), F.concat(F.lit("s"), F.col("page_id") % 3).alias("source"), F.concat(F.lit("Title "), F.col("page_id") % 60).alias("title"))
    b = pages.filter("page_id % 6 = 0").select(F.concat(F.lit("doi:10.5/"), F.col("page_id") % 40).alias("doi"), F.concat("url", F.lit("#")).alias("id"), F.lit("x").alias("source"), F.concat(F.lit("Other "), "page_id").alias("title"))
    return a.unionByName(b)


@query(f"""WITH k AS (SELECT *, CASE WHEN doi <> '' THEN 'doi:' || regexp_replace(doi, '^(https://doi.org/|doi:)', '') ELSE id END AS key FROM {_HITS}), o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY source, id, title) AS i FROM k)
SELECT key, min(title) FILTER (i = 1) AS title, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM o GROUP BY 1""")
def source_union(spark, d):
    return mining.source_union(_hits(spark, d)).withColumn("sources", F.array_join("sources", ","))


@query(f"SELECT title, count(*) AS n FROM {_HITS} WHERE title NOT IN (SELECT 'Title ' || (page_id % 30) FROM {{pages}}) GROUP BY 1")
def not_in_database(spark, d):
    known = t(spark, d, "pages").select(F.concat(F.lit("TITLE: "), F.col("page_id") % 30).alias("title"))
    return mining.not_in_database(_hits(spark, d), known).groupBy("title").agg(F.count("*").alias("n"))


# ---- ledger ----


def _now(spark, d):
    return F.lit("2024-01-20 00:00:00").cast("timestamp")


@query("""SELECT submission, reviewer, arg_max(kind, ("at", seq)) AS kind, max("at") AS "at" FROM {v_ledger} WHERE kind IN ('approve', 'hold') GROUP BY 1, 2""")
def current_verdicts(spark, d):
    return ledger.current_verdicts(t(spark, d, "v_ledger"), ["approve", "hold"])


@query("""WITH v AS (SELECT submission, reviewer, arg_max(kind, ("at", seq)) AS kind FROM {v_ledger} WHERE kind IN ('approve', 'hold') GROUP BY 1, 2), c AS (SELECT submission, count(*) FILTER (kind = 'approve') AS approvals, count(*) FILTER (kind = 'hold') AS objections FROM v GROUP BY 1)
SELECT *, approvals > 0 AND objections = 0 AS approvable FROM c""")
def is_approvable(spark, d):
    return ledger.is_approvable(ledger.current_verdicts(t(spark, d, "v_ledger"), ["approve", "hold"]))


@query("""SELECT submission, max("at") AS last_at, CAST(floor((epoch(TIMESTAMP '2024-01-20 00:00:00') - floor(epoch(max("at")))) / 86400) AS BIGINT) AS idle_days FROM {v_ledger} GROUP BY 1 HAVING floor((epoch(TIMESTAMP '2024-01-20 00:00:00') - floor(epoch(max("at")))) / 86400) >= -10""")
def stale_live(spark, d):
    return ledger.stale_live(t(spark, d, "v_ledger"), _now(spark, d), -10)


@query("""WITH l AS (SELECT submission, max("at") AS last_at, max(("at", seq)) FILTER (kind = 'approve') AS ap, max(("at", seq)) FILTER (kind IN ('hold', 'retract')) AS ob, max("at") FILTER (kind = 'approve') AS ap_at FROM {v_ledger} GROUP BY 1),
a AS (SELECT submission, CASE WHEN ap IS NOT NULL AND (ob IS NULL OR ob < ap) AND epoch(TIMESTAMP '2024-03-20 00:00:00') - floor(epoch(ap_at)) >= 259200 THEN 'publish' WHEN epoch(TIMESTAMP '2024-03-20 00:00:00') - floor(epoch(last_at)) >= 5184000 THEN 'dormant' END AS action FROM l) SELECT * FROM a WHERE action IS NOT NULL""")
def due_actions(spark, d):
    return ledger.due_actions(t(spark, d, "v_ledger"), F.lit("2024-03-20 00:00:00").cast("timestamp"), 72, 60)


_DUE = QUERIES["due_actions"][1]


def due_actions_stream(spark, d):
    """The same from a stream: the ledger in shuffled files, timers up to the same point in time, the last told of each submission."""
    from curaspark.streaming import ledger as stream

    with stream.with_timers(spark):
        told = stream.replay(t(spark, d, "v_ledger"), lambda events, delay: stream.due_actions_stream(events, 72, 60, delay), 6, "2024-03-20 00:00:00", "40 days")
    return told.groupBy("submission").agg(F.max_by("action", F.struct("as_of", "turn")).alias("action")).filter("action is not null")


QUERIES["due_actions_stream"] = (due_actions_stream, _DUE)


@query("""WITH RECURSIVE e AS (SELECT submission, row_number() OVER (PARTITION BY submission ORDER BY "at", seq) AS i, CASE kind WHEN 'received' THEN 'received' WHEN 'in_review' THEN 'in_review' WHEN 'approve' THEN 'approved' WHEN 'hold' THEN 'held' ELSE 'withdrawn' END AS t, kind FROM {v_ledger}),
s AS (SELECT submission, 0 AS i, 'received' AS state, 0 AS refused FROM (SELECT DISTINCT submission FROM e)
 UNION ALL SELECT s.submission, e.i, CASE WHEN ok THEN e.t ELSE s.state END, s.refused + CASE WHEN ok OR e.t = s.state OR e.kind = 'received' THEN 0 ELSE 1 END FROM s JOIN e ON e.submission = s.submission AND e.i = s.i + 1,
 LATERAL (SELECT (e.t = 'in_review' AND s.state IN ('received', 'held')) OR (e.t = 'approved' AND s.state = 'in_review') OR (e.t = 'held' AND s.state IN ('received', 'in_review', 'approved')) OR (e.t = 'withdrawn' AND s.state IN ('received', 'in_review', 'held', 'approved')) AS ok))
SELECT submission, arg_max(state, i) AS state, CAST(arg_max(refused, i) AS BIGINT) AS refused FROM s GROUP BY 1""")
def review_state(spark, d):
    return ledger.review_state(t(spark, d, "v_ledger"))


@query("""WITH v AS (SELECT submission, reviewer, arg_max(kind, ("at", seq)) AS kind, max("at") AS "at" FROM {v_ledger} WHERE kind IN ('approve', 'hold') GROUP BY 1, 2), j AS (SELECT submission, min("at") FILTER (kind = 'hold') AS h, min("at") FILTER (kind = 'approve') AS a FROM v GROUP BY 1), e AS (SELECT submission, min("at") AS r FROM {v_ledger} GROUP BY 1)
SELECT submission, CASE WHEN h IS NOT NULL THEN 'answer' WHEN a IS NOT NULL THEN 'publication' ELSE 'review' END AS waits_for, coalesce(h, a, r) AS since FROM e LEFT JOIN j USING (submission)""")
def waiting_on(spark, d):
    events = t(spark, d, "v_ledger")
    return ledger.waiting_on(ledger.current_verdicts(events, ["approve", "hold"]), events)


@query("SELECT submission, count(*) AS n_verdicts, array_to_string(list_sort(list(DISTINCT kind)), ',') AS kinds FROM {v_ledger} GROUP BY 1")
def decision_record(spark, d):
    return ledger.decision_record(t(spark, d, "v_ledger"))


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
