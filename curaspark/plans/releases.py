"""Queries of whole editions, exports, names and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.operators import claims, curation, editions, keys, ledger, summary  # noqa: F401
from curaspark.plans.relational import _REGION_COLUMNS, t
from curaspark.plans.views import oracle

QUERIES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(sql))
        return f

    return add


# ---- editions ----

_ONCE = "SELECT LINEAGE_NAME FROM {{{}}} GROUP BY 1 HAVING count(*) = 1"
_NAMES = f"""SELECT LINEAGE_NAME AS name, 'added' AS kind FROM ({_ONCE.format('v_lin_curr')}) WHERE LINEAGE_NAME NOT IN (SELECT LINEAGE_NAME FROM {{v_lin_prev}})
UNION ALL SELECT LINEAGE_NAME, 'removed' FROM ({_ONCE.format('v_lin_prev')}) WHERE LINEAGE_NAME NOT IN (SELECT LINEAGE_NAME FROM {{v_lin_curr}})"""
_FACTS = f"""SELECT a.LINEAGE_NAME AS name, c AS "column", CASE c WHEN 'GENUS_NAME' THEN a.GENUS_NAME WHEN 'GENBANK_ACC' THEN a.GENBANK_ACC ELSE CAST(length(a.SEQUENCE) AS VARCHAR) END AS was,
CASE c WHEN 'GENUS_NAME' THEN b.GENUS_NAME WHEN 'GENBANK_ACC' THEN b.GENBANK_ACC ELSE CAST(length(b.SEQUENCE) AS VARCHAR) END AS now
FROM {{v_lin_prev}} a JOIN {{v_lin_curr}} b USING (LINEAGE_NAME), (VALUES ('GENUS_NAME'), ('GENBANK_ACC'), ('SEQUENCE')) v(c)
WHERE LINEAGE_NAME IN ({_ONCE.format('v_lin_prev')}) AND LINEAGE_NAME IN ({_ONCE.format('v_lin_curr')})
AND CASE c WHEN 'GENUS_NAME' THEN a.GENUS_NAME <> b.GENUS_NAME WHEN 'GENBANK_ACC' THEN a.GENBANK_ACC <> b.GENBANK_ACC ELSE a.SEQUENCE <> b.SEQUENCE END"""
_KEY = ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"]
_K = ", ".join(_KEY)


@query(_NAMES)
def added_removed_names(spark, d):
    return editions.added_removed_names(*t(spark, d, "v_lin_prev", "v_lin_curr"), "LINEAGE_NAME")


@query(_FACTS)
def lineage_fact_changes(spark, d):
    return editions.fact_changes(*t(spark, d, "v_lin_prev", "v_lin_curr"), "LINEAGE_NAME", ["GENUS_NAME", "GENBANK_ACC", "SEQUENCE"])


@query(f"""WITH n AS ({_NAMES}), f AS ({_FACTS}), b AS (SELECT {_K}, count(*) AS nb, min(COUNTRY_NAME) AS b1, min(COMMENT) AS b2 FROM {{v_prev}} GROUP BY ALL), a AS (SELECT {_K}, count(*) AS na, min(COUNTRY_NAME) AS a1, min(COMMENT) AS a2 FROM {{v_curr}} GROUP BY ALL),
j AS (SELECT {_K}, coalesce(nb, 0) AS nb, coalesce(na, 0) AS na, b1, b2, a1, a2 FROM b FULL JOIN a USING ({_K})),
net AS (SELECT {_K}, sum(s) AS net FROM (SELECT {_K}, COUNTRY_NAME, COMMENT, -1 AS s FROM {{v_prev}} UNION ALL SELECT {_K}, COUNTRY_NAME, COMMENT, 1 FROM {{v_curr}}) SEMI JOIN (SELECT {_K} FROM j WHERE na > 1 OR nb > 1) USING ({_K}) GROUP BY {_K}, COUNTRY_NAME, COMMENT HAVING sum(s) <> 0),
o AS (SELECT SPECIES_NAME AS v FROM {{v_prev}}), c AS (SELECT SPECIES_NAME AS v FROM {{v_curr}}),
r AS (SELECT 'totals lineages' AS section, 'delta' AS kind, (SELECT count(*) FROM {{v_lin_curr}}) - (SELECT count(*) FROM {{v_lin_prev}}) AS n
UNION ALL SELECT 'totals host_records', 'delta', (SELECT count(*) FROM {{v_curr}}) - (SELECT count(*) FROM {{v_prev}})
UNION ALL SELECT 'names', kind, count(*) FROM n GROUP BY kind UNION ALL SELECT 'facts', "column", count(*) FROM f GROUP BY 2
UNION ALL SELECT 'diff host_records', CASE WHEN nb = 0 THEN 'added' ELSE 'removed' END, count(*) FROM j WHERE na <= 1 AND nb <= 1 AND na <> nb GROUP BY 2
UNION ALL SELECT 'diff host_records', 'modified', sum(CASE WHEN b1 <> a1 THEN 1 ELSE 0 END + CASE WHEN b2 <> a2 THEN 1 ELSE 0 END) FROM j WHERE na = 1 AND nb = 1 HAVING sum(CASE WHEN b1 <> a1 THEN 1 ELSE 0 END + CASE WHEN b2 <> a2 THEN 1 ELSE 0 END) > 0
UNION ALL SELECT 'diff host_records', CASE WHEN net > 0 THEN 'ambiguous added' ELSE 'ambiguous removed' END, sum(abs(net)) FROM net GROUP BY 2
UNION ALL SELECT 'values hosts', 'new', count(DISTINCT v) FROM c WHERE v <> '' AND v NOT IN (SELECT v FROM o) HAVING count(*) > 0
UNION ALL SELECT 'values hosts', 'retired', count(DISTINCT v) FROM o WHERE v <> '' AND v NOT IN (SELECT v FROM c) HAVING count(*) > 0)
SELECT section, kind, CAST(n AS BIGINT) AS n FROM r""")
def compare_editions(spark, d):
    a, b, prev, curr = t(spark, d, "v_lin_prev", "v_lin_curr", "v_prev", "v_curr")
    parts = editions.compare_editions(
        {"lineages": a, "host_records": prev}, {"lineages": b, "host_records": curr}, ["GENUS_NAME", "GENBANK_ACC", "SEQUENCE"],
        {"host_records": (_KEY, ["COUNTRY_NAME", "COMMENT"])}, {"hosts": ("host_records", "SPECIES_NAME")},
    )
    return editions.account(parts)


def _release_store(spark, d):
    lineages, hosts, references = t(spark, d, "v_lin_curr", "v_hosts", "v_references")
    k = F.col("l_orderkey")
    source = F.when(k % 9 == 0, "seed").when(k % 9 == 1, "").otherwise((k % 190).cast("string"))
    return {"lineages": lineages, "host_records": hosts.withColumn("_source", source).withColumn("_added", F.lit("2026")), "references": references}


_GATE = """a AS (SELECT submission, max(("at", seq)) FILTER (kind = 'approve') AS ap, max(("at", seq)) FILTER (kind <> 'approve') AS other FROM {v_ledger} GROUP BY 1),
h AS (SELECT *, CASE WHEN l_orderkey % 9 = 0 THEN 'seed' WHEN l_orderkey % 9 = 1 THEN '' ELSE CAST(l_orderkey % 190 AS VARCHAR) END AS source FROM {v_hosts}),
p AS (SELECT h.* FROM h LEFT JOIN a ON source = CAST(a.submission AS VARCHAR) WHERE source = 'seed' OR (ap IS NOT NULL AND (other IS NULL OR ap > other)))"""


@query(f"""WITH {_GATE}, r AS (SELECT 'table host_records' AS item, count(*) AS n FROM p UNION ALL SELECT 'table lineages', count(*) FROM {{v_lin_curr}} UNION ALL SELECT 'table references', count(*) FROM {{v_references}}
UNION ALL SELECT 'table summary', count(*) FROM {{v_lineages}} UNION ALL SELECT 'table gate', count(DISTINCT source) FROM h
UNION ALL SELECT 'tally SUM_HOST', count(*) FROM (SELECT DISTINCT LINEAGE_NAME, p.GENUS_NAME, p.SPECIES_NAME FROM p JOIN {{v_lineages}} l USING (LINEAGE_NAME) WHERE p.SPECIES_NAME <> '')
UNION ALL SELECT 'tally SUM_GENUS', count(*) FROM (SELECT DISTINCT LINEAGE_NAME, p.GENUS_NAME FROM p JOIN {{v_lineages}} l USING (LINEAGE_NAME)) UNION ALL SELECT 'tally SUM_FAMILY', count(*) FROM (SELECT DISTINCT LINEAGE_NAME, FAMILY_NAME FROM p JOIN {{v_lineages}} l USING (LINEAGE_NAME)) UNION ALL SELECT 'tally SUM_ORDER', count(*) FROM (SELECT DISTINCT LINEAGE_NAME, ORDER_NAME FROM p JOIN {{v_lineages}} l USING (LINEAGE_NAME))
UNION ALL SELECT 'warning no sequence', count(*) FROM {{v_lin_curr}} WHERE SEQUENCE = '' UNION ALL SELECT 'warning odd length', count(*) FROM {{v_lin_curr}} WHERE SEQUENCE <> '' AND length(SEQUENCE) <> 24
UNION ALL SELECT 'warning duplicate name', count(*) FROM (SELECT LINEAGE_NAME FROM {{v_lin_curr}} GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'warning natural key repeated', count(*) FROM (SELECT {_K} FROM p GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'warning orphan citation', count(DISTINCT REFERENCE_NAME) FROM p WHERE REFERENCE_NAME NOT IN (SELECT REFERENCE_NAME FROM {{v_references}})
UNION ALL SELECT 'warning impossible counts', count(*) FROM p WHERE NUMBER_FOUND > NUMBER_TESTED
UNION ALL SELECT 'warning no lineage', count(DISTINCT LINEAGE_NAME) FROM p WHERE LINEAGE_NAME NOT IN (SELECT LINEAGE_NAME FROM {{v_lin_curr}})) SELECT * FROM r""")
def build_release(spark, d):
    store = _release_store(spark, d)
    last = t(spark, d, "v_ledger").groupBy("submission").agg(F.max_by("kind", F.struct("at", "seq")).alias("kind"))
    states = last.select("submission", F.when(F.col("kind") == "approve", "approved").otherwise("open").alias("state"))
    gate = curation.release_gate(store["host_records"].groupBy(F.col("_source").alias("source")).agg(F.count("*").alias("n_rows")), states, "seed")
    lineages, vectors, regions = t(spark, d, "v_lineages", "v_vectors", "v_region_map")
    summed = lambda public: summary.lineage_summary(lineages.drop("p_partkey"), public["host_records"], vectors, regions, _REGION_COLUMNS, "building")
    release = editions.build_release(store, gate, summed, 24)
    tallies = release["summary"].agg(*[F.sum(F.coalesce(F.col(c).try_cast("long"), F.lit(0))).alias(c) for c in ("SUM_HOST", "SUM_GENUS", "SUM_FAMILY", "SUM_ORDER")])
    tallies = tallies.select(F.explode(F.array(*[F.struct(F.lit(f"tally {c}").alias("item"), F.col(c).alias("n")) for c in tallies.columns])).alias("x")).select("x.*")
    tables = editions.counted({f"table {name}": df for name, df in release.items() if name != "warnings"})
    return tables.withColumnRenamed("check", "item").union(tallies).union(release["warnings"].select(F.concat(F.lit("warning "), "check").alias("item"), "n"))


@query("""SELECT 'LIN-' || lpad(CAST(row_number() OVER (ORDER BY LINEAGE_NAME, SPECIES_NAME, SEQ_LENGTH) AS VARCHAR), 6, '0') AS RECORD_ID, LINEAGE_NAME, SPECIES_NAME, 'seed' AS _source, '2026-01' AS _added FROM {v_lineages}
UNION ALL SELECT 'dropped', "column", '', '', '' FROM (VALUES ('p_partkey'), ('GENUS_NAME')) v("column")""")
def seed_store(spark, d):
    lineages = t(spark, d, "v_lineages")
    seeded, dropped = editions.seed_store({"lineages": lineages}, {"lineages": ["LINEAGE_NAME", "SPECIES_NAME", "SEQ_LENGTH"]}, {"lineages": "LIN"}, {"lineages": ["LINEAGE_NAME", "SPECIES_NAME", "SEQ_LENGTH"]}, "2026-01")
    rows = seeded["lineages"].select("RECORD_ID", "LINEAGE_NAME", "SPECIES_NAME", "_source", "_added")
    blank = F.lit("")
    return rows.union(dropped.select(F.lit("dropped"), "dropped", blank, blank, blank))


@query(f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY {_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT ORDER BY _row_no) AS i FROM {{v_prev}} WHERE SITE_NAME <> 'S0'), q AS (SELECT *, row_number() OVER (PARTITION BY {_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT ORDER BY _row_no) AS i FROM {{v_curr}}),
j AS (SELECT {_K}, p._row_no AS a, q._row_no AS b FROM p FULL JOIN q USING ({_K}, COUNTRY_NAME, NUMBER_FOUND, COMMENT, i)),
k AS (SELECT {_K}, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS same, count(*) FILTER (b IS NULL) AS lost, count(*) FILTER (a IS NULL) AS fresh FROM j GROUP BY ALL)
SELECT 'host_records' AS "table", 'unchanged' AS outcome, CAST(sum(same) AS BIGINT) AS n FROM k UNION ALL SELECT 'host_records', 'changed', CAST(sum(least(lost, fresh)) AS BIGINT) FROM k UNION ALL SELECT 'host_records', 'added', CAST(sum(fresh - least(lost, fresh)) AS BIGINT) FROM k UNION ALL SELECT 'host_records', 'removed', CAST(sum(lost - least(lost, fresh)) AS BIGINT) FROM k
UNION ALL SELECT 'host_records', 'carried', count(*) FROM {{v_prev}} WHERE SITE_NAME = 'S0' UNION ALL SELECT 'references', 'carried', count(*) FROM {{v_references}}""")
def merge_store(spark, d):
    prev, curr, references = t(spark, d, "v_prev", "v_curr", "v_references")
    columns = [*_KEY, "COUNTRY_NAME", "NUMBER_FOUND", "COMMENT"]
    hosts = prev.withColumn("RECORD_ID", F.col("_row_no").cast("string")).drop("_row_no").withColumn("_source", F.when(F.col("SITE_NAME") == "S0", "sub-1").otherwise("seed"))
    merged = editions.merge_store({"host_records": hosts, "references": references}, {"host_records": curr}, {"host_records": (_KEY, columns)})
    counted = [df.groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "outcome", "n") for name, df in merged.items()]
    every = spark.sql("select * from values ('host_records', 'unchanged'), ('host_records', 'changed'), ('host_records', 'added'), ('host_records', 'removed'), ('host_records', 'carried'), ('references', 'carried') as v(`table`, outcome)")
    return every.join(counted[0].union(counted[1]), ["table", "outcome"], "left").na.fill(0)


@query("SELECT LINEAGE_NAME FROM {v_lin_curr} WHERE trim(SEQUENCE) = ''")
def no_sequence(spark, d):
    return editions.no_sequence(t(spark, d, "v_lin_curr"), "SEQUENCE").select("LINEAGE_NAME")


@query("SELECT LINEAGE_NAME, length(SEQUENCE) AS n FROM {v_lin_curr} WHERE SEQUENCE <> '' AND length(SEQUENCE) <> 24")
def odd_length(spark, d):
    return editions.odd_length(t(spark, d, "v_lin_curr"), "SEQUENCE", 24).select("LINEAGE_NAME", F.length("SEQUENCE").alias("n"))


@query("SELECT COUNTRY_NAME FROM (SELECT COUNTRY_NAME FROM {v_hosts} UNION SELECT COUNTRY_NAME FROM {v_vectors}) WHERE COUNTRY_NAME <> 'FRANCE'")
def countries_union(spark, d):
    return editions.countries_union(list(t(spark, d, "v_hosts", "v_vectors")), "COUNTRY_NAME", "FRANCE")


_STUDY = "CASE WHEN o_orderkey % 3 = 0 THEN 'Smith' || (o_custkey % 30) || ' unpubl' ELSE 'Smith' || (o_custkey % 40) || ' ' || (1990 + o_orderkey % 20) END"


def _studies(spark, d):
    who = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Smith"), F.col("o_custkey") % 30, F.lit(" unpubl"))).otherwise(F.concat(F.lit("Smith"), F.col("o_custkey") % 40, F.lit(" "), 1990 + F.col("o_orderkey") % 20))
    return t(spark, d, "orders").withColumn("REFERENCE_NAME", who)


@query(f"""WITH s AS (SELECT DISTINCT {_STUDY} AS r FROM {{orders}}) SELECT u.r AS unpublished, array_to_string(list_sort(list(DISTINCT p.r)), ',') AS published FROM s u JOIN s p ON split_part(u.r, ' ', 1) = split_part(p.r, ' ', 1) WHERE u.r LIKE '%unpubl' AND p.r NOT LIKE '%unpubl' GROUP BY 1""")
def split_studies(spark, d):
    rows = _studies(spark, d).select("REFERENCE_NAME")
    return editions.split_studies(rows, rows, F.substring_index("REFERENCE_NAME", " ", 1)).select("unpublished", F.array_join("published", ",").alias("published"))


@query(f"SELECT DISTINCT {_K} FROM {{v_hosts}} a WHERE REFERENCE_NAME = 'R2' AND EXISTS (SELECT 1 FROM {{v_hosts}} b WHERE b.REFERENCE_NAME = 'R1' AND a.LINEAGE_NAME = b.LINEAGE_NAME AND a.SPECIES_NAME = b.SPECIES_NAME AND a.SITE_NAME = b.SITE_NAME)")
def rename_key_collisions(spark, d):
    return editions.rename_key_collisions(t(spark, d, "v_hosts"), _KEY, "REFERENCE_NAME", "R1", "R2")


@query("""WITH c AS (SELECT 'host_records' AS "table", CASE WHEN l_orderkey % 2 = 0 THEN 'seed' ELSE 'sub' END AS source, REFERENCE_NAME AS r FROM {v_hosts} UNION ALL SELECT 'references', 'seed', REFERENCE_NAME FROM {v_references})
SELECT "table", CASE WHEN r = 'R5' THEN 'New 2026' ELSE r END AS reference, count(*) AS n, min(CASE WHEN "table" = 'references' AND r = 'R5' THEN 'sub' ELSE '' END) AS provenance FROM c GROUP BY 1, 2""")
def publish_reference(spark, d):
    hosts, references = t(spark, d, "v_hosts", "v_references")
    hosts = hosts.withColumn("_source", F.when(F.col("l_orderkey") % 2 == 0, "seed").otherwise("sub")).withColumn("_added", F.lit("2026"))
    references = references.withColumn("_source", F.lit("seed")).withColumn("_added", F.lit("2025"))
    out = editions.publish_reference({"host_records": hosts}, references, "R5", "New 2026", {"PUBLICATION_YEAR": 2026})
    mark = F.when(F.col("REFERENCE_NAME") == "New 2026", F.col("_source")).otherwise("")
    parts = [df.groupBy(F.lit(name).alias("table"), F.col("REFERENCE_NAME").alias("reference")).agg(F.count("*").alias("n"), F.min(mark if name == "references" else F.lit("")).alias("provenance")) for name, df in out.items()]
    return parts[0].union(parts[1])


@query("""SELECT 'host_records' AS "table", CAST(l_orderkey % 5 AS VARCHAR) AS source, count(*) AS n FROM {v_hosts} WHERE REFERENCE_NAME = 'R7' GROUP BY 2 UNION ALL SELECT 'vector_records', SITE_NAME, count(*) FROM {v_vectors} WHERE REFERENCE_NAME = 'R7' GROUP BY 2""")
def cites_study(spark, d):
    hosts, vectors = t(spark, d, "v_hosts", "v_vectors")
    return editions.cites_study({"host_records": hosts.withColumn("_source", (F.col("l_orderkey") % 5).cast("string")), "vector_records": vectors.withColumn("_source", F.col("SITE_NAME"))}, "R7")


# ---- exports ----


@query("""SELECT 'P' || l_partkey AS LINEAGE_NAME, coalesce(s_name, '') AS VECTOR_SPECIES, coalesce(n_name, '') AS COUNTRY_NAME, count(*) AS n FROM {lineitem} LEFT JOIN (SELECT * FROM {supplier} WHERE s_suppkey % 7 <> 0) ON l_suppkey = s_suppkey LEFT JOIN {nation} ON s_nationkey = n_nationkey GROUP BY ALL""")
def export_vectors(spark, d):
    facts, supplier, nation = t(spark, d, "lineitem", "supplier", "nation")
    supplier = supplier.filter("s_suppkey % 7 <> 0")
    out = editions.star(facts, [(supplier, "l_suppkey", "s_suppkey", {"s_name": "VECTOR_SPECIES", "s_nationkey": "NATION"}), (nation.withColumn("n_nationkey", F.col("n_nationkey").cast("string")), "NATION", "n_nationkey", {"n_name": "COUNTRY_NAME"})])
    return out.groupBy(F.concat(F.lit("P"), "l_partkey").alias("LINEAGE_NAME"), "VECTOR_SPECIES", "COUNTRY_NAME").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT DISTINCT LINEAGE_NAME, SPECIES_NAME FROM {v_hosts} WHERE SITE_NAME = 'S2' AND SPECIES_NAME <> '') SELECT l.LINEAGE_NAME, coalesce(q.SEQUENCE, '') AS SEQUENCE, coalesce(s.SPECIES_NAME, '') AS SPECIES_NAME FROM (SELECT LINEAGE_NAME FROM {v_lineages}) l LEFT JOIN (SELECT LINEAGE_NAME, max(SEQUENCE) AS SEQUENCE FROM {v_lin_curr} GROUP BY 1) q USING (LINEAGE_NAME) LEFT JOIN s USING (LINEAGE_NAME)""")
def export_lineages(spark, d):
    master, seqs, hosts = t(spark, d, "v_lineages", "v_lin_curr", "v_hosts")
    return editions.export_lineages(master.select("LINEAGE_NAME"), seqs.groupBy("LINEAGE_NAME").agg(F.max("SEQUENCE").alias("SEQUENCE")), hosts.filter("SITE_NAME = 'S2' and SPECIES_NAME <> ''").select("LINEAGE_NAME", "SPECIES_NAME"))


@query("""SELECT DISTINCT 'P' || l_partkey AS LINEAGE_NAME, coalesce(p_brand, '') AS GENUS_NAME, coalesce(p_name, '') AS SPECIES_NAME FROM {lineitem} LEFT JOIN (SELECT * FROM {part} WHERE p_partkey % 5 <> 0) ON l_partkey = p_partkey""")
def export_morpho(spark, d):
    links, part = t(spark, d, "lineitem", "part")
    out = editions.star(links, [(part.filter("p_partkey % 5 <> 0"), "l_partkey", "p_partkey", {"p_brand": "GENUS_NAME", "p_name": "SPECIES_NAME"})])
    return out.select(F.concat(F.lit("P"), "l_partkey").alias("LINEAGE_NAME"), "GENUS_NAME", "SPECIES_NAME").distinct()


@query("""SELECT REFERENCE_NAME, PUBLICATION_YEAR, coalesce(n_name, '') AS JOURNAL_NAME, coalesce(r_name, '') AS STUDY_TYPE FROM {v_references} LEFT JOIN {nation} ON PUBLICATION_YEAR % 20 = n_nationkey LEFT JOIN {region} ON PUBLICATION_YEAR % 7 = r_regionkey""")
def export_references(spark, d):
    references, nation, region = t(spark, d, "v_references", "nation", "region")
    rows = references.withColumn("_j", F.col("PUBLICATION_YEAR") % 20).withColumn("_t", F.col("PUBLICATION_YEAR") % 7)
    return editions.star(rows, [(nation, "_j", "n_nationkey", {"n_name": "JOURNAL_NAME"}), (region, "_t", "r_regionkey", {"r_name": "STUDY_TYPE"})]).drop("_j", "_t")


_ALT = "SELECT DISTINCT LINEAGE_NAME, trim(unnest(string_split(ALT_NAME, ','))) AS ALT_NAME, REFERENCE_NAME FROM {v_synonyms}"


@query(f"""SELECT * FROM ({_ALT}) a WHERE ALT_NAME <> '' AND EXISTS (SELECT 1 FROM {{v_hosts}} h WHERE h.LINEAGE_NAME = a.LINEAGE_NAME AND h.REFERENCE_NAME = a.REFERENCE_NAME)""")
def export_alt_names(spark, d):
    return editions.alt_names_table(*t(spark, d, "v_synonyms", "v_hosts"))


@query(f"SELECT * FROM ({_ALT}) WHERE ALT_NAME <> ''")
def lineage_names_table(spark, d):
    return editions.alt_names_table(t(spark, d, "v_synonyms"))


# ---- names ----


@query(f"""WITH n AS ({_NAMES}), a AS ({_ALT}) SELECT r.name AS old, min(a.LINEAGE_NAME) AS new FROM n r JOIN a ON a.ALT_NAME = r.name JOIN n p ON p.name = a.LINEAGE_NAME AND p.kind = 'added' WHERE r.kind = 'removed' GROUP BY 1 HAVING count(DISTINCT a.LINEAGE_NAME) = 1""")
def rename_detect(spark, d):
    names = editions.added_removed_names(*t(spark, d, "v_lin_prev", "v_lin_curr"), "LINEAGE_NAME")
    return claims.rename_detect(names.filter("kind = 'removed'"), names.filter("kind = 'added'"), editions.alt_names_table(t(spark, d, "v_synonyms")))


@query("""WITH i AS (SELECT *, 'sub' AS s FROM {v_lin_curr}), h AS (SELECT *, CASE WHEN length(GENBANK_ACC) % 2 = 0 THEN 'sub' ELSE 'seed' END AS s FROM {v_lin_prev})
SELECT i.LINEAGE_NAME AS name, CASE WHEN max(CASE WHEN i.SEQUENCE = h.SEQUENCE THEN 1 ELSE 0 END) = 1 THEN 'held with the same sequence' ELSE 'held with another sequence' END AS problem FROM i JOIN h ON i.LINEAGE_NAME = h.LINEAGE_NAME AND i.s <> h.s GROUP BY 1
UNION ALL SELECT LINEAGE_NAME, 'declared twice' FROM i GROUP BY 1 HAVING count(*) > 1""")
def name_collisions(spark, d):
    prev, curr = t(spark, d, "v_lin_prev", "v_lin_curr")
    store = prev.withColumn("_source", F.when(F.length("GENBANK_ACC") % 2 == 0, "sub").otherwise("seed"))
    return claims.name_collisions(store, curr.withColumn("_source", F.lit("sub")), "LINEAGE_NAME", "SEQUENCE", "_source")


@query("""WITH e AS (SELECT DISTINCT submission, name FROM {v_entries} WHERE state_no < 3) SELECT submission, name, n - 1 AS others FROM (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM e) WHERE n > 1""")
def names_held_elsewhere(spark, d):
    return claims.names_held_elsewhere(t(spark, d, "v_entries").filter("state_no < 3"))


@query("""WITH e AS (SELECT submission, CASE WHEN corrected <> '' THEN corrected ELSE name END AS name FROM {v_entries} WHERE state_no <> 4) SELECT name, min(submission) AS holder, count(DISTINCT submission) AS claims FROM e WHERE name NOT IN (SELECT LINEAGE_NAME FROM {v_lineages}) GROUP BY 1""")
def standing_claims(spark, d):
    entries, lineages = t(spark, d, "v_entries", "v_lineages")
    return claims.standing_claims(entries, lineages.select("LINEAGE_NAME"), entries.filter("state_no = 4").select("submission"))


@query("""WITH k AS (SELECT substr('ABC', 1 + CAST(p_partkey % 3 AS INT), 1) || 'X' AS stem, p_partkey AS n FROM {part}), h AS (SELECT stem, max(n) AS high FROM k GROUP BY 1), a AS (SELECT DISTINCT stem || n AS name, stem FROM k WHERE n % 17 = 0)
SELECT name, stem || (high + row_number() OVER (PARTITION BY stem ORDER BY name)) AS offer FROM a JOIN h USING (stem)""")
def name_suggestion(spark, d):
    part = t(spark, d, "part")
    names = part.select("p_partkey", F.concat(F.substring(F.lit("ABC"), 1 + (F.col("p_partkey") % 3).cast("int"), F.lit(1)), F.lit("X"), "p_partkey").alias("name"))
    return claims.name_suggestion(names.filter("p_partkey % 17 = 0"), names)


# ---- lookups ----


@query("""WITH r AS (SELECT DISTINCT LINEAGE_NAME, SPECIES_NAME, REFERENCE_NAME FROM {v_hosts}), s AS (SELECT DISTINCT LINEAGE_NAME, SPECIES_NAME, REFERENCE_NAME FROM {v_hosts} WHERE SITE_NAME <> 'S1')
SELECT r.LINEAGE_NAME, r.SPECIES_NAME, r.REFERENCE_NAME, count(s.REFERENCE_NAME) AS others, coalesce(array_to_string(list_sort(list(s.REFERENCE_NAME) FILTER (s.REFERENCE_NAME IS NOT NULL))[1:3], ', '), '') AS first
FROM r LEFT JOIN s ON r.LINEAGE_NAME = s.LINEAGE_NAME AND r.SPECIES_NAME = s.SPECIES_NAME AND r.REFERENCE_NAME <> s.REFERENCE_NAME GROUP BY 1, 2, 3""")
def pair_known(spark, d):
    hosts = t(spark, d, "v_hosts")
    return claims.pair_known(hosts, hosts.filter("SITE_NAME <> 'S1'"), ["LINEAGE_NAME", "SPECIES_NAME"], "REFERENCE_NAME")


@query("""WITH o AS (SELECT LINEAGE_NAME, min(GENUS_NAME) AS g FROM {v_lin_curr} WHERE GENUS_NAME = 'Newgenus' GROUP BY 1), s AS (SELECT LINEAGE_NAME, min(GENUS_NAME) AS g FROM {v_lin_prev} WHERE GENUS_NAME <> '' GROUP BY 1)
SELECT coalesce(o.g, s.g, '') AS genus, count(*) AS n FROM {v_hosts} h LEFT JOIN o USING (LINEAGE_NAME) LEFT JOIN s USING (LINEAGE_NAME) GROUP BY 1""")
def backfill_genus(spark, d):
    hosts, curr, prev = t(spark, d, "v_hosts", "v_lin_curr", "v_lin_prev")
    return claims.backfill_genus(hosts.select("LINEAGE_NAME"), curr.filter("GENUS_NAME = 'Newgenus'"), prev).groupBy("genus").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT 'S' || (s_suppkey % 7) AS SITE_NAME, s_suppkey AS line, CAST(s_suppkey % 200 AS BIGINT) AS lat, CAST(s_suppkey % 300 AS BIGINT) AS lon FROM {supplier}), f AS (SELECT SITE_NAME, arg_min(lat || ', ' || lon, line) AS c FROM s WHERE lat BETWEEN 50 AND 90 AND lon BETWEEN -180 AND 180 GROUP BY 1)
SELECT SITE_NAME, coalesce(c, '') AS coordinates, count(*) AS n FROM {v_hosts} LEFT JOIN f USING (SITE_NAME) GROUP BY ALL""")
def attach_coordinates(spark, d):
    hosts, supplier = t(spark, d, "v_hosts", "supplier")
    k = F.col("s_suppkey")
    sites = supplier.select(F.concat(F.lit("S"), k % 7).alias("SITE_NAME"), k.alias("line"), F.when(k % 200 < 50, 999).otherwise(k % 200).cast("long").alias("lat"), (k % 300).cast("long").alias("lon"))
    return claims.attach_coordinates(hosts.select("SITE_NAME"), sites).groupBy("SITE_NAME", "coordinates").agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT LINEAGE_NAME, REFERENCE_NAME, string_agg(ALT_NAME, ', ' ORDER BY ALT_NAME) AS a FROM (SELECT DISTINCT * FROM {v_synonyms}) GROUP BY 1, 2) SELECT h.LINEAGE_NAME, h.REFERENCE_NAME, coalesce(a, '') AS alt_names, count(*) AS n FROM {v_hosts} h LEFT JOIN n USING (LINEAGE_NAME, REFERENCE_NAME) GROUP BY ALL""")
def attach_alt_names(spark, d):
    hosts, names = t(spark, d, "v_hosts", "v_synonyms")
    out = claims.attach_alt_names(hosts.select("LINEAGE_NAME", "REFERENCE_NAME"), names.distinct().withColumn("line", F.col("ALT_NAME")))
    return out.groupBy("LINEAGE_NAME", "REFERENCE_NAME", "alt_names").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT DISTINCT GENUS_NAME AS v FROM {v_hosts}), b AS (SELECT DISTINCT 'G' || (o_custkey % 103) AS v FROM {orders}) SELECT v AS value, 'release only' AS side FROM a WHERE v NOT IN (SELECT v FROM b) UNION ALL SELECT v, 'key only' FROM b WHERE v NOT IN (SELECT v FROM a)""")
def key_vs_release(spark, d):
    hosts, orders = t(spark, d, "v_hosts", "orders")
    return claims.both_ways(hosts.select("GENUS_NAME"), orders.select(F.concat(F.lit("G"), F.col("o_custkey") % 103).alias("GENUS_NAME")), "GENUS_NAME", "release only", "key only")


@query("""SELECT DISTINCT COUNTRY_NAME FROM {v_hosts} WHERE COUNTRY_NAME NOT IN (SELECT n_name FROM {nation} WHERE n_nationkey % 3 <> 0) AND COUNTRY_NAME NOT IN (SELECT a.n_name FROM {nation} a JOIN {nation} b ON b.n_nationkey = a.n_nationkey + 1 AND b.n_nationkey % 3 <> 0 WHERE a.n_nationkey % 2 = 0)""")
def basemap_gap(spark, d):
    hosts, nation = t(spark, d, "v_hosts", "nation")
    shapes = nation.filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("admin"))
    target = nation.select((F.col("n_nationkey") - 1).alias("n_nationkey"), F.col("n_name").alias("admin"))
    aliases = nation.filter("n_nationkey % 2 = 0").join(target, "n_nationkey").select(F.col("n_name").alias("COUNTRY_NAME"), "admin")
    return claims.basemap_gap(hosts, shapes, aliases)


@query("""WITH r AS (SELECT c_mktsegment AS host, CAST(c_nationkey AS DOUBLE) + 0.0000001 AS lat, CAST(c_nationkey % 4 AS DOUBLE) AS lon, CASE WHEN c_custkey % 2 = 0 THEN 'HY' ELSE 'AHY' END AS age, CASE WHEN c_custkey % 3 = 0 THEN 'resident' ELSE 'migrant' END AS status FROM {customer}),
l AS (SELECT DISTINCT c_mktsegment AS host, CAST(c_nationkey AS DOUBLE) AS lat, CAST(c_nationkey % 4 AS DOUBLE) AS lon, 'code' || c_nationkey AS code FROM {customer} WHERE c_nationkey % 5 <> 0)
SELECT CASE WHEN age = 'HY' AND status <> 'resident' THEN coalesce(code, 'unknown') ELSE '' END AS range_code, count(*) AS n FROM r LEFT JOIN l ON r.host = l.host AND round(r.lat, 5) = l.lat AND r.lon = l.lon GROUP BY 1""")
def range_lookup_join(spark, d):
    c = t(spark, d, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = c.select(F.col("c_mktsegment").alias("host"), (n.cast("double") + 0.0000001).alias("lat"), (n % 4).cast("double").alias("lon"), F.when(k % 2 == 0, "HY").otherwise("AHY").alias("age"), F.when(k % 3 == 0, "resident").otherwise("migrant").alias("status"))
    lookup = c.filter("c_nationkey % 5 <> 0").select(F.col("c_mktsegment").alias("host"), n.cast("double").alias("lat"), (n % 4).cast("double").alias("lon"), F.concat(F.lit("code"), n).alias("code")).distinct()
    return claims.range_lookup_join(rows, lookup).groupBy("range_code").agg(F.count("*").alias("n"))


@query("""SELECT GENUS_NAME, CASE WHEN GENUS_NAME IN ('G1', 'G2') THEN 'M' || GENUS_NAME WHEN length(GENUS_NAME) = 2 THEN 'K' || GENUS_NAME ELSE GENUS_NAME END AS accepted, count(*) AS n FROM {v_hosts} GROUP BY ALL""")
def taxonomy_repair(spark, d):
    hosts = t(spark, d, "v_hosts").select("GENUS_NAME")
    names = hosts.distinct().select(F.col("GENUS_NAME").alias("name"))
    matcher = names.select("name", F.when(F.col("name").isin("G1", "G2"), F.concat(F.lit("M"), "name")).otherwise("").alias("accepted"))
    key = names.filter("length(name) = 2").select("name", F.concat(F.lit("K"), "name").alias("accepted"))
    return claims.taxonomy_repair(hosts, matcher, key, "GENUS_NAME").groupBy("GENUS_NAME", "accepted").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'already in table' WHEN p_size % 2 = 1 THEN 'curator' WHEN p_partkey % 3 = 0 THEN 'paper needed' ELSE 'add' END AS decision FROM {part}""")
def decide_candidate(spark, d):
    part = t(spark, d, "part")
    k = F.col("p_partkey")
    candidates = part.select(k.alias("id"), F.col("p_name").alias("lineage"), F.when(F.col("p_size") % 2 == 1, "near").otherwise("exact").alias("call"), F.when(k % 3 == 0, "").otherwise("10.1/x").alias("paper"))
    return claims.decide_candidate(candidates, part.filter(k % 4 == 0).select("p_partkey"))


@query("""SELECT 'kept' AS kind, count(*) AS n FROM {events} WHERE user_id NOT IN (3, 5, 7) UNION ALL SELECT 'unmatched', count(*) FROM (VALUES (3), (5), (7), (-1)) v(id) WHERE id NOT IN (SELECT user_id FROM {events})""")
def excluded_ids(spark, d):
    events = t(spark, d, "events")
    kept, unmatched = claims.excluded_ids(events, spark.sql("select cast(id as bigint) as id from values (3), (5), (7), (-1) as v(id)"), "user_id")
    return editions.counted({"kept": kept, "unmatched": unmatched}).withColumnRenamed("check", "kind")


@query("""SELECT p_brand, count(*) AS n FROM {part} WHERE NOT EXISTS (SELECT 1 FROM {part} e WHERE e.p_partkey <= 20 AND lower(e.p_brand) = lower(part.p_brand) AND lower(trim(e.p_name)) = lower(trim(part.p_name))) GROUP BY 1""".replace("FROM {part} WHERE NOT", "FROM {part} AS part WHERE NOT"))
def drop_example_rows(spark, d):
    part = t(spark, d, "part")
    examples = part.filter("p_partkey <= 20").select(F.upper("p_brand").alias("p_brand"), F.concat(F.lit(" "), "p_name").alias("p_name"))
    return claims.drop_example_rows(part, examples, ["p_brand", "p_name"]).groupBy("p_brand").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS epithet, p_type AS family FROM {part}) SELECT genus, array_to_string(list_sort(list(DISTINCT epithet)), ',') AS epithets, CASE WHEN count(DISTINCT family) = 1 THEN min(family) ELSE '' END AS family FROM r GROUP BY 1""")
def checklist_bird_names(spark, d):
    rows = t(spark, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("genus"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("epithet"), F.col("p_type").alias("family"))
    genera, family = claims.checklist_names(rows)
    return genera.join(family, "genus", "left").select("genus", F.array_join("epithets", ",").alias("epithets"), F.coalesce("family", F.lit("")).alias("family"))


@query("""WITH w AS (SELECT * FROM (VALUES ('R1'), ('R12'), ('nothing')) v(wanted)), r AS (SELECT wanted, REFERENCE_NAME, LINEAGE_NAME FROM w LEFT JOIN {v_hosts} ON contains(REFERENCE_NAME, wanted))
SELECT wanted, count(REFERENCE_NAME) AS records, count(DISTINCT LINEAGE_NAME) AS lineages, CASE WHEN count(DISTINCT REFERENCE_NAME) = 0 THEN 'empty' WHEN count(DISTINCT REFERENCE_NAME) > 1 THEN 'pooled' ELSE '' END AS warning FROM r GROUP BY 1""")
def truth_sets(spark, d):
    return claims.truth_sets(spark.sql("select * from values ('R1'), ('R12'), ('nothing') as v(wanted)"), t(spark, d, "v_hosts"))


# ---- small reports ----


@query("""SELECT CASE WHEN NUMBER_FOUND > 40 THEN 'high' WHEN NUMBER_FOUND > 20 THEN 'some' ELSE 'low' END AS class, count(*) AS n FROM {v_hosts} GROUP BY 1""")
def transmission_counts(spark, d):
    found = F.col("NUMBER_FOUND")
    return t(spark, d, "v_hosts").groupBy(F.when(found > 40, "high").when(found > 20, "some").otherwise("low").alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey AS project, count(*) AS runs, count(DISTINCT l_suppkey) AS samples, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS organisms FROM {lineitem} GROUP BY 1""")
def project_rollup(spark, d):
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("project")).agg(F.count("*").alias("runs"), F.count_distinct("l_suppkey").alias("samples"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("organisms"))


@query("SELECT p_partkey, p_name, p_size FROM {part} ORDER BY p_size DESC, p_name DESC, p_partkey LIMIT 25")
def newest_batch(spark, d):
    return t(spark, d, "part").orderBy(F.col("p_size").desc(), F.col("p_name").desc(), "p_partkey").select("p_partkey", "p_name", "p_size").limit(25)


@query("SELECT GENUS_NAME, count(*) AS n FROM {v_hosts} WHERE SPECIES_NAME = '' GROUP BY 1 ORDER BY n DESC, GENUS_NAME LIMIT 10")
def top_dropped(spark, d):
    return t(spark, d, "v_hosts").filter("SPECIES_NAME = ''").groupBy("GENUS_NAME").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "GENUS_NAME").limit(10)


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
