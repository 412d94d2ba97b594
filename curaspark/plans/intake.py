"""Queries of sources and sinks, by round trips over the given tables, and of whole batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.operators import cdc, claims, history, ingest, mining, quality
from curaspark.operators.shared import shared_folder
from curaspark.plans.relational import t
from curaspark.plans.views import oracle
from curaspark.sources import store as S
from curaspark.spec import SPECS

QUERIES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(sql))
        return f

    return add


# ---- whole batches ----


@query("""WITH i AS (SELECT vec_id, vec_id % 50 AS submission, CASE WHEN vec_id % 16 = 1 THEN 'V' || (vec_id - 1) || '_0' ELSE 'N' || vec_id END AS name FROM {embeddings}),
e AS (SELECT vec_id % 2 = 0 AS stored, * FROM i), bad AS (SELECT DISTINCT submission FROM e WHERE NOT stored AND vec_id % 16 = 1),
o AS (SELECT submission, name, CASE WHEN submission IN (SELECT submission FROM bad) THEN 'refused: name is held' WHEN NOT stored THEN 'new' WHEN vec_id % 4 = 0 THEN 'completes' ELSE 'known' END AS outcome, vec_id, stored FROM e)
SELECT submission, name, outcome, CASE WHEN outcome LIKE 'refused%' THEN NULL WHEN stored THEN 'V' || vec_id || '_0' ELSE name END AS as_name,
CASE WHEN outcome = 'new' THEN 'LIN-' || lpad(CAST(500 + row_number() OVER (PARTITION BY outcome ORDER BY submission, name) AS VARCHAR), 6, '0') END AS record_id FROM o""")
def ingest_batch(spark, d):
    rows = t(spark, d, "v_sequences")
    # what the store has of every fourth vector lacks its last bases
    held = rows.filter("vec_id % 2 = 0 and variant = case when vec_id % 4 = 0 then 4 else 0 end").select(F.concat(F.lit("V"), "vec_id", F.lit("_0")).alias("name"), "seq")
    name = F.when(F.col("vec_id") % 16 == 1, F.concat(F.lit("V"), F.col("vec_id") - 1, F.lit("_0"))).otherwise(F.concat(F.lit("N"), "vec_id"))
    incoming = rows.filter("variant = 1").select((F.col("vec_id") % 50).alias("submission"), name.alias("name"), "seq")
    return ingest.ingest_batch(held, incoming, 64, 40, "LIN", 500)


@query("""SELECT vec_id % 50 AS submission, 'N' || vec_id AS name, CASE WHEN vec_id % 2 = 0 THEN 'V' || vec_id || '_0' END AS as_name, vec_id % 4 = 0 AS completes FROM {embeddings}""")
def resolve_known(spark, d):
    rows = t(spark, d, "v_sequences")
    held = rows.filter("vec_id % 2 = 0 and variant = case when vec_id % 4 = 0 then 4 else 0 end").select(F.concat(F.lit("V"), "vec_id", F.lit("_0")).alias("name"), "seq")
    incoming = rows.filter("variant = 1").select((F.col("vec_id") % 50).alias("submission"), F.concat(F.lit("N"), "vec_id").alias("name"), "seq")
    return ingest.resolve_known(held, incoming, 64, 40).drop("seq")


# ---- round trips ----


@query("""SELECT CORRECTION_ID, OLD_VALUE, ROWS_CHANGED FROM (VALUES ('7', 'x', '3')) v(CORRECTION_ID, OLD_VALUE, ROWS_CHANGED)
UNION ALL SELECT '8', CASE WHEN count(*) = 0 THEN '' WHEN count(DISTINCT COUNTRY_NAME) = 1 THEN min(COUNTRY_NAME) ELSE '(various)' END, CAST(count(*) AS VARCHAR) FROM {v_hosts} WHERE SITE_NAME = 'S3' AND COUNTRY_NAME <> 'FRANCE'""")
def sink_correction_log(spark, d):
    hosts = t(spark, d, "v_hosts").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    log = spark.createDataFrame([("7", "x", "3")], "CORRECTION_ID string, OLD_VALUE string, ROWS_CHANGED string")
    folder = shared_folder(spark)
    S.append_correction(log, cdc.plan_correction(hosts, "id", {"SITE_NAME": "S3"}, "COUNTRY_NAME", "FRANCE"), {}).write.parquet(folder)
    return spark.read.parquet(folder)


@query("""SELECT 'hosts' AS "table", REFERENCE_NAME AS key, count(*) AS n FROM {v_hosts} GROUP BY 2 UNION ALL SELECT 'references', REFERENCE_NAME, 1 FROM {v_references}""")
def sink_downloads(spark, d):
    hosts, references = t(spark, d, "v_hosts", "v_references")
    folder = shared_folder(spark)
    archive = S.write_downloads({"hosts": hosts, "references": references, "summary": references}, folder, ("summary",))
    parts = [spark.read.option("header", True).csv(f"{folder}/{name}").groupBy("REFERENCE_NAME").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), F.col("REFERENCE_NAME").alias("key"), "n") for name in archive]
    return parts[0].union(parts[1])


@query("""SELECT n_name AS COUNTRY_NAME, r_name AS REGION FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 0""")
def scan_region_map(spark, d):
    nation, region = t(spark, d, "nation", "region")
    folder = shared_folder(spark)
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows.select(F.col("n_name").alias("COUNTRY_NAME"), F.when(F.col("n_nationkey") % 4 != 0, F.col("r_name")).alias("REGION")).write.option("header", True).csv(folder)
    return S.scan_region_map(spark, folder, [r.r_name for r in region.collect()])


@query("""SELECT n_name AS COUNTRY_NAME FROM {nation} WHERE n_nationkey % 4 = 0 OR n_nationkey % 7 = 0""")
def rows_needing_review(spark, d):
    rows = t(spark, d, "nation").select(F.col("n_name").alias("COUNTRY_NAME"), F.when(F.col("n_nationkey") % 4 == 0, "").otherwise("X").alias("REGION"), F.when(F.col("n_nationkey") % 7 == 0, "look").alias("REVIEW"))
    return S.rows_needing_review(rows).select("COUNTRY_NAME")


@query("""SELECT 'submission ' || o_custkey AS submission_id, 'P' || o_orderkey AS lineage_name, o_orderpriority AS host_species, count(*) AS n FROM {orders} WHERE o_custkey % 5 <> 0 GROUP BY ALL
UNION ALL SELECT DISTINCT 'submission ' || o_custkey, NULL, NULL, 1 FROM {orders} WHERE o_custkey % 5 = 0""")
def scan_submissions(spark, d):
    orders = t(spark, d, "orders")
    record = F.struct(F.concat(F.lit("P"), "o_orderkey").alias("lineage_name"), F.col("o_orderpriority").alias("host_species"), F.lit("X").alias("country"), F.lit(9).alias("number_tested"), F.lit(3).alias("number_found"))
    documents = orders.groupBy(F.concat(F.lit("submission "), "o_custkey").alias("submission_id"), (F.col("o_custkey") % 5 != 0).alias("_some")).agg(F.collect_list(record).alias("records"))
    folder = shared_folder(spark)
    documents.select("submission_id", F.lit("me").alias("submitter"), F.when(F.col("_some"), F.col("records")).alias("records")).write.json(folder)
    return S.submission_records(S.scan_submissions(spark, folder)).groupBy("submission_id", "lineage_name", "host_species").agg(F.count("*").alias("n"))


@query("""SELECT 'pages' AS source, CAST(page_id AS VARCHAR) AS id, url, NULL AS title FROM {pages} UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR), NULL, p_name FROM {part}""")
def scan_literature(spark, d):
    pages, part = t(spark, d, "pages", "part")
    return S.literature_hits({"pages": (pages, {"id": "page_id", "url": "url"}), "parts": (part, {"id": "p_partkey", "title": "p_name", "year": "p_size"})}).select("source", "id", "url", "title")


@query("""SELECT p_partkey AS id, p_brand AS brand, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS name, CASE WHEN p_size % 2 = 0 THEN '' || p_size ELSE '' END AS publications FROM {part}""")
def scan_xml_attributes(spark, d):
    part = t(spark, d, "part")
    tag = lambda name, v: F.concat(F.lit(f'<Attribute id="1" attribute_name="{name}" unit="-">'), v, F.lit("</Attribute>"))
    twice = F.concat(F.lit('<Publication id="'), F.col("p_size").cast("string"), F.lit('"/>'))
    xml = F.concat(F.lit("<BioSample>"), tag("brand", F.concat(F.lit(" "), "p_brand")), tag("name", F.when(F.col("p_size") % 3 == 0, "Not collected").otherwise(F.col("p_name"))), F.when(F.col("p_size") % 2 == 0, F.concat(twice, twice)).otherwise(""), F.lit("</BioSample>"))
    out = S.xml_attributes(part.select(F.col("p_partkey").alias("id"), xml.alias("xml")), "xml")
    return out.select("id", F.col("attributes")["brand"].alias("brand"), F.col("attributes")["name"].alias("name"), F.array_join("publications", ",").alias("publications"))


@query("""SELECT REFERENCE_NAME, '2026-03-01' AS stamp, 'vectors' AS missing FROM {v_references}""")
def scan_edition(spark, d):
    references = t(spark, d, "v_references")
    folder = shared_folder(spark)
    for stamp in ("2025-12-24", "2026-03-01"):
        references.write.option("header", True).csv(f"{folder}/references-{stamp}.csv")
        references.coalesce(1).write.option("header", True).csv(f"{folder}/files/{stamp}")
    stamps = spark.createDataFrame([(s,) for s in ("2025-12-24", "2026-03-01")], "s string").agg(F.max("s").alias("s")).first().s
    found, missing = S.scan_edition(spark, folder, stamps, ["references", "vectors"])
    return found["references"].select("REFERENCE_NAME", F.lit(stamps).alias("stamp"), F.lit(",".join(missing)).alias("missing"))


# ---- filters ----


@query("""SELECT doc_id FROM {documents} WHERE NOT (doc_id % 3 = 1 AND doc_id % 2 = 0)""")
def focal_rows(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.array(F.when(F.col("doc_id") % 2 == 0, "AB000001").otherwise("AB000002")).alias("accessions"))
    declared = rows.filter("doc_id % 3 = 1").select("doc_id", F.array(F.lit("AB000002")).alias("accessions"))
    return mining.classify_scope(rows, declared).filter("coalesce(scope, 'unknown') <> 'reprinted'").select("doc_id")


@query("""WITH s AS (SELECT LINEAGE_NAME, SPECIES_NAME FROM {v_hosts} WHERE l_orderkey % 3 <> 0) SELECT LINEAGE_NAME, REFERENCE_NAME, count(*) AS n FROM {v_hosts} WHERE l_orderkey % 3 = 0 AND (SPECIES_NAME = '' OR COUNTRY_NAME = '' OR LINEAGE_NAME = '') GROUP BY ALL""")
def rows_in_tier(spark, d):
    hosts = t(spark, d, "v_hosts")
    flagged = quality.row_flags(hosts.filter("l_orderkey % 3 = 0"), hosts.filter("l_orderkey % 3 <> 0"))
    return flagged.filter("tier = 'incomplete'").groupBy("LINEAGE_NAME", "REFERENCE_NAME").agg(F.count("*").alias("n"))


# ---- more names and histories ----


@query("""SELECT 'A' || p_size AS accession, count(*) AS rows FROM {part} WHERE p_partkey % 3 = 0 AND 'A' || p_size IN (SELECT GENBANK_ACC FROM {v_lin_curr}) GROUP BY 1""")
def accession_collision(spark, d):
    part, lineages = t(spark, d, "part", "v_lin_curr")
    return claims.accession_collision(part.filter("p_partkey % 3 = 0").select(F.concat(F.lit("A"), "p_size").alias("GENBANK_ACC")), lineages, "GENBANK_ACC")


@query("""WITH l AS (SELECT submission, arg_max(kind, ("at", kind)) AS prior FROM {v_ledger} WHERE kind IN ('approve', 'hold') GROUP BY 1) SELECT submission, coalesce(prior, '') AS prior, count(*) AS n FROM {v_entries} LEFT JOIN l USING (submission) GROUP BY ALL""")
def prior_decisions(spark, d):
    entries, events = t(spark, d, "v_entries", "v_ledger")
    decided = events.filter("kind in ('approve', 'hold')").select("submission", F.col("kind").alias("decision"), "at")
    return claims.prior_decisions(entries.select("submission"), decided, "submission").groupBy("submission", "prior").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN vec_id % 3 = 0 THEN 'V' || vec_id || '_0' ELSE 'X' || vec_id END AS printed, 'V' || vec_id || '_0' AS name FROM {embeddings}""")
def resolve_rows(spark, d):
    rows = t(spark, d, "v_sequences").filter("variant = 0")
    printed = F.when(F.col("vec_id") % 3 == 0, F.col("name")).otherwise(F.concat(F.lit("X"), "vec_id"))
    # equal sequences of two vectors resolve to either name
    out = claims.resolve_rows(rows.select(printed.alias("name"), F.concat("seq", F.lit("-"), "vec_id").alias("seq")), rows.select("name"), rows.select("name", F.concat("seq", F.lit("-"), "vec_id").alias("seq")))
    return out.select("printed", "name")


@query("""SELECT 'P' || p_partkey AS lineage, CASE WHEN p_size % 2 = 0 THEN 'Morphology seen' ELSE 'many gametocytes' END AS comment FROM {part} WHERE p_size % 4 <> 3 AND 'P' || p_partkey NOT IN (SELECT LINEAGE_NAME FROM {v_hosts} WHERE SITE_NAME = 'S1')""")
def morphology_comment(spark, d):
    part, hosts = t(spark, d, "part", "v_hosts")
    comment = F.when(F.col("p_size") % 4 == 3, "nothing").when(F.col("p_size") % 2 == 0, "Morphology seen").otherwise("many gametocytes")
    rows = part.select(F.concat(F.lit("P"), "p_partkey").alias("LINEAGE_NAME"), comment.alias("COMMENT"), F.lit(1).alias("line"))
    return claims.morphology_comment(rows, hosts.filter("SITE_NAME = 'S1'"))


@query("""SELECT DISTINCT trim(text) AS value FROM {conversations} WHERE length(trim(text)) >= 12 AND trim(text) NOT IN (SELECT trim(text) FROM {conversations} WHERE conv_id % 2 = 0)""")
def forbidden_values(spark, d):
    turns = t(spark, d, "conversations")
    return claims.forbidden_values(turns.select("text"), turns.filter("conv_id % 2 = 0").select("text"))


@query("""SELECT SITE_NAME, count(*) AS n FROM {v_hosts} GROUP BY 1""")
def leak_guard(spark, d):
    return claims.leak_guard(t(spark, d, "v_hosts"), "SPECIES_NAME").groupBy("SITE_NAME").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS query, 'P' || l_partkey AS name, CAST(l_quantity AS BIGINT) AS comparable FROM {lineitem}), r AS (SELECT *, rank() OVER (PARTITION BY query ORDER BY comparable DESC) AS rank FROM p)
SELECT query, rank, name, comparable, count(*) OVER (PARTITION BY query, rank) > 1 AS tied FROM r""")
def best_overlap(spark, d):
    pairs = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.concat(F.lit("P"), "l_partkey").alias("name"), F.col("l_quantity").cast("long").alias("comparable")).distinct()
    return claims.best_overlap(pairs)


@query("""WITH s AS (SELECT GENUS_NAME AS host, SITE_NAME AS site, list(DISTINCT CASE l_linenumber % 5 WHEN 0 THEN 'resident' WHEN 1 THEN 'breeding' WHEN 2 THEN 'non-breeding' WHEN 3 THEN 'passage' END) FILTER (l_linenumber % 5 < 4) AS z FROM {v_hosts} WHERE NUMBER_FOUND > 45 GROUP BY ALL)
SELECT host, site, CASE WHEN z IS NULL THEN 'outside' WHEN list_contains(z, 'resident') OR (list_contains(z, 'breeding') AND list_contains(z, 'non-breeding')) THEN 'mixed' WHEN list_contains(z, 'breeding') THEN 'breeding' WHEN list_contains(z, 'non-breeding') THEN 'non-breeding' ELSE 'uncertain' END AS verdict FROM s""")
def range_verdict(spark, d):
    k = F.col("l_linenumber") % 5
    season = F.when(k == 0, "resident").when(k == 1, "breeding").when(k == 2, "non-breeding").when(k == 3, "passage")
    return claims.range_verdict(t(spark, d, "v_hosts").filter("NUMBER_FOUND > 45").select(F.col("GENUS_NAME").alias("host"), F.col("SITE_NAME").alias("site"), season.alias("season")))


@query("""WITH t AS (SELECT 'P' || p_partkey AS name, 'noted' AS event, 'note ' || p_size AS reason FROM {part} WHERE p_partkey % 13 = 0 UNION ALL SELECT 'P' || p_partkey, 'removed', 'marked as deleted' FROM {part} WHERE p_partkey % 17 = 0)
SELECT * FROM t UNION ALL SELECT DISTINCT LINEAGE_NAME, 'vanished', 'in no later edition' FROM {v_lin_prev} WHERE LINEAGE_NAME NOT IN (SELECT name FROM t) AND LINEAGE_NAME NOT IN (SELECT LINEAGE_NAME FROM {v_lin_curr})""")
def history_seed(spark, d):
    part, prev, curr = t(spark, d, "part", "v_lin_prev", "v_lin_curr")
    name = F.concat(F.lit("P"), "p_partkey").alias("name")
    notes = part.select(name, F.when(F.col("p_partkey") % 13 == 0, F.concat(F.lit("note "), "p_size")).otherwise("").alias("reason"))
    named = lambda df: df.select(F.col("LINEAGE_NAME").alias("name"))
    return history.history_seed(notes, part.filter("p_partkey % 17 = 0").select(name), named(prev), named(curr))


@query("""WITH RECURSIVE d AS (SELECT DISTINCT OLD_NAME AS name, CASE WHEN NEW_NAME = '' THEN 'remove' ELSE 'merge' END AS kind, NEW_NAME AS target FROM {v_chain}),
r AS (SELECT name, target AS current, 1 AS hops FROM d WHERE kind = 'merge' UNION ALL SELECT r.name, d.target, r.hops + 1 FROM r JOIN d ON d.name = r.current AND d.kind = 'merge'), l AS (SELECT name, arg_max(current, hops) AS last, max(hops) AS hops FROM r GROUP BY 1)
SELECT d.name, kind, CASE WHEN kind = 'merge' THEN last ELSE target END AS target, CAST(coalesce(hops, 0) AS BIGINT) AS depth, CASE WHEN kind = 'merge' AND target NOT IN (SELECT LINEAGE_NAME FROM {v_lineages}) THEN 'unknown target' ELSE '' END AS problem FROM d LEFT JOIN l USING (name)""")
def decisions_to_events(spark, d):
    chain, lineages = t(spark, d, "v_chain", "v_lineages")
    decisions = chain.select(F.col("OLD_NAME").alias("name"), F.when(F.col("NEW_NAME") == "", "remove").otherwise("merge").alias("kind"), F.col("NEW_NAME").alias("target"))
    return history.decisions_to_events(decisions, lineages.select(F.col("LINEAGE_NAME").alias("name")))


# ---- stores and releases by round trip ----


@query("""SELECT 'references' AS "table", REFERENCE_NAME AS key, CAST(PUBLICATION_YEAR AS VARCHAR) AS value FROM {v_references} UNION ALL SELECT 'lineages', LINEAGE_NAME, GENUS_NAME FROM {v_lineages}""")
def sink_store(spark, d):
    folder = shared_folder(spark)
    S.write_store(_small_store(spark, d), folder)
    S.write_store(_small_store(spark, d), folder)
    found = S.scan_store(spark, folder)
    return found["references"].select(F.lit("references").alias("table"), F.col("REFERENCE_NAME").alias("key"), F.col("PUBLICATION_YEAR").alias("value")).union(found["lineages"].select(F.lit("lineages"), "LINEAGE_NAME", "GENUS_NAME"))


@query("""SELECT LINEAGE_NAME, GENUS_NAME, SPECIES_NAME FROM {v_lineages}""")
def sink_release(spark, d):
    folder = shared_folder(spark)
    S.write_release({"lineages": _small_store(spark, d)["lineages"]}, folder)
    return S.scan_release(spark, f"{folder}/lineages", SPECS["lineages"]).select("LINEAGE_NAME", "GENUS_NAME", "SPECIES_NAME")


@query("""SELECT name AS label, seq AS sequence FROM (SELECT 'P_' || LINEAGE_NAME || '_' || GENUS_NAME || '_' || split_part(SPECIES_NAME, ' ', 2) AS name, SEQUENCE AS seq FROM {v_lin_curr} WHERE SEQUENCE <> '')""")
def sink_fasta(spark, d):
    folder = shared_folder(spark)
    lineages = t(spark, d, "v_lin_curr").withColumn("SPECIES_NAME", F.concat_ws(" ", F.lit("x"), F.split_part("SPECIES_NAME", F.lit(" "), F.lit(2))))
    S.to_fasta(lineages).write.text(folder)
    return S.scan_fasta(spark, folder).select(F.col("name").alias("label"), "sequence")


def _small_store(spark, d):
    lineages, references = t(spark, d, "v_lineages", "v_references")

    def fitted(df, name):
        spec = SPECS[name]
        columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in spec.columns]
        return df.select(F.xxhash64(*df.columns).cast("string").alias("RECORD_ID"), *columns, F.lit("seed").alias("_source"), F.lit("2026").alias("_added"))

    return {"lineages": fitted(lineages, "lineages"), "references": fitted(references, "references")}


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
