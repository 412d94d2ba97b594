"""Queries of the ingest, claim and review operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.operators import cdc, curation, ledger, sequences
from curaspark.plans.relational import _STORE, _WHOLE, _papers, _store_and_whole, t
from curaspark.plans.views import oracle

QUERIES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(sql))
        return f

    return add


@query("SELECT n_name AS nation, r_name AS region, c_mktsegment AS segment, count(*) AS n FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY ALL")
def taxonomy_flatten(spark, d):
    c, n, r = t(spark, d, "customer", "nation", "region")
    chain = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return chain.groupBy(F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))


@query("SELECT LINEAGE_NAME, count(*) AS n FROM {v_hosts} WHERE trim(SPECIES_NAME) = '' GROUP BY 1")
def live_rows(spark, d):
    return t(spark, d, "v_hosts").filter(F.coalesce(F.trim("SPECIES_NAME"), F.lit("")) == "").groupBy("LINEAGE_NAME").agg(F.count("*").alias("n"))


@query("SELECT REFERENCE_NAME FROM {v_references} WHERE PUBLICATION_YEAR <> 2005")
def published_refs(spark, d):
    return t(spark, d, "v_references").filter("PUBLICATION_YEAR <> 2005").select("REFERENCE_NAME")


@query("SELECT REFERENCE_NAME, count(*) AS n FROM {v_hosts} WHERE SITE_NAME IN ('S1', 'S4') GROUP BY 1")
def select_correction(spark, d):
    return t(spark, d, "v_hosts").filter(F.trim("SITE_NAME").isin("S1", "S4")).groupBy("REFERENCE_NAME").agg(F.count("*").alias("n"))


@query(f"""WITH s AS {_STORE}, b AS {_WHOLE}, f AS (SELECT GENUS_NAME, SPECIES_NAME, arg_min(FAMILY_NAME, (l_orderkey * 10 + l_linenumber, FAMILY_NAME)) AS v FROM s GROUP BY 1, 2), w AS (SELECT GENUS_NAME, arg_min(FAMILY_NAME, (l_orderkey * 10 + l_linenumber, FAMILY_NAME)) AS v FROM s GROUP BY 1)
SELECT b.GENUS_NAME, b.SPECIES_NAME, coalesce(f.v, w.v, '') AS family, count(*) AS n FROM b LEFT JOIN f ON f.GENUS_NAME = b.GENUS_NAME AND f.SPECIES_NAME = b.SPECIES_NAME LEFT JOIN w ON w.GENUS_NAME = b.GENUS_NAME GROUP BY ALL""")
def backfill_taxonomy(spark, d):
    store, rows = _store_and_whole(spark, d, "GENUS_NAME", "SPECIES_NAME", "FAMILY_NAME", "l_orderkey", "l_linenumber")
    store = store.withColumn("_row_no", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    out = curation.backfill(rows.select("GENUS_NAME", "SPECIES_NAME"), store, ["GENUS_NAME", "SPECIES_NAME"], ["GENUS_NAME"], "FAMILY_NAME", "_row_no", "family")
    return out.groupBy("GENUS_NAME", "SPECIES_NAME", "family").agg(F.count("*").alias("n"))


@query(f"""WITH s AS {_STORE}, b AS {_WHOLE}, f AS (SELECT COUNTRY_NAME, min(CONTINENT_NAME) AS v FROM s GROUP BY 1) SELECT b.COUNTRY_NAME, coalesce(f.v, '') AS continent, count(*) AS n FROM b LEFT JOIN f USING (COUNTRY_NAME) GROUP BY ALL""")
def backfill_continent(spark, d):
    store, rows = _store_and_whole(spark, d, "COUNTRY_NAME", "CONTINENT_NAME", "l_orderkey", "l_linenumber")
    store = store.withColumn("_row_no", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    out = curation.backfill(rows.select("COUNTRY_NAME"), store, ["COUNTRY_NAME"], ["COUNTRY_NAME"], "CONTINENT_NAME", "_row_no", "continent")
    return out.groupBy("COUNTRY_NAME", "continent").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT DISTINCT k, trim(x) AS acc FROM (SELECT k, unnest(string_split_regex(upper(acc), '[,;]')) AS x FROM {v_cells}) WHERE trim(x) <> ''), m AS (SELECT acc, min(k) AS lo, max(k) AS hi, count(DISTINCT k) AS n FROM a GROUP BY 1) SELECT acc, lo AS first_holder, n AS holders FROM m WHERE n > 1""")
def accession_conflict(spark, d):
    cells = t(spark, d, "v_cells").select("k", F.explode(F.split(F.upper("acc"), "[,;]")).alias("x")).select("k", F.trim("x").alias("acc")).filter("acc <> ''").distinct()
    return cells.groupBy("acc").agg(F.min("k").alias("first_holder"), F.count("*").alias("holders")).filter("holders > 1")


@query("""SELECT acc, max(k) AS holder FROM (SELECT k, trim(unnest(string_split_regex(upper(acc), '[,;]'))) AS acc FROM {v_cells}) WHERE regexp_matches(acc, '^[A-Z]{{2}}[0-9]{{6}}$') GROUP BY 1""")
def accession_map(spark, d):
    cells = t(spark, d, "v_cells").select("k", F.explode(F.split(F.upper("acc"), "[,;]")).alias("x")).select("k", F.trim("x").alias("acc"))
    return cells.filter(F.col("acc").rlike("^[A-Z]{2}[0-9]{6}$")).groupBy("acc").agg(F.max("k").alias("holder"))


@query("""SELECT LINEAGE_NAME AS name, arg_min(l_suppkey, (l_shipdate, l_orderkey, l_suppkey)) AS holder, count(DISTINCT l_suppkey) - 1 AS others FROM {v_hosts} GROUP BY 1""")
def earliest_claim(spark, d):
    claims = t(spark, d, "v_hosts").withColumnRenamed("LINEAGE_NAME", "name")
    return curation.earliest_claim(claims, "name", ["l_shipdate", "l_orderkey", "l_suppkey"], "l_suppkey")


@query("""SELECT 'P' || substr('ABCD', 1 + p_partkey % 4, 1) AS acronym, count(DISTINCT p_partkey) AS taken, max(p_partkey) + 1 AS next_free FROM {part} GROUP BY 1""")
def next_free_number(spark, d):
    names = t(spark, d, "part").select(F.concat(F.lit("P"), F.substring(F.lit("ABCD"), 1 + (F.col("p_partkey") % 4).cast("int"), F.lit(1)), "p_partkey").alias("name"))
    return curation.next_free_number(names, "name")


@query("""WITH o AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY submission ORDER BY "at", seq) THEN 1 ELSE 0 END AS n1 FROM {v_ledger}), r AS (SELECT submission, kind, sum(n1) OVER (PARTITION BY submission ORDER BY "at", seq ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT submission, CAST(run AS BIGINT) AS run, kind, count(*) AS n FROM r GROUP BY ALL""")
def chimera_runs(spark, d):
    return curation.runs(t(spark, d, "v_ledger"), ["submission"], ["at", "seq"], "kind")


@query("SELECT l_partkey AS query, arg_min(l_suppkey, (-l_quantity, l_extendedprice, l_suppkey)) AS best FROM {lineitem} GROUP BY 1")
def best_hit(spark, d):
    rows = t(spark, d, "lineitem").withColumnRenamed("l_partkey", "query")
    return curation.best_hit(rows, "query", [-F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_suppkey")], "l_suppkey")


@query("""WITH j AS (SELECT p_partkey AS key, p_name AS a1, p_brand AS a2, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN upper(p_name) ELSE 'x' END AS b1, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS b2, p_partkey % 5 = 0 AS blank FROM {part}),
l AS (SELECT key, 'p_name' AS "column", CASE WHEN blank THEN '' ELSE a1 END AS ours, b1 AS theirs FROM j UNION ALL SELECT key, 'p_brand', a2, b2 FROM j)
SELECT *, CASE WHEN theirs = '' THEN 'none' WHEN ours = '' THEN 'fill' WHEN lower(ours) = lower(theirs) THEN 'same' ELSE 'conflict' END AS verdict FROM l""")
def propose_fills(spark, d):
    part = t(spark, d, "part").withColumnRenamed("p_partkey", "key")
    k = F.col("key")
    ours = part.select("key", F.when(k % 5 == 0, "").otherwise(F.col("p_name")).alias("p_name"), "p_brand")
    theirs = part.select("key", F.when(k % 3 == 0, "").when(k % 3 == 1, F.upper("p_name")).otherwise("x").alias("p_name"), F.when(k % 4 == 0, "").otherwise(F.col("p_brand")).alias("p_brand"))
    return curation.propose_fills(ours, theirs, "key", ["p_name", "p_brand"])


@query("SELECT LINEAGE_NAME, SPECIES_NAME, array_to_string(list_sort(list(DISTINCT SITE_NAME)), ',') AS blocks, count(*) - 1 AS dropped FROM {v_hosts} GROUP BY 1, 2")
def dedup_rows(spark, d):
    return curation.dedup_rows(t(spark, d, "v_hosts"), ["LINEAGE_NAME", "SPECIES_NAME"], "SITE_NAME").withColumn("blocks", F.array_join("blocks", ","))


@query("""WITH a AS (SELECT submission, max(("at", seq)) FILTER (kind = 'approve') AS ap, max(("at", seq)) FILTER (kind <> 'approve') AS other FROM {v_ledger} GROUP BY 1),
i AS (SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'seed' WHEN l_orderkey % 9 = 1 THEN '' ELSE CAST(l_orderkey % 190 AS VARCHAR) END AS source, count(*) AS n_rows FROM {lineitem} GROUP BY 1)
SELECT source, n_rows, CASE WHEN source = 'seed' THEN 'exempt' WHEN source = '' THEN 'refused: no source' WHEN a.submission IS NULL THEN 'refused: not in the ledger' WHEN ap IS NOT NULL AND (other IS NULL OR ap > other) THEN 'publishing' ELSE 'refused: open' END AS verdict FROM i LEFT JOIN a ON source = CAST(a.submission AS VARCHAR)""")
def release_gate(spark, d):
    events, lineitem = t(spark, d, "v_ledger", "lineitem")
    last = events.groupBy("submission").agg(F.max_by("kind", F.struct("at", "seq")).alias("kind"))
    states = last.select("submission", F.when(F.col("kind") == "approve", "approved").otherwise("open").alias("state"))
    k = F.col("l_orderkey")
    source = F.when(k % 9 == 0, "seed").when(k % 9 == 1, "").otherwise((k % 190).cast("string"))
    return curation.release_gate(lineitem.groupBy(source.alias("source")).agg(F.count("*").alias("n_rows")), states, "seed")


@query("""SELECT 'V' || vec_id || '_' || q AS query, CASE WHEN q = 3 THEN 'none' ELSE 'ambiguous' END AS verdict, CASE WHEN q = 3 THEN '' ELSE 'V' || vec_id || '_0,V' || vec_id || '_1' END AS names FROM {embeddings}, (VALUES (2), (3), (4)) v(q)""")
def exact_resolve(spark, d):
    rows = t(spark, d, "v_sequences")
    out = curation.exact_resolve(rows.filter("variant >= 2").select("name", "seq"), rows.filter("variant < 2").select("name", "seq"), 64, least=40)
    return out.withColumn("names", F.array_join("names", ","))


@query("SELECT name, CAST(vec_id % 7 - 3 AS BIGINT) AS \"offset\", CAST(0 AS BIGINT) AS mismatches, CAST(CASE WHEN variant NOT IN (2, 4) THEN 64 - abs(vec_id % 7 - 3) WHEN variant = 2 THEN 48 - greatest(3 - vec_id % 7, 0) ELSE 48 - greatest(vec_id % 7 - 3, 0) END AS BIGINT) AS comparable FROM {v_sequences}")
def register_offset(spark, d):
    rows = t(spark, d, "v_sequences")
    k = (F.col("vec_id") % 7 - 3).cast("int")
    # the sequence as it would be cut out with k bases of the frame missing, or pasted with k foreign ones before it
    cut = rows.select("name", F.col("seq").alias("whole"), F.when(k >= 0, F.substring(F.col("seq"), k + 1, F.lit(64))).otherwise(F.concat(F.repeat(F.lit("N"), -k), F.substring(F.col("seq"), F.lit(1), 64 + k))).alias("seq"))
    return curation.register_offset(cut, "name", "seq", F.col("whole"), 4, 40)


@query("""WITH n AS (SELECT DISTINCT SPECIES_NAME AS name FROM {v_hosts} WHERE SPECIES_NAME <> ''), k AS (SELECT name FROM n WHERE CAST(replace(split_part(name, ' ', 1), 'G', '') AS INT) % 2 = 0),
r AS (SELECT name || CASE WHEN CAST(replace(split_part(name, ' ', 1), 'G', '') AS INT) % 3 = 0 THEN ' sub' ELSE '' END AS name FROM n), x AS (SELECT name, split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 2) AS two, CAST(replace(split_part(name, ' ', 1), 'G', '') AS INT) AS g, split_part(name, ' ', 2) AS e FROM r)
SELECT name, CASE WHEN name IN (SELECT name FROM k) THEN name WHEN two IN (SELECT name FROM k) THEN two WHEN g < 90 AND 'G' || (g + 1) || ' ' || e IN (SELECT name FROM k) THEN 'G' || (g + 1) || ' ' || e END AS canonical,
 CASE WHEN name IN (SELECT name FROM k) THEN 'exact' WHEN two IN (SELECT name FROM k) THEN 'trimmed' WHEN g < 90 AND 'G' || (g + 1) || ' ' || e IN (SELECT name FROM k) THEN 'genus synonym' ELSE 'unmatched' END AS rule FROM x""")
def canonical_host(spark, d):
    names = t(spark, d, "v_hosts").select(F.col("SPECIES_NAME").alias("name")).filter("name <> ''").distinct()
    genus = F.regexp_extract("name", "^G([0-9]+)", 1).cast("int")
    rows = names.select(F.concat("name", F.when(genus % 3 == 0, " sub").otherwise("")).alias("name"))
    synonyms = spark.range(97).filter("id < 90").select(F.concat(F.lit("G"), "id").alias("old"), F.concat(F.lit("G"), F.col("id") + 1).alias("new"))
    return curation.canonical_host(rows, names.filter(genus % 2 == 0), synonyms)


@query("""WITH v AS (SELECT DISTINCT lower(split_part(text, ' ', 2)) AS term FROM {benchmark} WHERE regexp_matches(lower(split_part(text, ' ', 2)), '^[a-z]+$')), w AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '[^\\p{{L}}0-9]+', ' ', 'g'), ' ')) AS term FROM {documents})
SELECT doc_id, term, count(*) AS n FROM w JOIN v USING (term) GROUP BY ALL""")
def mine_countries(spark, d):
    docs, bench = t(spark, d, "documents", "benchmark")
    words = bench.select(F.lower(F.get(F.split("text", " "), 1)).alias("term")).filter(F.col("term").rlike("^[a-z]+$"))
    return curation.mine_terms(docs, words, 1)


@query("""WITH s AS (SELECT * FROM {v_sequences} WHERE variant IN (0, 1, 2)), p AS (SELECT a.name AS a, b.name AS b, a.variant AS va, b.variant AS vb, a.vec_id FROM s a JOIN s b ON a.vec_id = b.vec_id AND a.name < b.name)
SELECT a, b, CASE WHEN vb = 2 THEN 'contained' ELSE 'duplicate' END AS rule, CASE WHEN vb = 2 THEN a WHEN vec_id % 2 = 0 THEN a ELSE b END AS target FROM p""")
def propose_merges(spark, d):
    rows = t(spark, d, "v_sequences").filter("variant in (0, 1, 2)")
    pairs = sequences.all_pairs_compatible(rows, "name", "seq", 64)
    profiles = rows.select(F.col("name").alias("LINEAGE_NAME"), F.when((F.col("vec_id") % 2 == 1) & (F.col("variant") == 1), 5).otherwise(1).alias("records"), F.lit(2000).alias("first_year"))
    return curation.propose_merges(pairs, profiles, 40, 2)


@query("""SELECT 'c' AS kind, CAST(COMMENT AS VARCHAR) AS value, count(*) AS n FROM {v_curr} GROUP BY ALL UNION ALL SELECT 's', SITE_NAME, count(*) FROM {v_curr} GROUP BY ALL""")
def verdict_tallies(spark, d):
    rows = t(spark, d, "v_curr")
    parts = [rows.groupBy(F.lit(k).alias("kind"), F.col(c).alias("value")).agg(F.count("*").alias("n")) for k, c in (("c", "COMMENT"), ("s", "SITE_NAME"))]
    return parts[0].union(parts[1])


@query("""WITH b AS (SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, count(*) AS n, min(COMMENT) AS c FROM {v_prev} GROUP BY 1, 2, 3, 4), a AS (SELECT LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME, count(*) AS n, min(COMMENT) AS c FROM {v_curr} GROUP BY 1, 2, 3, 4)
SELECT 'COMMENT' AS "column", b.c AS was, a.c AS now, count(*) AS n FROM a JOIN b USING (LINEAGE_NAME, SPECIES_NAME, SITE_NAME, REFERENCE_NAME) WHERE a.n = 1 AND b.n = 1 AND a.c <> b.c GROUP BY ALL""")
def grouped_changes(spark, d):
    prev, curr = t(spark, d, "v_prev", "v_curr")
    diff = cdc.diff_table(prev, curr, ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"], ["COMMENT"])
    return diff.filter("kind = 'modified'").groupBy("column", "was", "now").agg(F.count("*").alias("n"))


@query("SELECT 'S2' AS source, count(*) FILTER (SITE_NAME = 'S2') AS removed, count(*) FILTER (SITE_NAME <> 'S2') AS kept FROM {v_hosts}")
def retract(spark, d):
    gone = (F.col("SITE_NAME") == "S2").cast("long")
    return t(spark, d, "v_hosts").agg(F.sum(gone).alias("removed"), F.sum(1 - gone).alias("kept")).select(F.lit("S2").alias("source"), "removed", "kept")


@query("""SELECT 'unknown country' AS finding, count(*) AS n FROM {v_hosts} WHERE COUNTRY_NAME NOT IN (SELECT COUNTRY_NAME FROM {v_region_map}) UNION ALL SELECT 'uncited reference', count(*) FROM {v_references} WHERE REFERENCE_NAME NOT IN (SELECT REFERENCE_NAME FROM {v_hosts})
UNION ALL SELECT 'repeated lineage', count(*) FROM (SELECT LINEAGE_NAME FROM {v_lineages} GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'host without binomial', count(*) FROM {v_hosts} WHERE SPECIES_NAME = ''""")
def integrity_report(spark, d):
    hosts, refs, regions, lineages = t(spark, d, "v_hosts", "v_references", "v_region_map", "v_lineages")
    found = {
        "unknown country": hosts.join(regions, "COUNTRY_NAME", "left_anti"),
        "uncited reference": refs.join(hosts.select("REFERENCE_NAME"), "REFERENCE_NAME", "left_anti"),
        "repeated lineage": lineages.groupBy("LINEAGE_NAME").count().filter("count > 1"),
        "host without binomial": hosts.filter("SPECIES_NAME = ''"),
    }
    parts = None
    for name, df in found.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("finding"), "n")
        parts = row if parts is None else parts.union(row)
    return parts


@query("""WITH n AS (SELECT c.* FROM {v_curr} c WHERE NOT EXISTS (SELECT 1 FROM {v_prev} p WHERE p.LINEAGE_NAME = c.LINEAGE_NAME AND p.SPECIES_NAME = c.SPECIES_NAME AND p.SITE_NAME = c.SITE_NAME AND p.REFERENCE_NAME = c.REFERENCE_NAME))
SELECT 'no host' AS finding, count(*) AS n FROM n WHERE SPECIES_NAME = '' UNION ALL SELECT 'name shared by studies', count(*) FROM (SELECT LINEAGE_NAME FROM n GROUP BY 1 HAVING count(DISTINCT REFERENCE_NAME) > 1)""")
def things_to_look_at(spark, d):
    prev, curr = t(spark, d, "v_prev", "v_curr")
    new = curr.join(prev.select("LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"), ["LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME"], "left_anti")
    shared = new.groupBy("LINEAGE_NAME").agg(F.count_distinct("REFERENCE_NAME").alias("k")).filter("k > 1")
    return new.filter("SPECIES_NAME = ''").agg(F.count("*").alias("n")).select(F.lit("no host").alias("finding"), "n").union(shared.agg(F.count("*").alias("n")).select(F.lit("name shared by studies").alias("finding"), "n"))


@query("SELECT c_nationkey AS person, sum(c_acctbal > 0) AS consenting, min(c_custkey) AS first, arg_max(c_name, c_custkey) AS latest_name FROM {customer} GROUP BY 1")
def contributors(spark, d):
    return t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("person")).agg(F.sum((F.col("c_acctbal") > 0).cast("long")).alias("consenting"), F.min("c_custkey").alias("first"), F.max_by("c_name", "c_custkey").alias("latest_name"))


@query("""SELECT submission, count(*) AS events, count(DISTINCT reviewer) AS reviewers, count(*) FILTER (kind = 'hold') AS holds FROM {v_ledger} GROUP BY 1""")
def submission_facts(spark, d):
    return t(spark, d, "v_ledger").groupBy("submission").agg(F.count("*").alias("events"), F.count_distinct("reviewer").alias("reviewers"), F.sum((F.col("kind") == "hold").cast("long")).alias("holds"))


@query("""SELECT submission, count(*) AS n FROM {v_ledger} WHERE "at" >= (SELECT max("at") FROM {v_ledger}) - INTERVAL 7 DAY GROUP BY 1""")
def lookback_window(spark, d):
    events = t(spark, d, "v_ledger")
    last = events.agg(F.max("at").alias("_last"))
    return events.join(F.broadcast(last), F.col("at") >= F.col("_last") - F.expr("interval 7 days")).groupBy("submission").agg(F.count("*").alias("n"))


@query("""SELECT seq, submission FROM {v_ledger} WHERE seq % 3 <> 0 AND "at" < (SELECT max("at") FROM {v_ledger} WHERE seq % 3 = 0)""")
def exactly_once_apply(spark, d):
    """Responses not applied yet that are older than the newest applied one."""
    events = t(spark, d, "v_ledger")
    applied = events.filter("seq % 3 = 0")
    newest = applied.agg(F.max("at").alias("_newest"))
    return events.join(applied.select("seq"), "seq", "left_anti").join(F.broadcast(newest), F.col("at") < F.col("_newest")).select("seq", "submission")


@query("""WITH v AS (SELECT submission, reviewer, arg_max(kind, ("at", seq)) AS kind FROM {v_ledger} WHERE kind IN ('approve', 'hold') GROUP BY 1, 2), o AS (SELECT submission, reviewer FROM {v_ledger} WHERE kind = 'hold' GROUP BY 1, 2)
SELECT v.submission, v.reviewer, v.kind, o.reviewer IS NOT NULL AS objected_before FROM v LEFT JOIN o ON o.submission = v.submission AND o.reviewer = v.reviewer""")
def standing_positions(spark, d):
    events = t(spark, d, "v_ledger")
    objected = events.filter("kind = 'hold'").select("submission", "reviewer").distinct().withColumn("_o", F.lit(True))
    now = ledger.current_verdicts(events, ["approve", "hold"]).join(objected, ["submission", "reviewer"], "left")
    return now.select("submission", "reviewer", "kind", F.coalesce("_o", F.lit(False)).alias("objected_before"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN true ELSE false END AS declares FROM {documents}""")
def declared_accessions(spark, d):
    from curaspark.operators import mining

    papers = _papers(spark, d)
    found = mining.declared_accessions(papers).select("doc_id", (F.size("accessions") > 0).alias("_d"))
    return papers.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("_d", F.lit(False)).alias("declares"))


@query("""SELECT k, trim(x) AS part FROM (SELECT k, unnest(string_split_regex(acc, '[,;]')) AS x FROM {v_cells} WHERE len(string_split_regex(acc, '[,;]')) >= 2)""")
def coinfection_explode(spark, d):
    parts = F.split("acc", "[,;]")
    return t(spark, d, "v_cells").filter(F.size(parts) >= 2).select("k", F.explode(parts).alias("x")).select("k", F.trim("x").alias("part"))


@query("SELECT p_partkey AS k, 'L' || p_partkey AS v FROM {part}")
def lineage_prefix_strip(spark, d):
    return t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.regexp_replace(F.concat(F.lit("p_L"), "p_partkey"), "^[a-z]_", "").alias("v"))


@query("SELECT DISTINCT SPECIES_NAME AS name FROM {v_hosts} WHERE regexp_matches(SPECIES_NAME, '^[A-Z][0-9]+ s[0-9]+$')")
def vocabularies(spark, d):
    return t(spark, d, "v_hosts").select(F.col("SPECIES_NAME").alias("name")).filter(F.col("name").rlike("^[A-Z][0-9]+ s[0-9]+$")).distinct()


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}
