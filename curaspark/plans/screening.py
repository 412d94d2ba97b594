"""Queries of checks, seeds and windows, unknown tables and rules of the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.functions import sequences as S
from curaspark.operators import cells, checks, ledger, sequences, windows
from curaspark.operators.checks import Check
from curaspark.plans.relational import t
from curaspark.plans.views import oracle

QUERIES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(sql))
        return f

    return add


# ---- checks ----

CHECKS = [
    Check("host_binomial", lambda: ~F.col("SPECIES_NAME").contains(" "), applies=lambda: F.col("SPECIES_NAME") != "", needs=("SPECIES_NAME",)),
    Check("host_missing", lambda: F.col("SPECIES_NAME") == "", needs=("SPECIES_NAME",)),
    Check("prevalence_found_over_tested", lambda: F.col("NUMBER_FOUND") > F.col("NUMBER_TESTED"), blocking=True, needs=("NUMBER_FOUND", "NUMBER_TESTED")),
    Check("prevalence_negative", lambda: F.least("NUMBER_FOUND", "NUMBER_TESTED") < 0, blocking=True, needs=("NUMBER_FOUND", "NUMBER_TESTED")),
    Check("lineage_known", lambda: ~F.col("lineage_there"), needs=("lineage_there",)),
    Check("reference_missing", lambda: ~F.col("reference_there"), blocking=True, needs=("reference_there",)),
    Check("country_mapped", lambda: ~F.col("country_there"), applies=lambda: F.col("COUNTRY_NAME") != "", needs=("country_there",)),
    Check("pair_previously_recorded", lambda: ~F.col("pair_there"), applies=lambda: F.col("SPECIES_NAME") != "", needs=("pair_there",)),
    Check("record_without_country", lambda: F.col("COUNTRY_NAME") == "", blocking=True, needs=("COUNTRY_NAME",)),
    Check("site_coordinates_unreadable", lambda: F.col("SITE_COORDINATES") == "", needs=("SITE_COORDINATES",)),
]


def _screened(spark, d):
    hosts, lineages, references, regions = t(spark, d, "v_hosts", "v_lin_prev", "v_references", "v_region_map")
    batch = hosts.filter("l_orderkey % 3 = 0")
    store = hosts.filter("l_orderkey % 3 <> 0")
    return checks.looked_up(
        batch,
        {"lineage_there": (lineages, ["LINEAGE_NAME"]), "reference_there": (references, ["REFERENCE_NAME"]), "country_there": (regions, ["COUNTRY_NAME"]), "pair_there": (store, ["LINEAGE_NAME", "SPECIES_NAME"])},
    )


_BATCH = """b AS (SELECT *, LINEAGE_NAME || '/' || l_orderkey || '-' || l_linenumber AS id, LINEAGE_NAME IN (SELECT LINEAGE_NAME FROM {v_lin_prev}) AS lt, REFERENCE_NAME IN (SELECT REFERENCE_NAME FROM {v_references}) AS rt, COUNTRY_NAME IN (SELECT COUNTRY_NAME FROM {v_region_map}) AS ct,
  (LINEAGE_NAME, SPECIES_NAME) IN (SELECT (LINEAGE_NAME, SPECIES_NAME) FROM {v_hosts} WHERE l_orderkey % 3 <> 0) AS pt FROM {v_hosts} WHERE l_orderkey % 3 = 0)"""


@query(f"""WITH {_BATCH}, r AS (
SELECT 'host_binomial' AS "check", count(*) FILTER (SPECIES_NAME <> '') AS evaluated, count(*) FILTER (SPECIES_NAME <> '' AND NOT contains(SPECIES_NAME, ' ')) AS findings, false AS blocking, '' AS skipped FROM b
UNION ALL SELECT 'host_missing', count(*), count(*) FILTER (SPECIES_NAME = ''), false, '' FROM b UNION ALL SELECT 'prevalence_found_over_tested', count(*), count(*) FILTER (NUMBER_FOUND > NUMBER_TESTED), true, '' FROM b
UNION ALL SELECT 'prevalence_negative', count(*), count(*) FILTER (least(NUMBER_FOUND, NUMBER_TESTED) < 0), true, '' FROM b UNION ALL SELECT 'lineage_known', count(*), count(*) FILTER (NOT lt), false, '' FROM b
UNION ALL SELECT 'reference_missing', count(*), count(*) FILTER (NOT rt), true, '' FROM b UNION ALL SELECT 'country_mapped', count(*) FILTER (COUNTRY_NAME <> ''), count(*) FILTER (COUNTRY_NAME <> '' AND NOT ct), false, '' FROM b
UNION ALL SELECT 'pair_previously_recorded', count(*) FILTER (SPECIES_NAME <> ''), count(*) FILTER (SPECIES_NAME <> '' AND NOT pt), false, '' FROM b UNION ALL SELECT 'record_without_country', count(*), count(*) FILTER (COUNTRY_NAME = ''), true, '' FROM b
UNION ALL SELECT 'site_coordinates_unreadable', 0, 0, false, 'no SITE_COORDINATES')
SELECT "check", evaluated, evaluated - findings AS passed, findings, CASE WHEN skipped <> '' OR evaluated = 0 THEN 'not run' WHEN findings = 0 THEN 'passed' WHEN blocking THEN 'blocked' ELSE 'warned' END AS outcome, skipped FROM r""")
def check_results(spark, d):
    return checks.results(_screened(spark, d), CHECKS)


@query(f"""WITH {_BATCH} SELECT 'host_missing' AS "check", id AS row FROM b WHERE SPECIES_NAME = '' UNION ALL SELECT 'prevalence_found_over_tested', id FROM b WHERE NUMBER_FOUND > NUMBER_TESTED UNION ALL SELECT 'prevalence_negative', id FROM b WHERE least(NUMBER_FOUND, NUMBER_TESTED) < 0
UNION ALL SELECT 'lineage_known', id FROM b WHERE NOT lt UNION ALL SELECT 'reference_missing', id FROM b WHERE NOT rt UNION ALL SELECT 'country_mapped', id FROM b WHERE NOT ct UNION ALL SELECT 'pair_previously_recorded', id FROM b WHERE SPECIES_NAME <> '' AND NOT pt""")
def check_findings(spark, d):
    rows = _screened(spark, d).withColumn("id", F.concat("LINEAGE_NAME", F.lit("/"), "l_orderkey", F.lit("-"), "l_linenumber"))
    return checks.findings(rows, CHECKS, "id")


@query(f"""WITH {_BATCH} SELECT concat_ws(',', CASE WHEN count(*) FILTER (NUMBER_FOUND > NUMBER_TESTED) > 0 THEN 'prevalence_found_over_tested' END, CASE WHEN count(*) FILTER (least(NUMBER_FOUND, NUMBER_TESTED) < 0) > 0 THEN 'prevalence_negative' END, CASE WHEN count(*) FILTER (NOT rt) > 0 THEN 'reference_missing' END) AS blocking, true AS incomplete FROM b""")
def check_verdict(spark, d):
    return checks.verdict(checks.results(_screened(spark, d), CHECKS))


# ---- seeds and windows ----


@query("""SELECT 'V' || vec_id || '_0' AS query, CASE WHEN vec_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(vec_id % 20 AS BIGINT) AS "offset", CAST(29 AS BIGINT) AS votes FROM {embeddings}""")
def locate_window(spark, d):
    rows = t(spark, d, "v_sequences").filter("variant = 0")
    part = F.substring("seq", (1 + F.col("vec_id") % 20).cast("int"), F.lit(40))
    turned = F.translate(F.reverse(part), "ACGT", "TGCA")
    asked = rows.select("name", F.when(F.col("vec_id") % 2 == 0, part).otherwise(turned).alias("seq"))
    return windows.locate_window(asked, rows, 12).select("query", "strand", F.col("offset").cast("long").alias("offset"), "votes")


def _contigs(spark, d):
    rows = t(spark, d, "v_sequences").filter("variant = 0")
    return rows, rows.select("name", F.concat(F.repeat(F.lit("N"), 30 + (F.col("vec_id") % 9).cast("int")), "seq", F.repeat(F.lit("N"), 50), "seq").alias("seq"))


@query("""SELECT 'V' || vec_id || '_0' AS contig, CAST(20 + vec_id % 9 AS BIGINT) AS first, CAST(30 + vec_id % 9 + 74 AS BIGINT) AS last, CAST(41 AS BIGINT) AS hits FROM {embeddings}
UNION ALL SELECT 'V' || vec_id || '_0', 20 + vec_id % 9 + 114, 30 + vec_id % 9 + 114 + 74, 41 FROM {embeddings}""")
def kmer_windows(spark, d):
    references, contigs = _contigs(spark, d)
    out = windows.hit_windows(contigs, windows.informative_kmers(references, 24), 24, 10)
    return out.select("contig", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "hits")


@query("""SELECT 'V' || vec_id || '_0' AS contig, CAST(0 AS BIGINT) AS first, CAST(30 + vec_id % 9 + 114 + 124 AS BIGINT) AS last, CAST(82 AS BIGINT) AS hits FROM {embeddings}""")
def merge_hit_windows(spark, d):
    references, contigs = _contigs(spark, d)
    out = windows.hit_windows(contigs, windows.informative_kmers(references, 24), 24, 60)
    return out.select("contig", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "hits")


@query("""WITH h AS (SELECT l_orderkey AS contig, 'P' || l_partkey AS name, CAST(l_suppkey % 3 AS BIGINT) AS m, CAST(450 + l_quantity AS BIGINT) AS c FROM {lineitem}), e AS (SELECT *, m = 0 AND c >= 470 AS x FROM h)
SELECT contig, CASE WHEN count(*) FILTER (x) = 1 THEN 'exact' WHEN count(*) FILTER (x) > 1 THEN 'several' ELSE 'near' END AS call, coalesce(arg_min(name, (-c, name)) FILTER (x), arg_min(name, (m, -c, name))) AS name, CAST(greatest(count(*) FILTER (x) - 1, 0) AS BIGINT) AS rivals FROM e GROUP BY contig""")
def genome_call(spark, d):
    rows = t(spark, d, "lineitem")
    hits = rows.select(F.col("l_orderkey").alias("contig"), F.concat(F.lit("P"), "l_partkey").alias("name"), (F.col("l_suppkey") % 3).alias("mismatches"), (450 + F.col("l_quantity")).cast("long").alias("comparable"))
    return windows.genome_call(hits, 470)


@query("""SELECT p_partkey AS accession, CASE WHEN p_partkey % 9 = 0 THEN 'no barcode' WHEN p_size % 4 = 0 THEN 'agrees' ELSE 'another lineage' END AS verdict FROM {part}""")
def cytb_check(spark, d):
    part = t(spark, d, "part")
    k = F.col("p_partkey")
    found = part.filter(k % 9 != 0).select(k.alias("accession"), F.when(F.col("p_size") % 4 == 0, F.col("p_brand")).otherwise("other").alias("name"))
    return windows.cytb_check(part.select(k.alias("accession"), F.col("p_brand").alias("lineage")), found)


@query("""WITH s AS (SELECT name, seq, vec_id % 7 - 3 AS o, variant FROM {v_sequences}), l AS (SELECT name, length(replace(substr(seq, 1, CAST(greatest(-o, 0) AS INT)), '-', '')) AS lost_before, CASE WHEN o > 0 THEN length(replace(right(seq, o), '-', '')) ELSE 0 END AS lost_behind FROM s)
SELECT name, CAST(lost_before AS BIGINT) AS lost_before, CAST(lost_behind AS BIGINT) AS lost_behind FROM l WHERE lost_before + lost_behind > 0""")
def misframed(spark, d):
    rows = t(spark, d, "v_sequences").select("name", "seq", (F.col("vec_id") % 7 - 3).alias("offset"))
    return windows.misframed(rows, 64).select("name", F.col("lost_before").cast("long").alias("lost_before"), F.col("lost_behind").cast("long").alias("lost_behind"))


@query("""SELECT 'V' || vec_id || '_' || x AS a, 'V' || vec_id || '_' || y AS b, CAST(n AS BIGINT) AS comparable FROM {embeddings}, (VALUES (0, 1, 64), (0, 2, 48), (1, 2, 48), (0, 4, 48), (1, 4, 48), (2, 3, 48)) v(x, y, n)""")
def within_batch_identical(spark, d):
    return sequences.all_pairs_compatible(t(spark, d, "v_sequences"), "name", "seq", 64, min_shared=48).select("a", "b", "comparable")


@query("""WITH c AS (SELECT i - 1 AS position, substr(seq, i, 1) AS base, name, variant FROM {v_sequences}, range(1, 65) r(i)), p AS (SELECT position, base, count(*) AS n FROM c WHERE variant = 0 AND base <> '-' GROUP BY ALL), s AS (SELECT position, sum(n) AS total, count(*) AS kinds FROM p GROUP BY 1)
SELECT c.name, c.position, c.base, CASE WHEN coalesce(p.n, 0) = 0 AND kinds = 1 THEN 'changes an invariant site' WHEN coalesce(p.n, 0) = 0 THEN 'never seen' ELSE 'rare' END AS kind FROM c JOIN s USING (position) LEFT JOIN p ON p.position = c.position AND p.base = c.base WHERE variant = 3 AND c.base <> '-' AND (coalesce(p.n, 0) = 0 OR (p.n + 1) / (total + 4) < 0.2)""")
def unusual_bases(spark, d):
    rows = t(spark, d, "v_sequences")
    return windows.unusual_bases(rows.filter("variant = 3"), sequences.site_profile(rows.filter("variant = 0"), "seq"), 0.2)


# ---- tables of unknown layout ----

_CELLS = """cells AS (SELECT p_brand AS "table", p_partkey % 40 AS row, p_size % 6 AS col, CASE WHEN p_partkey % 40 = 3 THEN p_type || ' - ' || p_name ELSE '' || p_retailprice END AS text FROM {part})"""


def _cells(spark, d):
    part = t(spark, d, "part")
    text = F.when(F.col("p_partkey") % 40 == 3, F.concat("p_type", F.lit(" - "), "p_name")).otherwise(F.col("p_retailprice").cast("string"))
    return part.select(F.col("p_brand").alias("table"), (F.col("p_partkey") % 40).alias("row"), (F.col("p_size") % 6).alias("col"), text.alias("text"))


def _words(spark, d):
    part = t(spark, d, "part")
    first, second = (F.lower(F.split_part("p_name", F.lit(" "), F.lit(k))) for k in (1, 2))
    return part.select(F.concat(F.lit("f"), first).alias("field"), first.alias("word")).union(part.select(F.concat(F.lit("g"), second), second)).distinct()


_MAPPED = """w AS (SELECT DISTINCT 'f' || lower(split_part(p_name, ' ', 1)) AS field, lower(split_part(p_name, ' ', 1)) AS word FROM {part} UNION SELECT 'g' || lower(split_part(p_name, ' ', 2)), lower(split_part(p_name, ' ', 2)) FROM {part}),
x AS (SELECT DISTINCT text, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS f FROM cells),
m AS (SELECT text, arg_min(field, (instr(reverse(f), ' ' || reverse(word) || ' '), -length(word), field)) AS field FROM x JOIN w ON contains(f, ' ' || word || ' ') GROUP BY 1)"""


@query(f"""WITH {_CELLS}, {_MAPPED} SELECT "table", row, col, field, count(*) AS n FROM cells JOIN m USING (text) GROUP BY ALL""")
def header_map(spark, d):
    return cells.header_map(_cells(spark, d), _words(spark, d)).groupBy("table", "row", "col", "field").agg(F.count("*").alias("n"))


@query(f"""WITH {_CELLS}, {_MAPPED}, l AS (SELECT "table", row, count(*) FILTER (regexp_matches(text, '[A-Za-z]') AND NOT regexp_matches(text, '[0-9]')) AS labels FROM cells WHERE row < 15 GROUP BY ALL), f AS (SELECT "table", row, count(DISTINCT field) AS fields FROM cells JOIN m USING (text) WHERE row < 15 GROUP BY ALL)
SELECT "table", arg_max(row, (fields, labels, -row)) AS row, max(fields) AS fields FROM l JOIN f USING ("table", row) GROUP BY 1""")
def header_row(spark, d):
    rows = _cells(spark, d)
    return cells.header_row(rows, cells.header_map(rows, _words(spark, d)))


@query("""WITH c AS (SELECT l_returnflag AS "table", l_linenumber AS col, l_orderkey * 10 + l_linenumber AS row, CASE WHEN l_linenumber % 2 = 0 THEN l_shipmode ELSE '' || CAST(l_quantity AS INT) END AS text FROM (SELECT *, l_linestatus AS l_shipmode FROM {lineitem})),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "table", col ORDER BY row, text) AS i FROM c) WHERE i <= 60)
SELECT "table", col, 'number' AS field, round(avg(CASE WHEN regexp_matches(text, '^[0-9]+$') THEN 1.0 ELSE 0.0 END), 6) AS share, avg(CASE WHEN regexp_matches(text, '^[0-9]+$') THEN 1.0 ELSE 0.0 END) >= CASE WHEN col > 3 THEN 0.9 ELSE 0.3 END AS fits FROM f GROUP BY "table", col""")
def value_shape_fit(spark, d):
    rows = t(spark, d, "lineitem")
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    long = rows.select(F.col("l_returnflag").alias("table"), F.col("l_linenumber").alias("col"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), text.alias("text"))
    shapes = rows.select(F.col("l_returnflag").alias("table"), F.col("l_linenumber").alias("col")).distinct().select("*", F.lit("number").alias("field"), F.lit("^[0-9]+$").alias("pattern"), (F.col("col") > 3).alias("strict"))
    return cells.value_shape_fit(long, shapes)


@query("""SELECT 'o' AS "table", o_orderkey AS row, slot, field, CASE field WHEN 'study' THEN o_orderstatus WHEN 'host' THEN o_orderpriority || slot ELSE '' || (o_custkey + slot) END AS text FROM {orders}, (VALUES (1), (2)) s(slot), (VALUES ('study'), ('host'), ('count')) f(field)""")
def slot_unpivot(spark, d):
    o = t(spark, d, "orders")
    columns = [("study", None, F.col("o_orderstatus")), ("host", 1, F.concat("o_orderpriority", F.lit("1"))), ("count", 1, (F.col("o_custkey") + 1).cast("string")), ("host", 2, F.concat("o_orderpriority", F.lit("2"))), ("count", 2, (F.col("o_custkey") + 2).cast("string")), ("host", 3, F.lit("alone"))]
    long = o.select(F.lit("o").alias("table"), F.col("o_orderkey").alias("row"), F.posexplode(F.array(*[c for _, _, c in columns])).alias("col", "text"))
    headers = spark.createDataFrame([("o", k, field, slot) for k, (field, slot, _) in enumerate(columns)], "table string, col int, field string, slot int")
    return cells.slot_unpivot(long, headers).select("table", "row", "slot", "field", "text")


@query("""SELECT CASE WHEN p_partkey % 13 = 0 THEN 'documentation' WHEN p_partkey % 2 = 0 AND p_partkey % 3 = 0 AND p_partkey % 5 = 0 THEN 'record and vector' WHEN p_partkey % 2 = 0 AND p_partkey % 3 = 0 THEN 'record' WHEN p_partkey % 2 = 0 AND p_partkey % 5 = 0 THEN 'vector' WHEN p_partkey % 7 = 0 THEN 'accession only' ELSE 'incomplete' END AS route, count(*) AS n FROM {part} GROUP BY 1""")
def row_routing(spark, d):
    k = F.col("p_partkey")
    has = lambda m, text: F.when(k % m == 0, text).otherwise("")
    rows = t(spark, d, "part").select(F.col("p_brand").alias("table"), k.alias("row"), F.when(k % 13 == 0, "Example").otherwise(has(2, "P1")).alias("lineage"), has(3, "Parus major").alias("host"), has(5, "Culex").alias("vector"), has(7, "AB123456").alias("accession"))
    return cells.row_routing(rows, ["example", "note"]).groupBy("route").agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT doc_id, regexp_extract_all(text, '\\b([A-Z][a-z]+ [a-z]{{3,}})', 1) AS l FROM {documents}), n AS (SELECT DISTINCT doc_id AS doc, split_part(x, ' ', 1) AS genus, split_part(x, ' ', 2) AS epithet FROM (SELECT doc_id, unnest(l) AS x FROM m))
SELECT doc, genus, epithet, CASE WHEN genus = 'The' THEN 'host' ELSE 'vector' END AS kind FROM n WHERE genus IN ('The', 'And') AND epithet NOT IN ('and', 'the')""")
def mine_binomials(spark, d):
    genera = spark.sql("select * from values ('The', 'host'), ('And', 'vector') as v(genus, kind)")
    return cells.mine_binomials(t(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text"), genera, ["and", "the"])


@query("""SELECT doc_id AS doc, CAST(CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'of the') THEN 1 ELSE 0 END AS BIGINT) AS cues, CAST(doc_id % 2 AS BIGINT) AS citations, (contains(lower(text), 'license') OR contains(lower(text), 'of the')) AND doc_id % 2 = 1 AS pooled FROM {documents} WHERE text IS NOT NULL""")
def pooled_compilation(spark, d):
    docs = t(spark, d, "documents").filter("text is not null")
    cited = docs.select(F.col("doc_id").alias("doc"), F.when(F.col("doc_id") % 2 == 1, F.concat("text", F.lit(" (Smith et al., 2005)"))).otherwise(F.col("text")).alias("text"))
    return cells.pooled_compilation(cited, ["license", "of the"])


@query("""WITH k AS (SELECT DISTINCT p_name AS name FROM {part} WHERE p_size > 25), r AS (SELECT p_partkey AS id, p_name, p_type FROM {part}) SELECT id, min(x) AS name FROM (SELECT id, p_name AS x FROM r UNION ALL SELECT id, p_type FROM r) WHERE x IN (SELECT name FROM k) GROUP BY 1""")
def name_stated(spark, d):
    part = t(spark, d, "part")
    return cells.name_stated(part.withColumnRenamed("p_partkey", "id"), ["p_name", "p_type"], part.filter("p_size > 25").select("p_name"))


# ---- rules of the ledger ----


@query("""SELECT event_id AS id, CASE WHEN event_id % 7 = 6 THEN 'filed: unknown reviewer' WHEN user_id % 5 = 0 THEN 'refused: no such revision' WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'refused: an objection needs a text' WHEN event_type = 'purchase' AND event_id % 7 = user_id % 4 THEN 'refused: own revision' ELSE '' END AS reason,
NOT (event_id % 7 = 6 OR user_id % 5 = 0 OR (event_type = 'error' AND event_id % 2 = 0) OR (event_type = 'purchase' AND event_id % 7 = user_id % 4)) AS accepted FROM {events}""")
def verdict_rules(spark, d):
    v = t(spark, d, "v_ledger")
    verdicts = v.select(F.col("seq").alias("id"), "submission", "reviewer", F.lit(0).alias("revision"), "kind", F.when(F.col("seq") % 2 == 0, " ").otherwise("why").alias("text"))
    revisions = v.filter("submission % 5 <> 0").select("submission", F.lit(0).alias("revision"), (F.col("submission") % 4).alias("author")).distinct()
    return ledger.verdict_rules(verdicts, v.filter("reviewer <> 6").select("reviewer"), revisions)


@query("""WITH b AS (SELECT submission, max("at") AS bumped FROM {v_ledger} WHERE kind = 'received' GROUP BY 1) SELECT seq AS id, NOT (kind = 'approve' AND coalesce("at" < bumped, false)) AS standing FROM {v_ledger} LEFT JOIN b USING (submission)""")
def bump_revision(spark, d):
    v = t(spark, d, "v_ledger")
    return ledger.bump_revision(v.withColumnRenamed("seq", "id"), v.filter("kind = 'received'").select("submission", "at"))


@query("""SELECT submission, arg_max(reviewer, ("at", seq)) AS author FROM {v_ledger} GROUP BY 1""")
def revision_author(spark, d):
    return ledger.revision_author(t(spark, d, "v_ledger"))


@query("""WITH l AS (SELECT submission, arg_max(kind, ("at", seq)) AS kind, max("at") AS since FROM {v_ledger} GROUP BY 1)
SELECT submission, CASE WHEN kind = 'received' THEN 'received' WHEN kind = 'approve' AND since <= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR THEN 'accepted' WHEN kind IN ('approve', 'in_review', 'hold') THEN 'under review' ELSE 'closed' END AS public FROM l""")
def public_state(spark, d):
    last = t(spark, d, "v_ledger").groupBy("submission").agg(F.max_by("kind", F.struct("at", "seq")).alias("kind"), F.max("at").alias("since"))
    state = F.create_map(*[F.lit(x) for pair in ledger.LEADS_TO.items() for x in pair])
    return ledger.public_state(last.select("submission", F.element_at(state, F.col("kind")).alias("state"), "since"), F.lit("2024-01-31 00:00:00").cast("timestamp"), 72)


@query("""WITH a AS (SELECT submission, max(("at", seq)) FILTER (kind = 'approve') AS ap, max("at") FILTER (kind = 'approve') AS t, max(("at", seq)) FILTER (kind IN ('hold', 'retract')) AS ob FROM {v_ledger} GROUP BY 1)
SELECT submission FROM a WHERE ap IS NOT NULL AND (ob IS NULL OR ob < ap) AND t <= TIMESTAMP '2024-02-20 00:00:00' - INTERVAL 48 HOUR AND submission % 3 <> 0 AND submission % 7 <> 0""")
def notices_due(spark, d):
    v = t(spark, d, "v_ledger")
    return ledger.notices_due(v, F.lit("2024-02-20 00:00:00").cast("timestamp"), 48, v.filter("submission % 3 = 0").select("submission").distinct(), v.filter("submission % 7 = 0").select("submission").distinct())


@query("SELECT submission FROM {v_entries} WHERE state_no = 2 AND NOT embargoed")
def releasable(spark, d):
    return ledger.releasable(t(spark, d, "v_entries").withColumn("state", F.when(F.col("state_no") == 2, "approved").otherwise("open"))).select("submission")


@query("""SELECT submission, name || '-' || k AS correction, CASE WHEN (submission + k) % 3 = 0 THEN 'to apply' ELSE 'awaiting approval' END AS status FROM {v_entries}, (VALUES (0), (1)) v(k) WHERE (submission + k) % 2 = 0""")
def pending_corrections(spark, d):
    one = lambda k: F.struct(F.concat("name", F.lit(f"-{k}")).alias("name"), ((F.col("submission") + k) % 3 == 0).alias("approved"), ((F.col("submission") + k) % 2 != 0).alias("applied"))
    return ledger.pending_corrections(t(spark, d, "v_entries").select("submission", F.array(one(0), one(1)).alias("corrections")))


@query("""SELECT o_orderkey AS item, CASE WHEN o_orderstatus <> 'P' THEN 'to do' ELSE 'incomplete' END AS status FROM {orders} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM {lineitem} WHERE l_returnflag = 'R') AND o_orderkey % 11 <> 0""")
def pending_work_items(spark, d):
    orders, lineitem = t(spark, d, "orders", "lineitem")
    arrived = orders.select(F.col("o_orderkey").alias("item"), (F.col("o_orderstatus") != "P").alias("complete"))
    return ledger.pending_work(arrived, lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("item")), arrived.filter("item % 11 = 0"))


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}


# ---- candidates and figures ----

_CODE = "substr('FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(16 * (instr('TCAG', substr({0}, 1, 1)) - 1) + 4 * (instr('TCAG', substr({0}, 2, 1)) - 1) + instr('TCAG', substr({0}, 3, 1)) AS INT), 1)"


@query("""SELECT 'N' || vec_id || CASE variant WHEN 1 THEN 'a' ELSE 'b' END AS name, 'R' || (vec_id % 20) AS paper, CASE WHEN vec_id % 2 = 1 THEN 'no hit' WHEN variant = 1 THEN 'known' ELSE 'novel' END AS verdict,
CASE WHEN vec_id % 2 = 0 THEN 'V' || vec_id END AS lineage, CASE WHEN vec_id % 2 = 0 THEN CASE variant WHEN 1 THEN 1.0 ELSE 63 / 64.0 END END AS identity, CASE WHEN vec_id % 2 = 0 THEN CAST(64 AS BIGINT) END AS length FROM {v_sequences} WHERE variant IN (1, 3)""")
def novelty_vs_db(spark, d):
    """Whole copies and copies with one base changed, some of them reversed, against every second vector's sequence."""
    rows = t(spark, d, "v_sequences")
    store = rows.filter("variant = 0 and vec_id % 2 = 0").select(F.concat(F.lit("V"), "vec_id").alias("name"), "seq")
    name = F.concat(F.lit("N"), "vec_id", F.when(F.col("variant") == 1, "a").otherwise("b"))
    turned = F.when(F.col("vec_id") % 3 == 0, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    found = rows.filter("variant in (1, 3)").select(name.alias("name"), turned.alias("seq"), F.concat(F.lit("R"), F.col("vec_id") % 20).alias("paper"))
    return windows.novelty_vs_db(found, store, least=60)


@query(f"""WITH s AS (SELECT vec_id, variant, seq FROM {{v_sequences}}), p AS (SELECT a.vec_id, a.seq AS q, b.seq AS n, substr(a.seq, 10, 1) AS x, substr(b.seq, 10, 1) AS y FROM s a JOIN s b ON a.vec_id = b.vec_id AND a.variant = 3 AND b.variant = 0),
c AS (SELECT *, {_CODE.format("substr(q, 10, 3)")} AS now, {_CODE.format("substr(n, 10, 3)")} AS was FROM p), k AS (SELECT substr(seq, 10, 1) AS x, vec_id % 3 AS g FROM s WHERE variant = 0)
SELECT 'V' || vec_id || '_3' AS label, 10 AS position, 1 AS codon_position, x AS query_base, y AS nearest_base, CASE WHEN now <> was THEN 'nonsynonymous' WHEN x || y IN ('AG', 'GA', 'CT', 'TC') THEN 'transition' ELSE 'transversion' END AS kind,
CASE WHEN now <> was THEN was || '->' || now END AS amino_acid, (SELECT count(*) FROM k WHERE k.x = c.x) AS carrying, (SELECT count(*) FROM k) AS covering, (SELECT count(*) FROM k WHERE k.x = c.x AND g = 1) AS of_one FROM c""")
def column_changes(spark, d):
    """Sequences with one base changed beside the whole one (the nearest) and a part of it."""
    rows = t(spark, d, "v_sequences")
    near = rows.filter("variant in (0, 2)").select(F.concat(F.lit("V"), "vec_id", F.lit("_3")).alias("label"), (F.col("variant") + 1).alias("rank"), "name")
    genus = F.regexp_extract("name", "^V([0-9]+)_", 1).cast("long") % 3
    whole = rows.filter("variant = 0").select("name", "seq")
    figures = sequences.alignment_columns(rows.filter("variant = 3").select(F.col("name").alias("label"), "seq"), near.filter("rank = 1"), whole, 64, genus=genus.cast("string"))
    return figures.withColumn("of_one", F.coalesce(F.element_at("genera", F.lit("1")), F.lit(0))).drop("share", "rare", "genera")
