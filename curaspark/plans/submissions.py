"""Queries of whole submissions: all checks of all sheets, their findings, and the verdicts of sequences behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.operators import curation, history, ledger, sequences, store_rows, submissions, synonymy
from curaspark.plans import scalars
from curaspark.plans.relational import t
from curaspark.plans.views import oracle

QUERIES: dict = {}


def query(text: str):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(text))
        return f

    return add


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items()}


def _ready(spark, d):
    records, cells, vectors, hosts, refs = t(spark, d, "v_sheet_records", "v_sheet_cells", "v_vectors", "v_hosts", "v_references")

    def sheet(rows: str | None = None, **columns: str):
        return (cells.filter(rows) if rows else cells).select(F.col("id").alias("row"), *[F.col(c).alias(n) for n, c in columns.items()])

    sheets = {
        "records": records.withColumnRenamed("id", "row"),
        "vectors": vectors.withColumn("row", F.concat_ws("/", "LINEAGE_NAME", "VECTOR_SPECIES", "REFERENCE_NAME")),
        "names": sheet(LINEAGE_NAME="name", HOST_SPECIES="host", PARASITE_GENUS="genus", ACCESSION="acc"),
        "sequences": sheet("k % 4 <> 0", LINEAGE_NAME="name", SEQUENCE="seq"),
        "accessions": sheet(LINEAGE_NAME="name", ACCESSION="one_acc"),
        "genomes": sheet(LINEAGE_NAME="name", RESOURCE_TYPE="kind", ACCESSION="acc"),
        "morphospecies": sheet(LINEAGE_NAME="name", BINOMIAL="genus"),
        "sites": sheet(LATITUDE="coord", LONGITUDE="coord"),
        "references": sheet(document="document", REFERENCE_NAME="ref"),
        "changes": cells.select(F.col("id").alias("row"), F.col("words").alias("WAS"), F.trim("words").alias("NOW")),
        "headers": sheet(FOUND_BY="found_by"),
    }
    filed = F.when(F.col("k") % 24 == 0, F.col("name")).otherwise(F.concat(F.lit("Q"), "k"))
    store = {
        "lineages": cells.filter("k % 5 = 0").select(filed.alias("LINEAGE_NAME"), "k", F.col("one_acc").alias("ACCESSION")).drop("k"),
        "hosts": hosts.filter(F.col("l_shipdate") < F.lit("1998-06-01 00:00:00").cast("timestamp")),
        "vectors": t(spark, d, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_name").alias("VECTOR_SPECIES")),
        "references": refs.union(cells.filter("k % 10 = 1").select("ref", F.lit(0))),
        "claimed": cells.filter("k % 6 = 3").select(F.col("name").alias("LINEAGE_NAME")),
        "available": cells.filter("k % 18 = 0").select(F.col("one_acc").alias("ACCESSION")),
    }
    return submissions.prepared(sheets, store)


_C4 = "list_filter(range(0, CAST(length(cs) // 3 AS BIGINT)), lambda i: substr(cs, CAST(3 * i + 1 AS BIGINT), 3) IN ('TAA', 'TAG'))"
# A row for each row of a sheet and check that looks at it: sheet, check, row, whether it blocks, whether it is a finding.
_TOLD = f"""WITH rec AS (SELECT *, upper(SPECIES_NAME) AS sp FROM {{v_sheet_records}}), cel AS (SELECT *, {scalars._REF} AS r, regexp_replace(upper(seq), '[^A-Z.~-]', '', 'g') AS cs, {scalars._LAT} AS lat FROM {{v_sheet_cells}}),
held AS (SELECT CASE WHEN k % 24 = 0 THEN name ELSE 'Q' || k END AS name, upper(replace(one_acc, '.1', '')) AS acc FROM cel WHERE k % 5 = 0),
old AS (SELECT upper(SPECIES_NAME) AS sp, COUNTRY_NAME FROM {{v_hosts}} WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00'),
dox AS (SELECT document, sum(n) AS n, sum(u) AS u, sum(f) AS f FROM (SELECT document, 1 AS n, CASE WHEN LINEAGE_NAME = '' THEN 1 ELSE 0 END AS u, 0 AS f FROM rec UNION ALL SELECT document, 0, 0, CASE WHEN r <> '' THEN 1 ELSE 0 END FROM cel) GROUP BY 1),
seqs AS (SELECT *, name IN (SELECT name FROM held) AS h, name IN (SELECT name FROM cel WHERE k % 4 <> 0) AS q FROM cel),
told AS (
SELECT 'documents' AS sheet, 'records_unlinked' AS c, document AS id, false AS b, u > 0 AS hit FROM dox WHERE n > 0
UNION ALL SELECT 'documents', 'reference_missing', document, true, f = 0 FROM dox
UNION ALL SELECT 'records', 'prevalence_sanity', id, true, coalesce(NUMBER_FOUND < 0, false) OR coalesce(NUMBER_TESTED < 0, false) OR coalesce(NUMBER_FOUND > NUMBER_TESTED, false) FROM rec
UNION ALL SELECT 'records', 'prevalence_numerator_alone', id, false, NUMBER_TESTED IS NULL FROM rec WHERE NUMBER_FOUND IS NOT NULL
UNION ALL SELECT 'records', 'lineage_known', id, false, LINEAGE_NAME NOT IN (SELECT name FROM held) FROM rec WHERE LINEAGE_NAME <> ''
UNION ALL SELECT 'records', 'host_binomial', id, false, sp NOT IN (SELECT sp FROM old) FROM rec WHERE sp <> ''
UNION ALL SELECT 'records', 'new_country', id, false, COUNTRY_NAME NOT IN (SELECT COUNTRY_NAME FROM old) FROM rec WHERE COUNTRY_NAME <> ''
UNION ALL SELECT 'records', 'record_without_country', id, false, COUNTRY_NAME = '' FROM rec
UNION ALL SELECT 'records', 'record_without_prevalence', id, false, NUMBER_FOUND IS NULL OR NUMBER_TESTED IS NULL FROM rec
UNION ALL SELECT 'records', 'comment_mentions_morphology', id, false, COMMENT LIKE 'Gametocyte%' FROM rec WHERE COMMENT <> ''
UNION ALL SELECT 'vectors', 'vector_sanity', LINEAGE_NAME || '/' || VECTOR_SPECIES || '/' || REFERENCE_NAME, false, VECTOR_SPECIES NOT IN (SELECT s_name FROM {{supplier}} WHERE s_suppkey % 3 = 0) FROM {{v_vectors}}
UNION ALL SELECT 'names', 'name_malformed', id, false, k % 3 <> 0 FROM cel
UNION ALL SELECT 'names', 'name_already_in_store', id, false, h FROM seqs
UNION ALL SELECT 'names', 'name_claimed_by_another_submission', id, false, name IN (SELECT name FROM cel WHERE k % 6 = 3) FROM cel
UNION ALL SELECT 'names', 'accession_malformed', id, false, k % 6 IN (1, 2, 3, 5) FROM cel
UNION ALL SELECT 'names', 'lineage_without_sequence', id, true, NOT q FROM seqs
UNION ALL SELECT 'names', 'lineage_without_host_record', id, false, name NOT IN (SELECT LINEAGE_NAME FROM rec) FROM cel
UNION ALL SELECT 'names', 'parasite_genus_carries_species', id, false, k % 6 IN (0, 1) FROM cel WHERE genus <> ''
UNION ALL SELECT 'names', 'parasite_genus_unrecognized', id, false, k % 6 = 4 FROM cel WHERE genus <> ''
UNION ALL SELECT 'sequences', 'sequence_stop_codon', id, false, len({_C4}) > 0 FROM cel WHERE k % 4 <> 0
UNION ALL SELECT 'sequences', 'sequence_longer_than_window', id, false, length(replace(cs, '-', '')) > 479 FROM cel WHERE k % 4 <> 0
UNION ALL SELECT 'sequences', 'sequence_not_iupac', id, false, false FROM cel WHERE k % 4 <> 0
UNION ALL SELECT 'sequences', 'sequence_without_declaration', id, false, false FROM cel WHERE k % 4 <> 0
UNION ALL SELECT 'accessions', 'accession_format', id, false, k % 6 IN (1, 2, 3, 5) FROM cel
UNION ALL SELECT 'accessions', 'accession_collision', id, false, EXISTS (SELECT 1 FROM held WHERE held.acc = upper(CASE WHEN cel.k % 6 IN (0, 1) THEN replace(cel.one_acc, '.1', '') ELSE cel.one_acc END) AND held.name <> cel.name) FROM cel
UNION ALL SELECT 'accessions', 'accession_resolves', id, false, k % 18 <> 0 FROM cel
UNION ALL SELECT 'genomes', 'genome_lineage_unknown', id, false, false FROM cel
UNION ALL SELECT 'genomes', 'genome_resource_type_unknown', id, false, k % 4 IN (2, 3) FROM cel
UNION ALL SELECT 'genomes', 'genome_accession_malformed', id, false, k % 6 = 5 FROM cel
UNION ALL SELECT 'genomes', 'genome_accession_unresolved', id, false, k % 18 <> 0 OR n % 18 <> 0 FROM cel
UNION ALL SELECT 'morphospecies', 'morphospecies_lineage_unknown', id, false, false FROM cel
UNION ALL SELECT 'morphospecies', 'morphospecies_binomial_malformed', id, false, true FROM cel
UNION ALL SELECT 'sites', 'site_coordinates_unreadable', id, false, NOT readable FROM (SELECT id, coord, coalesce(regexp_matches(coord, '^[-0-9.]+$') AND abs(TRY_CAST(coord AS DOUBLE)) <= 90, false) AS readable FROM cel)
UNION ALL SELECT 'references', 'reference_name_form', id, false, k % 5 = 0 FROM cel WHERE k % 5 IN (0, 1)
UNION ALL SELECT 'references', 'reference_already_in_store', id, false, {scalars._PUB} IN (SELECT {scalars._PUB} FROM cel WHERE k % 10 = 1) OR r IN (SELECT REFERENCE_NAME FROM {{v_references}}) FROM cel
UNION ALL SELECT 'references', 'reference_unpubl_malformed', id, false, false FROM cel WHERE k % 5 IN (2, 3)
UNION ALL SELECT 'references', 'reference_unpubl_form', id, false, {scalars._PUB} <> r FROM cel WHERE k % 5 IN (2, 3)
UNION ALL SELECT 'references', 'reference_name_unrecognized', id, false, k % 5 = 4 FROM cel WHERE k % 5 IN (0, 1, 4)
UNION ALL SELECT 'changes', 'values_normalized', id, false, words <> trim(words) FROM cel
UNION ALL SELECT 'headers', 'headers_intact', id, false, found_by <> 'label' FROM cel)"""
# Checks whose facts this submission does not bring.
_SKIPPED = {
    "records": {"host_name_resolves": "host_match", "host_geography_plausible": "geography", "lineage_previously_recorded": "recorded"},
    "sequences": {"sequence_is_known_lineage": "identity", "sequence_completes_known_lineage": "identity", "sequence_identity_unresolved": "identity", "sequence_unplaceable": "identity", "sequence_needs_reframing": "offset_lost", "sequences_identical_within_submission": "twins", "sequence_qc": "qc"},
    "genomes": {"genome_cytb_mismatch": "barcode", "genome_without_barcode": "barcode"},
    "sites": {"site_outside_country": "verdict", "site_country_not_in_atlas": "verdict"},
}
_NOT_RUN = ", ".join(f"('{s}', '{c}', 'no {why}')" for s, found in _SKIPPED.items() for c, why in found.items())


@query(f"""{_TOLD}, r AS (SELECT sheet, c, bool_or(b) AS b, count(*) AS n, count(*) FILTER (hit) AS f FROM told GROUP BY ALL)
SELECT sheet, c AS "check", n AS evaluated, n - f AS passed, f AS findings, CASE WHEN f = 0 THEN 'passed' WHEN b THEN 'blocked' ELSE 'warned' END AS outcome, '' AS skipped FROM r
UNION ALL SELECT s, c, 0, 0, 0, 'not run', w FROM (VALUES {_NOT_RUN}) v(s, c, w)""")
def submission_checks(spark, d):
    return submissions.results(_ready(spark, d))


@query(f"""{_TOLD} SELECT sheet, c AS "check", id AS row FROM told WHERE hit""")
def submission_findings(spark, d):
    return submissions.findings(_ready(spark, d))


@query("""WITH q AS (SELECT *, variant = 1 AND vec_id % 10 = 9 AS gone, CASE WHEN variant = 4 THEN 'L' || vec_id ELSE 'M' || vec_id END AS lin FROM {v_sequences} WHERE variant IN (1, 2, 4)),
u AS (SELECT *, NOT gone AND vec_id % 3 <> 1 AS told FROM q),
o AS (SELECT a.name, count(*) FILTER (b.lin <> a.lin) AS twins FROM u a JOIN u b ON a.vec_id = b.vec_id AND NOT a.gone AND NOT b.gone AND (a.variant = b.variant OR a.variant = 1 OR b.variant = 1) GROUP BY 1)
SELECT u.name AS row, CASE WHEN gone THEN 'unplaceable' WHEN vec_id % 3 = 1 THEN 'new' WHEN vec_id % 3 = 0 THEN 'known' WHEN variant = 1 THEN 'completes' WHEN variant = 2 THEN 'unresolved' ELSE 'known' END AS identity,
  CAST(CASE WHEN gone THEN 64 ELSE 0 END AS INT) AS offset_lost, coalesce(twins, 0) AS twins FROM u LEFT JOIN o ON u.name = o.name""")
def sequence_evidence(spark, d):
    rows = t(spark, d, "v_sequences")
    lineage = F.concat(F.when(F.col("variant") == 4, "L").otherwise("M"), "vec_id")
    shift = F.when((F.col("variant") == 1) & (F.col("vec_id") % 10 == 9), 64).otherwise(0)
    incoming = rows.filter("variant in (1, 2, 4)").select(F.col("name").alias("row"), lineage.alias("LINEAGE_NAME"), F.col("seq").alias("SEQUENCE"), shift.alias("OFFSET"))
    # the store holds whole sequences of every third vector, and of the next but one all but the last bases
    held = rows.filter("vec_id % 3 = 0 and variant = 0 or vec_id % 3 = 2 and variant = 4").select("name", "seq")
    return submissions.sequence_evidence(incoming, held, 64, 40)


# ---- rows of the store ----

_EARLY = "l_shipdate < TIMESTAMP '1998-06-01 00:00:00'"
_POINT = "CAST(CAST(s_suppkey % 80 AS DOUBLE) AS VARCHAR) || ', ' || CAST(CAST(s_suppkey % 170 AS DOUBLE) AS VARCHAR)"


@query(f"""WITH st AS (SELECT *, lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 12, '0') AS id FROM {{v_hosts}} WHERE {_EARLY}),
ex AS (SELECT GENUS_NAME AS g, SPECIES_NAME AS s, arg_min(ORDER_NAME, id) AS o, arg_min(FAMILY_NAME, id) AS f FROM st GROUP BY ALL), co AS (SELECT GENUS_NAME AS g, arg_min(ORDER_NAME, id) AS o, arg_min(FAMILY_NAME, id) AS f FROM st GROUP BY ALL),
cn AS (SELECT COUNTRY_NAME AS c, arg_min(CONTINENT_NAME, id) AS v FROM st GROUP BY ALL), pt AS (SELECT 'S' || (s_suppkey % 5) AS s, arg_min({_POINT}, s_suppkey) AS v FROM {{supplier}} GROUP BY ALL),
de AS (SELECT 'P' || k AS l, CASE WHEN k % 6 IN (0, 3) THEN 'Plasmodium' WHEN k % 6 = 1 THEN 'Haemoproteus' WHEN k % 6 = 2 THEN 'Leucocytozoon' END AS v FROM {{v_cells}} WHERE k % 10 <> 3),
he AS (SELECT DISTINCT LINEAGE_NAME AS l FROM st WHERE l_partkey % 7 <> 0),
al AS (SELECT l, r, string_agg(a, ',' ORDER BY line) AS v FROM (SELECT l, r, a, min(line) AS line FROM (SELECT 'P' || p_partkey AS l, 'R' || (p_size % 20) AS r, 'syn' || (p_partkey % 9) AS a, p_partkey * 2 + 1 AS line FROM {{part}} UNION ALL SELECT 'P' || p_partkey, 'R' || (p_size % 20), 'syn' || (p_size % 9), p_partkey * 2 FROM {{part}}) GROUP BY ALL) GROUP BY ALL),
b AS (SELECT h.*, CASE WHEN SPECIES_NAME = '' THEN '' ELSE GENUS_NAME END AS g FROM {{v_hosts}} h WHERE NOT {_EARLY}),
j AS (SELECT b.*, coalesce(ex.o, co.o) AS o, coalesce(ex.f, co.f) AS f, cn.v AS cv, pt.v AS pv, coalesce(de.v, CASE WHEN he.l IS NOT NULL THEN 'Plasmodium' END) AS gv, al.v AS av
  FROM b LEFT JOIN ex ON ex.g = b.g AND ex.s = SPECIES_NAME LEFT JOIN co ON co.g = b.g LEFT JOIN cn ON cn.c = COUNTRY_NAME LEFT JOIN pt ON pt.s = SITE_NAME LEFT JOIN de ON de.l = LINEAGE_NAME LEFT JOIN he ON he.l = LINEAGE_NAME LEFT JOIN al ON al.l = LINEAGE_NAME AND al.r = REFERENCE_NAME)
SELECT l_orderkey * 10 + l_linenumber AS line, LINEAGE_NAME, g AS GENUS_NAME, SPECIES_NAME, coalesce(o, '') AS ORDER_NAME, coalesce(f, '') AS FAMILY_NAME, COUNTRY_NAME, coalesce(cv, '') AS CONTINENT_NAME, SITE_NAME, coalesce(pv, '') AS SITE_COORDINATES,
  REFERENCE_NAME, coalesce(gv, '') AS PARASITE_GENUS, coalesce(av, '') AS ALT_NAME, CAST(NUMBER_TESTED AS VARCHAR) AS NUMBER_TESTED, CAST(NUMBER_FOUND AS VARCHAR) AS NUMBER_FOUND, 'sub-1' AS _source, 'v2' AS _added,
  concat_ws(';', CASE WHEN g <> '' AND o IS NULL THEN 'host unknown: ' || SPECIES_NAME END, CASE WHEN pv IS NULL THEN 'site without coordinates: ' || SITE_NAME END, CASE WHEN gv IS NULL THEN 'lineage neither held nor declared: ' || LINEAGE_NAME END, CASE WHEN cv IS NULL THEN 'country unknown: ' || COUNTRY_NAME END) AS notes FROM j""")
def host_rows_map(spark, d):
    hosts, cells, part, supplier = t(spark, d, "v_hosts", "v_cells", "part", "supplier")
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    early = F.col("l_shipdate") < F.lit("1998-06-01 00:00:00").cast("timestamp")
    sheet = hosts.filter(~early).select(line.alias("line"), "LINEAGE_NAME", F.col("SPECIES_NAME").alias("HOST_SPECIES"), "COUNTRY_NAME", "SITE_NAME", "REFERENCE_NAME", "NUMBER_TESTED", "NUMBER_FOUND")
    held = hosts.filter(early).withColumn("RECORD_ID", F.lpad(line.cast("string"), 12, "0")).withColumn("PARASITE_GENUS", F.when(F.col("l_partkey") % 7 == 0, "").otherwise("Plasmodium"))
    sites = supplier.select(F.col("s_suppkey").alias("line"), F.concat(F.lit("S"), F.col("s_suppkey") % 5).alias("SITE_NAME"), (F.col("s_suppkey") % 80).alias("LATITUDE"), (F.col("s_suppkey") % 170).alias("LONGITUDE"))
    names = cells.filter("k % 10 <> 3").select(F.col("k").alias("line"), F.concat(F.lit("P"), "k").alias("LINEAGE_NAME"), F.col("genus").alias("PARASITE_GENUS"))
    given = F.explode(F.array(F.struct((F.col("p_partkey") * 2).alias("line"), (F.col("p_size") % 9).cast("long").alias("n")), F.struct((F.col("p_partkey") * 2 + 1).alias("line"), (F.col("p_partkey") % 9).cast("long").alias("n"))))
    alternatives = part.select(F.concat(F.lit("P"), "p_partkey").alias("LINEAGE_NAME"), F.concat(F.lit("R"), F.col("p_size") % 20).alias("REFERENCE_NAME"), given.alias("x")).select("LINEAGE_NAME", "REFERENCE_NAME", "x.line", F.concat(F.lit("syn"), "x.n").alias("ALT_NAME"))
    rows = store_rows.host_rows(sheet, sites, names, alternatives, held, "sub-1", "v2")
    return rows.withColumn("notes", F.array_join("notes", ";"))


@query(f"""WITH l AS (SELECT k, CASE WHEN k % 6 IN (0, 3) THEN 'Plasmodium' WHEN k % 6 = 1 THEN 'Haemoproteus' WHEN k % 6 = 2 THEN 'Leucocytozoon' END AS g, genus, seq, acc, n FROM {{v_cells}}),
a AS (SELECT k, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(upper(trim(acc)), '[,;\\s]+'), lambda x: x <> ''))), ', ') AS v, len(list_distinct(list_filter(string_split_regex(upper(trim(acc)), '[,;\\s]+'), lambda x: x <> ''))) AS m FROM l)
SELECT CAST(k AS BIGINT) AS line, 'P' || k AS LINEAGE_NAME, coalesce(g, '') AS GENUS_NAME, CASE WHEN k % 5 = 0 THEN 'Plasmodium relictum' WHEN k % 6 = 0 THEN 'Plasmodium huffi' WHEN k % 6 = 1 THEN 'Haemoproteus majoris' ELSE '' END AS SPECIES_NAME, '' AS SEQ_LENGTH,
  v AS accessions, CASE WHEN k % 4 <> 0 THEN regexp_replace(upper(seq), '[^A-Z.~-]', '', 'g') ELSE '' END AS SEQUENCE,
  concat_ws(';', CASE WHEN k % 4 = 0 THEN 'no sequence' END, CASE WHEN m > 1 THEN 'several accessions: ' || m END, CASE WHEN k % 6 = 4 THEN 'genus not recorded: corvus' END, CASE WHEN k % 15 = 0 THEN 'several species' END) AS notes FROM l JOIN a USING (k)""")
def lineage_rows_map(spark, d):
    cells = t(spark, d, "v_cells").withColumn("line", F.col("k").cast("long")).withColumn("LINEAGE_NAME", F.concat(F.lit("P"), "k"))
    names = cells.select("line", "LINEAGE_NAME", F.col("genus").alias("PARASITE_GENUS"), F.col("acc").alias("ACCESSION"))
    sequences = cells.filter("k % 4 <> 0").select("line", "LINEAGE_NAME", F.col("seq").alias("SEQUENCE"))
    one = cells.filter("k % 5 = 0").select("line", "LINEAGE_NAME", F.lit("Plasmodium relictum").alias("BINOMIAL"))
    two = cells.filter("k % 15 = 0").select(F.col("line") + 1, "LINEAGE_NAME", F.lit("Haemoproteus majoris").alias("BINOMIAL"))
    rows = store_rows.lineage_rows(names, sequences, one.union(two), "sub-1", "v2").drop("_source", "_added")
    return rows.withColumn("accessions", F.array_join(F.array_sort(F.split("GENBANK_ACC", ", ")), ", ")).drop("GENBANK_ACC").withColumn("notes", F.array_join("notes", ";"))


@query("""SELECT 'V' || vec_id AS LINEAGE_NAME, 'AB' || (100000 + vec_id) AS accession, CASE WHEN vec_id % 3 = 0 THEN 'sequence_updated' ELSE 'noted' END AS EVENT, CASE vec_id % 5 WHEN 0 THEN 64 WHEN 1 THEN 64 WHEN 2 THEN 48 WHEN 3 THEN 64 ELSE 0 END AS compared, CASE WHEN vec_id % 5 = 1 THEN 1 ELSE 0 END AS mismatches,
CASE WHEN vec_id % 5 = 4 THEN 'no deposit' WHEN vec_id % 6 = 3 THEN 'stored sequence is not the row''s' WHEN vec_id % 5 = 2 THEN 'too little overlap' WHEN vec_id % 5 = 1 THEN 'differs' ELSE 'identical' END AS verdict FROM {embeddings}""")
def history_agrees(spark, d):
    rows = t(spark, d, "v_sequences")
    lineage, held = F.concat(F.lit("V"), "vec_id"), rows.filter("variant = 0")
    event = F.when(F.col("vec_id") % 3 == 0, "sequence_updated").otherwise("noted")
    source = F.concat(F.lit(" AB"), F.col("vec_id") + 100000, F.lit(".1"))
    events = held.select(lineage.alias("LINEAGE_NAME"), event.alias("EVENT"), source.alias("SOURCE"), F.when(F.col("vec_id") % 6 == 3, F.lit("ACGT")).otherwise(F.col("seq")).alias("NEW_SEQUENCE"))
    lineages = held.select(lineage.alias("LINEAGE_NAME"), F.col("seq").alias("SEQUENCE"))
    variant = F.when(F.col("vec_id") % 5 == 0, 0).when(F.col("vec_id") % 5 == 1, 3).when(F.col("vec_id") % 5 == 2, 4).when(F.col("vec_id") % 5 == 3, 1)
    deposits = rows.filter(F.col("variant") == variant).select(F.concat(F.lit("AB"), F.col("vec_id") + 100000).alias("accession"), F.concat(F.lit("NNN"), "seq").alias("seq"))
    return history.history_agrees(events, lineages, deposits, 64, least=50)


@query("""WITH s AS (SELECT *, TIMESTAMP '1996-04-20 00:00:00' + to_days(CAST(submission % 60 AS INT)) AS since FROM {v_entries} WHERE state_no <> 4 AND NOT embargoed)
SELECT row_number() OVER (ORDER BY since, submission) AS position, submission, name, CASE state_no WHEN 0 THEN 'received' WHEN 3 THEN CASE WHEN submission % 60 > 39 THEN 'under review' ELSE 'accepted' END ELSE 'under review' END AS public FROM s""")
def public_queue(spark, d):
    entries = t(spark, d, "v_entries")
    state = F.element_at(F.array(*[F.lit(s) for s in ("received", "in_review", "held", "approved", "withdrawn")]), F.col("state_no").cast("int") + 1)
    since = F.expr("timestampadd(DAY, cast(submission % 60 as int), timestamp '1996-04-20 00:00:00')")
    return ledger.public_queue(entries, entries.select("submission", state.alias("state"), since.alias("since")), F.lit("1996-06-01 00:00:00").cast("timestamp"), 72)


@query("""WITH p AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'contained' WHEN 2 THEN 'ambiguous' ELSE 'set aside' END AS kind, p_brand AS a, 'P' || p_partkey AS b FROM {part})
SELECT row_number() OVER (ORDER BY CASE kind WHEN 'duplicate' THEN 1 WHEN 'contained' THEN 2 WHEN 'ambiguous' THEN 3 ELSE 4 END, a, b) AS position, * FROM p""")
def review_order(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("duplicate", "contained", "ambiguous", "set aside")]), (F.col("p_partkey") % 4).cast("int") + 1)
    return curation.review_order(t(spark, d, "part").select(kind.alias("kind"), F.col("p_brand").alias("a"), F.concat(F.lit("P"), "p_partkey").alias("b")))


# ---- synonymy ----


def _synonyms(spark, d):
    rows = t(spark, d, "v_sequences").filter("variant in (0, 2, 4) or variant = 1 and vec_id % 2 = 1").withColumnRenamed("name", "LINEAGE_NAME")
    n = F.when(F.col("variant") == 0, 3).when(F.col("variant") == 1, 2).when(F.col("variant") == 2, F.col("vec_id") % 2).otherwise(F.col("vec_id") % 6).cast("int")
    hosts = rows.select("LINEAGE_NAME", F.explode(F.expr("sequence(1, 5)")).alias("i"), n.alias("n")).filter("i <= n")
    hosts = hosts.select("LINEAGE_NAME", F.concat(F.lit("H"), F.col("i") % 2).alias("SPECIES_NAME"), F.concat(F.lit("C"), "i").alias("COUNTRY_NAME"), F.concat(F.lit("R"), "i").alias("REFERENCE_NAME"))
    genus = F.when((F.col("variant") == 4) & (F.col("vec_id") % 5 == 0), "G2").otherwise("G1")
    lineages = rows.select("LINEAGE_NAME", genus.alias("GENUS_NAME"), F.lit("").alias("GENBANK_ACC"), F.lit("Full").alias("SEQ_LENGTH"), F.col("seq").alias("SEQUENCE"))
    alternatives = rows.filter("variant = 1 and vec_id % 3 = 0").select("LINEAGE_NAME", F.concat(F.lit("V"), "vec_id", F.lit("_0")).alias("ALT_NAME"))
    vectors = hosts.limit(0).withColumnRenamed("SPECIES_NAME", "VECTOR_SPECIES")
    known = synonymy.profiles(lineages, hosts, vectors, t(spark, d, "v_references"), hosts.select("LINEAGE_NAME", "SPECIES_NAME").limit(0), alternatives)
    decisions = rows.filter("variant = 4 and vec_id % 10 = 1").select("LINEAGE_NAME", F.lit("keep").alias("DECISION"))
    return synonymy.synonymy_review(known, 64, alternatives, decisions, floor=40, small=1, shared=40)


_REVIEW = """v AS (SELECT vec_id, variant, name, CASE variant WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN vec_id % 2 ELSE vec_id % 6 END AS n FROM {v_sequences} WHERE variant IN (0, 2, 4) OR variant = 1 AND vec_id % 2 = 1),
rw AS (SELECT CASE WHEN a.variant = 1 THEN 'duplicate' ELSE 'contained' END AS KIND, a.name AS LINEAGE, b.name AS OTHER, a.variant AS va, a.vec_id AS id, a.n AS na, b.n AS nb, CASE WHEN a.variant = 1 THEN 64 ELSE 48 END AS COMPARABLE, a.variant = 4 AND a.vec_id % 5 = 0 AS cross_genus
  FROM v a JOIN v b ON a.vec_id = b.vec_id AND (a.variant = 1 AND b.variant = 0 OR a.variant IN (2, 4) AND b.variant IN (0, 1))),
rv AS (SELECT *, CASE WHEN cross_genus THEN 'decide: genera differ' WHEN KIND = 'duplicate' THEN 'merge: one sequence' WHEN id % 2 = 1 THEN 'decide: several hold it' WHEN na <= 1 THEN 'merge: adds little' WHEN na > nb THEN 'decide: better established' ELSE 'decide: records would move' END AS PROPOSAL FROM rw)"""


@query(f"""WITH {_REVIEW} SELECT KIND, LINEAGE, OTHER, PROPOSAL, CASE WHEN PROPOSAL LIKE 'merge%' THEN OTHER ELSE '' END AS PROPOSED_INTO, COMPARABLE, 64 - COMPARABLE AS OTHER_PRIVATE, 0 AS LINEAGE_PRIVATE, CASE WHEN KIND = 'contained' THEN 1 + id % 2 ELSE 0 END AS N_CONTAINERS,
CASE WHEN KIND = 'duplicate' THEN '' WHEN id % 2 = 1 THEN 'V' || id || '_0, V' || id || '_1' ELSE 'V' || id || '_0' END AS CONTAINERS, CASE WHEN KIND = 'duplicate' AND id % 3 = 0 THEN 'yes' ELSE '' END AS ALREADY_ALT_NAME, CASE WHEN va = 4 AND id % 10 = 1 THEN 'keep' ELSE '' END AS PRIOR_DECISION,
na AS LINEAGE_HOST_RECORDS, nb AS OTHER_HOST_RECORDS, least(na, 2) AS LINEAGE_HOSTS, na AS LINEAGE_REFERENCES, CASE WHEN na > 0 THEN 2001 END AS LINEAGE_FIRST_YEAR, CASE na WHEN 0 THEN '' WHEN 1 THEN 'R1' WHEN 2 THEN 'R1; R2' WHEN 3 THEN 'R1; R2; R3' WHEN 4 THEN 'R1; R2; R3; R4' ELSE 'R1; R2; R3; R4; R5' END AS LINEAGE_REFERENCE_NAMES FROM rv""")
def synonymy_review(spark, d):
    shown = "KIND LINEAGE OTHER PROPOSAL PROPOSED_INTO COMPARABLE OTHER_PRIVATE LINEAGE_PRIVATE N_CONTAINERS CONTAINERS ALREADY_ALT_NAME PRIOR_DECISION LINEAGE_HOST_RECORDS OTHER_HOST_RECORDS LINEAGE_HOSTS LINEAGE_REFERENCES LINEAGE_FIRST_YEAR LINEAGE_REFERENCE_NAMES"
    return _synonyms(spark, d).select(*shown.split())


@query(f"""WITH {_REVIEW} SELECT count(*) AS n_pairs, count(*) FILTER (KIND = 'duplicate') AS n_duplicate, count(*) FILTER (KIND = 'contained') AS n_contained, 0 AS n_ambiguous, count(*) FILTER (PROPOSAL LIKE 'merge%') AS n_proposed_merges, 0 AS n_below_floor, count(*) FILTER (cross_genus) AS n_cross_genus,
count(*) FILTER (KIND = 'duplicate' AND id % 3 = 0) AS n_already_alt_name, count(DISTINCT CASE WHEN KIND = 'contained' THEN LINEAGE END) AS n_contained_lineages, count(DISTINCT CASE WHEN KIND = 'contained' AND id % 2 = 0 THEN LINEAGE END) AS n_contained_unique, (SELECT count(*) FROM v) AS n_lineages_in_pairs FROM rv""")
def synonymy_summary(spark, d):
    return synonymy.review_summary(_synonyms(spark, d), floor=40)


@query("""SELECT 'V' || vec_id || '_0' AS haplotype, name AS lineage, 2 AS n_names FROM {v_sequences} WHERE variant IN (0, 1)""")
def synonymy_report(spark, d):
    rows = t(spark, d, "v_sequences")
    pairs = sequences.all_pairs_compatible(rows, "name", "seq", 64, min_shared=40)
    return synonymy.synonymy_report(pairs, rows.withColumnRenamed("name", "LINEAGE_NAME"))[0]
