"""Checks of whole submissions: every finding planted once, nothing told as passed that nobody looked at."""

import pytest
from pyspark.sql import functions as F

from curaspark.operators import quality, submissions


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="module")
def sheets(spark):
    return {
        "records": frame(
            spark, "document string, row string, LINEAGE_NAME string, SPECIES_NAME string, COUNTRY_NAME string, NUMBER_FOUND int, NUMBER_TESTED int, COMMENT string",
            ("d1", "r1", "new 01", "Parus major", "Peru", 3, 2, "Gametocytes seen"), ("d1", "r2", "OLD01", "Parus  Major", "peru", 1, None, ""),
            ("d1", "r3", "", "Corvus corax", "", -1, 4, None), ("d2", "r4", "old01", "Nova species", "Chile", None, None, "plain"), (None, "r5", None, None, None, 0, 0, None),
        ),
        "vectors": frame(spark, "row string, VECTOR_SPECIES string", ("v1", "Culex pipiens"), ("v2", "Parus major"), ("v3", None)),
        "names": frame(
            spark, "row string, LINEAGE_NAME string, HOST_SPECIES string, PARASITE_GENUS string, ACCESSION string",
            ("n1", "PARMAJ01", "Parus major", "Plasmodium", "AB123456"), ("n2", "NEW01", "Parus major", "Plasmodium relictum", "AB12; XY1"), ("n3", "OLD01", "", "Corvus", ""), ("n4", None, None, None, None),
        ),
        "sequences": frame(spark, "row string, LINEAGE_NAME string, SEQUENCE string", ("s1", "PARMAJ01", "ATTTAA"), ("s2", "OTHER9", "ACGTJ"), ("s3", "NEW01", "ACGT" * 120), ("s4", "NEW01", None)),
        "accessions": frame(spark, "row string, ACCESSION string, LINEAGE_NAME string", ("a1", "AB123456.1", "NEW01"), ("a2", "bad-1", "OLD01"), ("a3", "AB000001", "OLD01"), ("a4", "AB000001", "OLD01"), ("a5", "", "")),
        "genomes": frame(spark, "row string, LINEAGE_NAME string, RESOURCE_TYPE string, ACCESSION string", ("g1", "OLD01", "Mitogenome", "AB123456,AB000001"), ("g2", "NEW01", "poem", "nothing-1"), ("g3", "LOST1", None, "")),
        "morphospecies": frame(spark, "row string, LINEAGE_NAME string, BINOMIAL string", ("m1", "NEW01", "Plasmodium relictum"), ("m2", "LOST1", "relictum"), ("m3", None, None)),
        "sites": frame(spark, "row string, LATITUDE string, LONGITUDE string", ("x1", "12.5", "-70.25"), ("x2", "north", "10"), ("x3", "", None)),
        "references": frame(
            spark, "document string, row string, REFERENCE_NAME string",
            ("d1", "f1", "Smith et al., 2001"), ("d1", "f2", "Ellis 1999"), ("d3", "f3", "Ellis et. al., unpublished"), ("d3", "f4", "unpub by Ellis"), ("d3", "f5", "A fine title"), ("d2", "f6", ""),
        ),
        "changes": frame(spark, "row string, WAS string, NOW string", ("c1", " a", "a"), ("c2", "a", "a"), ("c3", None, None)),
        "headers": frame(spark, "row string, FOUND_BY string", ("h1", "label"), ("h2", "position")),
    }


@pytest.fixture(scope="module")
def store(spark):
    return {
        "lineages": frame(spark, "LINEAGE_NAME string, ACCESSION string", ("OLD01", "AB000001"), ("OLD02", "AB123456"), ("OLD03", None)),
        "hosts": frame(spark, "SPECIES_NAME string, COUNTRY_NAME string", ("Parus major", "PERU"), ("Corvus corax", "PERU"), ("", "")),
        "vectors": frame(spark, "VECTOR_SPECIES string", ("Culex modestus",)),
        "references": frame(spark, "REFERENCE_NAME string", ("Smith et al 2001",)),
        "claimed": frame(spark, "LINEAGE_NAME string", ("parmaj01",)),
        "available": frame(spark, "ACCESSION string", ("AB000001.2",)),
    }


@pytest.fixture(scope="module")
def evidence(spark):
    return {
        "sequences": frame(
            spark, "row string, identity string, offset_lost int, twins int, qc array<string>",
            ("s1", "known", 2, 1, ["placed_in_frame", "suspected_frameshift"]), ("s2", "unplaceable", 0, 0, ["3_nonsynonymous_changes_vs_nearest_lineage"]), ("s3", "completes", 0, 1, None),
        ),
        "sites": frame(spark, "row string, verdict string", ("x1", "outside"), ("x2", "unknown")),
        "genomes": frame(spark, "row string, barcode string", ("g1", "another lineage"), ("g2", "no barcode")),
        "records": frame(spark, "row string, host_match string, geography string, recorded boolean", ("r1", "exact", "known", True), ("r4", "none", "new order", False)),
    }


EXPECTED = {
    "records_unlinked": {"d1", None}, "reference_missing": {"d2", None},
    "prevalence_sanity": {"r1", "r3"}, "prevalence_numerator_alone": {"r2"}, "lineage_known": {"r1"}, "host_binomial": {"r4"}, "new_country": {"r4"},
    "record_without_country": {"r3", "r5"}, "record_without_prevalence": {"r2", "r4"}, "comment_mentions_morphology": {"r1"},
    "host_name_resolves": {"r4"}, "host_geography_plausible": {"r4"}, "lineage_previously_recorded": {"r4"}, "vector_sanity": {"v2"},
    "name_malformed": {"n2", "n3"}, "name_already_in_store": {"n3"}, "name_claimed_by_another_submission": {"n1"}, "accession_malformed": {"n2"},
    "lineage_without_sequence": {"n3"}, "lineage_without_host_record": {"n1"}, "parasite_genus_carries_species": {"n2"}, "parasite_genus_unrecognized": {"n3"},
    "sequence_is_known_lineage": {"s1"}, "sequence_completes_known_lineage": {"s3"}, "sequence_unplaceable": {"s2"}, "sequence_needs_reframing": {"s1"},
    "sequence_longer_than_window": {"s3"}, "sequence_not_iupac": {"s2"}, "sequences_identical_within_submission": {"s1", "s3"},
    "sequence_without_declaration": {"s2"}, "sequence_qc": {"s1"}, "accession_format": {"a2"}, "accession_collision": {"a1"}, "accession_resolves": {"a1", "a2"},
    "genome_lineage_unknown": {"g3"}, "genome_resource_type_unknown": {"g2", "g3"}, "genome_accession_malformed": {"g2"}, "genome_accession_unresolved": {"g1", "g2"},
    "genome_cytb_mismatch": {"g1"}, "genome_without_barcode": {"g2"}, "morphospecies_lineage_unknown": {"m2", "m3"}, "morphospecies_binomial_malformed": {"m2", "m3"},
    "site_coordinates_unreadable": {"x2"}, "site_outside_country": {"x1"}, "site_country_not_in_atlas": {"x2"},
    "reference_name_form": {"f1"}, "reference_already_in_store": {"f1"}, "reference_unpubl_malformed": {"f4"}, "reference_unpubl_form": {"f3"}, "reference_name_unrecognized": {"f5"},
    "values_normalized": {"c1"}, "headers_intact": {"h2"},
}


def test_every_planted_finding_is_told_once(sheets, store, evidence):
    ready = submissions.prepared(sheets, store, evidence)
    got = {}
    for r in submissions.findings(ready).collect():
        got.setdefault(r.check, []).append(r.row)
    # stops are counted by the fourth code's own rule, tested with count_stops
    got.pop("sequence_stop_codon", None)
    assert {k: set(v) for k, v in got.items()} == EXPECTED
    assert all(len(v) == len(set(v)) for v in got.values())
    told = {r.check: r for r in submissions.results(ready).collect()}
    assert set(told) == {c.name for rules in submissions.RULES.values() for c in rules}
    assert all(told[k].findings == len(v) and told[k].outcome in ("warned", "blocked") for k, v in EXPECTED.items())
    assert told["accession_format"].evaluated == 4 and told["prevalence_sanity"].outcome == "blocked"


def test_what_nobody_looked_at_is_not_passed(sheets):
    told = {r.check: r for r in submissions.results(submissions.prepared({"records": sheets["records"]}, {})).collect()}
    assert told["lineage_known"].outcome == "not run" and told["lineage_known"].skipped == "no lineage_held"
    assert told["site_outside_country"].skipped == "no sheet sites" and told["reference_missing"].skipped == "no references"
    assert told["prevalence_sanity"].outcome == "blocked" and told["records_unlinked"].findings == 2


def test_empty_sheets_and_repeated_or_clashing_columns(spark, sheets, store):
    none = {name: df.limit(0) for name, df in sheets.items()}
    told = submissions.results(submissions.prepared(none, store)).collect()
    assert {r.outcome for r in told} == {"not run"} and len(told) == sum(map(len, submissions.RULES.values()))
    twice = sheets["vectors"].unionByName(sheets["vectors"]).withColumn("LINEAGE_NAME", F.lit("x")).withColumn("found", F.lit(1))
    one = submissions.results(submissions.prepared({"vectors": twice}, store)).filter("check = 'vector_sanity'").first()
    assert (one.evaluated, one.findings) == (4, 2)


def test_flags_of_records_and_vectors(spark):
    schema = "LINEAGE_NAME string, SPECIES_NAME string, COUNTRY_NAME string, REFERENCE_NAME string, NUMBER_FOUND int, NUMBER_TESTED int, ACCESSION string, lineage_resolution string, source_scope string"
    rows = frame(
        spark, schema,
        ("L1", "A b", "P", "R1", 1, 2, "X1", None, None), ("L1", "A b", "P", "R2", 1, 2, "", "resolved", "scope_uncertain"), ("L9", "A b", "P", "R1", 1, 2, "X1", "none", None),
        ("L9", "C d", "Q", "R1", 3, 2, None, None, "reprinted"), (None, "A b", None, None, 1, 2, "X1", "none", None), ("L1", "A b", "P", None, 1, 2, "", None, None),
    )
    store = frame(spark, "LINEAGE_NAME string, SPECIES_NAME string, COUNTRY_NAME string, REFERENCE_NAME string", ("L1", "A b", "P", "R1"), ("L1", "A b", "P", "R1"))
    filed = frame(spark, "ACCESSION string, LINEAGE_NAME string", ("X1", "L1"), ("", "L7"))
    got = [(sorted(r.flags), r.tier) for r in quality.row_flags(rows, store, accessions=filed).sort("LINEAGE_NAME", "REFERENCE_NAME", "SPECIES_NAME").collect()]
    want = [
        (["country_missing", "lineage_missing"], "incomplete"), (["pair_already_in_store"], "confirms"), ([], "new"), (["pair_already_in_store", "source_uncertain"], "confirms"),
        (["lineage_accession_conflict", "lineage_unresolved"], "review"), (["country_not_in_store", "host_not_in_store", "lineage_not_in_store", "prevalence_inconsistent", "source_reprinted"], "review"),
    ]
    assert got == want
    vectors = rows.withColumnRenamed("SPECIES_NAME", "VECTOR_SPECIES").filter("LINEAGE_NAME = 'L1'").withColumn("VECTOR_SPECIES", F.lit(""))
    assert {tuple(r.flags) for r in quality.row_flags(vectors.drop("source_scope"), store, species="VECTOR_SPECIES").collect()} == {("vector_missing",)}


def test_sheets_become_store_rows_with_notes(spark):
    from curaspark.operators import store_rows as R

    hosts = frame(
        spark, "line int, LINEAGE_NAME string, HOST_SPECIES string, COUNTRY_NAME string, SITE_NAME string, REFERENCE_NAME string, NUMBER_TESTED int, NUMBER_FOUND int",
        (2, "new 01", "Parus major", "Peru", "Lima", "Smith et al., 2001", 4, 1), (3, "OLD01", "Parus ater", "Chile", "", "Ellis 1999", None, None), (4, None, None, None, None, None, None, None), (5, "LOST", "Nova avis", "", "Quito", "", 1, 1),
    )
    sites = frame(spark, "line int, SITE_NAME string, LATITUDE string, LONGITUDE string", (2, "Lima", "far", "1"), (3, "Lima", "-12.5", "-77.25"), (4, "Lima", "1", "1"))
    names = frame(spark, "line int, LINEAGE_NAME string, PARASITE_GENUS string, ACCESSION string", (2, "NEW01", "Plasmodium relictum", "AB123456, AB123457"), (3, "OLD01", "corvus", ""), (4, "", "", ""))
    alternatives = frame(spark, "line int, LINEAGE_NAME string, REFERENCE_NAME string, ALT_NAME string", (2, "NEW01", "Smith et al 2001", "b"), (3, "NEW01", "Smith et al. 2001", "a"), (4, "NEW01", "Smith et al 2001", "b"), (5, "NEW01", "Ellis 1999", "c"))
    schema = "RECORD_ID string, LINEAGE_NAME string, GENUS_NAME string, SPECIES_NAME string, ORDER_NAME string, FAMILY_NAME string, COUNTRY_NAME string, CONTINENT_NAME string, PARASITE_GENUS string"
    store = frame(spark, schema, ("R2", "OLD01", "Parus", "Parus major", "O2", "F2", "Peru", "South", "Haemoproteus"), ("R1", "X1", "Parus", "Parus caeruleus", "O1", "F1", "Peru", "America", ""), ("R3", "X2", "Parus", "Parus major", "O3", "F3", None, None, None))
    got = {r.line: r for r in R.host_rows(hosts, sites, names, alternatives, store, "sub-1", "v9").collect()}
    assert len(got) == 4
    one, two, blank, lost = got[2], got[3], got[4], got[5]
    assert (one.LINEAGE_NAME, one.ORDER_NAME, one.FAMILY_NAME, one.CONTINENT_NAME, one.SITE_COORDINATES) == ("NEW01", "O2", "F2", "America", "-12.5, -77.25")
    assert (one.PARASITE_GENUS, one.ALT_NAME, one.REFERENCE_NAME, one._source, one._added, one.notes) == ("Plasmodium", "b,a", "Smith et al 2001", "sub-1", "v9", [])
    assert (two.ORDER_NAME, two.PARASITE_GENUS, two.ALT_NAME, two.notes) == ("O1", "Haemoproteus", "", ["country unknown: Chile"])
    assert blank.notes == [] and blank.SPECIES_NAME == ""
    assert lost.notes == ["host unknown: Nova avis", "site without coordinates: Quito", "lineage neither held nor declared: LOST"]

    sequences = frame(spark, "line int, LINEAGE_NAME string, SEQUENCE string", (2, "new01", " "), (3, "new01", ">h\nac\ngt"), (4, "new01", "TTTT"))
    links = frame(spark, "line int, LINEAGE_NAME string, BINOMIAL string, REFERENCE_NAME string, COMMENT string", (2, "OLD01", "Haemoproteus majoris", "Ellis 1999", " seen "), (3, "OLD01", "Haemoproteus payevskyi", "Ellis 1999", ""), (4, "OLD01", "Haemoproteus majoris", "Ellis 1999", "later"), (5, "NEW01", "relictum", "", None))
    declared = {r.LINEAGE_NAME: r for r in R.lineage_rows(names, sequences, links, "sub-1", "v9").collect()}
    assert set(declared) == {"NEW01", "OLD01"}
    assert (declared["NEW01"].SEQUENCE, declared["NEW01"].GENUS_NAME, declared["NEW01"].SPECIES_NAME, declared["NEW01"].notes) == ("ACGT", "Plasmodium", "Plasmodium relictum", ["several accessions: 2"])
    assert (declared["OLD01"].SPECIES_NAME, declared["OLD01"].SEQ_LENGTH, declared["OLD01"].notes) == ("Haemoproteus majoris", "", ["no sequence", "genus not recorded: corvus", "several species"])
    assert sorted((r.line, r.SPECIES_NAME, r.MORPHOLOGY_COMMENT, len(r.notes)) for r in R.morphology_rows(links, "s", "v").collect()) == [(2, "Haemoproteus majoris", "seen", 0), (3, "Haemoproteus payevskyi", "", 0), (5, "relictum", "", 1)]
    assert sorted((r.line, r.ALT_NAME) for r in R.alternative_rows(alternatives, "s", "v").collect()) == [(2, "b"), (3, "a"), (5, "c")]
    genomes = frame(spark, "line int, LINEAGE_NAME string, RESOURCE_TYPE string, ACCESSION string", (2, "NEW01", "Mitogenome", "AB123456; x"), (3, "NEW01", None, None), (4, "", "", "AB123456"))
    assert sorted((r.line, r.ACCESSION, r.ARCHIVE, r.notes) for r in R.genome_rows(genomes, "s", "v").collect()) == [(2, "AB123456", "nucleotide", []), (2, "X", "", ["not an accession: X"]), (3, "", "", ["no accession"])]
    refs = frame(spark, "line int, REFERENCE_NAME string, TITLE string, DOI string", (2, "Smith et al., 2001", "T", ""), (3, "Smith et al 2001", "U", ""), (4, "Ellis 1999", "", ""), (5, None, None, None))
    new = R.reference_rows(refs, frame(spark, "REFERENCE_NAME string", ("Ellis 1999",)), "s", "v").collect()
    assert [(r.line, r.REFERENCE_NAME, r.PUBLICATION_YEAR, r.TITLE, r.notes) for r in new] == [(2, "Smith et al 2001", "2001", "T", ["respelled: Smith et al., 2001"])]
    seen = frame(spark, "line int, LINEAGE_NAME string, VECTOR_SPECIES string, COUNTRY_NAME string, REFERENCE_NAME string", (2, "OLD01", "Culex  pipiens", "Peru", ""), (3, "OLD01", None, "Mars", ""))
    assert sorted((r.line, r.GENUS_NAME, r.CONTINENT_NAME, r.notes) for r in R.vector_rows(seen, store, "s", "v").collect()) == [(2, "Culex", "America", []), (3, "", "", ["no vector", "country unknown: Mars"])]


def test_history_rows_are_held_against_their_deposits(spark):
    from curaspark.operators import history

    base = "ACGTTGCAACCGGTTATCGATCGGATTACAGGCATTCAGCAT"
    changed = base[:20] + ("A" if base[20] != "A" else "C") + base[21:]
    events = frame(spark, "LINEAGE_NAME string, EVENT string, SOURCE string, NEW_SEQUENCE string", ("L1", "noted", " ab123456.1", None), ("L2", "noted", "AB000002", ""), ("L3", "noted", "AB000003", ""), ("L4", "sequence_updated", "AB123456", "ACG"), ("L5", "noted", "AB999999", ""), ("L6", "noted", "Smith 2001", ""), ("L7", "noted", None, None))
    lineages = frame(spark, "LINEAGE_NAME string, SEQUENCE string", ("L1", "--" + base), ("L2", changed), ("L3", base), ("L4", base), ("L5", base), ("L6", base))
    deposits = frame(spark, "accession string, seq string", ("AB123456.2", "TTT" + base + "GG"), ("AB000002", base), ("AB000003", base[30:]), ("AB000003.2", "ZZ"))
    got = {r.LINEAGE_NAME: (r.compared, r.mismatches, r.verdict) for r in history.history_agrees(events, lineages, deposits, 479, k=8, least=30).collect()}
    assert got == {"L1": (42, 0, "identical"), "L2": (42, 1, "differs"), "L3": (12, 0, "too little overlap"), "L4": (42, 0, "stored sequence is not the row's"), "L5": (0, 0, "no deposit")}


def test_public_queue_and_review_order(spark):
    from curaspark.operators import curation, ledger

    states = spark.sql("select * from values (1L, 'approved', timestamp '2024-01-09'), (2L, 'in_review', timestamp '2024-01-02'), (3L, 'withdrawn', timestamp '2024-01-01'), (4L, 'received', timestamp '2024-01-03'), (5L, 'approved', timestamp '2024-01-01') as t(submission, state, since)")
    entries = frame(spark, "submission long, name string, embargoed boolean", (1, "a", False), (2, "b", False), (3, "c", False), (4, "d", True), (5, "e", False), (6, "f", False))
    got = sorted(tuple(r) for r in ledger.public_queue(entries, states, F.lit("2024-01-10").cast("timestamp"), 72).collect())
    assert got == [(1, 5, "e", "accepted"), (2, 2, "b", "under review"), (3, 1, "a", "under review")]
    pairs = frame(spark, "kind string, a string, b string", ("duplicate", "A", "B"), ("odd", "A", "B"), ("ambiguous", "B", "C"), ("contained", "A", "Z"), ("ambiguous", "A", "C"))
    assert [tuple(r)[:3] for r in curation.review_order(pairs).sort("position").collect()] == [("duplicate", "A", "B"), ("contained", "A", "Z"), ("ambiguous", "A", "C"), ("ambiguous", "B", "C"), ("odd", "A", "B")]
