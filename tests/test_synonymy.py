"""The synonymy review: strongest name of a group, containers, genera, codes, ties and blanks."""

import pytest

from curaspark.operators import synonymy


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="module")
def known(spark):
    full, other = "ACGTACGTTGCA", "TTTTCCCCGGGG"
    lineages = frame(
        spark, "LINEAGE_NAME string, GENUS_NAME string, GENBANK_ACC string, SEQ_LENGTH string, SEQUENCE string",
        ("A1", "Plasmodium", "X1", "Full", full), ("A2", "Plasmodium", "X2", "Full", full.lower()), ("A3", "", None, None, full), ("A3", "Haemoproteus", "Z9", "Full", other),
        ("C1", "Plasmodium", "X4", "Partial", "R" + full[1:8] + "----"), ("D1", "Haemoproteus", "X5", "Partial", "----" + full[4:]), ("E1", None, "X6", "Full", other), ("F1", "", "X7", "", None), ("", "", "", "", full),
    )
    hosts = frame(
        spark, "LINEAGE_NAME string, SPECIES_NAME string, COUNTRY_NAME string, REFERENCE_NAME string",
        ("A2", "h1", "P", "R1"), ("A2", "h1", "P", "R1"), ("A1", "h1", "P", "R2"), ("A3", "h2", "", "R1"), ("C1", "h1", None, "R1"), ("C1", "", "Q", "R2"), ("C1", "h3", "Q", None),
    )
    vectors = frame(spark, "LINEAGE_NAME string, VECTOR_SPECIES string, COUNTRY_NAME string, REFERENCE_NAME string", ("A1", "v", "Q", "R2"))
    references = frame(spark, "REFERENCE_NAME string, PUBLICATION_YEAR int", ("R1", 2005), ("R2", 1999))
    morphology = frame(spark, "LINEAGE_NAME string, SPECIES_NAME string", ("A1", "Plasmodium x"), ("A1", "Plasmodium x"), ("A1", ""))
    alternatives = frame(spark, "LINEAGE_NAME string, ALT_NAME string", ("A2", "A3"), ("A1", "other"), ("A1", None))
    return synonymy.profiles(lineages, hosts, vectors, references, morphology, alternatives), alternatives


def test_profiles_take_one_row_a_name(known):
    rows = {r.LINEAGE_NAME: r for r in known[0].collect()}
    assert set(rows) == {"A1", "A2", "A3", "C1", "D1", "E1", "F1"}
    a1, c1, f1 = rows["A1"], rows["C1"], rows["F1"]
    assert (a1.HOST_RECORDS, a1.VECTOR_RECORDS, a1.HOSTS, a1.REFERENCES, a1.COUNTRIES, a1.FIRST_YEAR, a1.MORPHO_LINKS, a1.ALT_NAMES, a1.BASES) == (1, 1, 1, 1, 2, 1999, 1, 1, 12)
    assert (c1.HOST_RECORDS, c1.HOSTS, c1.COUNTRIES, c1.REFERENCES, c1.FIRST_YEAR, c1.REFERENCE_NAMES, c1.BASES) == (3, 2, 1, 2, 1999, "R1; R2", 7)
    assert (f1.BASES, f1.HOST_RECORDS, f1.FIRST_YEAR, f1.REFERENCE_NAMES, f1.GENUS) == (0, 0, None, "", "")
    assert rows["A3"].ACCESSION == "" and rows["A3"].BASES == 12


def test_review_of_groups_containers_and_genera(spark, known):
    decisions = frame(spark, "LINEAGE_NAME string, DECISION string", ("C1", "keep"), ("X", "merge"))
    review = synonymy.synonymy_review(known[0], 12, known[1], decisions, floor=6, small=1, shared=1)
    assert len(review.columns) == 16 + 2 * len(synonymy.SIDE)
    rows = {(r.KIND, r.LINEAGE, r.OTHER): r for r in review.collect()}
    # A1 and A2 have two records each: the earlier year wins, so A1 outlives both
    doubles = {k[1:]: (r.PROPOSAL, r.PROPOSED_INTO) for k, r in rows.items() if k[0] == "duplicate"}
    assert doubles == {("A2", "A1"): ("merge: one sequence", "A1"), ("A3", "A1"): ("merge: one sequence", "A1"), ("A3", "A2"): ("merge: one sequence", "A1")}
    assert rows["duplicate", "A3", "A2"].ALREADY_ALT_NAME == "yes" and rows["duplicate", "A3", "A1"].ALREADY_ALT_NAME == ""
    c1 = rows["contained", "C1", "A1"]
    assert (c1.PROPOSAL, c1.PROPOSED_INTO, c1.N_CONTAINERS, c1.CONTAINERS, c1.COMPARABLE, c1.PRIOR_DECISION) == ("decide: several hold it", "", 3, "A1, A2, A3", 7, "keep")
    assert (c1.LINEAGE_PRIVATE, c1.OTHER_PRIVATE, c1.AMBIGUITY_CODE_MATCHES) == (0, 5, 1)
    assert rows["contained", "D1", "A1"].PROPOSAL == "decide: genera differ" and rows["contained", "D1", "A3"].PROPOSAL == "decide: several hold it"
    apart = [r for k, r in rows.items() if k[0] == "ambiguous"]
    assert {frozenset((r.LINEAGE, r.OTHER)) for r in apart} == {frozenset(("C1", "D1"))} and apart[0].PROPOSAL == "decide: genera differ"
    assert not any("E1" in k or "F1" in k for k in rows)
    told = synonymy.review_summary(review, floor=6).first()
    assert (told.n_pairs, told.n_duplicate, told.n_contained, told.n_ambiguous, told.n_proposed_merges, told.n_below_floor) == (10, 3, 6, 1, 3, 1)
    assert (told.n_lineages_in_pairs, told.n_contained_lineages, told.n_contained_unique, told.n_cross_genus, told.n_already_alt_name) == (5, 2, 0, 3, 1)


def test_report_counts_what_surplus_names_add(spark):
    pairs = frame(spark, "a string, b string, kind string", ("A", "B", "duplicate"), ("B", "C", "duplicate"), ("D", "E", "duplicate"), ("E", "F", "contained"))
    lineages = frame(spark, "LINEAGE_NAME string", *[(x,) for x in "ABCDEFG"])
    rows, counts = synonymy.synonymy_report(pairs, lineages)
    assert sorted(tuple(r) for r in rows.collect()) == [("A", "A", 3), ("A", "B", 3), ("A", "C", 3), ("D", "D", 2), ("D", "E", 2)]
    assert tuple(counts.first()) == (5, 2, 7, 75.0)
    none = synonymy.synonymy_report(pairs.limit(0), lineages)
    assert none[0].count() == 0 and tuple(none[1].first()) == (0, 0, 7, 0.0)
