"""All checks of a submission: several sheets, what the store says about their rows, and one registry over all of them.

A submission is a set of sheets (tables by name), the store another. Facts are looked up once for each sheet and become columns;
checks are declared over those columns. Whatever was not supplied (a sheet, a table of the store, the verdicts of a costly operator)
leaves its column out, and the checks that need it say that they did not run: "nobody looked" is never told as "passed".

Sheets (``row`` identifies a row, ``document`` its submission; both may repeat or be null)::

    records        document, row, LINEAGE_NAME, SPECIES_NAME, COUNTRY_NAME, NUMBER_FOUND, NUMBER_TESTED, COMMENT
    vectors        row, VECTOR_SPECIES
    names          row, LINEAGE_NAME, HOST_SPECIES, PARASITE_GENUS, ACCESSION
    sequences      row, LINEAGE_NAME, SEQUENCE
    accessions     row, ACCESSION, LINEAGE_NAME
    genomes        row, LINEAGE_NAME, RESOURCE_TYPE, ACCESSION
    morphospecies  row, LINEAGE_NAME, BINOMIAL
    sites          row, LATITUDE, LONGITUDE
    references     document, row, REFERENCE_NAME
    changes        row, WAS, NOW
    headers        row, FOUND_BY ('label' or 'position')

Store: lineages (LINEAGE_NAME, ACCESSION), hosts (SPECIES_NAME, COUNTRY_NAME), vectors (VECTOR_SPECIES), references (REFERENCE_NAME),
claimed (LINEAGE_NAME: names that other open submissions hold), available (ACCESSION: publicly retrievable).

Evidence, verdicts of operators by row, joined by ``row``: ``sequences`` (identity, offset_lost, twins, qc), ``sites`` (verdict),
``genomes`` (barcode), ``records`` (host_match, geography, recorded).

Nulls are blanks; blanks are not looked up. Columns beyond those named are carried and ignored. Lookups join distinct keys of the
store, so rows are never multiplied and a broadcast is chosen by size; a frequent key of the rows is divided by adaptive execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import sequences as S
from curaspark.functions import text as T
from curaspark.operators import checks
from curaspark.operators.checks import Check
from curaspark.operators.quality import held_by_others
from curaspark.operators.sequences import all_pairs_compatible, compatible_references
from curaspark.operators.shared import stored

# Kinds of genomic resources, words that speak of morphology.
RESOURCE_TYPES = ("mitogenome", "mitogenome_partial", "nuclear_genome", "apicoplast_genome", "transcriptome", "other")
MORPHOLOGY = "(?i)morpholog|gametocyte|blood smear"
#: Length of the barcode window.
WINDOW = 479
#: Flags of the sequence screen that only tell how far a sequence is from known ones, or what the screen did.
_DISTANCE = "(near_known|divergent|_vs_nearest_lineage|placed_in|exact_match|contains_unknown_amino_acid)"


def _plain(name: str) -> Column:
    return T.norm_ws(F.coalesce(F.col(name).cast("string"), F.lit("")))


def _lineage(name: str = "LINEAGE_NAME") -> Column:
    return F.coalesce(T.lineage_name(F.col(name)), F.lit(""))


def _accession(name: str = "ACCESSION") -> Column:
    """Upper case without a version, as accessions are compared."""
    return F.regexp_replace(F.upper(_plain(name)), r"\.[0-9]+$", "")


def _genus(name: str) -> Column:
    return F.split(_plain(name), " ")[0]


# What each sheet is read as before anything is looked up: column -> expression.
_READ = {
    "records": {"lineage": _lineage, "species": lambda: T.norm_species(_plain("SPECIES_NAME")), "country": lambda: T.norm_country(_plain("COUNTRY_NAME")), "comment": lambda: _plain("COMMENT")},
    "vectors": {"species": lambda: _plain("VECTOR_SPECIES"), "genus": lambda: _genus("VECTOR_SPECIES")},
    "names": {"lineage": _lineage, "stems": lambda: T.host_acronyms(_plain("HOST_SPECIES")), "genus_cell": lambda: _plain("PARASITE_GENUS"), "accessions": lambda: T.accession_list(_plain("ACCESSION"))},
    "sequences": {"lineage": _lineage, "bases": lambda: T.clean_sequence(F.coalesce("SEQUENCE", F.lit("")))},
    "accessions": {"accession": _accession, "lineage": _lineage},
    "genomes": {"lineage": _lineage, "kind": lambda: F.lower(_plain("RESOURCE_TYPE")), "accessions": lambda: T.accession_list(_plain("ACCESSION"))},
    "morphospecies": {"lineage": _lineage, "binomial": lambda: _plain("BINOMIAL")},
    "sites": {"latitude": lambda: _plain("LATITUDE"), "longitude": lambda: _plain("LONGITUDE")},
    "references": {"reference": lambda: _plain("REFERENCE_NAME"), "marked": lambda: T.ref_is_unpublished(_plain("REFERENCE_NAME")), "key": lambda: T.ref_published_form(_plain("REFERENCE_NAME"))},
    "changes": {"was": lambda: F.col("WAS"), "now": lambda: F.col("NOW")},
    "headers": {"found_by": lambda: _plain("FOUND_BY")},
}


def _malformed(accessions: str, kinds: tuple[str, ...]) -> Column:
    """Whether any accession of the list is of none of the kinds."""
    return F.exists(accessions, lambda a: ~F.coalesce(T.accession_class(a).isin(*kinds), F.lit(False)))


def _has(column: str):
    return lambda: F.col(column) != ""


_GENERA = ("Plasmodium", "Haemoproteus", "Leucocytozoon")

#: Every check by sheet, in the order in which they are told.
RULES: dict[str, list[Check]] = {
    "documents": [
        Check("records_unlinked", lambda: F.col("unlinked") > 0, applies=lambda: F.col("records") > 0, needs=("unlinked",)),
        Check("reference_missing", lambda: F.col("references") == 0, blocking=True, needs=("references",)),
    ],
    "records": [
        Check("prevalence_sanity", lambda: (F.coalesce(F.least("NUMBER_FOUND", "NUMBER_TESTED"), F.lit(0)) < 0) | F.coalesce(F.col("NUMBER_FOUND") > F.col("NUMBER_TESTED"), F.lit(False)), blocking=True, needs=("NUMBER_FOUND", "NUMBER_TESTED")),
        Check("prevalence_numerator_alone", lambda: F.col("NUMBER_TESTED").isNull(), applies=lambda: F.col("NUMBER_FOUND").isNotNull(), needs=("NUMBER_FOUND", "NUMBER_TESTED")),
        Check("lineage_known", lambda: ~F.col("lineage_held"), applies=_has("lineage"), needs=("lineage_held",)),
        Check("host_binomial", lambda: ~F.col("host_held"), applies=_has("species"), needs=("host_held",)),
        Check("new_country", lambda: ~F.col("country_held"), applies=_has("country"), needs=("country_held",)),
        Check("record_without_country", lambda: F.col("country") == "", needs=("country",)),
        Check("record_without_prevalence", lambda: F.col("NUMBER_FOUND").isNull() | F.col("NUMBER_TESTED").isNull(), needs=("NUMBER_FOUND", "NUMBER_TESTED")),
        Check("comment_mentions_morphology", lambda: F.col("comment").rlike(MORPHOLOGY), applies=_has("comment"), needs=("comment",)),
        Check("host_name_resolves", lambda: F.col("host_match") == "none", applies=lambda: F.col("host_match").isNotNull(), needs=("host_match",)),
        Check("host_geography_plausible", lambda: F.col("geography") != "known", applies=lambda: F.col("geography").isNotNull(), needs=("geography",)),
        Check("lineage_previously_recorded", lambda: ~F.col("recorded"), applies=lambda: F.col("recorded").isNotNull(), needs=("recorded",)),
    ],
    "vectors": [Check("vector_sanity", lambda: ~F.col("genus_held"), applies=_has("species"), needs=("genus_held",))],
    "names": [
        Check("name_malformed", lambda: T.name_malformed(F.col("lineage"), F.col("stems")), applies=_has("lineage"), needs=("stems",)),
        Check("name_already_in_store", lambda: F.col("lineage_held"), applies=_has("lineage"), needs=("lineage_held",)),
        Check("name_claimed_by_another_submission", lambda: F.col("lineage_claimed"), applies=_has("lineage"), needs=("lineage_claimed",)),
        Check("accession_malformed", lambda: _malformed("accessions", ("nucleotide",)), applies=lambda: F.size("accessions") > 0, needs=("accessions",)),
        Check("lineage_without_sequence", lambda: ~F.col("has_sequence"), blocking=True, applies=_has("lineage"), needs=("has_sequence",)),
        Check("lineage_without_host_record", lambda: ~F.col("has_record"), applies=_has("lineage"), needs=("has_record",)),
        Check("parasite_genus_carries_species", lambda: T.parasite_binomial(F.col("genus_cell")).isNotNull(), applies=_has("genus_cell"), needs=("genus_cell",)),
        Check("parasite_genus_unrecognized", lambda: T.clean_genus(F.col("genus_cell")).isNull(), applies=_has("genus_cell"), needs=("genus_cell",)),
    ],
    "sequences": [
        Check("sequence_is_known_lineage", lambda: F.col("identity") == "known", blocking=True, applies=lambda: F.col("identity").isNotNull(), needs=("identity",)),
        Check("sequence_completes_known_lineage", lambda: F.col("identity") == "completes", applies=lambda: F.col("identity").isNotNull(), needs=("identity",)),
        Check("sequence_identity_unresolved", lambda: F.col("identity") == "unresolved", blocking=True, applies=lambda: F.col("identity").isNotNull(), needs=("identity",)),
        Check("sequence_unplaceable", lambda: F.col("identity") == "unplaceable", blocking=True, applies=lambda: F.col("identity").isNotNull(), needs=("identity",)),
        Check("sequence_needs_reframing", lambda: F.col("offset_lost") > 0, applies=lambda: F.col("offset_lost").isNotNull(), needs=("offset_lost",)),
        Check("sequence_stop_codon", lambda: S.count_stops(F.col("bases")) > 0, applies=_has("bases"), needs=("bases",)),
        Check("sequence_longer_than_window", lambda: F.length(F.regexp_replace("bases", "[^A-Z]", "")) > WINDOW, applies=_has("bases"), needs=("bases",)),
        Check("sequence_not_iupac", lambda: F.col("bases").rlike("[^ACGTURYSWKMBDHVN.~-]"), applies=_has("bases"), needs=("bases",)),
        Check("sequences_identical_within_submission", lambda: F.col("twins") > 0, blocking=True, applies=lambda: F.col("twins").isNotNull(), needs=("twins",)),
        Check("sequence_without_declaration", lambda: ~F.col("declared"), needs=("declared",)),
        Check("sequence_qc", lambda: F.exists("qc", lambda q: ~q.rlike(_DISTANCE)), applies=lambda: F.col("qc").isNotNull(), needs=("qc",)),
    ],
    "accessions": [
        Check("accession_format", lambda: ~F.coalesce(T.accession_class(F.col("accession")) == "nucleotide", F.lit(False)), applies=_has("accession"), needs=("accession",)),
        Check("accession_collision", lambda: F.col("filed_elsewhere"), applies=_has("accession"), needs=("filed_elsewhere",)),
        Check("accession_resolves", lambda: ~F.col("retrievable"), applies=_has("accession"), needs=("retrievable",)),
    ],
    "genomes": [
        Check("genome_lineage_unknown", lambda: ~(F.col("lineage_held") | F.col("declared")), needs=("lineage_held", "declared")),
        Check("genome_resource_type_unknown", lambda: ~F.col("kind").isin(*RESOURCE_TYPES), needs=("kind",)),
        Check("genome_accession_malformed", lambda: _malformed("accessions", ("nucleotide", "assembly", "project", "reads")), applies=lambda: F.size("accessions") > 0, needs=("accessions",)),
        Check("genome_accession_unresolved", lambda: F.col("unretrievable") > 0, applies=lambda: F.size("accessions") > 0, needs=("unretrievable",)),
        Check("genome_cytb_mismatch", lambda: F.col("barcode") == "another lineage", blocking=True, applies=lambda: F.col("barcode").isNotNull(), needs=("barcode",)),
        Check("genome_without_barcode", lambda: F.col("barcode") == "no barcode", applies=lambda: F.col("barcode").isNotNull(), needs=("barcode",)),
    ],
    "morphospecies": [
        Check("morphospecies_lineage_unknown", lambda: ~(F.col("lineage_held") | F.col("declared")), needs=("lineage_held", "declared")),
        Check("morphospecies_binomial_malformed", lambda: ~F.coalesce(F.col("binomial").rlike(f"^({'|'.join(_GENERA)}) [a-z][a-z-]+$"), F.lit(False)), needs=("binomial",)),
    ],
    "sites": [
        Check("site_coordinates_unreadable", lambda: T.parse_coordinate(F.col("latitude"), True).isNull() | T.parse_coordinate(F.col("longitude"), False).isNull(), applies=lambda: (F.col("latitude") != "") | (F.col("longitude") != ""), needs=("latitude", "longitude")),
        Check("site_outside_country", lambda: F.col("verdict") == "outside", applies=lambda: F.col("verdict").isNotNull(), needs=("verdict",)),
        Check("site_country_not_in_atlas", lambda: F.col("verdict") == "unknown", applies=lambda: F.col("verdict").isNotNull(), needs=("verdict",)),
    ],
    "references": [
        Check("reference_name_form", lambda: F.col("key") != F.col("reference"), applies=lambda: ~F.col("marked") & T.ref_is_citation_key(F.col("reference")), needs=("key",)),
        Check("reference_already_in_store", lambda: F.col("reference_held"), applies=_has("key"), needs=("reference_held",)),
        Check("reference_unpubl_malformed", lambda: ~F.col("marked"), applies=lambda: F.lower("reference").contains("unpub"), needs=("marked",)),
        Check("reference_unpubl_form", lambda: F.col("key") != F.col("reference"), applies=lambda: F.col("marked"), needs=("key",)),
        Check("reference_name_unrecognized", lambda: ~T.ref_is_citation_key(F.col("reference")), applies=lambda: (F.col("reference") != "") & ~F.col("marked") & ~F.lower("reference").contains("unpub"), needs=("marked",)),
    ],
    "changes": [Check("values_normalized", lambda: ~F.col("was").eqNullSafe(F.col("now")), needs=("was", "now"))],
    "headers": [Check("headers_intact", lambda: F.col("found_by") != "label", needs=("found_by",))],
}


def _read(sheets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sheets with their normalised columns; columns that a sheet lacks are blank."""

    def one(name: str, df: DataFrame) -> DataFrame:
        named = {"records": ["document", "COMMENT"], "names": ["HOST_SPECIES", "PARASITE_GENUS", "ACCESSION"], "references": ["document"], "accessions": ["LINEAGE_NAME"]}
        for column in named.get(name, []):
            if column not in df.columns:
                df = df.withColumn(column, F.lit(""))
        return df.withColumns({c: make() for c, make in _READ[name].items()})

    return {name: one(name, df) for name, df in sheets.items()}


def _documents(read: dict[str, DataFrame]) -> DataFrame:
    """(document, records, unlinked, references) of every document that any sheet names; counts of a sheet not there are absent."""
    parts, counts = [], []
    blank = F.lit(0).cast("long")
    if "records" in read:
        parts.append(read["records"].select("document", F.lit(1).alias("records"), (F.col("lineage") == "").cast("long").alias("unlinked"), blank.alias("references")))
        counts += ["records", "unlinked"]
    if "references" in read:
        parts.append(read["references"].select("document", blank.alias("records"), blank.alias("unlinked"), (F.col("reference") != "").cast("long").alias("references")))
        counts.append("references")
    return reduce(DataFrame.unionByName, parts).groupBy("document").agg(*[F.sum(c).alias(c) for c in counts])


def prepared(sheets: dict[str, DataFrame], store: dict[str, DataFrame], evidence: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The sheets with every fact that the tables at hand can tell, ready for :data:`RULES`."""
    out = _read(sheets)
    held = {}
    if "lineages" in store:
        held["lineages"] = store["lineages"].select(_lineage().alias("lineage")).filter("lineage <> ''")
    if "hosts" in store:
        held["species"] = store["hosts"].select(T.norm_species(_plain("SPECIES_NAME")).alias("species")).filter("species <> ''")
        held["countries"] = store["hosts"].select(T.norm_country(_plain("COUNTRY_NAME")).alias("country")).filter("country <> ''")
    if "vectors" in store:
        held["genera"] = store["vectors"].select(_genus("VECTOR_SPECIES").alias("genus")).filter("genus <> ''")
    if "references" in store:
        held["references"] = store["references"].select(T.ref_published_form(_plain("REFERENCE_NAME")).alias("key")).filter("key <> ''")
    if "claimed" in store:
        held["claimed"] = store["claimed"].select(_lineage().alias("lineage")).filter("lineage <> ''")
    if "available" in store:
        held["available"] = store["available"].select(_accession().alias("accession")).filter("accession <> ''")
    for sheet, of in (("names", "declared"), ("sequences", "sequenced"), ("records", "recorded")):
        if sheet in out:
            rows = out[sheet].filter("bases <> ''") if sheet == "sequences" else out[sheet]
            held[of] = rows.select("lineage").filter("lineage <> ''")
    wanted = [
        ("records", "lineage_held", "lineages", "lineage"), ("records", "host_held", "species", "species"), ("records", "country_held", "countries", "country"),
        ("vectors", "genus_held", "genera", "genus"), ("names", "lineage_held", "lineages", "lineage"), ("names", "lineage_claimed", "claimed", "lineage"),
        ("names", "has_sequence", "sequenced", "lineage"), ("names", "has_record", "recorded", "lineage"), ("sequences", "declared", "declared", "lineage"),
        ("accessions", "retrievable", "available", "accession"), ("genomes", "lineage_held", "lineages", "lineage"), ("genomes", "declared", "declared", "lineage"),
        ("morphospecies", "lineage_held", "lineages", "lineage"), ("morphospecies", "declared", "declared", "lineage"), ("references", "reference_held", "references", "key"),
    ]
    for sheet, fact, table, key in wanted:
        if sheet in out and table in held:
            out[sheet] = checks.looked_up(out[sheet], {fact: (held[table], [key])})
    if "accessions" in out and "lineages" in store and "ACCESSION" in store["lineages"].columns:
        filed = store["lineages"].select(F.explode(T.accession_list(_plain("ACCESSION"))).alias("ACCESSION"), _lineage().alias("lineage")).select(_accession().alias("accession"), "lineage")
        out["accessions"] = held_by_others(out["accessions"], filed, ["accession"], "lineage", "filed_elsewhere")
    if "genomes" in out and "available" in held:
        out["genomes"] = _unretrievable(out["genomes"], held["available"])
    for sheet, verdicts in (evidence or {}).items():
        if sheet in out:
            out[sheet] = out[sheet].join(verdicts, "row", "left")
    if {"records", "references"} & set(out):
        out["documents"] = _documents(out)
    return out


def _unretrievable(genomes: DataFrame, available: DataFrame) -> DataFrame:
    """``genomes`` with how many of a row's accessions can't be retrieved; rows are told apart by their list, so no row id is needed."""
    lists = genomes.select("accessions").distinct()
    each = lists.select("accessions", F.explode("accessions").alias("a")).select("accessions", F.regexp_replace("a", r"\.[0-9]+$", "").alias("accession"))
    missing = checks.looked_up(each, {"there": (available, ["accession"])}).groupBy("accessions").agg(F.sum((~F.col("there")).cast("long")).alias("unretrievable"))
    return genomes.join(missing, "accessions", "left").withColumn("unretrievable", F.coalesce("unretrievable", F.lit(0)))


def results(ready: dict[str, DataFrame]) -> DataFrame:
    """(sheet, check, evaluated, passed, findings, outcome, skipped) of every check of :data:`RULES`: one pass over each sheet."""
    parts = []
    for sheet, rules in RULES.items():
        if sheet in ready:
            parts.append(checks.results(ready[sheet], rules).select(F.lit(sheet).alias("sheet"), "*"))
    spark = next(iter(ready.values())).sparkSession
    absent = [(s, c.name, 0, 0, 0, "not run", f"no sheet {s}") for s, rules in RULES.items() if s not in ready for c in rules]
    if absent:
        parts.append(spark.createDataFrame(absent, "sheet string, check string, evaluated long, passed long, findings long, outcome string, skipped string"))
    return reduce(DataFrame.unionByName, parts)


def findings(ready: dict[str, DataFrame]) -> DataFrame:
    """(sheet, check, row) of every finding; a document's row is its name."""
    parts = []
    for sheet, rules in RULES.items():
        if sheet in ready:
            rows = ready[sheet].withColumn("row", F.col("document")) if sheet == "documents" else ready[sheet]
            parts.append(checks.findings(rows.withColumn("row", F.col("row").cast("string")), rules, "row").select(F.lit(sheet).alias("sheet"), "*"))
    return reduce(DataFrame.unionByName, parts)


def sequence_evidence(sequences: DataFrame, store: DataFrame, width: int, least: int) -> DataFrame:
    """(row, identity, offset_lost, twins) of placed sequences (row, LINEAGE_NAME, SEQUENCE, optional OFFSET) against a store (name, seq).

    known: agrees with a stored sequence over ``least`` positions; completes: and determines more bases than it; unresolved: agrees,
    but over fewer positions; unplaceable: no base stands in the window; else new. ``twins`` counts rows of the sheet that agree with the
    row under another name. Equal texts are compared once and counted by name, so copies never make pairs.
    """
    offset = F.col("OFFSET") if "OFFSET" in sequences.columns else F.lit(0)
    cleaned = T.clean_sequence(F.coalesce("SEQUENCE", F.lit("")))
    rows = sequences.select(F.col("row").alias("name"), _lineage().alias("lineage"), cleaned.alias("raw"), offset.cast("int").alias("offset"))
    rows = rows.withColumn("seq", S.place_in_window(F.col("raw"), F.col("offset"), width))
    bases = lambda c: F.length(F.regexp_replace(F.upper(c), "[^ACGT]", ""))
    counts = stored(rows.groupBy("seq", "lineage").agg(F.count("*").alias("n"), F.min("name").alias("one")))
    texts = stored(counts.groupBy("seq").agg(F.min("one").alias("name")))
    met = compatible_references(texts.select("name", "seq"), store.select("name", "seq"), width, min_shared=1)
    stored_bases = store.groupBy("name").agg(F.max(bases("seq")).alias("had"))
    agreeing = met.select(F.col("query").alias("name"), "comparable", F.explode("names").alias("ref")).join(stored_bases.withColumnRenamed("name", "ref"), "ref")
    best = agreeing.groupBy("name").agg(F.max("comparable").alias("comparable"), F.max(F.when(F.col("comparable") >= least, F.col("had"))).alias("had"))
    told = texts.join(best, "name", "left").select("seq", "comparable", "had")
    identity = (
        F.when(bases("seq") == 0, "unplaceable")
        .when(F.col("comparable") >= least, F.when(bases("seq") > F.col("had"), "completes").otherwise("known"))
        .when(F.col("comparable") > 0, "unresolved")
        .otherwise("new")
    )
    pairs = all_pairs_compatible(texts.filter(bases("seq") > 0), "name", "seq", width, min_shared=least).select("a", "b")
    itself = texts.filter(bases("seq") >= least).select(F.col("name").alias("a"), F.col("name").alias("b"))
    near = pairs.union(pairs.select("b", "a")).union(itself)
    held = counts.join(texts, "seq").select(F.col("name").alias("b"), "lineage", "n")
    reach = near.join(held, "b").groupBy("a", "lineage").agg(F.sum("n").alias("own"))
    total = reach.groupBy("a").agg(F.sum("own").alias("total"))
    twins = reach.join(total, "a").join(texts.select("seq", F.col("name").alias("a")), "a").select("seq", "lineage", (F.col("total") - F.col("own")).alias("twins"))
    out = rows.join(told, "seq", "left").join(twins, ["seq", "lineage"], "left")
    lost = bases("raw") - bases("seq")
    return out.select(F.col("name").alias("row"), identity.alias("identity"), lost.alias("offset_lost"), F.coalesce("twins", F.lit(0)).alias("twins"))
