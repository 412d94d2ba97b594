"""Sheets of a submission to rows of the store's tables, with notes for what has no home or needs a curator.

Every builder is a map over one sheet and joins with small aggregates of the others (one row a key), so a sheet of any size is read
once and no row is multiplied. Each returns the table's columns, ``line`` of the sheet and ``notes`` (array of text, empty if there is nothing to say).
Nulls are blanks. A blank is left blank rather than guessed: what the submission declares comes before what the store knows, for
lineages; for hosts and countries the store alone is asked. Columns beyond those named are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions import text as T


def _cell(name: str) -> Column:
    return T.py_strip(F.coalesce(F.col(name).cast("string"), F.lit("")))


def _lineage(name: str = "LINEAGE_NAME") -> Column:
    return F.coalesce(T.lineage_name(F.col(name)), F.lit(""))


def _notes(*told: Column) -> Column:
    return F.array_compact(F.array(*told))


def _first(df: DataFrame, key: list[str], value: Column, order: str, as_: str) -> DataFrame:
    """One row a key: the value of the first line that has one."""
    return df.withColumn("_v", value).filter("_v <> ''").groupBy(*key).agg(F.min_by("_v", order).alias(as_))


def _earliest(store: DataFrame, key: list[str], value: Column, has: Column, order: str) -> DataFrame:
    """One row a key: the value of the store's first row that has one, by ``order``, then by value."""
    return store.filter(has).groupBy(*key).agg(F.min_by(value, F.struct(F.col(order), value)).alias("v"))


def _looked_up(rows: DataFrame, table: DataFrame, on: list[str], as_: str) -> DataFrame:
    """``rows`` with the table's value for the columns ``on``, null without one or where the last of them is blank."""
    named = table.toDF(*[f"_{as_}{i}" for i in range(len(on))], as_)
    test = F.col(on[-1]) != ""
    for i, column in enumerate(on):
        test = test & (F.col(column) == F.col(f"_{as_}{i}"))
    return rows.join(named, test, "left").drop(*[f"_{as_}{i}" for i in range(len(on))])


def host_rows(hosts: DataFrame, sites: DataFrame, names: DataFrame, alternatives: DataFrame, store: DataFrame, submission: str, release: str, order: str = "RECORD_ID") -> DataFrame:
    """Detections to host records, with five back-fills.

    ``hosts`` (line, LINEAGE_NAME, HOST_SPECIES, COUNTRY_NAME, SITE_NAME, REFERENCE_NAME, NUMBER_TESTED, NUMBER_FOUND), ``sites`` (line, SITE_NAME,
    LATITUDE, LONGITUDE), ``names`` (line, LINEAGE_NAME, PARASITE_GENUS), ``alternatives`` (line, LINEAGE_NAME, REFERENCE_NAME, ALT_NAME), ``store``
    the host records so far, whose first row by ``order`` counts. Order and family come from the same species, else from its genus; the continent from the country;
    coordinates from the first readable line of the site; the parasite's genus as declared, else as the store has it; the study's
    own names of the lineage in sheet order, each once.
    """
    split = T.split_host(F.col("HOST_SPECIES"))
    rows = hosts.select(
        "line", _lineage().alias("LINEAGE_NAME"), F.coalesce(split["genus"], F.lit("")).alias("GENUS_NAME"), F.coalesce(split["binomial"], F.lit("")).alias("SPECIES_NAME"),
        _cell("COUNTRY_NAME").alias("COUNTRY_NAME"), _cell("SITE_NAME").alias("SITE_NAME"), T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME"),
        _cell("NUMBER_TESTED").alias("NUMBER_TESTED"), _cell("NUMBER_FOUND").alias("NUMBER_FOUND"),
    )
    place, has_place = F.struct(F.col("ORDER_NAME").alias("o"), F.col("FAMILY_NAME").alias("f")), (F.col("ORDER_NAME") != "") & (F.col("FAMILY_NAME") != "")
    genus, species, country = F.col("GENUS_NAME"), F.col("SPECIES_NAME"), F.col("COUNTRY_NAME")
    rows = _looked_up(rows, _earliest(store, ["GENUS_NAME", "SPECIES_NAME"], place, has_place, order), ["GENUS_NAME", "SPECIES_NAME"], "_exact")
    rows = _looked_up(rows, _earliest(store, ["GENUS_NAME"], place, has_place, order), ["GENUS_NAME"], "_coarse")
    rows = _looked_up(rows, _earliest(store, ["COUNTRY_NAME"], F.col("CONTINENT_NAME"), F.col("CONTINENT_NAME") != "", order), ["COUNTRY_NAME"], "_continent")
    lat, lon = T.parse_coordinate(_cell("LATITUDE"), True), T.parse_coordinate(_cell("LONGITUDE"), False)
    point = F.coalesce(F.concat(lat.cast("string"), F.lit(", "), lon.cast("string")), F.lit(""))
    rows = _looked_up(rows, _first(sites.withColumn("SITE_NAME", _cell("SITE_NAME")), ["SITE_NAME"], point, "line", "_p"), ["SITE_NAME"], "_point")
    declared = _first(names.withColumn("LINEAGE_NAME", _lineage()), ["LINEAGE_NAME"], F.coalesce(T.clean_genus(_cell("PARASITE_GENUS")), F.lit("")), "line", "_g")
    rows = _looked_up(rows, declared, ["LINEAGE_NAME"], "_declared")
    rows = _looked_up(rows, _earliest(store, ["LINEAGE_NAME"], F.col("PARASITE_GENUS"), F.col("PARASITE_GENUS") != "", order), ["LINEAGE_NAME"], "_held")
    own = alternatives.select("line", T.ref_published_form(_cell("REFERENCE_NAME")).alias("r"), _lineage().alias("l"), _cell("ALT_NAME").alias("a")).filter("a <> ''")
    first = own.groupBy("r", "l", "a").agg(F.min("line").alias("line"))
    listed = first.groupBy("r", "l").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "a"))), lambda x: x["a"]), ",").alias("_alt"))
    rows = _looked_up(rows, listed, ["REFERENCE_NAME", "LINEAGE_NAME"], "_alt")
    placed = F.coalesce("_exact", "_coarse")
    blank = lambda c: F.coalesce(c, F.lit(""))
    genus_of = F.coalesce("_declared", "_held")
    return rows.select(
        "line", "LINEAGE_NAME", "GENUS_NAME", "SPECIES_NAME", blank(placed["o"]).alias("ORDER_NAME"), blank(placed["f"]).alias("FAMILY_NAME"), "COUNTRY_NAME",
        blank(F.col("_continent")).alias("CONTINENT_NAME"), "SITE_NAME", blank(F.col("_point")).alias("SITE_COORDINATES"), "REFERENCE_NAME", blank(genus_of).alias("PARASITE_GENUS"),
        blank(F.col("_alt")).alias("ALT_NAME"), "NUMBER_TESTED", "NUMBER_FOUND", F.lit(submission).alias("_source"), F.lit(release).alias("_added"),
        _notes(
            F.when((genus != "") & placed.isNull(), F.concat(F.lit("host unknown: "), F.when(species != "", species).otherwise(genus))),
            F.when((F.col("SITE_NAME") != "") & F.col("_point").isNull(), F.concat(F.lit("site without coordinates: "), "SITE_NAME")),
            F.when((F.col("LINEAGE_NAME") != "") & genus_of.isNull(), F.concat(F.lit("lineage neither held nor declared: "), "LINEAGE_NAME")),
            F.when((country != "") & F.col("_continent").isNull(), F.concat(F.lit("country unknown: "), country)),
        ).alias("notes"),
    )


def lineage_rows(names: DataFrame, sequences: DataFrame, links: DataFrame, submission: str, release: str) -> DataFrame:
    """Declared lineages (line, LINEAGE_NAME, PARASITE_GENUS, ACCESSION) to lineage rows; lines without a name are left out.

    The sequence is the first of ``sequences`` (line, LINEAGE_NAME, SEQUENCE) for the name, cleaned; the species the first of ``links`` (line,
    LINEAGE_NAME, BINOMIAL), else a binomial typed as the genus, never one guessed from a genus. SEQ_LENGTH is a curator's word and stays blank.
    """
    cell = _cell("PARASITE_GENUS")
    rows = names.select("line", _lineage().alias("LINEAGE_NAME"), cell.alias("_cell"), T.accession_list(_cell("ACCESSION")).alias("_acc")).filter("LINEAGE_NAME <> ''")
    bases = _first(sequences.withColumn("LINEAGE_NAME", _lineage()), ["LINEAGE_NAME"], T.clean_sequence(F.coalesce("SEQUENCE", F.lit(""))), "line", "_s")
    named = links.withColumn("LINEAGE_NAME", _lineage()).withColumn("_b", F.coalesce(T.parasite_binomial(_cell("BINOMIAL")), F.lit("")))
    species = _first(named, ["LINEAGE_NAME"], F.col("_b"), "line", "_b1")
    several = named.filter("_b <> ''").groupBy("LINEAGE_NAME").agg((F.min("_b") != F.max("_b")).alias("_several"))
    rows = _looked_up(_looked_up(_looked_up(rows, bases, ["LINEAGE_NAME"], "_seq"), species, ["LINEAGE_NAME"], "_linked"), several, ["LINEAGE_NAME"], "_several")
    genus, typed = T.clean_genus(F.col("_cell")), T.parasite_binomial(F.col("_cell"))
    return rows.select(
        "line", "LINEAGE_NAME", F.coalesce(genus, F.lit("")).alias("GENUS_NAME"), F.coalesce("_linked", typed, F.lit("")).alias("SPECIES_NAME"), F.lit("").alias("SEQ_LENGTH"),
        F.array_join("_acc", ", ").alias("GENBANK_ACC"), F.coalesce("_seq", F.lit("")).alias("SEQUENCE"), F.lit(submission).alias("_source"), F.lit(release).alias("_added"),
        _notes(
            F.when(F.col("_seq").isNull(), "no sequence"),
            F.when(F.size("_acc") > 1, F.concat(F.lit("several accessions: "), F.size("_acc").cast("string"))),
            F.when((F.col("_cell") != "") & genus.isNull(), F.concat(F.lit("genus not recorded: "), "_cell")),
            F.when(F.coalesce("_several", F.lit(False)), "several species"),
        ).alias("notes"),
    )


def vector_rows(vectors: DataFrame, store: DataFrame, submission: str, release: str, order: str = "RECORD_ID") -> DataFrame:
    """Detections in vectors (line, LINEAGE_NAME, VECTOR_SPECIES, COUNTRY_NAME, REFERENCE_NAME) to vector rows; the continent from ``store``'s countries."""
    rows = vectors.select("line", _lineage().alias("LINEAGE_NAME"), T.norm_ws(_cell("VECTOR_SPECIES")).alias("VECTOR_SPECIES"), _cell("COUNTRY_NAME").alias("COUNTRY_NAME"), T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME"))
    rows = _looked_up(rows, _earliest(store, ["COUNTRY_NAME"], F.col("CONTINENT_NAME"), F.col("CONTINENT_NAME") != "", order), ["COUNTRY_NAME"], "_continent")
    return rows.select(
        "line", "LINEAGE_NAME", F.split("VECTOR_SPECIES", " ")[0].alias("GENUS_NAME"), "VECTOR_SPECIES", "COUNTRY_NAME", F.coalesce("_continent", F.lit("")).alias("CONTINENT_NAME"), "REFERENCE_NAME",
        F.lit(submission).alias("_source"), F.lit(release).alias("_added"),
        _notes(F.when(F.col("VECTOR_SPECIES") == "", "no vector"), F.when((F.col("COUNTRY_NAME") != "") & F.col("_continent").isNull(), F.concat(F.lit("country unknown: "), "COUNTRY_NAME"))).alias("notes"),
    )


def alternative_rows(alternatives: DataFrame, submission: str, release: str) -> DataFrame:
    """Other names of lineages, one row for each (lineage, name, reference), at its first line; blank names and a lineage's own name are left out."""
    rows = alternatives.select("line", _lineage().alias("LINEAGE_NAME"), _cell("ALT_NAME").alias("ALT_NAME"), T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME"))
    kept = rows.filter("LINEAGE_NAME <> '' and ALT_NAME <> '' and ALT_NAME <> LINEAGE_NAME").groupBy("LINEAGE_NAME", "ALT_NAME", "REFERENCE_NAME").agg(F.min("line").alias("line"))
    return kept.select("line", "LINEAGE_NAME", "ALT_NAME", "REFERENCE_NAME", F.lit(submission).alias("_source"), F.lit(release).alias("_added"), F.array().cast("array<string>").alias("notes"))


def morphology_rows(links: DataFrame, submission: str, release: str) -> DataFrame:
    """Links of lineages to described species (line, LINEAGE_NAME, BINOMIAL, REFERENCE_NAME, COMMENT), one for each (lineage, species, reference), at its first line."""
    rows = links.select(
        "line", _lineage().alias("LINEAGE_NAME"), F.coalesce(T.parasite_binomial(_cell("BINOMIAL")), T.norm_ws(_cell("BINOMIAL"))).alias("SPECIES_NAME"),
        T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME"), T.norm_ws(_cell("COMMENT")).alias("MORPHOLOGY_COMMENT"), T.parasite_binomial(_cell("BINOMIAL")).isNull().alias("_odd"),
    ).filter("LINEAGE_NAME <> '' and SPECIES_NAME <> ''")
    key = ["LINEAGE_NAME", "SPECIES_NAME", "REFERENCE_NAME"]
    one = rows.groupBy(*key).agg(F.min("line").alias("line"), F.min_by("MORPHOLOGY_COMMENT", "line").alias("MORPHOLOGY_COMMENT"), F.max("_odd").alias("_odd"))
    return one.select("line", *key, "MORPHOLOGY_COMMENT", F.lit(submission).alias("_source"), F.lit(release).alias("_added"), _notes(F.when(F.col("_odd"), F.concat(F.lit("not a species of a recorded genus: "), "SPECIES_NAME"))).alias("notes"))


def reference_rows(references: DataFrame, store: DataFrame, submission: str, release: str) -> DataFrame:
    """Studies (line, REFERENCE_NAME, TITLE, DOI) that the store lacks, under the name it would give them; one row a name, at its first line."""
    rows = references.select("line", T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME"), T.norm_ws(_cell("TITLE")).alias("TITLE"), F.coalesce(T.normalize_doi(_cell("DOI")), F.lit("")).alias("DOI"), T.norm_ws(_cell("REFERENCE_NAME")).alias("_was"))
    first = rows.filter("REFERENCE_NAME <> ''").groupBy("REFERENCE_NAME").agg(F.min_by(F.struct("line", "TITLE", "DOI", "_was"), "line").alias("r"))
    new = first.join(store.select(T.ref_published_form(_cell("REFERENCE_NAME")).alias("REFERENCE_NAME")).distinct(), "REFERENCE_NAME", "left_anti")
    year = F.regexp_extract("REFERENCE_NAME", r"([0-9]{4})[a-z]?$", 1)
    return new.select(
        "r.line", "REFERENCE_NAME", year.alias("PUBLICATION_YEAR"), "r.TITLE", "r.DOI", F.lit(submission).alias("_source"), F.lit(release).alias("_added"),
        _notes(F.when(F.col("r._was") != F.col("REFERENCE_NAME"), F.concat(F.lit("respelled: "), "r._was")), F.when(F.col("r.TITLE") == "", "no title")).alias("notes"),
    )


def genome_rows(genomes: DataFrame, submission: str, release: str) -> DataFrame:
    """Genomic resources (line, LINEAGE_NAME, RESOURCE_TYPE, ACCESSION), one row for each accession; a resource without one keeps its row and a note."""
    rows = genomes.select("line", _lineage().alias("LINEAGE_NAME"), F.lower(T.norm_ws(_cell("RESOURCE_TYPE"))).alias("RESOURCE_TYPE"), T.accession_list(_cell("ACCESSION")).alias("_acc")).filter("LINEAGE_NAME <> ''")
    each = rows.select("*", F.explode_outer("_acc").alias("_one"))
    return each.select(
        "line", "LINEAGE_NAME", "RESOURCE_TYPE", F.coalesce("_one", F.lit("")).alias("ACCESSION"), F.coalesce(T.accession_class(F.col("_one")), F.lit("")).alias("ARCHIVE"), F.lit(submission).alias("_source"), F.lit(release).alias("_added"),
        _notes(F.when(F.col("_one").isNull(), "no accession").when(T.accession_class(F.col("_one")).isNull(), F.concat(F.lit("not an accession: "), "_one"))).alias("notes"),
    )
