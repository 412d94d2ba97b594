"""Sources and sinks of the record store: release tables, store tables, sequences, flat files, feeds."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.spec import SPECS, TableSpec


def schema_drift(columns: list[str], spec: TableSpec) -> dict[str, list[str]]:
    """Columns that a source lacks, and those that the spec does not know."""
    return {"missing": [c for c in spec.columns if c not in columns], "unexpected": [c for c in columns if c not in spec.columns and c not in ("RECORD_ID", "_source", "_added")]}


def scan_release(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """One release table: all text, blanks for nulls, a byte-order mark dropped; a missing column is an error."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    names = [c.lstrip("﻿") for c in raw.columns]
    raw = raw.toDF(*names)
    drift = schema_drift(names, spec)
    if drift["missing"]:
        raise ValueError(f"{spec.name}: missing columns {drift['missing']}")
    return raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in spec.columns])


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scan_store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of a store as Parquet; one that is not there is empty."""
    found = {}
    for name, spec in SPECS.items():
        path = f"{folder}/{name}.parquet"
        found[name] = spark.read.parquet(path) if _exists(spark, path) else spark.createDataFrame([], spec.schema(provenance=True))
    return found


def store_populated(store: dict[str, DataFrame]) -> bool:
    return any(not df.isEmpty() for df in store.values())


def write_store(store: dict[str, DataFrame], folder: str) -> None:
    """Each table in its column order, sorted by natural key then id; written beside, then put in place.

    The old table is renamed aside before the new one takes its name and deleted only then, so a crash loses neither.
    """
    for name, df in store.items():
        spec = SPECS[name]
        columns = ["RECORD_ID", *spec.columns, "_source", "_added"]
        order = [*spec.key, "RECORD_ID"]
        ordered = df.select(*[c for c in columns if c in df.columns]).repartitionByRange(*order).sortWithinPartitions(*order)
        staging, target = f"{folder}/_staging/{name}.parquet", f"{folder}/{name}.parquet"
        ordered.write.mode("overwrite").parquet(staging)
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        aside = path(f"{folder}/_staging/{name}.old.parquet")
        fs.delete(aside, True)
        if fs.exists(path(target)):
            fs.rename(path(target), aside)
        fs.rename(path(staging), path(target))
        fs.delete(aside, True)


def write_release(store: dict[str, DataFrame], folder: str) -> None:
    """Public columns only, blanks as nulls; an empty table is written too."""
    for name, df in store.items():
        spec = SPECS[name]
        df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in spec.columns]).write.mode("overwrite").option("header", True).option("escape", "\"").csv(f"{folder}/{name}")


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence): the first word of each header and its letters in upper case."""
    raw = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    head = F.split("value", r"\r?\n", 2)
    return raw.select(F.split(F.trim(head[0]), r"\s+")[0].alias("name"), F.upper(F.regexp_replace(F.coalesce(F.get(head, 1), F.lit("")), r"\s", "")).alias("sequence"))


def to_fasta(lineages: DataFrame, prefix: str = "P", width: int = 60) -> DataFrame:
    """One text per lineage with a sequence: tip label and wrapped letters."""
    from curaspark.functions.text import fasta_label

    word = lambda c, k: F.coalesce(F.get(F.split(F.col(c), " "), k), F.lit("")) if c in lineages.columns else F.lit("")
    label = fasta_label(F.lit(prefix), F.col("LINEAGE_NAME"), word("GENUS_NAME", 0), word("SPECIES_NAME", 1))
    return lineages.filter("SEQUENCE <> ''").select(F.concat(F.lit(">"), label, F.lit("\n"), F.regexp_replace("SEQUENCE", f"(.{{{width}}})(?=.)", "$1\n")).alias("value"))


def scan_genbank(spark: SparkSession, path: str) -> DataFrame:
    """A row for each flat-file record; one large file is read by all tasks, cut between records.

    accession, version, length, definition, organism, host and sequence are single values (the first); organelle, strain and
    isolate too. keywords and references (title, journal, pubmed) are arrays, dblink a map; features has every (kind, location)
    and qualifiers every (key, value), repeated ones too, lines of one value joined.
    """
    raw = spark.read.option("lineSep", "\n//").text(path).filter(F.col("value").contains("LOCUS"))
    flat = lambda c: F.regexp_replace(F.trim(c), r"\s+", " ")
    get = lambda pattern: F.trim(F.regexp_extract("value", pattern, 1))
    letters = F.regexp_extract("value", r"(?s)\nORIGIN[^\n]*\n(.*)$", 1)
    # a value may run over lines; the next field begins in column 0
    block = lambda name: F.regexp_extract("value", rf"(?s)\n{name}\s+(.*?)\n(?=[A-Z/]|$)", 1)
    found = F.regexp_extract_all("value", F.lit(r'(?s)\n {21}/(\w+="[^"]*"|\w+=[^\n"]+|\w+)'), F.lit(1))
    pair = lambda q: F.struct(F.regexp_extract(q, r"^(\w+)", 1).alias("key"), flat(F.regexp_extract(q, r'(?s)^\w+="?([^"]*)"?$', 1)).alias("value"))
    features = F.regexp_extract_all("value", F.lit(r"\n {5}(\S+ +\S+(?:\n {21}[^/\s]\S*)*)"), F.lit(1))
    feature = lambda f: F.struct(F.regexp_extract(f, r"^(\S+)", 1).alias("kind"), F.regexp_replace(F.regexp_extract(f, r"(?s)^\S+ +(.*)$", 1), r"\s", "").alias("location"))
    papers = F.regexp_extract_all("value", F.lit(r"(?s)\nREFERENCE (.*?)(?=\n[A-Z/]|$)"), F.lit(1))
    within = lambda r, name: flat(F.regexp_extract(r, rf"(?s)\n  *{name} +(.*?)(?=\n {{1,9}}[A-Z]|$)", 1))
    paper = lambda r: F.struct(within(r, "TITLE").alias("title"), within(r, "JOURNAL").alias("journal"), within(r, "PUBMED").alias("pubmed"))
    words = lambda c, by: F.filter(F.transform(F.split(c, by), lambda w: F.trim(w)), lambda w: w != "")
    links = F.filter(F.transform(F.split(block("DBLINK"), "\n"), lambda w: F.trim(w)), lambda w: w.contains(":"))
    first = lambda key: F.coalesce(F.get(F.transform(F.filter("qualifiers", lambda q: q["key"] == key), lambda q: q["value"]), 0), F.lit(""))
    read = raw.select("value", F.transform(found, pair).alias("qualifiers"))
    return read.select(
        get(r"\nACCESSION\s+(\S+)").alias("accession"),
        get(r"\nVERSION\s+(\S+)").alias("version"),
        get(r"LOCUS\s+\S+\s+(\d+) bp").try_cast("int").alias("length"),
        flat(block("DEFINITION")).alias("definition"),
        get(r"\n\s+ORGANISM\s+([^\n]+)").alias("organism"),
        F.when(first("host") != "", first("host")).otherwise(get(r'/host="([^"]+)"')).alias("host"),
        F.upper(F.regexp_replace(letters, r"[^A-Za-z]", "")).alias("sequence"),
        *[first(k).alias(k) for k in ("organelle", "strain", "isolate")],
        words(F.regexp_replace(flat(block("KEYWORDS")), r"[.]$", ""), ";").alias("keywords"),
        F.transform(papers, paper).alias("references"),
        F.map_from_entries(F.transform(links, lambda w: F.struct(F.trim(F.substring_index(w, ":", 1)).alias("k"), F.trim(F.regexp_replace(w, "^[^:]*:", "")).alias("v")))).alias("dblink"),
        F.transform(features, feature).alias("features"),
        "qualifiers",
    )


def scan_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(admin, rings) of GeoJSON polygons and multi-polygons, holes as further rings."""
    ring = "array<array<double>>"
    raw = spark.read.option("multiLine", True).schema("features array<struct<properties:struct<ADMIN:string>,geometry:struct<type:string,coordinates:string>>>").json(path)
    rows = raw.select(F.explode("features").alias("f")).select(F.col("f.properties.ADMIN").alias("admin"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"))
    many = F.when(F.col("kind") == "Polygon", F.from_json("c", f"array<{ring}>")).otherwise(F.flatten(F.from_json("c", f"array<array<{ring}>>")))
    return rows.select("admin", many.alias("rings"))


def scan_cells(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(document, row, column, value) of delimited tables of any shape, rows counted from 0, blank ones left out.

    A quoted value may hold delimiters, doubled quotes and line ends, and a file is cut for its tasks wherever its splits
    fall: whether a line begins inside quotes follows from the number of quotes before it, which is summed within
    each split and then over the splits, of which a file has few. Nothing is read whole. A quote always opens or closes.
    """
    split = ["document", "_split"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"), F.regexp_replace("value", "^\ufeff", "").alias("line")
    )
    lines = lines.withColumn("_quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    inside = Window.partitionBy(*split).orderBy("_at")

    def before(rows: DataFrame, count: str) -> DataFrame:
        """By split, the sum of a count over the splits of the file before it."""
        summed = rows.groupBy(*split).agg(F.sum(count).alias("_n"))
        earlier = F.sum("_n").over(Window.partitionBy("document").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
        return summed.select(*split, F.coalesce(earlier, F.lit(0)).alias(f"{count}_before"))

    here = F.coalesce(F.sum("_quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.join(before(lines, "_quotes"), split).withColumn("_begins", ((F.col("_quotes_before") + here) % 2 == 0).cast("int"))
    numbered = marked.join(before(marked, "_begins"), split).withColumn("row", F.col("_begins_before") + F.sum("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_split", "_at", "line"))), lambda x: x["line"]), "\n")
    records = numbered.groupBy("document", "row").agg(whole.alias("record")).filter("trim(record) <> ''")
    d = re.escape(delimiter)
    fields = F.regexp_extract_all(F.concat(F.lit(delimiter), "record"), F.lit(rf'{d}("[^"]*+(?:""[^"]*+)*+"[^{d}]*|[^{d}]*)'), F.lit(1))
    plain = F.transform(fields, lambda f: F.when(f.startswith('"'), F.replace(F.regexp_replace(f, r'(?s)^"(.*)"([^"]*)$', "$1$2"), F.lit('""'), F.lit('"'))).otherwise(f))
    return records.select("document", F.col("row").cast("int").alias("row"), F.posexplode(plain).alias("column", "value"))


def table_payload(df: DataFrame, columns: list[str], chunk_rows: int = 10_000) -> DataFrame:
    """JSON arrays of cells as text, ``chunk_rows`` rows of a partition each and in its order, so that no payload holds a whole large table."""
    at = F.monotonically_increasing_id()
    rows = df.select(F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])).alias("cells"), at.alias("at")).withColumn("chunk", F.floor(F.col("at") / chunk_rows))
    return rows.groupBy("chunk").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(F.struct("at", "cells")))["cells"], ","), F.lit("]")).alias("payload"))


def feed_changed(new: DataFrame, old: DataFrame, timestamp: str) -> bool:
    """Whether a feed differs in anything but its time."""
    columns = [c for c in new.columns if c != timestamp]
    digest = lambda df: df.select(F.sha2(F.to_json(F.struct(*columns)), 256).alias("h")).groupBy("h").count()
    a, b = digest(new), digest(old)
    return not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())


def round_trip(release: DataFrame, store: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows by which the store and the release differ, as multisets of the published columns."""
    from curaspark.operators.cdc import multiset_compare

    return multiset_compare(release, store, list(spec.columns))


# ---- further sources and sinks ----


def scan_region_map(spark: SparkSession, path: str, regions: list[str]) -> DataFrame:
    """(COUNTRY_NAME, REGION) of a map file; blank regions are skipped, an unknown one stops the read."""
    raw = spark.read.option("header", True).csv(path).filter("coalesce(REGION, '') <> ''")
    known = F.assert_true(F.col("REGION").isin(regions), F.concat(F.lit("unknown region "), "REGION"))
    return raw.withColumn("_ok", known).filter("_ok is null").select("COUNTRY_NAME", "REGION")


def rows_needing_review(region_map: DataFrame) -> DataFrame:
    return region_map.filter("coalesce(REVIEW, '') <> '' or coalesce(REGION, '') = ''")


def newest_stamp(spark: SparkSession, folder: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> str | None:
    """The newest date in the file names of a folder, none without any."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.regexp_extract(F.element_at(F.split("path", "/"), -1), pattern, 1).alias("stamp"))
    return files.filter("stamp <> ''").agg(F.max("stamp").alias("s")).first().s


def scan_edition(spark: SparkSession, folder: str, stamp: str, names: list[str]) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables ``name-stamp.csv`` of one edition as text, and the names of those that are not there."""
    found, missing = {}, []
    for name in names:
        path = f"{folder}/{name}-{stamp}.csv"
        if _exists(spark, path):
            raw = spark.read.option("header", True).option("escape", '"').csv(path)
            found[name] = raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in raw.columns])
        else:
            missing.append(name)
    return found, missing


SUBMISSION = """submission_id string, submitter string, accessions array<string>,
    records array<struct<lineage_name:string,host_species:string,country:string,number_tested:int,number_found:int>>,
    sequences array<struct<lineage_name:string,sequence:string>>"""


def scan_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Nested submission documents, one a line."""
    return spark.read.schema(SUBMISSION).json(path)


def submission_records(documents: DataFrame) -> DataFrame:
    """One row for each record of each document; a document without records keeps one with nulls."""
    return documents.select("submission_id", F.posexplode_outer("records").alias("pos", "r")).select("submission_id", "pos", "r.*")


def literature_hits(pages: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """(source, id, doi, title, journal, year, url) from the landed pages of several sources, each with its own column names."""
    wanted = ("id", "doi", "title", "journal", "year", "url")
    parts = [df.select(F.lit(source).alias("source"), *[(F.expr(names[c]) if c in names else F.lit(None)).cast("string").alias(c) for c in wanted]) for source, (df, names) in pages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def xml_attributes(df: DataFrame, column: str, missing: tuple[str, ...] = ("missing", "not collected", "not applicable", "na")) -> DataFrame:
    """``df`` with ``attributes`` (name to value, without words for nothing) and ``publications`` of its XML text."""
    each = F.regexp_extract_all(column, F.lit(r'(?s)<Attribute [^>]*attribute_name="[^"]+"[^>]*>.*?</Attribute>'), F.lit(0))
    pairs = F.transform(each, lambda x: F.struct(F.regexp_extract(x, 'attribute_name="([^"]+)"', 1).alias("k"), F.trim(F.regexp_extract(x, r"(?s)>(.*)</Attribute>$", 1)).alias("v")))
    kept = F.filter(pairs, lambda x: ~F.lower(x["v"]).isin("", *missing))
    first = F.aggregate(kept, F.create_map().cast("map<string,string>"), lambda m, x: F.when(F.map_contains_key(m, x["k"]), m).otherwise(F.map_concat(m, F.create_map(x["k"], x["v"]))))
    return df.withColumn("attributes", first).withColumn("publications", F.array_distinct(F.regexp_extract_all(column, F.lit(r'<Publication id="([^"]+)"'), F.lit(1))))


def write_downloads(tables: dict[str, DataFrame], folder: str, derived: tuple[str, ...] = ()) -> list[str]:
    """Each table as CSV below ``folder``; the names of those that belong to the archive, which leaves derived ones out."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    return [name for name in tables if name not in derived]


def append_correction(log: DataFrame, changes: DataFrame, given: dict[str, str]) -> DataFrame:
    """The log with one more decision: the next id, the old value or ``(various)``, and how many rows changed."""
    facts = changes.agg(F.count("*").alias("n"), F.min("was").alias("low"), F.max("was").alias("high"))
    following = log.agg((F.coalesce(F.max(F.col("CORRECTION_ID").cast("long")), F.lit(0)) + 1).alias("id"))
    old = F.when(F.col("n") == 0, "").when(F.col("low") == F.col("high"), F.col("low")).otherwise("(various)")
    made = {"CORRECTION_ID": F.col("id").cast("string"), "OLD_VALUE": old, "ROWS_CHANGED": F.col("n").cast("string")}
    row = facts.crossJoin(following).select(*[(made[c] if c in made else F.lit(given.get(c, ""))).alias(c) for c in log.columns])
    return log.unionByName(row)
