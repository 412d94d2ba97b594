"""Whole editions: seeding and merging a store, building a release, accounting for what changed between two."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.operators import cdc, keys


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def once_only(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key stands once; a repeated key is ambiguous."""
    single = df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n = 1").select(key)
    return df.join(single, key, "left_semi")


def added_removed_names(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(name, kind): names of one side only, names that are ambiguous on their side left out."""
    all_before, all_after = (df.select(F.col(key).alias("name")).distinct() for df in (before, after))
    only = lambda df, other, kind: once_only(df.select(F.col(key).alias("name")), "name").join(other, "name", "left_anti").select("name", F.lit(kind).alias("kind"))
    return only(after, all_before, "added").union(only(before, all_after, "removed"))


def fact_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str], by_length: tuple[str, ...] = ("SEQUENCE",)) -> DataFrame:
    """(name, column, was, now) of the facts that differ on names that stand once on both sides; long texts by their lengths."""
    shown = lambda c: F.length(c).cast("string") if c in by_length else F.col(c)
    a = once_only(before, key).select(F.col(key).alias("name"), *[F.col(c).alias(f"was_{c}") for c in columns], *[shown(c).alias(f"s_was_{c}") for c in columns])
    b = once_only(after, key).select(F.col(key).alias("name"), *[F.col(c).alias(f"now_{c}") for c in columns], *[shown(c).alias(f"s_now_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s_was_{c}").alias("was"), F.col(f"s_now_{c}").alias("now"), F.col(f"was_{c}").eqNullSafe(F.col(f"now_{c}")).alias("same")) for c in columns])
    return a.join(b, "name").select("name", F.explode(cells).alias("x")).filter("not x.same").select("name", "x.column", "x.was", "x.now")


def compare_editions(before: dict[str, DataFrame], after: dict[str, DataFrame], facts: list[str], tables: dict[str, tuple[list[str], list[str]]], vocabularies: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """The whole account of two editions as named tables.

    ``totals`` of every table, ``names`` added and removed, ``facts`` changed, a diff for each of ``tables`` (name: key columns, other
    columns) and, for each of ``vocabularies`` (what: table, column), its new and retired values.
    """
    out = {"totals": cdc.edition_totals(before, after), "names": added_removed_names(before["lineages"], after["lineages"], "LINEAGE_NAME"), "facts": fact_changes(before["lineages"], after["lineages"], "LINEAGE_NAME", facts)}
    for name, (key, columns) in tables.items():
        out[f"diff {name}"] = cdc.diff_table(before[name], after[name], key, columns)
    for what, (table, column) in vocabularies.items():
        out[f"values {what}"] = cdc.new_retired(before[table], after[table], column)
    return out


def account(parts: dict[str, DataFrame]) -> DataFrame:
    """(section, kind, n) of a comparison."""
    rows = []
    for section, df in parts.items():
        if section == "totals":
            rows.append(df.select(F.concat(F.lit("totals "), "entity").alias("section"), F.lit("delta").alias("kind"), F.col("delta").cast("long").alias("n")))
        else:
            kind = "column" if section == "facts" else "kind"
            amount = F.sum("n") if "n" in df.columns else F.count("*")
            rows.append(df.groupBy(F.col(kind).alias("kind")).agg(amount.cast("long").alias("n")).select(F.lit(section).alias("section"), "kind", "n"))
    return _stack(rows)


def seed_store(tables: dict[str, DataFrame], columns: dict[str, list[str]], prefixes: dict[str, str], order: dict[str, list[str]], release: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Release tables on store columns, stamped and numbered, and (table, dropped): the columns that the store does not keep."""
    seeded, dropped = {}, []
    for name, df in tables.items():
        kept = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns[name]])
        seeded[name] = keys.assign_ids(keys.stamp_provenance(kept, "seed", release), order[name], prefixes[name])
        dropped += [(name, c) for c in df.columns if c not in columns[name]]
    return seeded, next(iter(tables.values())).sparkSession.createDataFrame(dropped, "table string, dropped string")


def merge_store(existing: dict[str, DataFrame], exported: dict[str, DataFrame], specs: dict[str, tuple[list[str], list[str]]], row_no: str = "_row_no") -> dict[str, DataFrame]:
    """(columns, record id, outcome) of each table: seed rows merge with the export, rows of other sources and tables without an export are carried."""
    out = {}
    for name, df in existing.items():
        if name not in exported:
            out[name] = df.withColumn("outcome", F.lit("carried"))
            continue
        key, columns = specs[name]
        merged = cdc.merge_table(df.filter("_source = 'seed'"), exported[name], key, columns, "RECORD_ID", row_no)
        carried = df.filter("_source <> 'seed'").select(*columns, "RECORD_ID", F.lit("carried").alias("outcome"))
        out[name] = merged.select(*columns, "RECORD_ID", "outcome").unionByName(carried)
    return out


def counted(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, n): how many rows each table of findings has, none too."""
    return _stack([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n") for name, df in checks.items()])


def release_warnings(store: dict[str, DataFrame], width: int) -> DataFrame:
    """(check, n) of what a release tells but does not stop for."""
    lineages, hosts, references = store["lineages"], store["host_records"], store["references"]
    return counted(
        {
            "no sequence": no_sequence(lineages, "SEQUENCE"),
            "odd length": odd_length(lineages, "SEQUENCE", width),
            "duplicate name": keys.duplicate_values(lineages, "LINEAGE_NAME"),
            "natural key repeated": hosts.groupBy("LINEAGE_NAME", "SPECIES_NAME", "SITE_NAME", "REFERENCE_NAME").agg(F.count("*").alias("n")).filter("n > 1"),
            "orphan citation": hosts.select("REFERENCE_NAME").distinct().join(references.select("REFERENCE_NAME"), "REFERENCE_NAME", "left_anti"),
            "impossible counts": hosts.filter("NUMBER_FOUND > NUMBER_TESTED"),
            "no lineage": hosts.select("LINEAGE_NAME").distinct().join(lineages.select("LINEAGE_NAME"), "LINEAGE_NAME", "left_anti"),
        }
    )


def build_release(store: dict[str, DataFrame], gate: DataFrame, summary, width: int) -> dict[str, DataFrame]:
    """Gate, summary, public tables and warnings; a refused source keeps its rows out of every public table and out of the
    summary, which ``summary`` makes of the public tables."""
    open_sources = gate.filter("verdict in ('exempt', 'publishing')").select(F.col("source").alias("_source"))
    public = {name: df.join(open_sources, "_source", "left_semi").drop("_source", "_added") if "_source" in df.columns else df for name, df in store.items()}
    return {"gate": gate, "summary": summary(public), **public, "warnings": release_warnings(public, width)}


def no_sequence(lineages: DataFrame, column: str) -> DataFrame:
    return lineages.filter(F.trim(F.coalesce(column, F.lit(""))) == "")


def odd_length(lineages: DataFrame, column: str, width: int) -> DataFrame:
    return lineages.filter((F.col(column) != "") & (F.length(column) != width))


def countries_union(tables: list[DataFrame], column: str, placeholder: str = "") -> DataFrame:
    return reduce(DataFrame.union, [df.select(column) for df in tables]).distinct().filter(F.col(column) != placeholder)


# ---- studies ----


def split_studies(cited: DataFrame, published: DataFrame, authors: Column) -> DataFrame:
    """(unpublished, published): citations marked unpublished whose authors have published keys."""
    waiting = cited.filter("lower(REFERENCE_NAME) like '%unpubl%'").select(F.col("REFERENCE_NAME").alias("unpublished"), authors.alias("_who")).distinct()
    known = published.filter("lower(REFERENCE_NAME) not like '%unpubl%'").select(F.col("REFERENCE_NAME").alias("_key"), authors.alias("_who")).filter("_who <> ''").distinct()
    return waiting.join(known, "_who").groupBy("unpublished").agg(F.array_sort(F.collect_set("_key")).alias("published"))


def rename_key_collisions(rows: DataFrame, key: list[str], column: str, old: str, new: str) -> DataFrame:
    """Natural keys that rows of one study would share with another's after its renaming."""
    moved = rows.filter(F.col(column) == old).withColumn(column, F.lit(new)).select(*key).distinct()
    return moved.join(rows.filter(F.col(column) != old).select(*key), key, "left_semi")


def publish_reference(tables: dict[str, DataFrame], references: DataFrame, old: str, new: str, given: dict[str, str]) -> dict[str, DataFrame]:
    """The renamed study in every table that cites it, and its reference row with the provenance of the rows behind it."""
    out = {name: df.withColumn("REFERENCE_NAME", F.when(F.col("REFERENCE_NAME") == old, new).otherwise(F.col("REFERENCE_NAME"))) for name, df in tables.items()}
    behind = reduce(DataFrame.union, [df.filter(F.col("REFERENCE_NAME") == old).select("_source", "_added") for df in tables.values()])
    first = behind.agg(F.min(F.struct("_added", "_source")).alias("x"))
    given = {"REFERENCE_NAME": new, **given}
    row = first.select(*[F.col("x._source").alias(c) if c == "_source" else F.col("x._added").alias(c) if c == "_added" else F.lit(given.get(c, "")).cast(references.schema[c].dataType).alias(c) for c in references.columns])
    out["references"] = references.filter(~F.col("REFERENCE_NAME").isin(old, new)).unionByName(row)
    return out


def cites_study(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """(table, source, n): where a study is cited and by which submissions."""
    return _stack([df.filter(F.col("REFERENCE_NAME") == name).groupBy(F.col("_source").alias("source")).agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "source", "n") for t, df in tables.items()])


# ---- exports of the normalised master ----


def star(facts: DataFrame, lookups: list[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """Facts with the columns of their lookups: (table, fact column, its key, {column: as}); a missing one is blank."""
    for table, column, key, taken in lookups:
        side = table.select(F.col(key).alias("_k"), *[F.col(c).alias(name) for c, name in taken.items()])
        facts = facts.join(side, F.col(column) == F.col("_k"), "left").drop("_k")
        for name in taken.values():
            facts = facts.withColumn(name, F.coalesce(F.col(name).cast("string"), F.lit("")))
    return facts


def alt_names_table(rows: DataFrame, cited: DataFrame | None = None) -> DataFrame:
    """Comma-joined synonyms as distinct (lineage, name, reference); with ``cited`` only of its (lineage, reference) pairs."""
    split = rows.select("LINEAGE_NAME", F.explode(F.split("ALT_NAME", ",")).alias("ALT_NAME"), "REFERENCE_NAME").withColumn("ALT_NAME", F.trim("ALT_NAME")).filter("ALT_NAME <> ''").distinct()
    return split if cited is None else split.join(cited.select("LINEAGE_NAME", "REFERENCE_NAME"), ["LINEAGE_NAME", "REFERENCE_NAME"], "left_semi")


def export_lineages(master: DataFrame, sequences: DataFrame, species: DataFrame) -> DataFrame:
    """Every lineage with its sequence and, a row each, its species; blanks where there is none."""
    named = species.groupBy("LINEAGE_NAME").agg(F.array_sort(F.collect_set("SPECIES_NAME")).alias("_species"))
    rows = master.join(sequences, "LINEAGE_NAME", "left").join(named, "LINEAGE_NAME", "left")
    return rows.withColumn("SPECIES_NAME", F.explode_outer("_species")).drop("_species").na.fill("")
