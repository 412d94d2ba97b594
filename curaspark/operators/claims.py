"""Names: who holds them, who waits for them, what they may become; and joins that look things up for a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rename_detect(removed: DataFrame, added: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(old, new): a removed name that is a synonym of exactly one added lineage."""
    hits = removed.select(F.col("name").alias("old")).join(synonyms.select(F.col("ALT_NAME").alias("old"), F.col("LINEAGE_NAME").alias("new")), "old").join(added.select(F.col("name").alias("new")), "new", "left_semi")
    return hits.groupBy("old").agg(F.count_distinct("new").alias("_n"), F.min("new").alias("new")).filter("_n = 1").select("old", "new")


def name_collisions(store: DataFrame, incoming: DataFrame, name: str, sequence: str, source: str) -> DataFrame:
    """(name, problem): new names that another source holds, with the same or another sequence, or that the batch declares twice."""
    mine = incoming.select(F.col(name).alias("name"), F.col(sequence).alias("_seq"), F.col(source).alias("_by"))
    held = store.select(F.col(name).alias("name"), F.col(sequence).alias("_held"), F.col(source).alias("_of"))
    both = mine.join(held, "name").filter("_by <> _of")
    met = both.groupBy("name").agg(F.max((F.col("_seq") == F.col("_held")).cast("int")).alias("same"))
    twice = mine.groupBy("name", "_by").agg(F.count("*").alias("n")).filter("n > 1").select("name", F.lit("declared twice").alias("problem")).distinct()
    return met.select("name", F.when(F.col("same") == 1, "held with the same sequence").otherwise("held with another sequence").alias("problem")).union(twice)


def names_held_elsewhere(entries: DataFrame) -> DataFrame:
    """(submission, name, others) of names that other open submissions hold too: one aggregate, no pairs of submissions."""
    held = entries.select("submission", "name").distinct()
    holders = held.groupBy("name").agg(F.count("*").alias("holders")).filter("holders > 1")
    return held.join(holders, "name").select("submission", "name", (F.col("holders") - 1).alias("others"))


def standing_claims(entries: DataFrame, released: DataFrame, closed: DataFrame) -> DataFrame:
    """(name, holder, claims): names still reserved, by their corrected form, the smallest submission holding them."""
    live = entries.join(closed, "submission", "left_anti").withColumn("name", F.when(F.coalesce("corrected", F.lit("")) != "", F.col("corrected")).otherwise(F.col("name")))
    waiting = live.join(released.select(F.col(released.columns[0]).alias("name")), "name", "left_anti")
    return waiting.groupBy("name").agg(F.min("submission").alias("holder"), F.count_distinct("submission").alias("claims"))


def name_suggestion(taken: DataFrame, known: DataFrame, stem: str = "^([A-Z]+)[0-9]+$") -> DataFrame:
    """(name, offer): for taken names the next free numbers of their stem, each offered once.

    Numbers go on from the highest known one; a stem's taken names are few (the names of one report).
    """
    number = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).try_cast("long")
    highest = known.select(F.regexp_extract("name", stem, 1).alias("stem"), number("name").alias("n")).filter("stem <> ''").groupBy("stem").agg(F.max("n").alias("high"))
    asked = taken.select("name", F.regexp_extract("name", stem, 1).alias("stem")).filter("stem <> ''").distinct()
    turn = F.row_number().over(Window.partitionBy("stem").orderBy("name"))
    return asked.withColumn("turn", turn).join(highest, "stem", "left").select("name", F.concat("stem", (F.coalesce("high", F.lit(0)) + F.col("turn")).cast("string")).alias("offer"))


def pair_known(rows: DataFrame, store: DataFrame, pair: list[str], reference: str, shown: int = 3) -> DataFrame:
    """(pair, reference, others, first): how many other references record the pair, the first few of them."""
    refs = store.groupBy(*pair).agg(F.array_sort(F.collect_set(reference)).alias("_refs"))
    asked = rows.select(*pair, reference).distinct().join(refs, pair, "left")
    others = F.array_remove(F.coalesce("_refs", F.array().cast("array<string>")), F.col(reference))
    return asked.select(*pair, reference, F.size(others).cast("long").alias("others"), F.array_join(F.slice(others, 1, shown), ", ").alias("first"))


def backfill_genus(rows: DataFrame, declared: DataFrame, store: DataFrame) -> DataFrame:
    """``rows`` with ``genus``: as the batch declares the lineage, else the store's, else blank; the smallest of several."""
    own = declared.filter("GENUS_NAME <> ''").groupBy("LINEAGE_NAME").agg(F.min("GENUS_NAME").alias("_own"))
    known = store.filter("GENUS_NAME <> ''").groupBy("LINEAGE_NAME").agg(F.min("GENUS_NAME").alias("_known"))
    return rows.join(own, "LINEAGE_NAME", "left").join(known, "LINEAGE_NAME", "left").withColumn("genus", F.coalesce("_own", "_known", F.lit(""))).drop("_own", "_known")


def attach_coordinates(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """``rows`` with ``coordinates`` "lat, lon" of the first usable line of its site."""
    usable = sites.filter("lat between -90 and 90 and lon between -180 and 180")
    first = usable.groupBy("SITE_NAME").agg(F.min_by(F.concat_ws(", ", F.col("lat").cast("string"), F.col("lon").cast("string")), "line").alias("coordinates"))
    return rows.join(first, "SITE_NAME", "left").withColumn("coordinates", F.coalesce("coordinates", F.lit("")))


def attach_alt_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with ``alt_names`` of its (lineage, reference), comma-joined in sheet order."""
    joined = names.groupBy("LINEAGE_NAME", "REFERENCE_NAME").agg(F.array_sort(F.collect_list(F.struct("line", "ALT_NAME"))).alias("_n"))
    return rows.join(joined, ["LINEAGE_NAME", "REFERENCE_NAME"], "left").withColumn("alt_names", F.coalesce(F.array_join("_n.ALT_NAME", ", "), F.lit(""))).drop("_n")


def both_ways(one: DataFrame, two: DataFrame, column: str, only_one: str, only_two: str) -> DataFrame:
    """(value, side) of values that the other side lacks."""
    a, b = (df.select(F.col(column).alias("value")).distinct() for df in (one, two))
    return a.join(b, "value", "left_anti").withColumn("side", F.lit(only_one)).union(b.join(a, "value", "left_anti").withColumn("side", F.lit(only_two)))


def basemap_gap(records: DataFrame, shapes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Countries of records without a shape, by name or by alias."""
    known = shapes.select(F.col("admin").alias("COUNTRY_NAME")).union(aliases.join(shapes, "admin").select("COUNTRY_NAME")).distinct()
    return records.select("COUNTRY_NAME").filter("COUNTRY_NAME <> ''").distinct().join(known, "COUNTRY_NAME", "left_anti")


def range_lookup_join(rows: DataFrame, lookup: DataFrame, digits: int = 5) -> DataFrame:
    """``rows`` with ``range_code`` of (host, rounded place), only for young birds that are not resident."""
    side = lookup.select("host", F.round("lat", digits).alias("_lat"), F.round("lon", digits).alias("_lon"), "code")
    keyed = rows.withColumn("_lat", F.round("lat", digits)).withColumn("_lon", F.round("lon", digits))
    out = keyed.join(side, ["host", "_lat", "_lon"], "left").drop("_lat", "_lon")
    return out.withColumn("range_code", F.when((F.col("age") == "HY") & (F.col("status") != "resident"), F.coalesce("code", F.lit("unknown"))).otherwise("")).drop("code")


def taxonomy_repair(rows: DataFrame, matcher: DataFrame, key: DataFrame, species: str) -> DataFrame:
    """``rows`` with ``accepted``: the matcher's answer, else the shipped key's, else the name itself."""
    m = matcher.select(F.col("name").alias(species), F.col("accepted").alias("_m"))
    k = key.select(F.col("name").alias(species), F.col("accepted").alias("_k"))
    out = rows.join(m, species, "left").join(k, species, "left")
    nonblank = lambda c: F.nullif(F.col(c), F.lit(""))
    return out.withColumn("accepted", F.coalesce(nonblank("_m"), nonblank("_k"), F.col(species))).drop("_m", "_k")


def decide_candidate(candidates: DataFrame, in_table: DataFrame) -> DataFrame:
    """(id, decision) of candidates (id, lineage, call, paper): already there, add, paper needed, or for a curator."""
    there = in_table.select(F.col(in_table.columns[0]).alias("id")).distinct().withColumn("_there", F.lit(True))
    decision = F.when(F.col("_there"), "already in table").when(F.col("call") != "exact", "curator").when(F.coalesce("paper", F.lit("")) == "", "paper needed").otherwise("add")
    return candidates.join(there, "id", "left").select("id", decision.alias("decision"))


def excluded_ids(rows: DataFrame, excluded: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows without the configured ids, and the ids that match nothing."""
    ids = excluded.select(F.col(excluded.columns[0]).alias(column)).distinct()
    return rows.join(ids, column, "left_anti"), ids.join(rows, column, "left_anti")


def drop_example_rows(rows: DataFrame, examples: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose leading cells are not those of a worked example, whatever the case."""
    folded = lambda df: [F.lower(F.trim(F.col(c))).alias(f"_{c}") for c in columns]
    known = examples.select(*folded(examples)).distinct()
    marked = rows.select("*", *folded(rows))
    return marked.join(known, [f"_{c}" for c in columns], "left_anti").drop(*[f"_{c}" for c in columns])


def checklist_names(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genus, epithets) with sorted epithets, and (genus, family) only where a genus has one family."""
    genera = rows.groupBy("genus").agg(F.array_sort(F.collect_set("epithet")).alias("epithets"))
    family = rows.groupBy("genus").agg(F.count_distinct("family").alias("_n"), F.min("family").alias("family")).filter("_n = 1").select("genus", "family")
    return genera, family


def truth_sets(references: DataFrame, records: DataFrame, least: int = 1) -> DataFrame:
    """(wanted, records, lineages, warning) of references told by a part of their name: pooled if several match, empty if none.

    ``references`` is a short list of wanted parts; record names are reduced to distinct ones before they are matched.
    """
    sizes = records.groupBy("REFERENCE_NAME").agg(F.count("*").alias("n"))
    hits = references.join(sizes, F.col("REFERENCE_NAME").contains(F.col("wanted")), "left")
    matched = hits.groupBy("wanted").agg(F.count("REFERENCE_NAME").alias("_m"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"))
    pairs = hits.join(records.select("REFERENCE_NAME", "LINEAGE_NAME").distinct(), "REFERENCE_NAME").groupBy("wanted").agg(F.count_distinct("LINEAGE_NAME").alias("lineages"))
    warning = F.when(F.col("_m") == 0, "empty").when(F.col("_m") > least, "pooled").otherwise("")
    return matched.join(pairs, "wanted", "left").select("wanted", "records", F.coalesce("lineages", F.lit(0)).alias("lineages"), warning.alias("warning"))


def accession_collision(rows: DataFrame, store: DataFrame, accession: str) -> DataFrame:
    """(accession, rows): submitted accessions that are curated already."""
    asked = rows.filter(F.col(accession) != "").groupBy(F.col(accession).alias("accession")).agg(F.count("*").alias("rows"))
    return asked.join(store.select(F.col(accession).alias("accession")), "accession", "left_semi")


def prior_decisions(rows: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """``rows`` with the latest earlier decision on their key, blank without one."""
    last = decisions.groupBy(key).agg(F.max_by("decision", F.struct("at", "decision")).alias("prior"))
    return rows.join(last, key, "left").withColumn("prior", F.coalesce("prior", F.lit("")))


def resolve_rows(rows: DataFrame, known: DataFrame, resolved: DataFrame) -> DataFrame:
    """``rows`` (name, seq) whose printed name is unknown get the name their sequence resolves to; the printed one is kept."""
    there = known.select(F.col(known.columns[0]).alias("name")).distinct().withColumn("_known", F.lit(True))
    names = resolved.select("seq", F.col("name").alias("_resolved")).dropDuplicates(["seq"])
    out = rows.join(there, "name", "left").join(names, "seq", "left").withColumn("printed", F.col("name"))
    return out.withColumn("name", F.when(F.col("_known").isNull() & F.col("_resolved").isNotNull(), F.col("_resolved")).otherwise(F.col("name"))).drop("_known", "_resolved")


def morphology_comment(rows: DataFrame, linked: DataFrame, words: str = "morpholog|gametocyte|blood smear") -> DataFrame:
    """(lineage, comment): the first comment on morphology of each lineage that no species is linked to."""
    said = rows.filter(F.lower("COMMENT").rlike(words)).groupBy(F.col("LINEAGE_NAME").alias("lineage")).agg(F.min_by("COMMENT", "line").alias("comment"))
    return said.join(linked.select(F.col("LINEAGE_NAME").alias("lineage")), "lineage", "left_anti")


def forbidden_values(private: DataFrame, released: DataFrame, least: int = 12) -> DataFrame:
    """Distinct private values of ``least`` characters or more that no release holds: what no feed may show."""
    values = private.select(F.trim(F.col(private.columns[0])).alias("value")).filter(F.length("value") >= least).distinct()
    return values.join(released.select(F.trim(F.col(released.columns[0])).alias("value")), "value", "left_anti")


def leak_guard(payload: DataFrame, column: str, forbidden: str = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z]+|PRIVATE KEY") -> DataFrame:
    """``payload`` unchanged; the job stops at a row that holds an address or a private key."""
    return payload.withColumn("_safe", F.assert_true(~F.col(column).rlike(forbidden), F.lit("a payload holds a private value"))).filter("_safe is null").drop("_safe")


def best_overlap(pairs: DataFrame) -> DataFrame:
    """(query, rank, name, comparable, tied) of compatible names by overlap; a tie at the top is ambiguous, shorter ones are listed."""
    rank = F.rank().over(Window.partitionBy("query").orderBy(F.col("comparable").desc()))
    ranked = pairs.withColumn("rank", rank)
    return ranked.withColumn("tied", F.count("*").over(Window.partitionBy("query", "rank")) > 1).select("query", F.col("rank").cast("long").alias("rank"), "name", "comparable", "tied")


def range_verdict(seen: DataFrame) -> DataFrame:
    """(host, site, verdict) from (host, site, season) of the polygons that hold a site, season null where the host has polygons but none holds it."""
    sets = seen.groupBy("host", "site").agg(F.collect_set("season").alias("_s"))
    has = lambda s: F.array_contains("_s", s)
    verdict = (
        F.when(F.size("_s") == 0, "outside").when(has("resident") | (has("breeding") & has("non-breeding")), "mixed").when(has("breeding"), "breeding")
        .when(has("non-breeding"), "non-breeding").otherwise("uncertain")
    )
    return sets.select("host", "site", verdict.alias("verdict"))
