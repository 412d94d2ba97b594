"""Fixpoints: rename chains and groups of duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.operators.shared import stored


def current_name(events: DataFrame, old: str = "OLD_NAME", new: str = "NEW_NAME") -> DataFrame:
    """(name, current, hops): the name in force for every renamed one; '' if removed, null in a circle or on the way into one.

    Each round joins every pointer with its target's pointer, so chains halve. A chain that ends has fewer steps than
    there are rows: what is still open after log2(rows) + 1 rounds is in a circle of whatever length.
    """
    own = events.groupBy(F.col(old).alias("name")).agg(F.min(new).alias("current"))
    rows = stored(own.withColumn("hops", F.lit(1).cast("long")).withColumn("open", F.lit(True)))
    for _ in range(rows.count().bit_length() + 1):
        ahead = rows.select(F.col("name").alias("current"), F.col("current").alias("_next"), F.col("hops").alias("_more"))
        joined = rows.join(ahead, "current", "left")
        rows = stored(joined.select("name", F.coalesce("_next", "current").alias("current"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops"), F.col("_more").isNotNull().alias("open")))
        if not rows.filter("open").limit(1).count():
            break
    return rows.select("name", F.when(~F.col("open"), F.col("current")).alias("current"), F.when(~F.col("open"), F.col("hops")).alias("hops"))


def groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(member, group): connected components of pairs, named by their smallest member."""
    one = pairs.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    edges = stored(one.union(one.select("dst", "src")).distinct())
    labels = stored(edges.groupBy(F.col("src").alias("member")).agg(F.min("dst").alias("low")).select("member", F.least("member", "low").alias("group")))
    while True:
        near = edges.join(labels, F.col("dst") == F.col("member")).groupBy("src").agg(F.min("group").alias("low"))
        top = labels.select(F.col("member").alias("_m"), F.col("group").alias("_g"))
        step = labels.join(near, F.col("member") == F.col("src")).select("member", F.col("group").alias("was"), F.least("group", "low").alias("group"))
        step = stored(step.join(top, F.col("group") == F.col("_m"), "left").select("member", "was", F.least("group", F.coalesce("_g", "group")).alias("group")))
        if not step.filter("group <> was").limit(1).count():
            return step.select("member", "group")
        labels = step.select("member", "group")


def duplicate_groups(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """(member, survivor): the member with most records, then the earliest year, then the smallest name survives."""
    members = groups(pairs).join(profiles.select(F.col("LINEAGE_NAME").alias("member"), "records", "first_year"), "member", "left")
    best = members.groupBy("group").agg(F.min_by("member", F.struct((-F.coalesce("records", F.lit(0))).alias("r"), F.coalesce("first_year", F.lit(9999)).alias("y"), F.col("member").alias("m"))).alias("survivor"))
    return members.join(best, "group").select("member", "survivor")


def rename_propagate(rows: DataFrame, renames: DataFrame, column: str) -> DataFrame:
    """Approved renames (old, new) applied to a name column."""
    table = renames.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return rows.join(table, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


#: Tables whose rows cite a lineage by name; the history itself is never rewritten.
CITING = ("host_records", "vector_records", "alt_names", "morpho_species", "genomic_resources")


def event_plan(store: dict[str, DataFrame], event: dict) -> DataFrame:
    """(table, n_rows): how many rows of each table an event touches; no row for a table that is not there."""
    parts = None
    for name in ("lineages", *CITING):
        if name not in store:
            continue
        touched = store[name].filter(F.col("LINEAGE_NAME") == event["name"]).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        parts = touched if parts is None else parts.union(touched)
    return parts


def event_apply(store: dict[str, DataFrame], event: dict) -> dict[str, DataFrame]:
    """The store after one event: sequence_updated, renamed, merged_into or removed.

    A rename or merge leaves the old name as a synonym; a merge and a removal take the lineage's own row
    away, a removal its citing rows too. Everything else in the store is carried through.
    """
    kind, name, new = event["kind"], event["name"], event.get("new", "")
    mine = F.col("LINEAGE_NAME") == name
    out = dict(store)
    if kind == "sequence_updated":
        out["lineages"] = store["lineages"].withColumn("SEQUENCE", F.when(mine, new).otherwise(F.col("SEQUENCE")))
    elif kind == "removed":
        for table in ("lineages", *CITING):
            if table in store:
                out[table] = store[table].filter(~mine)
    elif kind in ("renamed", "merged_into"):
        renamed = lambda df: df.withColumn("LINEAGE_NAME", F.when(mine, new).otherwise(F.col("LINEAGE_NAME")))
        out["lineages"] = renamed(store["lineages"]) if kind == "renamed" else store["lineages"].filter(~mine)
        for table in CITING:
            if table in store:
                out[table] = renamed(store[table])
        if "alt_names" in store:
            columns = store["alt_names"].columns
            given = {"LINEAGE_NAME": new, "ALT_NAME": name}
            synonym = store["alt_names"].sparkSession.range(1).select(*[F.lit(given.get(c, "")).alias(c) for c in columns])
            out["alt_names"] = out["alt_names"].unionByName(synonym).distinct()
    else:
        raise ValueError(f"unknown event {kind}")
    if "lineage_history" in store:
        given = {"LINEAGE_NAME": new if kind in ("renamed", "merged_into") else name, "EVENT": kind, "OLD_NAME": name, "NEW_NAME": new if kind != "sequence_updated" else "", "DATE": event.get("date", ""), "REASON": event.get("reason", ""), "SOURCE": event.get("source", "")}
        columns = store["lineage_history"].columns
        row = store["lineage_history"].sparkSession.range(1).select(*[F.lit(given.get(c, "")).alias(c) for c in columns])
        out["lineage_history"] = store["lineage_history"].unionByName(row)
    return out


def history_seed(notes: DataFrame, deleted: DataFrame, earlier: DataFrame, current: DataFrame) -> DataFrame:
    """(name, event, reason): a history from notes, from rows marked deleted, and from names that an earlier edition had and no row explains."""
    told = notes.filter("reason <> ''").select("name", F.lit("noted").alias("event"), "reason")
    gone = deleted.select("name", F.lit("removed").alias("event"), F.lit("marked as deleted").alias("reason"))
    known = told.select("name").union(gone.select("name")).union(current.select("name"))
    lost = earlier.select("name").distinct().join(known, "name", "left_anti").select("name", F.lit("vanished").alias("event"), F.lit("in no later edition").alias("reason"))
    return told.union(gone).union(lost)


def decisions_to_events(decisions: DataFrame, store: DataFrame) -> DataFrame:
    """(name, kind, target, depth, problem) of decisions (name, kind, target): events in the order of ``depth``, deepest merges first.

    A name decided in two ways is a conflict, a name or target that the store lacks is unknown, merges in a circle are
    refused; chains of merges are resolved to their last target.
    """
    known = store.select("name").distinct().withColumn("_there", F.lit(True))
    ways = decisions.select("name", "kind", "target").distinct().groupBy("name").agg(F.count("*").alias("_ways"), F.min("kind").alias("kind"), F.min("target").alias("target"))
    merges = ways.filter("_ways = 1 and kind = 'merge'")
    last = current_name(merges.select(F.col("name").alias("OLD_NAME"), F.col("target").alias("NEW_NAME"))).select("name", F.col("current").alias("_last"), "hops")
    rows = ways.join(last, "name", "left").join(known, "name", "left").join(known.withColumnRenamed("_there", "_target").withColumnRenamed("name", "target"), "target", "left")
    problem = (
        F.when(F.col("_ways") > 1, "conflict").when(F.col("_there").isNull(), "unknown name").when((F.col("kind") == "merge") & F.col("_target").isNull(), "unknown target")
        .when((F.col("kind") == "merge") & F.col("_last").isNull(), "circle").otherwise("")
    )
    return rows.select("name", "kind", F.when(F.col("kind") == "merge", F.coalesce("_last", "target")).otherwise(F.col("target")).alias("target"), F.coalesce("hops", F.lit(0)).alias("depth"), problem.alias("problem"))


def history_agrees(events: DataFrame, lineages: DataFrame, deposits: DataFrame, width: int, k: int = 12, least: int = 300) -> DataFrame:
    """(LINEAGE_NAME, accession, compared, mismatches, verdict) of history rows (LINEAGE_NAME, EVENT, SOURCE, NEW_SEQUENCE) whose source is an accession.

    The stored sequence is laid over the deposited one (accession, seq) at the offset that most of their common words of ``k`` bases
    vote for (ties: the smallest), without gaps. Verdicts: no deposit, stored sequence is not the row's (an update whose new sequence
    the store does not hold), too little overlap (fewer than ``least`` determined bases on both sides), identical, differs. Rows without
    an accession are left out; a lineage that the store lacks has an empty sequence. ``width`` bounds the stored sequence's length.
    """
    bare = lambda c: F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[-.~ ]", "")
    accession = F.regexp_replace(F.upper(F.trim("SOURCE")), r"\.[0-9]+$", "")
    rows = events.select("LINEAGE_NAME", "EVENT", accession.alias("accession"), bare(F.col("NEW_SEQUENCE")).alias("new")).filter(F.col("accession").rlike("^[A-Z]{1,2}[0-9]{5,8}$")).distinct()
    held = lineages.groupBy("LINEAGE_NAME").agg(F.substring(F.min(bare(F.col("SEQUENCE"))), 1, width).alias("stored"))
    found = deposits.groupBy(F.regexp_replace(F.upper(F.trim("accession")), r"\.[0-9]+$", "").alias("accession")).agg(F.min(bare(F.col("seq"))).alias("deposit"))
    pairs = rows.join(held, "LINEAGE_NAME", "left").join(found, "accession", "left").withColumn("stored", F.coalesce("stored", F.lit("")))
    laid = pairs.select("LINEAGE_NAME", "accession", "stored", "deposit").filter("deposit is not null and stored <> ''").distinct()

    def words(seq: str, at: str):
        starts = F.when(F.length(seq) >= k, F.sequence(F.lit(1), F.length(seq) - k + 1)).otherwise(F.array().cast("array<int>"))
        each = laid.select("LINEAGE_NAME", "accession", F.explode(F.transform(starts, lambda i: F.struct(i.alias(at), F.substring(seq, i, F.lit(k)).alias("word")))).alias("x"))
        return each.select("LINEAGE_NAME", "accession", "x.*").filter(~F.col("word").rlike("[^ACGT]"))

    votes = words("stored", "i").join(words("deposit", "j"), ["LINEAGE_NAME", "accession", "word"]).groupBy("LINEAGE_NAME", "accession", (F.col("j") - F.col("i")).alias("shift")).agg(F.count("*").alias("n"))
    offset = votes.groupBy("LINEAGE_NAME", "accession").agg(F.min_by("shift", F.struct((-F.col("n")).alias("n"), "shift")).alias("shift"))
    told = pairs.join(offset, ["LINEAGE_NAME", "accession"], "left")
    at = F.when(F.length("stored") > 0, F.sequence(F.lit(1), F.length("stored"))).otherwise(F.array().cast("array<int>"))
    letters = F.transform(at, lambda i: F.struct(F.substring("stored", i, F.lit(1)).alias("a"), F.when(i + F.col("shift") >= 1, F.substring("deposit", i + F.col("shift"), F.lit(1))).otherwise("").alias("b")))
    both = F.filter(letters, lambda x: x["a"].isin("A", "C", "G", "T") & x["b"].isin("A", "C", "G", "T"))
    told = told.withColumn("_both", F.when(F.col("shift").isNotNull(), both))
    compared = F.coalesce(F.when(F.col("_both").isNotNull(), F.size("_both")), F.lit(0))
    mismatches = F.coalesce(F.size(F.filter("_both", lambda x: x["a"] != x["b"])), F.lit(0))
    told = told.select("LINEAGE_NAME", "accession", "EVENT", "new", "stored", "deposit", compared.alias("compared"), F.when(F.col("_both").isNotNull(), mismatches).otherwise(0).alias("mismatches"))
    verdict = (
        F.when(F.col("deposit").isNull(), "no deposit")
        .when((F.col("EVENT") == "sequence_updated") & (F.col("new") != F.col("stored")), "stored sequence is not the row's")
        .when(F.col("compared") < least, "too little overlap")
        .when(F.col("mismatches") == 0, "identical")
        .otherwise("differs")
    )
    return told.select("LINEAGE_NAME", "accession", "EVENT", "compared", "mismatches", verdict.alias("verdict"))
