"""One batch of submissions into the store: known sequences resolved, bad ones refused, the rest placed and numbered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.operators import claims, keys, windows
from curaspark.operators.curation import exact_resolve
from curaspark.operators.sequences import all_pairs_compatible
from curaspark.operators.shared import stored


def resolve_known(store: DataFrame, incoming: DataFrame, width: int, least: int) -> DataFrame:
    """(submission, name, seq, as_name, completes): new sequences that agree with stored ones take the first one's name.

    ``completes`` is true where the new sequence determines more bases, so that the stored one is completed by it.
    """
    tagged = incoming.withColumn("_id", F.concat_ws("|", F.col("submission").cast("string"), "name"))
    found = exact_resolve(tagged.select(F.col("_id").alias("name"), "seq"), store.select("name", "seq"), width, least=least)
    known = found.filter("verdict <> 'none'").select(F.col("query").alias("_id"), F.get("names", 0).alias("as_name"))
    bases = lambda c: F.length(F.regexp_replace(F.upper(c), "[^ACGT]", ""))
    rows = tagged.join(known, "_id", "left").join(store.select(F.col("name").alias("as_name"), bases("seq").alias("_had")), "as_name", "left")
    return rows.select("submission", "name", "seq", "as_name", F.coalesce(bases("seq") > F.col("_had"), F.lit(False)).alias("completes"))


def refusals(store: DataFrame, incoming: DataFrame, offsets: DataFrame | None, width: int, least: int) -> DataFrame:
    """(submission, reason): names that others hold, sequences that lose bases when placed, equal sequences in one batch."""
    sourced = incoming.select("name", "seq", F.col("submission").cast("string").alias("source"))
    collided = claims.name_collisions(store.select("name", "seq", F.lit("store").alias("source")), sourced, "name", "seq", "source").select("name")
    parts = incoming.join(collided.distinct(), "name", "left_semi").select("submission", F.lit("name is held").alias("reason"))
    if offsets is not None:
        lost = windows.misframed(incoming.join(offsets, ["submission", "name"]), width).select("submission", F.lit("loses bases in the window").alias("reason"))
        parts = parts.union(lost)
    tagged = incoming.select(F.concat_ws("|", F.col("submission").cast("string"), "name").alias("name"), "seq")
    pairs = all_pairs_compatible(tagged, "name", "seq", width, min_shared=least)
    owner = lambda c: F.substring_index(c, "|", 1)
    twice = pairs.filter(owner("a") == owner("b")).select(owner("a").alias("_s"), F.lit("equal sequences in the batch").alias("reason"))
    return parts.union(twice.select(F.col("_s").cast(incoming.schema["submission"].dataType).alias("submission"), "reason")).distinct()


def ingest_batch(store: DataFrame, incoming: DataFrame, width: int, least: int, prefix: str, start: int, offsets: DataFrame | None = None) -> DataFrame:
    """(submission, name, outcome, as_name, record_id) of every incoming sequence (submission, name, seq).

    A submission is taken whole or not at all. Of those that are taken, known sequences are merged into the stored
    lineage (or complete it) and new ones get the next ids, in the order of submission and name.
    """
    resolved = stored(resolve_known(store, incoming, width, least))
    fresh = resolved.filter("as_name is null").select("submission", "name", "seq")
    refused = stored(refusals(store, fresh, offsets, width, least))
    bad = refused.groupBy("submission").agg(F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reason"))
    judged = resolved.join(bad, "submission", "left")
    outcome = F.when(F.col("reason").isNotNull(), F.concat(F.lit("refused: "), "reason")).when(F.col("as_name").isNull(), "new").when(F.col("completes"), "completes").otherwise("known")
    rows = stored(judged.select("submission", "name", outcome.alias("outcome"), F.when(F.col("reason").isNull(), F.coalesce("as_name", "name")).alias("as_name")))
    numbered = keys.assign_ids(rows.filter("outcome = 'new'"), ["submission", "name"], prefix, start, "record_id")
    return numbered.unionByName(rows.filter("outcome <> 'new'").withColumn("record_id", F.lit(None).cast("string")))
