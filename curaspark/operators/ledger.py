"""The review ledger as a batch: standing verdicts, state folds and clocks over an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.operators.keys import row_numbers

# Which state each event leads to, and from which states it is allowed.
MOVES = {
    "in_review": ("received", "held"),
    "approved": ("in_review",),
    "held": ("received", "in_review", "approved"),
    "withdrawn": ("received", "in_review", "held", "approved"),
}
LEADS_TO = {"received": "received", "in_review": "in_review", "approve": "approved", "hold": "held", "retract": "withdrawn"}


def current_verdicts(events: DataFrame, kinds: list[str]) -> DataFrame:
    """(submission, reviewer, kind, at): the latest verdict of each reviewer, by event time, then arrival."""
    given = events.filter(F.col("kind").isin(kinds))
    last = given.groupBy("submission", "reviewer").agg(F.max_by(F.struct("kind", "at"), F.struct("at", "seq")).alias("v"))
    return last.select("submission", "reviewer", "v.kind", "v.at")


def is_approvable(verdicts: DataFrame) -> DataFrame:
    """(submission, approvals, objections, approvable): one approval and no standing objection."""
    counted = verdicts.groupBy("submission").agg(F.sum((F.col("kind") == "approve").cast("long")).alias("approvals"), F.sum((F.col("kind") == "hold").cast("long")).alias("objections"))
    return counted.withColumn("approvable", (F.col("approvals") > 0) & (F.col("objections") == 0))


def stale_live(events: DataFrame, now: Column, days: int) -> DataFrame:
    """(submission, last_at, idle_days) of items that nothing has happened to for so many days."""
    last = events.groupBy("submission").agg(F.max("at").alias("last_at"))
    idle = F.floor((F.unix_timestamp(now) - F.unix_timestamp("last_at")) / 86400).cast("long")
    return last.withColumn("idle_days", idle).filter(F.col("idle_days") >= days)


def due_actions(events: DataFrame, now: Column, hold_hours: int, dormant_days: int) -> DataFrame:
    """(submission, action): approvals whose hold is over without a later objection publish, silent items go dormant."""
    last = events.groupBy("submission").agg(
        F.max("at").alias("last_at"),
        F.max(F.when(F.col("kind") == "approve", F.struct("at", "seq"))).alias("approved"),
        F.max(F.when(F.col("kind").isin("hold", "retract"), F.struct("at", "seq"))).alias("objected"),
    )
    waited = F.unix_timestamp(now) - F.unix_timestamp("approved.at")
    publish = F.col("approved").isNotNull() & (F.col("objected").isNull() | (F.col("objected") < F.col("approved"))) & (waited >= hold_hours * 3600)
    dormant = F.unix_timestamp(now) - F.unix_timestamp("last_at") >= dormant_days * 86400
    action = F.when(publish, "publish").when(dormant, "dormant")
    return last.select("submission", action.alias("action")).filter("action is not null")


def review_state(events: DataFrame) -> DataFrame:
    """(submission, state, refused): events folded in order of event time; illegal moves are counted, not made."""
    ordered = events.groupBy("submission").agg(F.array_sort(F.collect_list(F.struct("at", "seq", "kind"))).alias("log"))
    start = F.struct(F.lit("received").alias("state"), F.lit(0).cast("long").alias("refused"))

    def step(held: Column, event: Column) -> Column:
        to = F.lit(None).cast("string")
        for kind, state in LEADS_TO.items():
            to = F.when(event["kind"] == kind, state).otherwise(to)
        allowed = F.lit(False)
        for state, sources in MOVES.items():
            allowed = allowed | ((to == state) & held["state"].isin(*sources))
        same = (to == held["state"]) | (event["kind"] == "received")
        return F.struct(F.when(allowed, to).otherwise(held["state"]).alias("state"), (held["refused"] + F.when(allowed | same, 0).otherwise(1)).alias("refused"))

    return ordered.select("submission", F.aggregate("log", start, step).alias("x")).select("submission", "x.state", "x.refused")


def waiting_on(verdicts: DataFrame, events: DataFrame) -> DataFrame:
    """(submission, waits_for, since): an objection first, then an approval, then a first look."""
    seen = events.groupBy("submission").agg(F.min("at").alias("received_at"))
    judged = verdicts.groupBy("submission").agg(F.min(F.when(F.col("kind") == "hold", F.col("at"))).alias("held_at"), F.min(F.when(F.col("kind") == "approve", F.col("at"))).alias("approved_at"))
    rows = seen.join(judged, "submission", "left")
    what = F.when(F.col("held_at").isNotNull(), "answer").when(F.col("approved_at").isNotNull(), "publication").otherwise("review")
    return rows.select("submission", what.alias("waits_for"), F.coalesce("held_at", "approved_at", "received_at").alias("since"))


def decision_record(events: DataFrame) -> DataFrame:
    """(submission, n_verdicts, kinds): final dispositions without free text."""
    return events.groupBy("submission").agg(F.count("*").alias("n_verdicts"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


# ---- rules of single entries ----


def verdict_rules(verdicts: DataFrame, reviewers: DataFrame, revisions: DataFrame) -> DataFrame:
    """(id, accepted, reason): unknown reviewers are filed, not dropped; objections need a text, revisions must exist, and
    nobody approves a revision of their own.

    ``verdicts`` (id, submission, reviewer, revision, kind, text), ``reviewers`` (reviewer), ``revisions`` (submission, revision, author).
    """
    known = reviewers.select("reviewer").distinct().withColumn("_known", F.lit(True))
    there = revisions.groupBy("submission", "revision").agg(F.min("author").alias("_author"))
    rows = verdicts.join(known, "reviewer", "left").join(there, ["submission", "revision"], "left")
    reason = (
        F.when(F.col("_known").isNull(), "filed: unknown reviewer")
        .when(F.col("_author").isNull(), "refused: no such revision")
        .when((F.col("kind") == "hold") & (F.trim(F.coalesce("text", F.lit(""))) == ""), "refused: an objection needs a text")
        .when((F.col("kind") == "approve") & (F.col("_author") == F.col("reviewer")), "refused: own revision")
        .otherwise("")
    )
    return rows.select("id", (reason == "").alias("accepted"), reason.alias("reason"))


def bump_revision(verdicts: DataFrame, bumps: DataFrame) -> DataFrame:
    """(id, standing): a later revision voids approvals given before it and keeps objections; ``bumps`` is (submission, at)."""
    last = bumps.groupBy("submission").agg(F.max("at").alias("_bumped"))
    void = (F.col("kind") == "approve") & F.coalesce(F.col("at") < F.col("_bumped"), F.lit(False))
    return verdicts.join(last, "submission", "left").select("id", (~void).alias("standing"))


def revision_author(events: DataFrame) -> DataFrame:
    """(submission, author): who typed the latest record."""
    return events.groupBy("submission").agg(F.max_by("reviewer", F.struct("at", "seq")).alias("author"))


# What the public sees of each state.
PUBLIC = {"received": "received", "in_review": "under review", "held": "under review", "approved": "accepted", "withdrawn": "closed"}


def public_state(states: DataFrame, now: Column, hold_hours: int) -> DataFrame:
    """(submission, public): a coarse status; an approval shows only when its hold is over. ``states`` (submission, state, since)."""
    shown = F.lit("closed")
    for state, words in PUBLIC.items():
        shown = F.when(F.col("state") == state, words).otherwise(shown)
    hidden = (F.col("state") == "approved") & (F.unix_timestamp(now) - F.unix_timestamp("since") < hold_hours * 3600)
    return states.select("submission", F.when(hidden, "under review").otherwise(shown).alias("public"))


def public_queue(entries: DataFrame, states: DataFrame, now: Column, hold_hours: int) -> DataFrame:
    """(position, submission, name, public): what the public sees of open items, the oldest first; held-back entries and closed ones are not told.

    ``entries`` (submission, name, embargoed), ``states`` (submission, state, since). Positions come from a range-sorted, stored table's
    partition counts, so there is no window over the whole queue.
    """
    told = public_state(states, now, hold_hours).filter("public <> 'closed'").join(states.select("submission", "since"), "submission")
    rows = entries.filter("not embargoed").join(told, "submission").select("submission", "name", "public", "since")
    return row_numbers(rows, ["since", "submission"], "position").select("position", "submission", "name", "public")


def notices_due(events: DataFrame, now: Column, hold_hours: int, sent: DataFrame, clashing: DataFrame) -> DataFrame:
    """(submission): settled items: an approval whose hold is over, no later objection, no name clash, nothing sent before."""
    due = due_actions(events, now, hold_hours, 1 << 20).filter("action = 'publish'").select("submission")
    return due.join(sent.select("submission"), "submission", "left_anti").join(clashing.select("submission"), "submission", "left_anti")


def releasable(entries: DataFrame) -> DataFrame:
    return entries.filter((F.col("state") == "approved") & ~F.coalesce("embargoed", F.lit(False)))


def pending_corrections(entries: DataFrame) -> DataFrame:
    """(submission, correction, status) of array column corrections (name, approved, applied) that still wait."""
    rows = entries.select("submission", F.explode("corrections").alias("x")).filter("not x.applied")
    return rows.select("submission", F.col("x.name").alias("correction"), F.when(F.col("x.approved"), "to apply").otherwise("awaiting approval").alias("status"))


def pending_work(arrived: DataFrame, results: DataFrame, excluded: DataFrame) -> DataFrame:
    """(item, status): complete items without a result, and incomplete ones apart; excluded ones are left out."""
    left = arrived.join(results.select("item"), "item", "left_anti").join(excluded.select("item"), "item", "left_anti")
    return left.select("item", F.when(F.col("complete"), "to do").otherwise("incomplete").alias("status"))
