"""Editions compared as multisets, identity-keeping merges, logged corrections."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.functions.text import norm_ws, py_strip
from curaspark.operators.shared import stored
from curaspark.operators.keys import numbered


def multiset_compare(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """(side, columns, n): rows only before or only after, repetitions counted, white space normalized.

    One aggregation over both sides: equal rows cancel out in their counts.
    """
    clean = lambda df, sign: df.select(*[norm_ws(F.col(c).cast("string")).alias(c) for c in columns], F.lit(sign).alias("_sign"))
    both = clean(before, -1).unionByName(clean(after, 1)).groupBy(*columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    return both.select(F.when(F.col("_net") < 0, "before").otherwise("after").alias("side"), *columns, F.abs("_net").cast("long").alias("n"))


def diff_table(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, kind, column, was, now, n) of a table by natural key.

    A key with one row on each side is modified column by column; keys with several rows on a side are
    compared as multisets, their surplus added or removed, and marked ambiguous.
    """
    side = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(f"n_{name}"), F.min(F.struct(*columns)).alias(name))
    both = side(before, "was").join(side(after, "now"), keys, "full").fillna(0, ["n_was", "n_now"])
    simple = both.filter("n_was <= 1 and n_now <= 1")
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    whole = simple.filter("n_was <> n_now").select(*keys, F.when(F.col("n_was") == 0, "added").otherwise("removed").alias("kind"), none.alias("column"), none.alias("was"), none.alias("now"), F.lit(1).cast("long").alias("n"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), text(f"was.{c}").alias("was"), text(f"now.{c}").alias("now")) for c in columns])
    changed = simple.filter("n_was = 1 and n_now = 1").select(*keys, F.explode(F.filter(cells, lambda x: ~x["was"].eqNullSafe(x["now"]))).alias("c"))
    modified = changed.select(*keys, F.lit("modified").alias("kind"), "c.column", "c.was", "c.now", F.lit(1).cast("long").alias("n"))
    several = both.filter("n_was > 1 or n_now > 1").select(*keys)
    net = (
        before.select(*keys, *columns, F.lit(-1).alias("_s")).unionByName(after.select(*keys, *columns, F.lit(1).alias("_s"))).join(several, keys, "left_semi")
        .groupBy(*keys, *columns).agg(F.sum("_s").alias("_net")).filter("_net <> 0")
    )
    surplus = net.groupBy(*keys, (F.col("_net") > 0).alias("_more")).agg(F.sum(F.abs("_net")).alias("n"))
    ambiguous = surplus.select(*keys, F.when(F.col("_more"), "ambiguous added").otherwise("ambiguous removed").alias("kind"), none.alias("column"), none.alias("was"), none.alias("now"), F.col("n").cast("long").alias("n"))
    return whole.unionByName(modified).unionByName(ambiguous)


def edition_totals(before: dict[str, DataFrame | None], after: dict[str, DataFrame | None]) -> DataFrame:
    """(entity, previous, current, delta); a missing table is null, which is not zero."""
    parts = None
    for name in dict.fromkeys([*before, *after]):
        # one small row from each table
        a, b = before.get(name), after.get(name)
        count = lambda df, as_: df.agg(F.count("*").alias(as_)) if df is not None else None
        row = count(a, "previous") if a is not None else count(b, "current").select(F.lit(None).cast("long").alias("previous"))
        row = row.crossJoin(count(b, "current")) if b is not None else row.withColumn("current", F.lit(None).cast("long"))
        row = row.select(F.lit(name).alias("entity"), "previous", "current", (F.col("current") - F.col("previous")).alias("delta"))
        parts = row if parts is None else parts.union(row)
    return parts


def new_retired(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    a, b = (df.select(F.col(column).alias("value")).filter("value <> ''").distinct() for df in (before, after))
    return b.subtract(a).select("value", F.lit("new").alias("kind")).union(a.subtract(b).select("value", F.lit("retired").alias("kind")))


def column_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(column, changed) over keys that stand once on both sides."""
    once = lambda df, name: df.groupBy(key).agg(F.count("*").alias(f"n_{name}"), F.min(F.struct(*columns)).alias(name)).filter(F.col(f"n_{name}") == 1)
    both = once(before, "was").join(once(after, "now"), key)
    flags = F.array(*[F.struct(F.lit(c).alias("column"), (~F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}"))).cast("long").alias("changed")) for c in columns])
    return both.select(F.explode(flags).alias("x")).groupBy("x.column").agg(F.sum("x.changed").alias("changed"))


# ---- corrections ----


def plan_correction(df: DataFrame, record_id: str, where: dict[str, str], column: str, value: str) -> DataFrame:
    """(record, was, now) of the rows that a correction would change."""
    chosen = df
    for name, wanted in where.items():
        chosen = chosen.filter(py_strip(F.col(name)) == wanted.strip())
    return chosen.filter(F.col(column) != value).select(F.col(record_id).alias("record"), F.col(column).alias("was"), F.lit(value).alias("now"))


def apply_correction(df: DataFrame, where: dict[str, str], column: str, value: str) -> DataFrame:
    test = F.lit(True)
    for name, wanted in where.items():
        test = test & (py_strip(F.col(name)) == wanted.strip())
    return df.withColumn(column, F.when(test, value).otherwise(F.col(column)))


def replay_corrections(df: DataFrame, log: list[dict], record_id: str) -> DataFrame:
    """(correction, changed): every logged correction applied again in order; zero changed is not needed.

    The log is a control table of few rows; it becomes one chain of expressions over one scan, with a
    counter for each correction.
    """
    counters = []
    for k, entry in enumerate(log):
        test = F.col(entry["column"]) != entry["value"]
        for name, wanted in entry["where"].items():
            test = test & (py_strip(F.col(name)) == wanted.strip())
        df = df.withColumn(f"_c{k}", test.cast("long"))
        df = apply_correction(df, entry["where"], entry["column"], entry["value"])
        counters.append(F.struct(F.lit(k).alias("correction"), F.col(f"_c{k}").alias("changed")))
    return df.select(F.explode(F.array(*counters)).alias("x")).groupBy("x.correction").agg(F.sum("x.changed").alias("changed"))


# ---- merge ----


def replace_source(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str], source: str) -> DataFrame:
    """(outcome, n) of every outcome, also with n 0: one source's rows replaced, the n-th row of a key keeping the n-th row's id."""
    own = existing.filter(F.col("_source") == source)
    a = numbered(own, keys, order).select(*keys, "_n", F.lit(1).alias("_was"))
    b = numbered(incoming, keys, order).select(*keys, "_n", F.lit(1).alias("_now"))
    outcome = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("replaced")
    counted = a.join(b, [*keys, "_n"], "full").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    kept = existing.filter(F.col("_source") != source).agg(F.count("*").alias("n")).select(F.lit("kept").alias("outcome"), "n")
    every = existing.sparkSession.createDataFrame([("replaced",), ("added",), ("removed",), ("kept",)], "outcome string")
    return every.join(counted.union(kept), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


def _pairing(columns: list[str], record_id: str, row_no: str):
    """The grouped function of ``merge_table``; inside another function, so that it is sent by value."""

    def by_rows(was: np.ndarray, now: np.ndarray) -> np.ndarray:
        """The new row that each old row gets, or -1: one old row at a time is compared with all free ones."""
        free, partner = np.arange(len(now)), np.full(len(was), -1)
        least = np.zeros(len(was), np.int64)  # no free row is nearer than that
        for distance in range(was.shape[1] + 1):
            for i in np.flatnonzero((partner < 0) & (least <= distance)).tolist():
                if not len(free):
                    break
                apart = (now[free] != was[i]).sum(axis=1)
                first = int(apart.argmin())
                least[i] = apart[first]
                if least[i] == distance:
                    partner[i] = free[first]
                    free = np.delete(free, first)
        return partner

    def by_subsets(was: np.ndarray, now: np.ndarray) -> np.ndarray:
        """The same by an index: at a distance, rows meet under every set of columns that may agree; where sets outnumber the new rows, by rows."""
        both = np.concatenate([was, now])
        varying = np.flatnonzero((both != both[0]).any(axis=0)).tolist()
        partner, used = np.full(len(was), -1), np.zeros(len(now), bool)
        for distance in range(len(varying) + 1):
            waiting, open_ = np.flatnonzero(partner < 0), np.flatnonzero(~used)
            if not len(waiting) or not len(open_):
                break
            if math.comb(len(varying), distance) > len(open_):
                partner[waiting] = np.append(open_, -1)[by_rows(was[waiting], now[open_])]
                break
            indexes = []
            for agree in itertools.combinations(varying, len(varying) - distance):
                rows = np.concatenate([was[waiting][:, agree], now[open_][:, agree]])
                keys = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1) if agree else np.zeros(len(rows), np.int64)
                mine, theirs = keys[: len(waiting)], keys[len(waiting) :]
                order = np.argsort(theirs, kind="stable")
                heads = np.searchsorted(theirs[order], np.arange(keys.max() + 2))
                indexes.append((mine.tolist(), open_[order].tolist(), heads[:-1].tolist(), heads[1:].tolist()))
            for at, i in enumerate(waiting.tolist()):
                best = -1
                for mine, rows, head, end in indexes:
                    key = mine[at]
                    while head[key] < end[key] and used[rows[head[key]]]:
                        head[key] += 1
                    if head[key] < end[key] and (best < 0 or rows[head[key]] < best):
                        best = rows[head[key]]
                if best >= 0:
                    partner[i], used[best] = best, True
        return partner

    def pair(old: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
        """Greedy by (differing columns, old row, new row); no list of pairs is held."""
        fresh.columns = [*columns, row_no]
        old, fresh = old.sort_values(record_id).reset_index(drop=True), fresh.sort_values(row_no).reset_index(drop=True)
        codes = np.stack([pd.factorize(pd.concat([old[c], fresh[c]], ignore_index=True))[0] for c in columns], axis=1)
        was, now = codes[: len(old)], codes[len(old) :]
        partner = by_subsets(was, now) if len(was) * len(now) > 1 << 20 else by_rows(was, now)
        free = np.setdiff1d(np.arange(len(now)), partner)
        changed = fresh.loc[partner[partner >= 0], columns].reset_index(drop=True)
        changed[record_id] = old.loc[partner >= 0, record_id].to_numpy()
        added = fresh.loc[free, columns].assign(**{record_id: None})
        removed = old.loc[partner < 0, [*columns, record_id]]
        parts = [part.assign(outcome=outcome) for part, outcome in ((changed, "changed"), (added, "added"), (removed, "removed")) if len(part)]
        return pd.concat(parts, ignore_index=True)[[*columns, record_id, "outcome"]]

    return pair


def merge_table(existing: DataFrame, exported: DataFrame, keys: list[str], columns: list[str], record_id: str, row_no: str) -> DataFrame:
    """(columns, record_id or null, outcome): exported rows with the identities they keep.

    Identical rows keep ids n-th with n-th. What is left is paired within a natural key by the fewest
    differing columns, then by the order of old and new rows, which only keys with leftovers on both sides need; the rest is
    new (null id) or removed. Keys with one leftover on a side, nearly all, are paired by a join and an aggregate; only
    keys with several on both go through a grouped map, which holds the rows of one key.
    """
    a = numbered(existing, columns, [record_id])
    b = numbered(exported, columns, [row_no])
    both = stored(a.select(*columns, "_n", record_id).join(b.select(*columns, "_n", row_no), [*columns, "_n"], "full").withColumn("_at", F.monotonically_increasing_id()))
    kind = both.schema[record_id].dataType
    same = both.filter(F.col(record_id).isNotNull() & F.col(row_no).isNotNull()).select(*columns, record_id, F.lit("unchanged").alias("outcome"))
    # stored rows have numbers of their own, as neither ids nor row numbers need be unique
    left = both.filter(F.col(row_no).isNull()).select(*columns, record_id, "_at")
    new = both.filter(F.col(record_id).isNull()).select(*columns, row_no, "_at")
    sides = left.groupBy(*keys).agg(F.count("*").alias("_old")).join(new.groupBy(*keys).agg(F.count("*").alias("_new")), keys)
    sides = stored(sides.select(*keys, ((F.col("_old") > 1) & (F.col("_new") > 1)).alias("_many")))
    many, few = sides.filter("_many").drop("_many"), sides.filter("not _many").drop("_many")

    own, fresh = left.join(few, keys, "left_semi"), new.join(few, keys, "left_semi")
    renamed = fresh.toDF(*[f"_{c}" for c in [*columns, row_no, "_at"]])
    apart = sum((~F.col(c).eqNullSafe(F.col(f"_{c}"))).cast("int") for c in columns)
    met = own.join(renamed, [F.col(k) == F.col(f"_{k}") for k in keys])
    first = F.struct(apart.alias("apart"), F.col(record_id).alias("old"), F.col(f"_{row_no}").alias("new"), F.col("_at").alias("old_at"), F.col("__at").alias("new_at"))
    chosen = stored(met.groupBy(*keys).agg(F.min(first).alias("c"), F.min_by(F.struct(*[F.col(f"_{c}").alias(c) for c in columns]), first).alias("row")))
    changed = chosen.select("row.*", F.col("c.old").alias(record_id), F.lit("changed").alias("outcome"))
    lost = own.join(chosen.select(F.col("c.old_at").alias("_at")), "_at", "left_anti").select(*columns, record_id, F.lit("removed").alias("outcome"))
    more = fresh.join(chosen.select(F.col("c.new_at").alias("_at")), "_at", "left_anti").select(*columns, F.lit(None).cast(kind).alias(record_id), F.lit("added").alias("outcome"))

    # both sides come from one join; new column names tell them apart
    fresh_many = new.join(many, keys, "left_semi").drop("_at").toDF(*[f"{c}_new" for c in [*columns, row_no]])
    paired = left.join(many, keys, "left_semi").drop("_at").groupBy(*keys).cogroup(fresh_many.groupBy(*[f"{k}_new" for k in keys])).applyInPandas(_pairing(columns, record_id, row_no), same.schema)
    removed = left.join(sides, keys, "left_anti").select(*columns, record_id, F.lit("removed").alias("outcome"))
    added = new.join(sides, keys, "left_anti").select(*columns, F.lit(None).cast(kind).alias(record_id), F.lit("added").alias("outcome"))
    parts = [same, changed, lost, more, paired, removed, added]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def blanked_values(before: DataFrame, after: DataFrame, record_id: str, columns: list[str]) -> DataFrame:
    """(record, column, was): cells that held something and would be empty."""
    a = before.select(record_id, *[F.col(c).alias(f"was_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"was_{c}").alias("was"), F.col(c).alias("now")) for c in columns])
    rows = a.join(after.select(record_id, *columns), record_id).select(record_id, F.explode(cells).alias("x"))
    return rows.filter("x.was <> '' and coalesce(x.now, '') = ''").select(F.col(record_id).alias("record"), "x.column", "x.was")
