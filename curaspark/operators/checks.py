"""The check registry: one row for each check with what it looked at, what passed and why it did not run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``finding`` is true of a row that fails; rows where ``applies`` is false are not looked at."""

    name: str
    finding: Callable[[], Column]
    blocking: bool = False
    applies: Callable[[], Column] = lambda: F.lit(True)
    needs: tuple[str, ...] = ()


def results(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """(check, evaluated, passed, findings, outcome, skipped) of every check, all in one pass over the rows.

    A check whose columns are not there is skipped and says so; nothing evaluated counts as not run.
    """
    have, counts, known = set(rows.columns), [], []
    for k, check in enumerate(checks):
        missing = [c for c in check.needs if c not in have]
        known.append((k, check.name, check.blocking, f"no {', '.join(missing)}" if missing else ""))
        if not missing:
            looked = F.coalesce(check.applies(), F.lit(False))
            counts += [F.sum(looked.cast("long")).alias(f"e{k}"), F.sum((looked & F.coalesce(check.finding(), F.lit(False))).cast("long")).alias(f"f{k}")]
    spark = rows.sparkSession
    registry = spark.createDataFrame(known, "k int, check string, blocking boolean, skipped string")
    ran = [k for k, _, _, why in known if not why]
    if counts:
        one = rows.agg(*counts)
        cells = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(f"e{k}", F.lit(0)).alias("evaluated"), F.coalesce(f"f{k}", F.lit(0)).alias("findings")) for k in ran])
        found = one.select(F.explode(cells).alias("x")).select("x.*")
    else:
        found = spark.createDataFrame([], "k int, evaluated long, findings long")
    joined = registry.join(found, "k", "left").na.fill(0, ["evaluated", "findings"])
    outcome = F.when((F.col("skipped") != "") | (F.col("evaluated") == 0), "not run").when(F.col("findings") == 0, "passed").when(F.col("blocking"), "blocked").otherwise("warned")
    return joined.select("check", "evaluated", (F.col("evaluated") - F.col("findings")).alias("passed"), "findings", outcome.alias("outcome"), "skipped")


def findings(rows: DataFrame, checks: list[Check], row_id: str) -> DataFrame:
    """(check, row) of every finding: the long table behind the counts."""
    have = set(rows.columns)
    told = [F.when(F.coalesce(c.applies() & c.finding(), F.lit(False)), c.name) for c in checks if all(n in have for n in c.needs)]
    return rows.select(F.explode(F.array_compact(F.array(*told))).alias("check"), F.col(row_id).alias("row"))


def verdict(result: DataFrame) -> DataFrame:
    """(blocking, incomplete): the names of checks that block, and whether any did not run."""
    blocked = F.array_sort(F.collect_list(F.when(F.col("outcome") == "blocked", F.col("check"))))
    return result.agg(F.array_join(blocked, ",").alias("blocking"), F.max(F.col("outcome") == "not run").alias("incomplete"))


def looked_up(rows: DataFrame, lookups: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """``rows`` with a boolean for each lookup (table, key columns): whether the row's key stands in it.

    Keys are made distinct first, so a frequent key of the table never multiplies rows.
    """

    def add(df: DataFrame, item) -> DataFrame:
        name, (table, key) = item
        return df.join(table.select(*key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))

    return reduce(add, lookups.items(), rows)
