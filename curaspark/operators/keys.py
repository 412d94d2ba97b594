"""Record identities: natural keys, numbered ids, first-row rules, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.operators.shared import stored


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; an aggregate, so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    top = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def natural_key_violations(df: DataFrame, keys: list[str], record_id: str) -> DataFrame:
    """Keys carried by more than one row, with the number of rows and their sorted ids."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.col(record_id))).alias("ids"))
    return repeated.filter("n > 1")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def id_high_water(df: DataFrame, column: str, prefix: str, floor: int = 0) -> DataFrame:
    """The highest number of the ids of a prefix, never below the floor."""
    number = F.regexp_extract(column, f"^{prefix}-([0-9]+)$", 1).try_cast("long")
    return df.agg(F.greatest(F.coalesce(F.max(number), F.lit(0)), F.lit(floor)).alias("highest"))


def row_numbers(df: DataFrame, order: list[str], as_: str) -> DataFrame:
    """Numbers from 1 in row order, made without bringing the rows into one task.

    Rows are range-partitioned by the order and written once with the number of their partition, so that counting
    and numbering see the same partitions whatever adaptive execution does later. Each partition is then numbered
    by itself from the sum of the counts before it, one small row for each partition.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    within = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    joined = within.join(F.broadcast(before.select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))), "_part")
    return joined.withColumn(as_, F.col("_n") + F.col("_before")).drop("_part", "_n", "_before")


def assign_ids(df: DataFrame, order: list[str], prefix: str, start: int = 0, id_as: str = "RECORD_ID") -> DataFrame:
    """New ids above ``start`` in row order, of six digits or more."""
    digits = (F.col("_number") + start).cast("string")
    number = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    return row_numbers(df, order, "_number").withColumn(id_as, F.concat(F.lit(f"{prefix}-"), number)).drop("_number")


def stamp_provenance(df: DataFrame, source: str, release: str) -> DataFrame:
    """Fill blank provenance, leave what is there."""
    for name, value in (("_source", source), ("_added", release)):
        had = F.col(name) if name in df.columns else F.lit("")
        df = df.withColumn(name, F.coalesce(F.nullif(had, F.lit("")), F.lit(value)))
    return df


def numbered(df: DataFrame, keys: list[str], order: list[str], as_: str = "_n") -> DataFrame:
    """The how-manieth row of its key each row is."""
    return df.withColumn(as_, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def pair_nth_with_nth(before: DataFrame, after: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, n, outcome): the n-th row before meets the n-th after; what is over is added or removed."""
    a = numbered(before, keys, order).select(*keys, "_n", F.lit(True).alias("_was"))
    b = numbered(after, keys, order).select(*keys, "_n", F.lit(True).alias("_now"))
    both = a.join(b, [*keys, "_n"], "full")
    outcome = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("kept")
    return both.select(*keys, F.col("_n").alias("n"), outcome.alias("outcome"))
