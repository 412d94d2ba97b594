"""plausibility row by row: nulls, blanks and separators in values, the store as a table and as a condition; one shuffle."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from curaspark.operators import quality

TAXA = ["SPECIES_NAME", "GENUS_NAME", "FAMILY_NAME", "ORDER_NAME"]
COLUMNS = ["LINEAGE_NAME", *TAXA, "COUNTRY_NAME"]
VALUES = ["a", "", None, "\x1e", "\x1f", "\x1e1", "a\x1fb", "\x1e0"]


def _rows():
    lineages = ["L1", "L2", "L3", "", None]
    rows = [(lineage, *[VALUES[(k * (j + 1) + j) % len(VALUES)] for j in range(5)], held) for k, (lineage, held) in enumerate(itertools.product(lineages, [True, False, None] * 8))]
    return rows + [("L4", "a", "a", "a", "a", "a", None), ("L4", "a", "a", "a", "a", "a", False)]


def _expected(rows, store):
    out = set()
    for row in rows:
        mine = [s for s in store if s[0] is not None and s[0] == row[0]]
        seen = lambda k: row[k] is not None and any(s[k] == row[k] for s in mine)  # noqa: B023, E731
        level = next((c.split("_")[0].lower() for k, c in enumerate(TAXA, 1) if seen(k) and row[k] != ""), "new") if mine else "unknown lineage"
        out.add((row[0], row[1], row[5], level, seen(5)))
    return out


@pytest.mark.parametrize("as_condition", [True, False])
def test_plausibility_row_by_row(spark, as_condition):
    rows = _rows()
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS) + ", held boolean")
    out = quality.plausibility(frame, F.col("held") if as_condition else frame.filter("held"))
    assert len(re.findall(r"\bExchange ", out._jdf.queryExecution().executedPlan().toString())) == 1
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found))
    assert set(found) == _expected(rows, [r for r in rows if r[6]])


def test_parts_grow_with_the_files_read(spark, sf, monkeypatch):
    from curaspark.plans import registry

    monkeypatch.setattr(quality, "PART_BYTES", 5_000, raising=False)
    out = registry.queries()["plausibility"](spark, sf)
    dealt = re.findall(r"hashpartitioning\(LINEAGE_NAME#\d+, (\d+)\), REPARTITION_BY_NUM", out._jdf.queryExecution().executedPlan().toString())
    assert len(dealt) == 1 and int(dealt[0]) > int(spark.conf.get("spark.sql.shuffle.partitions"))
