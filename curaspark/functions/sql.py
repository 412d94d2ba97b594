"""The library's functions for SQL text: temporary functions and a table function, registered in a session."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from curaspark.functions import sequences, text

#: name: (parameters, result, the expression of its parameters)
_FUNCTIONS = {
    "norm_ws": ("x STRING", "STRING", lambda: text.norm_ws(F.col("x"))),
    "lineage_name": ("x STRING", "STRING", lambda: text.lineage_name(F.col("x"))),
    "norm_country": ("x STRING", "STRING", lambda: text.norm_country(F.col("x"))),
    "ref_published_form": ("x STRING", "STRING", lambda: text.ref_published_form(F.col("x"))),
    "parse_latitude": ("x STRING", "DOUBLE", lambda: text.parse_coordinate(F.col("x"), True)),
    "parse_longitude": ("x STRING", "DOUBLE", lambda: text.parse_coordinate(F.col("x"), False)),
    "translate4": ("x STRING", "STRING", lambda: sequences.translate4(F.col("x"))),
    "reverse_complement": ("x STRING", "STRING", lambda: sequences.reverse_complement(F.col("x"))),
}


def _as_sql(body: Column) -> str:
    """The SQL text of an expression. Operators print as functions, whose names need quotes."""
    printed = body._jc.node().sql()
    return re.sub(r"'(?:[^'\\]|\\.)*'|(?<![\w`])(?:[!=<>+\-*/%]+|and|or|in)(?=\()", lambda m: m[0] if m[0].startswith("'") else f"`{m[0]}`", printed)


def _expand_range(longest: int):
    """A table function made here, so that it travels with its plan and executors need no copy of this package."""

    class ExpandRange:
        def eval(self, text: str):
            seen = set()
            for prefix, first, again, last in re.findall(r"\b([A-Z]{1,2})([0-9]{5,6})\s*-\s*([A-Z]{0,2})([0-9]{2,6})\b", text or ""):
                a, b = int(first), int(first[: len(first) - len(last)] + last)
                if again in ("", prefix) and 0 < b - a <= longest:
                    for n in range(a, b + 1):
                        name = f"{prefix}{n:0{len(first)}d}"
                        if name not in seen:
                            seen.add(name)
                            yield (name,)

    return F.udtf(ExpandRange, returnType="accession string")


def register(spark: SparkSession, longest: int = 500) -> list[str]:
    """Make the functions known to the session's SQL; returns their names.

    ``parse_coordinate(x, latitude)`` reads either axis. ``expand_range(text)`` is a table function for ``LATERAL``: a row for each
    accession that the text's ranges stand for; ranges of more than ``longest`` steps are not ranges.
    """
    for name, (parameters, result, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {_as_sql(body())}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION parse_coordinate(x STRING, latitude BOOLEAN) RETURNS DOUBLE RETURN CASE WHEN latitude THEN parse_latitude(x) ELSE parse_longitude(x) END")
    spark.udtf.register("expand_range", _expand_range(longest))
    return [*_FUNCTIONS, "parse_coordinate", "expand_range"]
