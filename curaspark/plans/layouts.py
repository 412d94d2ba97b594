"""Queries in SQL text with the library's functions, text layouts and partitioned sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from curaspark.functions import sql
from curaspark.operators import cells
from curaspark.operators.shared import shared_folder
from curaspark.plans import scalars
from curaspark.plans.relational import _papers, t
from curaspark.plans.views import oracle
from curaspark.sources import store

QUERIES: dict = {}


def query(text: str | None):
    def add(f):
        QUERIES[f.__name__] = (f, oracle(text) if text else None)
        return f

    return add


def queries() -> dict:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in QUERIES.items() if text}


# ---- SQL text ----


@query("SELECT doc_id, unnest(['PV9484' || (10 + doc_id % 80), 'PV9484' || (11 + doc_id % 80)]) AS accession FROM {documents} WHERE doc_id % 5 = 0")
def expand_range_lateral(spark, d):
    """The table function beside each paper, in SQL text."""
    sql.register(spark)
    return spark.sql("SELECT doc_id, accession FROM {papers}, LATERAL expand_range(text)", papers=_papers(spark, d).select("doc_id", "text"))


def _of(name: str) -> str:
    """The oracle's own expression of a scalar query with one column v."""
    return scalars.SCALARS[name][1].removesuffix(" AS v")


@query(f"""SELECT k, {_of('lineage_name')} AS lineage, {_of('norm_country')} AS country, {scalars._PUB} AS reference, {scalars._LAT} AS latitude, {scalars._AMINO} AS amino FROM {{v_cells}}""")
def sql_functions(spark, d):
    """The temporary functions over every cell, in SQL text."""
    sql.register(spark)
    text = "SELECT k, lineage_name(words) AS lineage, norm_country(words) AS country, ref_published_form(ref) AS reference, parse_coordinate(coord, true) AS latitude, translate4(seq) AS amino FROM {cells}"
    return spark.sql(text, cells=t(spark, d, "v_cells"))


# ---- layouts ----

#: Twelve parts a page: caption, heading, a row a part (every fifth wraps into a second line), a sub-heading, a page break, and prose behind.
#: A remark right after a wrapped line is a second line of prose, which ends the table.
_PAGE = "CAST(floor(p_partkey / 12) AS BIGINT)"


@query(f"""WITH p AS (SELECT {_PAGE} AS doc, p_partkey, 'P' || p_partkey AS a, CASE WHEN p_partkey % 5 = 0 THEN p_name || ' (' || p_size || ')' ELSE p_name END AS b, p_brand AS c FROM {{part}}),
n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY p_partkey) AS row, count(*) OVER (PARTITION BY doc) AS n, max(p_partkey) OVER (PARTITION BY doc) AS z FROM p),
r AS (SELECT doc, row, a, b, c FROM n UNION ALL SELECT DISTINCT doc, 0, 'Identifier', 'Name of part', 'Brand' FROM n UNION ALL SELECT DISTINCT doc, n + 1, 'Remarks', NULL, NULL FROM n WHERE z % 5 <> 0)
SELECT doc, CAST(0 AS BIGINT) AS block, 'Table ' || doc AS caption, CAST(row AS BIGINT) AS row, col, CASE col WHEN 0 THEN a WHEN 1 THEN b ELSE c END AS text
FROM r CROSS JOIN (SELECT unnest([0, 1, 2]) AS col) WHERE doc IN (SELECT doc FROM n WHERE n >= 2) AND CASE col WHEN 0 THEN a WHEN 1 THEN b ELSE c END IS NOT NULL""")
def carve_layout(spark, d):
    rows = t(spark, d, "part").select(
        F.floor(F.col("p_partkey") / 12).alias("doc"), "p_partkey",
        F.concat(F.rpad(F.concat(F.lit("P"), "p_partkey"), 12, " "), F.rpad("p_name", 50, " "), F.col("p_brand"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("\n" + " " * 12), F.lit("("), "p_size", F.lit(")"))).otherwise("")).alias("text"),
    )
    head = F.concat(F.lit("Prose before.\nTable "), "doc", F.lit("\n" + "Identifier".ljust(12) + "Name of part".ljust(50) + "Brand\n\n"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "text"))), lambda x: x["text"]), "\n")
    pages = rows.groupBy("doc").agg(body.alias("body")).select("doc", F.concat(head, "body", F.lit("\nRemarks\nProse behind.\n\f\nTwo  cells\nare  no table")).alias("text"))
    lines = pages.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return cells.carve_layout(lines).withColumn("row", F.col("row").cast("long"))


# ---- sources ----


@query("""WITH p AS (SELECT p_partkey % 4 AS file, row_number() OVER (PARTITION BY p_partkey % 4 ORDER BY p_partkey) - 1 AS row, p_partkey, p_name, p_size, p_brand FROM {part})
SELECT file, row, col, CASE col WHEN 0 THEN 'P' || p_partkey WHEN 1 THEN p_name || ', "' || p_size || '"' || chr(10) || 'more' ELSE p_brand END AS value FROM p CROSS JOIN (SELECT unnest([0, 1, 2]) AS col)""")
def scan_supplement(spark, d):
    """Quoted cells with delimiters, quotes and line ends, from files that are cut for their tasks."""
    folder = shared_folder(spark)
    quoted = F.concat(F.lit('"'), "p_name", F.lit(', ""'), "p_size", F.lit('""\nmore"'))
    rows = t(spark, d, "part").select((F.col("p_partkey") % 4).alias("file"), "p_partkey", F.concat_ws(",", F.concat(F.lit("P"), "p_partkey"), quoted, F.col("p_brand")).alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "p_partkey").select("file", "value").write.partitionBy("file").text(folder)
    cells_ = store.scan_cells(spark, folder)
    return cells_.select(F.regexp_extract("document", r"file=(\d+)", 1).cast("long").alias("file"), F.col("row").cast("long").alias("row"), F.col("column").alias("col"), "value")
