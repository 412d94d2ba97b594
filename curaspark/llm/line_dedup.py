"""Line dedup by a log-template tree, in DataFrame operations only.

Tokens are what single spaces separate. The tree has a fixed depth: token count, then the ``depth``
leading tokens (a token with a digit counts as the variable ``<*>``). In a leaf, identical masked
lines are one entry. An entry's tokens are put in the order of how many of the leaf's texts have them at their
place, so that what a format keeps comes before what it varies; the first tokens in that order are the entry's path
below the leaf. Each path that keeps at least ``similar`` (a fraction) of the tokens, and one more than the leading
ones, is a candidate template, with ``<*>`` at the other places. Entries with the same path share it, so
one leaf can hold any number of templates, and neither the order of lines nor other formats of the leaf matter.

A masked line or a template that stands in ``min_texts`` different texts recurs; for lines of ``long_tokens`` tokens or
more, which prose does not repeat by chance, ``min_long_texts`` are enough. It is kept in the smallest
document that holds it and dropped from all others. Copies of one text count once, so that copied
documents are not emptied as boilerplate.

Skew: lines are counted by (leaf, line, text) first and so pre-aggregated before they meet by line; only entries of
recurring leaves are split into tokens. Windows hold the tokens of one line.

Defined results: a null text has no lines and stays null; an empty text has one empty line; each text of a
repeated id loses its own lines only; a null id never loses a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curaspark.llm import common

VARIABLE = "<*>"


def _masked(line: Column) -> Column:
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(line)


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """(doc_id, body, pos, masked, n, leaf) of every line; body tells texts apart."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    masked = rows.select("doc_id", "body", "pos", _masked(F.col("line")).alias("masked")).withColumn("n", F.size(F.split("masked", " ")))
    return masked.withColumn("leaf", F.xxhash64("n", F.substring_index("masked", " ", depth)))


def recurring_lines(
    docs: DataFrame, min_texts: int = 10, long_tokens: int = 20, min_long_texts: int = 3, depth: int = 3, similar: tuple[int, int] = (7, 10)
) -> DataFrame:
    """(doc_id, body, pos) of the lines to drop, of documents with ``doc_id`` and ``text``."""
    enough = F.col("texts") >= F.when(F.col("n") >= long_tokens, min_long_texts).otherwise(min_texts)
    line = ["line_a", "line_b"]
    lines = _lines(docs, depth)
    hashed = [F.xxhash64("masked").alias("line_a"), F.xxhash64("masked", F.lit(1)).alias("line_b")]
    slim = common.stored(lines.select("doc_id", "body", "pos", "n", "leaf", *hashed))
    by_text = common.stored(slim.groupBy("leaf", "n", *line, "body").agg(F.min("doc_id").alias("low")))
    entries = common.stored(by_text.groupBy("leaf", "n", *line).agg(F.count("*").alias("texts"), F.min("low").alias("low")))
    exact = entries.filter(enough).select(*line, "low")

    leaves = common.stored(entries.groupBy("leaf", "n").agg(F.sum("texts").alias("texts"), F.count("*").alias("entries")).filter(enough & (F.col("entries") > 1)).select("leaf"))
    held = lines.select("leaf", "masked", *hashed).join(common.if_small(leaves), "leaf").distinct()
    counted = common.stored(held.join(entries.select(*line, "n", "texts"), line))
    tokens = counted.select("leaf", *line, "n", "texts", F.posexplode(F.split("masked", " ")).alias("at", "token")).withColumn("token", F.xxhash64("at", "token"))
    shares = common.stored(tokens.groupBy("leaf", "token").agg(F.sum("texts").alias("share")))
    weighed = tokens.join(common.if_small(shares), ["leaf", "token"])
    path = Window.partitionBy(*line).orderBy(F.col("share").desc(), "at").rowsBetween(Window.unboundedPreceding, 0)
    paths = weighed.select("leaf", *line, "n", "texts", F.count("*").over(path).alias("kept"), F.bit_xor("token").over(path).alias("path"))
    paths = common.stored(paths.filter(F.expr(f"kept < n and kept > {depth} and kept >= (n * {similar[0]} + {similar[1] - 1}) div {similar[1]}")))
    # what recurs by its entries' texts, then by texts that differ
    shared = paths.groupBy("leaf", "n", "kept", "path").agg(F.sum("texts").alias("texts"), F.count("*").alias("entries")).filter(enough & (F.col("entries") > 1)).select("kept", "path", "leaf")
    fits = common.stored(paths.join(shared, ["leaf", "kept", "path"]).select("leaf", "kept", "path", *line))
    apart = by_text.join(fits.drop("leaf"), line).groupBy("leaf", "n", "kept", "path", "body").agg(F.min("low").alias("low"))
    templates = common.stored(apart.groupBy("leaf", "n", "kept", "path").agg(F.count("*").alias("texts"), F.min("low").alias("low")).filter(enough).drop("texts", "n"))
    general = fits.join(common.if_small(templates), ["leaf", "kept", "path"]).select(*line, "low")

    drops = common.stored(exact.union(general).groupBy(*line).agg(F.min("low").alias("low")))
    return slim.join(common.if_small(drops), line).filter("doc_id <> low").select("doc_id", "body", "pos")


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_lines: str = "_n_lines", n_dropped: str = "_n_dropped", **rules) -> DataFrame:
    """All columns of ``docs``, its text without the recurring lines, and two counts (columns of their names are replaced)."""
    found = common.stored(recurring_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), **rules))
    own, body, places, rest = (common.fresh(name, docs) for name in ("own", "body", "places", "rest"))
    small = found.count() <= common.SMALL_ROWS
    # as many numbers as the document has lines
    grouped = found.groupBy(F.col("doc_id").alias(own), F.col("body").alias(body)).agg(F.collect_set("pos").alias(places))
    text = F.col(text_col).cast("string")
    joined = docs.join(F.broadcast(grouped) if small else grouped, (F.col(id_col) == F.col(own)) & (F.xxhash64(text) == F.col(body)), "left")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    out = joined.withColumn(rest, F.when(F.col(own).isNotNull(), F.transform(kept, lambda k: F.get(lines, k))))
    return out.select(
        *[F.when(F.col(own).isNull(), F.col(c)).otherwise(F.array_join(rest, "\n")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in (n_lines, n_dropped)],
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
        F.when(F.col(own).isNull(), 0).otherwise(F.size(lines) - F.size(rest)).cast("long").alias(n_dropped),
    )


def clean_lines(docs: DataFrame, **rules) -> DataFrame:
    """Documents without recurring lines; a document that had nothing else is gone. ``n_chars`` is counted anew."""
    n_lines, n_dropped = common.fresh("n_lines", docs), common.fresh("n_dropped", docs)
    out = drop_recurring(docs, n_lines=n_lines, n_dropped=n_dropped, **rules).filter((F.col(n_dropped) == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(n_dropped) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same rules in the oracle's dialect; paths are compared as texts.
LINES_SQL = """
WITH lines AS (
  SELECT doc_id, text, i - 1 AS pos, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
leafed AS (
  SELECT doc_id, text, pos, line, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM lines),
entries AS (
  SELECT masked, count(DISTINCT text) AS texts, min(doc_id) AS low, string_split(masked, ' ') AS tokens,
         len(string_split(masked, ' ')) AS n, array_to_string(string_split(masked, ' ')[1:3], ' ') AS lead,
         CASE WHEN len(string_split(masked, ' ')) >= 20 THEN 3 ELSE 10 END AS need
  FROM leafed GROUP BY masked),
leaves AS (SELECT n, lead FROM entries GROUP BY n, lead HAVING sum(texts) >= any_value(need) AND count(*) > 1),
places AS (
  SELECT *, tokens[k] AS token FROM (SELECT e.*, unnest(range(1, n + 1)) AS k FROM entries e JOIN leaves USING (n, lead))),
shares AS (SELECT n, lead, k, token, sum(texts) AS share FROM places GROUP BY ALL),
paths AS (
  SELECT n, lead, need, masked, texts,
         row_number() OVER (PARTITION BY masked ORDER BY share DESC, k) AS kept,
         string_agg(k || ':' || token, ' ') OVER (PARTITION BY masked ORDER BY share DESC, k ROWS UNBOUNDED PRECEDING) AS path
  FROM places JOIN shares USING (n, lead, k, token)),
shared AS (
  SELECT n, lead, kept, path FROM paths WHERE kept < n AND kept > 3 AND 10 * kept >= 7 * n
  GROUP BY n, lead, kept, path HAVING sum(texts) >= any_value(need) AND count(*) > 1),
fits AS (SELECT p.* FROM paths p JOIN shared USING (n, lead, kept, path)),
templates AS (
  SELECT f.n, f.lead, f.kept, f.path, min(l.doc_id) AS low FROM fits f JOIN leafed l USING (masked)
  GROUP BY ALL HAVING count(DISTINCT l.text) >= any_value(f.need)),
drops AS (
  SELECT masked, min(low) AS low FROM (
    SELECT masked, low FROM entries WHERE texts >= need
    UNION ALL SELECT f.masked, t.low FROM fits f JOIN templates t USING (n, lead, kept, path)) GROUP BY masked),
marked AS (
  SELECT l.doc_id, l.pos, l.line, d.masked IS NOT NULL AND l.doc_id <> d.low AS gone
  FROM leafed l LEFT JOIN drops d USING (masked)),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_dropped, 0) AS n_dropped, c.text
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""
