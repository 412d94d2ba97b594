"""Tables of unknown layout as long rows of cells (table, row, col, text): headers, shapes of values, slots, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def header_map(cells: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(table, row, col, field): each header cell's field, by the synonym that ends furthest right, then the longest, then by name.

    ``synonyms`` (field, word) is a short vocabulary; distinct cell texts, not cells, are met with it.
    """
    folded = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    texts = cells.select(folded.alias("folded")).distinct().filter("folded <> ''")
    at = F.expr("locate(reverse(concat(' ', word, ' ')), reverse(concat(' ', folded, ' ')))")
    hits = texts.join(F.broadcast(synonyms), F.concat(F.lit(" "), "folded", F.lit(" ")).contains(F.concat(F.lit(" "), F.col("word"), F.lit(" "))))
    best = hits.groupBy("folded").agg(F.min(F.struct(at.alias("from_right"), (-F.length("word")).alias("shorter"), F.col("field"))).alias("top"))
    return cells.withColumn("folded", folded).join(best, "folded").select("table", "row", "col", F.col("top.field").alias("field"))


def header_row(cells: DataFrame, mapped: DataFrame, first_rows: int = 15) -> DataFrame:
    """(table, row): of the first rows the one with most different fields, then most label-like cells, then the first."""
    labels = cells.filter(F.col("row") < first_rows).groupBy("table", "row").agg(F.sum((F.col("text").rlike("[A-Za-z]") & ~F.col("text").rlike("[0-9]")).cast("long")).alias("labels"))
    fields = mapped.filter(F.col("row") < first_rows).groupBy("table", "row").agg(F.count_distinct("field").alias("fields"))
    scored = labels.join(fields, ["table", "row"])
    return scored.groupBy("table").agg(F.max(F.struct("fields", "labels", (-F.col("row")).alias("up"))).alias("top")).select("table", (-F.col("top.up")).alias("row"), F.col("top.fields").alias("fields"))


def value_shape_fit(cells: DataFrame, shapes: DataFrame, sampled: int = 60, least: float = 0.3) -> DataFrame:
    """(table, col, field, share, fits): the share of a column's first values that have the field's shape.

    The first ``sampled`` values of a column are the feature's bound; ``shapes`` is (table, col, field, pattern, vocabulary flag).
    """
    turn = F.row_number().over(Window.partitionBy("table", "col").orderBy("row"))
    few = cells.filter("trim(text) <> ''").withColumn("_t", turn).filter(F.col("_t") <= sampled)
    joined = few.join(shapes, ["table", "col"])
    shared = joined.groupBy("table", "col", "field").agg(F.avg(F.expr("cast(text rlike pattern as double)")).alias("share"), F.max("strict").alias("strict"))
    return shared.select("table", "col", "field", F.round("share", 6).alias("share"), (F.col("share") >= F.when(F.col("strict"), 0.9).otherwise(least)).alias("fits"))


def slot_unpivot(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """(table, row, slot, field, text): columns such as "host 2" as one row a slot, of slots with equal sets of fields.

    ``headers`` is (table, col, field, slot), a null slot for what all slots of a row share.
    """
    signatures = headers.filter("slot is not null").groupBy("table", "slot").agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("signature"))
    most = signatures.groupBy("table", "signature").agg(F.count("*").alias("n")).groupBy("table").agg(F.max_by("signature", F.struct("n", "signature")).alias("signature"))
    slots = signatures.join(most, ["table", "signature"]).select("table", "slot")
    own = headers.filter("slot is not null").join(slots, ["table", "slot"])
    shared = headers.filter("slot is null").drop("slot").join(slots, "table")
    return cells.join(own.unionByName(shared), ["table", "col"]).filter("trim(text) <> ''").select("table", "row", "slot", "field", "text")


def row_routing(rows: DataFrame, host_words: list[str]) -> DataFrame:
    """(table, row, route): complete rows are records or vectors, accessions are kept anyway, documentation is left out."""
    documented = F.lower(F.coalesce("lineage", F.lit(""))).isin(*host_words)
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    route = (
        F.when(documented, "documentation").when(has("lineage") & has("host") & has("vector"), "record and vector").when(has("lineage") & has("host"), "record")
        .when(has("lineage") & has("vector"), "vector").when(has("accession"), "accession only").otherwise("incomplete")
    )
    return rows.select("table", "row", route.alias("route"))


_BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"


def layout_blocks(lines: DataFrame, least: int = 3) -> DataFrame:
    """(doc, block, line, text, structured, caption): runs of lines of which at least ``least`` have cells apart by two blanks or more.

    ``lines`` is (doc, line, text). A page break, a second blank line or a second line of prose in a row (blank lines aside) ends
    a run; single ones stay inside. The caption is the last prose before a run. Lines of a document are ordered in one window.
    """
    trimmed = F.regexp_replace("text", f"^{_BLANK}+|{_BLANK}+$", "")
    kind = F.when(F.col("text").contains("\f"), "break").when(trimmed == "", "blank").when(trimmed.rlike(f"{_BLANK}{{2,}}"), "cells").otherwise("prose")
    order = Window.partitionBy("doc").orderBy("line")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = lines.select("doc", "line", F.coalesce("text", F.lit("")).alias("text")).withColumn("kind", kind).withColumn("_said", F.when(F.col("kind") == "prose", trimmed))
    last = F.last(F.when(F.col("kind") != "blank", F.col("kind")), ignorenulls=True).over(before)
    ends = (F.col("kind") == "break") | ((F.col("kind") == "blank") & (F.lag("kind").over(order) == "blank")) | ((F.col("kind") == "prose") & (last == "prose"))
    marked = known.withColumn("_ends", F.coalesce(ends, F.lit(False))).withColumn("_caption", F.last("_said", ignorenulls=True).over(before))
    run = F.sum(F.col("_ends").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = marked.withColumn("_run", run).filter(~F.col("_ends"))
    inside = Window.partitionBy("doc", "_run").orderBy("line")
    begun = F.sum((F.col("kind") == "cells").cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy("doc", "_run")
    held = runs.withColumn("_begun", begun).filter(F.col("_begun") > 0)
    held = held.withColumn("_n", F.max("_begun").over(whole)).filter(F.col("_n") >= least)
    caption = F.first("_caption").over(inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return held.select("doc", F.col("_run").alias("block"), "line", "text", (F.col("kind") == "cells").alias("structured"), F.coalesce(caption, F.lit("")).alias("caption"))


def column_spans(blocks: DataFrame) -> DataFrame:
    """(doc, block, spans): columns as [first, last) places. What is blank on every structured line for two places or more is between columns."""
    places = F.filter(F.transform(F.split("text", ""), lambda c, k: F.when(~c.rlike(_BLANK) & (c != ""), k)), lambda k: k.isNotNull())
    taken = blocks.filter("structured").select("doc", "block", F.explode(places).alias("place")).groupBy("doc", "block").agg(F.array_sort(F.collect_set("place")).alias("p"))
    width = blocks.groupBy("doc", "block").agg(F.max(F.length("text")).alias("width"))
    edge = lambda k: F.filter("p", lambda x: ~F.array_contains("p", x + k) & ~F.array_contains("p", x + 2 * k))
    spans = F.zip_with(edge(-1), edge(1), lambda a, z: F.struct(F.when(a == 1, 0).otherwise(a).alias("first"), F.when(z + 2 == F.col("width"), F.col("width")).otherwise(z + 1).alias("last")))
    return taken.join(width, ["doc", "block"]).select("doc", "block", spans.alias("spans"))


def carve_layout(lines: DataFrame, least: int = 3) -> DataFrame:
    """(doc, block, caption, row, col, text): tables of text whose columns stand under each other, a row for each cell that is not blank.

    Every line of a block is cut at the columns of its structured lines. A row without a first cell continues the row above: its
    cells are joined to that row's by one space. Blocks of fewer than two columns or ``least`` rows are none. Blocks count
    from 0 in each document, rows and columns in each block.
    """
    blocks = layout_blocks(lines, least)
    cut = F.transform("spans", lambda s: F.regexp_replace(F.substring(F.col("text"), s["first"] + 1, s["last"] - s["first"]), f"^{_BLANK}+|{_BLANK}+$", ""))
    spoken = blocks.filter(F.col("text").rlike(f"[^{_BLANK[1:]}"))
    rows = spoken.join(column_spans(blocks), ["doc", "block"]).filter(F.size("spans") >= 2).withColumn("cells", cut)
    inside = Window.partitionBy("doc", "block").orderBy("line")
    numbered = rows.withColumn("row", F.sum((F.col("cells")[0] != "").cast("int")).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    # a block whose first row has no first cell begins with it all the same
    open_first = F.max((F.col("_first") & (F.col("cells")[0] == "")).cast("int")).over(Window.partitionBy("doc", "block"))
    numbered = numbered.withColumn("row", F.col("row") - 1 + open_first)
    numbered = numbered.withColumn("_rows", F.max("row").over(Window.partitionBy("doc", "block")) + 1).filter(F.col("_rows") >= least)
    cells = numbered.select("doc", "block", "caption", "row", "line", F.posexplode("cells").alias("col", "text")).filter("text <> ''")
    joined = cells.groupBy("doc", "block", "caption", "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), " ").alias("text"))
    return joined.withColumn("block", F.dense_rank().over(Window.partitionBy("doc").orderBy("block")) - 1)


def mine_binomials(sentences: DataFrame, genera: DataFrame, stop: list[str]) -> DataFrame:
    """(doc, genus, epithet, kind) of two-word names whose genus is known, but for stop words as epithets; a footnote letter behind an epithet goes."""
    found = sentences.select("doc", F.explode(F.regexp_extract_all("text", F.lit(r"\b([A-Z][a-z]+ [a-z]{3,})"), F.lit(1))).alias("name"))
    words = found.select("doc", F.split_part("name", F.lit(" "), F.lit(1)).alias("genus"), F.split_part("name", F.lit(" "), F.lit(2)).alias("epithet"))
    return words.filter(~F.col("epithet").isin(*stop)).join(genera, "genus").select("doc", "genus", "epithet", "kind").distinct()


def pooled_compilation(lines: DataFrame, cues: list[str]) -> DataFrame:
    """(doc, cues, citations, pooled): a document that says it compiles others' records and cites several."""
    said = F.lit(False)
    for cue in cues:
        said = said | F.lower("text").contains(cue)
    # a year stands by itself, with a letter at most: not at the head of a longer number, a key or a version
    cites = F.size(F.regexp_extract_all("text", F.lit(r"\(?[A-Z][a-z]+(?: et al)?\.?,? (?:19|20)[0-9]{2}[a-z]?\b(?!\.[0-9])\)?"), F.lit(0)))
    summed = lines.groupBy("doc").agg(F.sum(said.cast("long")).alias("cues"), F.sum(cites).cast("long").alias("citations"))
    return summed.withColumn("pooled", (F.col("cues") > 0) & (F.col("citations") > 0))


def name_stated(records: DataFrame, fields: list[str], known: DataFrame) -> DataFrame:
    """(id, name): records with a field that is exactly a stored name, the smallest of several."""
    cells = records.select("id", F.explode(F.array(*[F.trim(F.col(c).cast("string")) for c in fields])).alias("name")).filter("name <> ''")
    return cells.join(known.select(F.col(known.columns[0]).alias("name")).distinct(), "name", "left_semi").groupBy("id").agg(F.min("name").alias("name"))
