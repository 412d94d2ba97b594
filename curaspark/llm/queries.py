"""The registered queries of the corpus operators and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.llm import common, decontam, gif, hard_negatives, langid, line_dedup, mixing, ngram_join, pii, quality, secret_scan, spelling, substring_dedup, tool_calls


def op1_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.gif_digest(gif.texts_as_gif(common.documents(spark, sf_dir)))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(docs, ~common.held_out())
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", common.held_out().alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~common.held_out())
    found = quality.score(docs, model)
    return found.select("doc_id", common.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _kinds(*kinds: str):
    """How many base spans of each kind."""
    return [F.expr(f"cast(size(filter(found, s -> s.base and s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in kinds]


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    found = secret_scan.find_secrets(docs, secret_scan.learn(docs))
    return found.select("doc_id", *_kinds("assign", "access", "hex"), "base_sha256", "spans")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    found = pii.find_personal_data(docs, pii.learn(docs))
    return found.select("doc_id", *_kinds("email", "ip", "card", "phone"), "base_sha256", "spans")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_recurring(common.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    linked = tool_calls.link_calls(calls, results, tool_calls.turn_schemas(spark))
    return linked.select("conv_id", "turn", "call_id", "status", "position", F.array_join("errors", ";").alias("errors"), "json")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_passages(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(common.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(common.documents(spark, sf_dir), at_least=6)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    word = F.when(F.col("h") % 199 == 0, spelling.without_letter(F.col("run"), F.col("h") % F.length("run"))).otherwise(F.col("run"))
    counts = spelling.count_words(runs.withColumn("h", h).select(word.alias("word")))
    return spelling.spelling_groups(counts).select("word", "form", "root", "n", "n_near", "form_n")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeats(common.documents(spark, sf_dir), texts=False).drop("text")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = hard_negatives.quantised(rows.withColumn("label", moved))
    return hard_negatives.hard_negatives(known, known.filter("id % 100 = 0"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": line_dedup.LINES_SQL, "op8_tool_calls": tool_calls.CALLS_SQL, "op12_substring_dedup": substring_dedup.REPEATS_SQL, "op13_hard_negatives": hard_negatives.NEGATIVES_SQL}
