"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir); its result is written to the shared folder and read again as the next stage's
documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rodovia.llm.decontamination import without_items
from rodovia.llm.language_id import UNKNOWN, learn_floors, learn_profiles, with_languages
from rodovia.llm.line_dedup import drop_site_lines
from rodovia.llm.near_dedup import near_duplicates
from rodovia.llm.packing import pack
from rodovia.llm.tables import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tell the language of each text, which replaces its ``lang``, and drop documents in which none can be told: null texts, texts
    without letters, and texts too far from the nearest learned language. All labelled documents teach. Without any the letters alone
    decide, and ``lang`` stays null."""
    told = with_languages(docs, learn_profiles(docs, sample=None), floors=learn_floors(docs)).filter("near")
    lang = F.when(F.col("lang_pred") != UNKNOWN, F.col("lang_pred")).otherwise(F.col("row.lang"))
    return told.select(*[(lang if c == "lang" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines out of the texts of each source. All rows stay; null texts and rows without source are as they were, and an
    empty table gives an empty one."""
    return drop_site_lines(docs, min_pages=3).drop("_n_lines", "_n_dropped")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id. Rows with the same id and text stay once;
    an id with several texts is as many documents here, so that none is lost for what another one repeats. Rows without id, and
    texts without words, are near nothing."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       F.coalesce(F.xxhash64("text"), F.lit(0)).alias("t"))
    # One text of each id goes by the id itself, others by numbers beyond all ids.
    first = rows.filter("id is not null").groupBy("id").agg(F.min("t").alias("t0"))
    other = F.lit(1 << 62).bitwiseOR(F.xxhash64("id", "t").bitwiseAND(F.lit((1 << 61) - 1)))
    keys = stored(rows.select("id", "t").join(first, "id").groupBy("id", "t", "t0").agg(F.count("*").alias("n"))
                  .select("id", "t", F.when(F.col("t") == F.col("t0"), F.col("id")).otherwise(other).alias("key"), "n"), "keys")
    plain = keys.filter("key <> id").isEmpty()
    keyed = rows.withColumn("key", F.col("id")) if plain else rows.join(keys.select("id", "t", "key"), ["id", "t"], "left")
    gone = near_duplicates(keyed.select("key", F.col("row.text").alias("text")), doc_id="key").filter("not kept")
    marks = (gone.select(F.col("doc_id").alias("key"), F.lit(True).alias("gone")).unionByName(keys.filter("n > 1").select("key", F.lit(False).alias("gone")))
             .groupBy("key").agg(F.max("gone").alias("gone")))
    marked = keyed.join(marks, "key", "left")
    once = marked.filter("not gone").dropDuplicates(["key"])
    kept = marked.filter("gone is null").select("row").unionByName(once.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold three quarters or more of a benchmark item. Null texts and texts without words hold none, and an empty
    table, of documents or of items, changes nothing."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences. A null or empty text is the closing id alone; an empty table gives an empty one."""
    return pack(docs).drop("ids")


STAGES = [(f.__name__, f) for f in (language_id, line_dedup, minhash_near_dedup, benchmark_decontamination, best_fit_packing)]

#: SQL cannot tokenize or tell languages; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
