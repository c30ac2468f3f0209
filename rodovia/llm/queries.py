"""The registered queries of the operators of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rodovia.llm.decontamination import contained_items
from rodovia.llm.language_id import held_out, learn_profiles, predict_languages
from rodovia.llm.lexical_search import ranked_documents
from rodovia.llm.license_scan import find_licenses
from rodovia.llm.line_dedup import drop_site_lines
from rodovia.llm.near_dedup import near_duplicates
from rodovia.llm.packing import pack
from rodovia.llm.repeated_spans import remove_repeats
from rodovia.llm.repeated_windows import remove_repeated_windows
from rodovia.llm.spelling import spelling_variants
from rodovia.llm.tables import stored
from rodovia.llm.token_counts import DELETE, INSERT, REVISE, TokenTotals, count_tokens
from rodovia.llm.topk import top_k
from rodovia.llm.url_filter import judge_urls
from rodovia.session import scratch_path

#: Host, path and verdict of the rules on urls.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in, with a guess of their BPE tokens; exact counts replace the
    guesses; documents labelled toxic go. The second batch is delivered twice."""
    docs = table(spark, sf_dir, "documents")
    guess = F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / 4).cast("bigint")
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"), 0)).cast("bigint")
    counted = stored(count_tokens(docs.withColumns({"guess": guess, "words": words}),
                                  ["doc_id", "source", "lang", "guess", "words"]), "counts")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    gone = counted.join(toxic, "doc_id", "left_semi")

    def changes(rows: DataFrame, op: str, tokenizer: str, tokens: str, old: str | None = None) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                           F.col(tokens).alias("tokens"), (F.col(old) if old else F.lit(0)).alias("old_tokens"))

    totals = TokenTotals(spark, scratch_path(spark, "token-totals"))
    totals.apply("1-arrived", changes(counted, INSERT, "words-1", "words").unionByName(
        changes(counted, INSERT, "byte_bpe_50k-1", "guess")))
    for _ in range(2):
        totals.apply("2-counted", changes(counted, REVISE, "byte_bpe_50k-1", "n", "guess"))
    totals.compact()
    totals.apply("3-toxic", changes(gone, DELETE, "words-1", "words").unionByName(
        changes(gone, DELETE, "byte_bpe_50k-1", "n")))
    return totals.totals()


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return (judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
            .select("page_id", "host", "path", "rule", "verdict"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs, usable=~held_out(F.col("doc_id")))
    return (predict_languages(docs, profiles)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (drop_site_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), min_pages=3)
            .select("doc_id", "source", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                    F.md5(F.col("text").cast("binary")).alias("kept_md5")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents")).drop("kept")


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_minhash_near_dedup, op3_exact_top_k,
    op4_suffix_array_dedup, op5_license_scan, op6_token_counts, op7_url_filter, op8_best_fit_packing,
    op9_language_id, op10_line_dedup, op11_spelling_variants, op12_substring_dedup, op13_ranked_lexical_search,
)}
