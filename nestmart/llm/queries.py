"""One registered query for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate, hit_words, is_contaminated
from .fill_middle import fill_middle, restored
from .langid import fit_languages, held_out, predict_languages
from .line_dedup import line_dedup
from .minhash_join import minhash_groups
from .oracles import ORACLES
from .page_text import main_text
from .periodic_runs import listed as listed_runs
from .periodic_runs import longest, periodic_runs, with_planted_tail
from .pieces import decode, encode
from .quality import MIN_WORDS, quality_scores
from .secrets import BASE_KINDS, listed, of_kinds, secret_spans
from .simhash import simhash_groups
from .substring_dedup import substring_dedup
from .toxicity import fit_severity, severity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches, of every document."""
    found = line_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                        F.concat_ws(",", F.transform("removed", lambda x: x.cast("string"))).alias(
                            "removed"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = hit_words("spans")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, their verdict, and the log-likelihood ratio's, of every document."""
    scored, cut = quality_scores(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", failed.alias("base_failed"),
                         (~failed & (F.col("score") >= F.lit(cut))).alias("kept"), "score")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = predict_languages(docs, fit_languages(docs, train=~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    docs = _table(spark, sf_dir, "documents")
    return severity(docs, fit_severity(docs, _table(spark, sf_dir, "labels")))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the digest of what they decode to."""
    found = decode(encode(_table(spark, sf_dir, "documents")), out_col="decoded")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secret_spans(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(F.size(of_kinds("spans", k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(listed(of_kinds("spans", *BASE_KINDS)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document after cutting repeated 20-word windows."""
    found = substring_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept", 256).alias("kept_sha256"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in its middle, and what it is restored to."""
    found = fill_middle(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash near-duplicate component of every document."""
    found = minhash_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, in one of ten with a repeating tail, and what is left."""
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_tail().alias("text")))
    best = longest(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(listed_runs(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash, op3_decontaminate, op4_quality, op5_langid, op6_toxicity,
    op7_pieces, op8_page_text, op9_secrets, op10_substring_dedup, op11_fill_middle, op12_minhash,
    op13_periodic_runs)}

__all__ = ["ORACLES", "QUERIES"]
