"""The operators' queries over the generated tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import (
    arrow_output, fill_middle, html_extract, jaccard_join, license_scan, lm_scoring, mixing, packing, quality, simhash_dedup, sql,
    suffix_dedup, topk, va_clusters,
)
from casebook.llm._common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_quality(spark, sf):
    return quality.judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register
def op2_html(spark, sf):
    return html_extract.extract(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


@register
def op3_suffix(spark, sf):
    found = suffix_dedup.spans(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256")


@register
def op4_license(spark, sf):
    return license_scan.licenses(table(spark, sf, "documents"))


@register
def op5_jaccard(spark, sf):
    return jaccard_join.classes(table(spark, sf, "documents"))


@register
def op6_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register
def op7_lm(spark, sf):
    return lm_scoring.score(table(spark, sf, "documents"))


@register
def op8_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@register
def op9_arrow_output(spark, sf):
    return arrow_output.read_documents(spark, arrow_output.write_sequences(table(spark, sf, "documents")))


@register
def op10_topk(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op11_fill_middle(spark, sf):
    made = fill_middle.transform(table(spark, sf, "documents"))
    whole = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(whole, 256).alias("restored_sha256"))


@register
def op12_va_clusters(spark, sf):
    found = va_clusters.cluster(table(spark, sf, "embeddings"))
    digest = F.sha2(F.array_join("centroid", ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


@register
def op13_simhash(spark, sf):
    found = simhash_dedup.classes(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def all_sql() -> dict[str, str]:
    return {"op1_quality": sql.op1_quality(), "op6_mixing": sql.op6_mixing(), "op10_topk": sql.op10_topk(),
            "op11_fill_middle": sql.op11_fill_middle(), "op12_va_clusters": sql.op12_va_clusters()}
