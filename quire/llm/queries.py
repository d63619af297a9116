"""The queries of this subpackage: each applies an operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, language_id, license_scan, packing, passages, simhash, suffix_dedup, token_store, url_filter

#: Listed hosts and starts of paths. Fixed values.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    store = token_store.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return store.documents()


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, F.octet_length("text"), F.col("source"), packing.cluster_of(F.col("text"))).withColumnRenamed("key", "doc_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")))


def held_out(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    return language_id.identify(docs, model).withColumnRenamed("key", "doc_id").select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("detections").withColumnRenamed("key", "doc_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id").withColumnRenamed("other", "other_doc_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), listed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_store, op2_simhash, op3_packing, op4_suffix_dedup, op5_language, op6_decontaminate, op7_licenses, op8_exact_dedup, op9_passages, op10_url_filter)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op8_exact_dedup": r"""
        with n as (
            select doc_id, length(coalesce(text, '')) as points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents
        ), r as (
            select *, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size, row_number() over w as place
            from n window w as (partition by text_sha256 order by points desc, doc_id)
        )
        select doc_id, keep_id, cast(group_size as bigint) as group_size, place = 1 as kept, text_sha256 from r""",
    "op10_url_filter": rf"""
        with rules(r_host, r_path, r_verdict) as (values {", ".join(str(r) for r in URL_RULES)}), p as (
            select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
                regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
            from pages
        ), hits as (
            select page_id, host, path, r_host || r_path as rule, r_verdict, row_number() over (partition by page_id, host, path order by length(r_host) + length(r_path) desc, length(r_host) desc, r_verdict desc) as place
            from p join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
        )
        select p.page_id, p.host, p.path, rule, coalesce(r_verdict, 'allow') as verdict
        from p left join (select * from hits where place = 1) h on h.page_id = p.page_id and h.host = p.host and h.path = p.path""",
}
