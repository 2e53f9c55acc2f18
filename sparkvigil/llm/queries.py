"""The registered queries of the operators for training corpora."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.llm import ann, html_text, langid, licenses, merkle, mixing, overlap, packing, secrets, simhash, topk, trie, warc
from sparkvigil.llm.oracle import ORACLES
from sparkvigil.session import stage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(read(spark, sf_dir, "documents"), VOCABULARY)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    captures = warc.read_back(pages, warc.archive_pages(pages), payload=False)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    written = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(written(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents"))
    begins = F.transform("base", lambda b: b["begin"])
    base = F.transform("base", lambda b: b["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(begins).cast("long").alias("first_word"),
        F.array_max(begins).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, "templates")).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.col("score")).alias("score"),
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlap.find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        hit.alias("n_hit"),
        (F.size("items") + F.col("no_id").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id and path: the first turns are those of the conversation at the head of its twenty."""
    own = stage(trie.turn_units(conversations), "conversations")
    heads = own.filter(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("head"), F.slice("units", 1, 3).alias("opening")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    joined = own.select("*", (F.col("conv_id") - F.col("conv_id") % 20).alias("head"), taken.alias("h")).join(heads, "head", "left")
    opening = F.slice(F.coalesce("opening", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    units = F.concat(opening, F.slice("units", F.col("h") + 1, F.size("units")))
    return joined.select("conv_id", F.unhex(F.array_join(units, "")).alias("path"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(rebuilt_conversations(read(spark, sf_dir, "conversations")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = merkle.build_manifest(read(spark, sf_dir, "documents"), merkle.tampered_third()).audit()
    return audit.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    f.__name__: f
    for f in (op1_pack, op2_language, op3_warc, op4_secrets, op5_simhash, op6_mix, op7_licenses, op8_html, op9_ann, op10_topk,
              op11_decontaminate, op12_trie, op13_merkle)
}

__all__ = ["ORACLES", "QUERIES", "VOCABULARY"]
