"""Registered queries of the operators of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fichario.llm import (
    bitplanes, bpe, collocations, decontaminate, neighbours, pii, quality_model, quality_rules, simhash,
    slots, toxicity, turns, warc)
from fichario.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
        "spans", "n_id")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.tokenize(docs, tokenizer("byte_bpe_50k.json"), keep_ids=False)


def op6_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bitplanes.read(bitplanes.write(docs, tokenizer("word_bpe_49k.json"), end_id=1))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.assign(table(spark, sf_dir, "documents"), shards=16)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).drop("url")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.report(rows, turns.damaged(rows))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_bpe": op5_bpe,
    "op6_bitplanes": op6_bitplanes,
    "op7_sharding": op7_sharding,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {"op2_quality_rules": quality_rules.SQL}
