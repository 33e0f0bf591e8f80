"""The queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom.llm import ctw, decontaminate, dialogue, html, lexsearch, licences, lines, packing, paragraphs, quality, rules, setjoin, tokenfiles

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % 5 == remainder


@query
def op1_attention_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(0))
    return docs.select("doc_id", held_out(0).alias("held_out"), quality.score("text", model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op2_paragraph_minhash(spark, sf_dir):
    return paragraphs.repeated(table(spark, sf_dir, "documents"))


@query
def op3_licence_paragraphs(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op4_fuzzy_lines(spark, sf_dir):
    return lines.groups(table(spark, sf_dir, "documents")).drop("row", "kept_row")


@query
def op5_retrieval_packing(spark, sf_dir):
    from public_tokenizers import path
    return packing.pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query
def op6_context_tree_weighting(spark, sf_dir):
    return ctw.score(table(spark, sf_dir, "documents"), held_out(1))


@query
def op7_containment_search(spark, sf_dir):
    rows = decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.drop("row").withColumn("containment", F.col("shared") / F.col("total"))


@query
def op8_risk_controlled_rules(spark, sf_dir):
    rows = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *[f"stats.{f}" for f in rules.FIELDS[:5]], "base_failed", "kept", "stratum", "failed_rule")


@query
def op9_count_vector_join(spark, sf_dir):
    return setjoin.join(table(spark, sf_dir, "documents"))


@query
def op10_main_text(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", html.extract("html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op13_fp_tree_search(spark, sf_dir):
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_branch_bound_repair(spark, sf_dir):
    return dialogue.repair(table(spark, sf_dir, "conversations"))


@query
def op11_huffman_token_files(spark, sf_dir):
    from public_tokenizers import path
    return tokenfiles.read(spark, tokenfiles.write(table(spark, sf_dir, "documents"), path("word_bpe_49k.json")))
