"""Query keys of the text operators, one per operator, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (chat_format, decontaminate, langid, packing, periodic_runs, pii, quality_classifier, quality_rules,
               secret_scan, simhash, tokens, warc, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontaminate(spark, sf_dir):
    return decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op5_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


@_query
def op7_token_counts(spark, sf_dir):
    # a cache of this call's own: every distinct text is encoded here
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


@_query
def op8_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    found = quality_classifier.score(docs, model)
    return found.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query
def op3_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.learn(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@_query
def op10_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("kind").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


ORACLE["op10_warc"] = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
     f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
  FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100"""


@_query
def op4_quality_rules(spark, sf_dir):
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


@_query
def op9_secrets(spark, sf_dir):
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


@_query
def op2_pii(spark, sf_dir):
    return pii.report(_table(spark, sf_dir, "documents"))


def _with_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by h = crc32(doc_id) repeats a stretch of its words to the end.

    With g = h div 10 and n words, word i >= a is the text's word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumn("n", F.size("words"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    turned = F.transform("words", lambda w, i: F.when(
        i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@_query
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(_with_tails(_table(spark, sf_dir, "documents")))
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(
        "", r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period, r.start, r.period)))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_query
def op11_chat_format(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], rows.schema)
    path, tokenizer = scratch_path(spark, "chat"), _tokenizer("byte_bpe_50k.json")
    chat_format.format_conversations(rows.unionAll(own), tokenizer).write.parquet(path)
    return chat_format.read_back(spark.read.parquet(path), tokenizer)


@_query
def op12_whitening(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return whitening.transform(rows, whitening.fit(rows))
