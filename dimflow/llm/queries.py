"""The registered queries of the operators: each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dimflow.llm import (
    ann,
    chat,
    decontaminate,
    hard_negatives,
    html_text,
    licences,
    line_rules,
    oracles,
    packing,
    quality,
    sharding,
    simhash,
    trie,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


def op1_html(spark, sf_dir):
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op2_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op3_licences(spark, sf_dir):
    return licences.scan(_table(spark, sf_dir, "documents"))


def op4_urls(spark, sf_dir):
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_chat(spark, sf_dir):
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op6_simhash(spark, sf_dir):
    return simhash.duplicates(_table(spark, sf_dir, "documents"))


def op7_ann(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_decontaminate(spark, sf_dir):
    docs, questions = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.occurrences(docs, questions, whole=True)
    return found.drop("row")


def op9_packing(spark, sf_dir):
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer)


def op10_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op11_trie(spark, sf_dir):
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_line_rules(spark, sf_dir):
    judged = line_rules.clean(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


QUERIES = {
    "op1_html": op1_html,
    "op2_sharding": op2_sharding,
    "op3_licences": op3_licences,
    "op4_urls": op4_urls,
    "op5_chat": op5_chat,
    "op6_simhash": op6_simhash,
    "op7_ann": op7_ann,
    "op8_decontaminate": op8_decontaminate,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_trie": op11_trie,
    "op12_line_rules": op12_line_rules,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLES = oracles.ORACLES
