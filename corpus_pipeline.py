"""From raw documents to token ids: quality, repeated lines, near copies, benchmark passages, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of ``docs``. Defined results: NULL texts have no words and fail the quality rules; columns beyond those of
``documents`` are carried along, whatever their names, up to the last stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.arrow import quoted
from clientele.llm.bpe import encode_documents
from clientele.llm.decontamination import keep_clean
from clientele.llm.line_dedup import without_repeats
from clientele.llm.ngram_join import one_of_each
from clientele.llm.quality_rules import keep_good
from clientele.sources.storage import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned from ``labels``."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; one of which no line with a word is left goes."""
    others = F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"]).alias("row")
    left = without_repeats(docs.select("doc_id", "text", others), keep=["row"])
    left = left.filter((F.size("deleted") == 0) | (F.size("deleted") < F.col("n_lines")))
    columns = {c: F.col(f"row.{quoted(c)}") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        shorter = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.size("deleted") > 0, shorter).otherwise(columns["n_chars"])
    return left.select(*[columns[c].alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of similar ones."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, their number, and a digest of what they decode to."""
    encoded = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "decoded")]
    return encoded.select(*map(quoted, kept), "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encode_decode", bpe_encode_decode),
]

#: Learned rules and byte-pair merges have no SQL; the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
