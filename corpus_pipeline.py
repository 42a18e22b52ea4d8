"""From raw documents to token ids: five stages, each on what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.context import scratch_path
from starloom.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity

TOXIC = 0.5
LINE_EDITS = 2
CONTAMINATED_SHARE = 20
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, threshold=TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand, equal or nearly so, in an earlier place go; ``n_chars``, if there
    is one, follows the text. Documents of which nothing but blank lines is left go."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return line_dedup.strip_repeats(docs, edits=LINE_EDITS, length=length)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates stays."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in twenty or more inside a passage of the benchmark go."""
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.drop_contaminated(docs, benchmark, share=CONTAMINATED_SHARE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, and
    ``ids`` (little-endian unsigned 32-bit integers)."""
    out = bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: The classifier and the tokenizer can't be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
