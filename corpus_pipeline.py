"""A corpus pipeline: toxic documents go, repeated line chunks go, one document of each group of near copies stays,
secrets are masked, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All but the last return the
columns of documents; run() writes the result of each as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinwork.llm import jaccard, lines, packing, secrets, toxicity
from skeinwork.llm.common import Scratch, read
from skeinwork.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression rejects go."""
    return toxicity.toxic_rows_removed(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts; n_chars follows."""
    return lines.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles at 0.8 connect, the one with the smallest doc_id stays."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; n_chars follows."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("n-gram Jaccard join", drop_near_copies), ("secret scans", mask_secrets), ("best-fit packing", pack)]

#: The first stage's regression can't be expressed in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch, docs = Scratch(spark, "pipeline"), read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
