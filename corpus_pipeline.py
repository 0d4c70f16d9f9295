"""From raw documents to token files: five stages, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontamination, jaccard_join, mixing, token_files, toxicity
from textloom.llm.queries import END_ID, TOXIC_FROM, id_remainder, table, tokenizer_path
from textloom.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labels, lets pass."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder(3) != 1)
    return toxicity.harmless(docs, model, TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target sizes."""
    return mixing.mixed(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids read back from the token files of the mix."""
    path = token_files.write_tokens(docs, tokenizer_path(), END_ID)
    return token_files.digests(token_files.read_tokens(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("token_files", write_token_files),
]

#: Stages 1, 2, 3 and 5 are beyond SQL; tests/llm compares run() with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again.

    Defined cases: null and empty texts are harmless, near nothing and leak
    nothing; as they have no words, the mix takes one as often as its source's
    turn comes. Of repeated rows, exact ones included, the near-duplicate
    stage keeps one. Null ids, sources and languages pass; a source without
    words has no target. Without labels nothing is toxic, without benchmark items
    nothing leaks. An empty table gives no rows. Columns beyond those of ``documents`` are carried
    up to the last stage, whatever their names, and play no part.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        rows.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        docs = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
