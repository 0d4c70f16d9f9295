"""Question-answer paragraphs made from a document table.

Each document is a context with two questions: its first words, answered by a
hashed run of its words, and its last words, marked impossible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.draws import draw_hex, pick
from textloom.functions.text import CONTEXT_SPACE
from textloom.operators.windows import context_words


def document_paragraphs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` to ``(context_id, context, qas)``."""
    # A word is any other character: the words themselves are looked for once.
    some = docs.filter(F.col("text").rlike(CONTEXT_SPACE.replace("[", "[^", 1)))
    base = some.select("doc_id", context_words(F.col("text")).alias("w"))
    digest = draw_hex("qa", "doc_id")
    placed = base.withColumn("n", F.size("w")).withColumn("s", pick(digest, F.col("n")).cast("int"))
    sized = placed.withColumn("len", F.least(pick(digest, 4, 1).cast("int") + 1, F.col("n") - F.col("s")))
    run = F.array_join(F.slice("w", F.col("s") + 1, F.col("len")), " ")
    bare = F.regexp_replace(run, "[.,]+$", "")
    before = F.array_join(F.slice("w", F.lit(1), F.col("s")), " ")
    answer = F.struct(
        F.when(bare == "", run).otherwise(bare).alias("text"),
        (F.length(before) + F.when(F.col("s") > 0, 1).otherwise(0)).cast("int").alias("answer_start"),
    )
    key = F.col("doc_id").cast("string")
    tail = F.slice("w", F.greatest(F.col("n") - 7, F.lit(1)), F.lit(8))
    return sized.select(
        key.alias("context_id"),
        F.array_join("w", " ").alias("context"),
        F.array(
            F.struct(
                F.concat(key, F.lit("-0")).alias("id"),
                F.array_join(F.slice("w", 1, 8), " ").alias("question"),
                F.lit(False).alias("is_impossible"),
                F.array(answer).alias("answers"),
            ),
            F.struct(
                F.concat(key, F.lit("-1")).alias("id"),
                F.array_join(tail, " ").alias("question"),
                F.lit(True).alias("is_impossible"),
                F.filter(F.array(answer), lambda a: F.lit(False)).alias("answers"),
            ),
        ).alias("qas"),
    )
