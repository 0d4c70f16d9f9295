"""A vocabulary table taken from a corpus, for runs without a vocabulary file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as X
from textloom.operators.pieces import count_words
from textloom.session import cut

# Special pieces, ids 0 to 4.
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")


def corpus_vocabulary(
    docs: DataFrame, whole_words: int = 1000, continuations: int = 300, lower: bool = True
) -> DataFrame:
    """``(token, token_id)``: specials, characters, their continuation forms,
    then the most frequent words and continuation forms of the top ones.

    A count-based list, not a learned vocabulary. Ids are dense.
    """
    # Words are counted where the texts are split: as rows of their own they would be most of the work.
    texts = docs.select(X.spaced_text(F.col("text"), lower).alias("text"))
    counts = cut(texts.mapInArrow(count_words, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")))
    top = counts.orderBy(F.desc("n"), "token").limit(whole_words)
    top = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "token")))
    chars = counts.select(F.explode(F.split("token", "")).alias("token")).distinct()
    chars = chars.filter(F.col("token") != "")

    def block(df: DataFrame, number: int, token, place) -> DataFrame:
        return df.select(token.alias("token"), F.lit(number).alias("block"), place.alias("place"))

    spark = docs.sparkSession
    specials = spark.createDataFrame(list(enumerate(SPECIALS)), "place int, token string")
    none, token = F.lit(0), F.col("token")
    entries = (
        block(specials, 0, token, F.col("place"))
        .union(block(chars, 1, token, none))
        .union(block(chars, 2, F.concat(F.lit("##"), token), none))
        .union(block(top, 3, token, F.col("place")))
        .union(block(top.filter(F.col("place") <= continuations), 4, F.concat(F.lit("##"), token), F.col("place")))
    )
    first = entries.groupBy("token").agg(F.min(F.struct("block", "place")).alias("at"))
    # The list is bounded by the alphabet and the two limits, so one ordered
    # numbering of it is small.
    numbered = F.row_number().over(Window.orderBy("at.block", "at.place", "token")) - 1
    return cut(first.select("token", numbered.cast("int").alias("token_id")))
