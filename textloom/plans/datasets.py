"""End-to-end labelled dataset builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import labels as L
from textloom.session import cut


#: Fixed value: sentences that the tagged sets keep of a text.
TAGGED_SENTENCES = 40


def tagged_text(text, max_sentences: int | None = TAGGED_SENTENCES):
    """Flatten lines, keep the first sentences (None: all), drop non-ASCII, squeeze."""
    kept = X.sentences(X.flat_lines(text))
    if max_sentences is not None:
        kept = F.slice(kept, 1, max_sentences)
    return X.squeeze(X.ascii_only(F.array_join(kept, " ")))


def tagged_dataset(
    docs: DataFrame,
    tags: list[str],
    key: str = "doc_id",
    n_labels: int = 5,
    train_share: float = 0.85,
    keep_other: bool = False,
    split: bool = True,
    max_sentences: int | None = TAGGED_SENTENCES,
) -> tuple[DataFrame, DataFrame]:
    """Tagged documents to ``(key, tag, label_no, label, label_id, split, inputs)``
    and the label lists. All tag columns are handled together.

    ``split=False`` gives the fine-tuning variant without a test part.
    """
    rows = L.explode_labels(L.has_text(docs), tags, [key])
    top = cut(L.top_labels(rows, n_labels))
    kept = L.restrict_labels(rows, top, keep_other)
    keyed = kept.drop("text")
    if split:
        keyed = L.positional_split(keyed, ["tag"], [key, "label_no"], train_share)
    else:
        keyed = keyed.withColumn("split", F.lit("train"))
    # A text is cleaned once, however many labels it has, and never moved for ranking.
    texts = docs.select(key, tagged_text(_first(docs, "text"), max_sentences).alias("inputs"))
    out = keyed.join(texts, key).select(key, "tag", "label_no", "label", "label_id", "split", "inputs")
    return out, L.selected_labels(rows, top, keep_other)


def _first(df: DataFrame, text: str):
    is_array = df.schema[text].dataType.typeName() == "array"
    return F.get(text, F.lit(0)) if is_array else F.col(text)


def tweet_dataset(tweets: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, label, text)`` to cleaned inputs with labels 0 and 4 only."""
    tokens = F.transform(
        X.rule_words(X.strip_handles(F.col("text"))),
        lambda t: X.delete_chars(t, X.TWEET_PUNCTUATION),
    )
    return L.keep_labels(tweets, "label", [0, 4]).select(
        *keys, X.joined_lower(tokens, strip=False).alias("inputs"), "label"
    )


def review_tokens(text, first_sentence_only: bool):
    parts = X.sentences(text)
    body = F.coalesce(F.get(parts, F.lit(0)), F.lit("")) if first_sentence_only else F.array_join(parts, " ")
    stripped = F.transform(X.rule_words(body), lambda t: X.delete_chars(t, X.REVIEW_PUNCTUATION))
    return F.filter(stripped, lambda t: t != "br")


def shorter_than(rows: DataFrame, tokens: str, n: int) -> DataFrame:
    """Rows of fewer than ``n`` tokens."""
    return rows.filter(F.size(tokens) < n)


def review_dataset(
    reviews: DataFrame, keys: list[str], first_sentence_only: bool = False, max_tokens: int | None = None
) -> DataFrame:
    """``(keys, label, text)`` to cleaned inputs.

    ``max_tokens`` drops texts of that many tokens or more; None keeps all.
    """
    rows = reviews.withColumn("tokens", review_tokens(F.col("text"), first_sentence_only))
    if max_tokens is not None:
        rows = shorter_than(rows, "tokens", max_tokens)
    return rows.select(*keys, X.joined_lower(F.col("tokens"), strip=True).alias("inputs"), "label")
