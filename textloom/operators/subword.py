"""Greedy longest-match subword encoding of a whole corpus.

A vocabulary of a checked size is compiled into an automaton (``pieces``) and
broadcast, and rows are encoded where they are: nothing is shuffled. Beyond that
size the corpus is reduced to its distinct words (map-side combined), the words
are joined with the vocabulary, and the result is joined back. Words that make
up a large share of the corpus never travel through a shuffle then: their entries
are broadcast, and only the remaining words are joined by key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrays import gather, let
from textloom.functions import text as X
from textloom.operators.pieces import PieceAutomaton, encoder, portions, text_encoder
from textloom.session import BROADCAST_MAX_ROWS, broadcast_if_small, cut, small_enough

MAX_WORD_CHARS = 200
UNK, CLS, SEP, MASK, PAD = "[UNK]", "[CLS]", "[SEP]", "[MASK]", "[PAD]"


@dataclass(frozen=True)
class VocabFacts:
    """Scalars about a vocabulary that expressions need as literals."""

    size: int
    longest: int
    special: dict[str, int]
    gaps: tuple[int, ...] = ()

    def id(self, token: str) -> Column:
        if token not in self.special:
            raise KeyError(f"vocabulary has no {token}")
        return F.lit(self.special[token])

    def nth_id(self, rank: Column) -> Column:
        """Id of the ``rank``-th vocabulary entry, stepping over unused ids."""
        if not self.gaps:
            return rank
        shifted = F.array(*[F.lit(g - i) for i, g in enumerate(self.gaps)])
        return rank + F.size(F.filter(shifted, lambda g: g <= rank))


def vocab_facts(vocab: DataFrame) -> VocabFacts:
    """One pass over ``(token, token_id)``; only aggregates reach the driver."""
    specials = [UNK, CLS, SEP, MASK, PAD]
    row = vocab.agg(
        F.count("*").alias("size"),
        F.max(F.length("token")).alias("longest"),
        F.max("token_id").alias("top"),
        *[
            F.max(F.when(F.col("token") == s, F.col("token_id"))).alias(f"id_{i}")
            for i, s in enumerate(specials)
        ],
    ).first()
    found = {s: row[f"id_{i}"] for i, s in enumerate(specials) if row[f"id_{i}"] is not None}
    gaps = ()
    if row["size"] and row["size"] != row["top"] + 1:
        # Repeated lines leave unused ids; there are as many as repeats.
        every = vocab.sparkSession.range(row["top"] + 1).select(F.col("id").cast("int").alias("token_id"))
        unused = every.join(vocab, "token_id", "left_anti")
        gaps = tuple(sorted(r["token_id"] for r in unused.collect()))
    return VocabFacts(row["size"], row["longest"] or 1, found, gaps)


def _bounded(word) -> Column:
    """Over-long words are unknown whatever they hold, so none is kept or joined."""
    return F.when(F.length(word) > MAX_WORD_CHARS, UNK).otherwise(F.col(word))


def word_counts(docs: DataFrame, units: str) -> DataFrame:
    """Occurrences per distinct word of an ``array<struct<unit, word>>`` column."""
    # The outer form: a plain explode of a computed array is evaluated again
    # in the emptiness filter that the optimiser derives from it.
    return (
        docs.select(F.explode_outer(F.col(f"{units}.word")).alias("word"))
        .filter("word is not null")
        .withColumn("word", _bounded("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def compiled(vocab: DataFrame, facts: VocabFacts, with_pieces: bool = False, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast ``(automaton, tokens by id or None)``, or None beyond the checked size."""
    entries = vocab.select("token", F.col("token_id").cast("int").alias("token_id"))
    if not small_enough(entries, max_rows):
        return None
    rows = entries.filter("token is not null").collect()  # within the bound just checked
    tokens, ids = [r["token"] for r in rows], [r["token_id"] for r in rows]
    spelled = None
    if with_pieces:
        named = [""] * (1 + max(ids, default=-1))
        for t, i in zip(tokens, ids):
            named[i] = t
        spelled = pa.array(named, pa.string())
    if UNK not in facts.special:
        raise KeyError(f"vocabulary has no {UNK}")
    automaton = PieceAutomaton(tokens, ids, facts.special[UNK], MAX_WORD_CHARS)
    return vocab.sparkSession.sparkContext.broadcast((vars(automaton), spelled))


def longest_matches(words: DataFrame, vocab: DataFrame, facts: VocabFacts) -> DataFrame:
    """For each (word, start): end and id of the longest vocabulary match, packed.

    ``start`` and the end, both inclusive, count from 1; ``best`` is null where
    nothing matches. Other columns of ``words`` are carried along. Over-long
    words are looked at in their first position only; they are never split.
    """
    shared = compiled(vocab, facts)
    if shared is None:
        return _joined_matches(words, vocab, facts.longest)

    def walk(batches):
        automaton = PieceAutomaton.of(shared.value[0])
        for whole in batches:
            for batch in (whole.slice(k, 20_000) for k in range(0, whole.num_rows, 20_000)):
                texts = batch.column(batch.schema.get_field_index("word")).cast(pa.large_string())
                places, end, found = automaton.longest(texts)
                rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), places)))
                first = np.repeat(np.cumsum(places) - places, places)
                start = np.arange(len(end)) - first + 1
                best = pa.array(end << 32 | found, pa.int64(), mask=end < 0)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(start.astype(np.int32)), best], [*batch.schema.names, "start", "best"]
                )

    out = T.StructType([*words.schema.fields, T.StructField("start", T.IntegerType()), T.StructField("best", T.LongType())])
    return words.mapInArrow(walk, out)


def _joined_matches(words: DataFrame, vocab: DataFrame, longest: int) -> DataFrame:
    """``longest_matches`` by a join, for a vocabulary of any size."""
    size = F.length("word")
    starts = words.select(
        *words.columns,
        F.explode(F.sequence(F.lit(1), F.when(size <= MAX_WORD_CHARS, size).otherwise(1))).alias("start"),
    )
    spans = starts.select(
        "*",
        F.explode(
            F.sequence(
                F.col("start"), F.least(F.length("word"), F.col("start") + F.lit(longest - 1))
            )
        ).alias("end"),
    )
    piece = F.substring("word", F.col("start"), F.col("end") - F.col("start") + 1)
    keyed = spans.withColumn(
        "token", F.when(F.col("start") > 1, F.concat(F.lit("##"), piece)).otherwise(piece)
    )
    entries = vocab.filter(F.length("token") <= MAX_WORD_CHARS + 2).select("token", "token_id")
    packed = F.shiftleft(F.col("end").cast("long"), 32) + F.col("token_id").cast("long")
    return (
        keyed.join(broadcast_if_small(entries), "token", "left")
        .groupBy(*words.columns, "start")
        .agg(F.max(packed).alias("best"))
    )


def _encoded_fields(with_pieces: bool) -> list[T.StructField]:
    names = {"ids": T.IntegerType(), "piece_units": T.IntegerType()}
    if with_pieces:
        names["pieces"] = T.StringType()
    return [T.StructField(n, T.ArrayType(t)) for n, t in names.items()]


def segment_words(
    words: DataFrame,
    vocab: DataFrame,
    facts: VocabFacts | None = None,
    max_broadcast: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Distinct words to ``(word, pieces array<string>, ids array<int>)``.

    A word with an unmatched position, or longer than 200 characters, becomes
    the single unknown piece. Other columns of ``words`` are kept.
    """
    facts = facts or vocab_facts(vocab)
    shared = compiled(vocab, facts, True, max_broadcast)
    if shared is not None:
        asked = words.select("*", F.array(F.struct(F.lit(0).alias("unit"), "word")).alias("_units"))
        out = [*words.schema.fields, *_encoded_fields(True)]
        found = asked.mapInArrow(encoder(shared), T.StructType(out))
        return found.select(*words.columns, "pieces", "ids")
    matched = (
        _joined_matches(words, vocab, facts.longest)
        .groupBy(*words.columns)
        .agg(F.sort_array(F.collect_list(F.struct("start", "best"))).alias("found"))
    )
    step = "struct<next:int,cuts:array<int>,ids:array<int>>"
    begin = F.struct(
        F.lit(1).alias("next"),
        F.array().cast("array<int>").alias("cuts"),
        F.array().cast("array<int>").alias("ids"),
    ).cast(step)
    walked = F.aggregate(
        "found",
        begin,
        lambda acc, m: F.when(
            (m["start"] == acc["next"]) & m["best"].isNotNull(),
            F.struct(
                (F.shiftright(m["best"], 32) + 1).cast("int").alias("next"),
                F.array_append(acc["cuts"], m["start"]).alias("cuts"),
                F.array_append(acc["ids"], m["best"].bitwiseAND(0xFFFFFFFF).cast("int")).alias("ids"),
            ).cast(step),
        ).otherwise(acc),
    )
    size = F.length("word")
    walk = matched.withColumn("walk", walked)
    complete = (size <= MAX_WORD_CHARS) & (F.col("walk.next") == size + 1)
    pieces = let(
        lambda cuts: F.transform(
            cuts,
            lambda c, i: F.concat(
                F.when(i > 0, "##").otherwise(""),
                F.substring("word", c, F.coalesce(F.get(cuts, i + 1), size + 1) - c),
            ),
        ),
        F.col("walk.cuts"),
    )
    return walk.select(
        *words.columns,
        F.when(complete, pieces).otherwise(F.array(F.lit(UNK))).alias("pieces"),
        F.when(complete, F.col("walk.ids")).otherwise(F.array(facts.id(UNK))).alias("ids"),
    )


def word_dictionary(
    docs: DataFrame, units: str, vocab: DataFrame, facts=None, max_broadcast: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """Distinct words of the corpus with counts, pieces and ids, written once."""
    # Few bytes but much work per word: a fixed number of partitions keeps
    # adaptive coalescing from folding this stage into a handful of tasks. The
    # written counts also spare a second corpus pass when a task is retried.
    counts = cut(word_counts(docs, units))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(segment_words(counts.repartition(width, "word"), vocab, facts, max_broadcast))


def encode(
    docs: DataFrame,
    keys: list[str],
    units: str,
    vocab: DataFrame,
    facts: VocabFacts | None = None,
    with_pieces: bool = False,
    max_broadcast: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Encode an ``array<struct<unit, word>>`` column.

    Returns ``keys`` plus ``ids array<int>`` and ``piece_units array<int>``
    (the unit each piece came from), and ``pieces array<string>`` on request.
    ``keys`` must identify a row of ``docs``. A vocabulary of more than
    ``max_broadcast`` entries goes the way over a dictionary of distinct words.
    """
    facts = facts or vocab_facts(vocab)
    shared = compiled(vocab, facts, with_pieces, max_broadcast)
    if shared is not None:
        rows = docs.select(*keys, units)
        out = T.StructType([*rows.schema.fields[:-1], *_encoded_fields(with_pieces)])
        return rows.mapInArrow(encoder(shared), out)
    return _encode_joined(docs, keys, units, vocab, facts, with_pieces, max_broadcast)


def encode_text(
    docs: DataFrame,
    keys: list[str],
    text: Column,
    vocab: DataFrame,
    facts: VocabFacts | None = None,
    with_pieces: bool = False,
    by_word: bool = False,
    max_broadcast: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """:func:`encode` of a normalised text (``functions.text.spaced_text``); its lines are the units, or its words.

    The text is split by the task that encodes it: as an array of words it
    would take several times the memory on both sides.
    """
    facts = facts or vocab_facts(vocab)
    shared = compiled(vocab, facts, with_pieces, max_broadcast)
    if shared is None:
        units = docs.select(*keys, (X.word_units if by_word else X.line_units)(text).alias("units"))
        return _encode_joined(units, keys, "units", vocab, facts, with_pieces, max_broadcast)
    rows = docs.select(*keys, F.array(text).alias("texts"))
    out = T.StructType([*rows.schema.fields[:-1], *_encoded_fields(with_pieces)])
    return rows.mapInArrow(text_encoder(shared, by_word), out)


def _encode_joined(docs, keys, units, vocab, facts, with_pieces, max_broadcast) -> DataFrame:
    dictionary = word_dictionary(docs, units, vocab, facts, max_broadcast)
    payload = ["ids", "pieces"] if with_pieces else ["ids"]
    entries = dictionary.select("word", "n", *payload)
    few = small_enough(entries, max_broadcast)
    # Beside a broadcast dictionary, rows keep the place their document has, so
    # documents are dealt by key while they are compact and words never are.
    source = docs.repartition(*keys) if few else docs
    occurrences = source.select(
        *keys, F.posexplode_outer(units).alias("pos", "item")
    ).select(*keys, "pos", F.col("item.unit").alias("unit"), F.col("item.word").alias("word"))
    occurrences = occurrences.withColumn("word", _bounded("word"))

    if few:
        joined = occurrences.join(F.broadcast(entries.drop("n")), "word", "left")
    else:
        # Fewer than max_broadcast words can each hold more than
        # total / max_broadcast of all occurrences.
        total = entries.agg(F.sum("n")).first()[0]
        hot = F.col("n") * F.lit(max_broadcast) > F.lit(total)
        probed = occurrences.join(
            F.broadcast(entries.filter(hot).drop("n")), "word", "left"
        )
        cold = F.col("word").isNotNull() & F.col("ids").isNull()
        rest = probed.filter(cold).drop(*payload)
        joined = probed.filter(~cold).unionByName(
            rest.join(entries.filter(~hot).drop("n"), "word")
        )

    parts = F.sort_array(
        F.collect_list(
            F.when(F.col("pos").isNotNull(), F.struct("pos", "unit", *payload))
        )
    )
    grouped = joined.groupBy(*keys).agg(parts.alias("parts"))
    return grouped.select(
        *keys,
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.flatten(
            F.transform("parts", lambda p: F.array_repeat(p["unit"], F.size(p["ids"])))
        ).alias("piece_units"),
        *([F.flatten(F.col("parts.pieces")).alias("pieces")] if with_pieces else []),
    )


def lookup(
    df: DataFrame, keys: list[str], values: str, table: DataFrame, key: str, value: str
) -> DataFrame:
    """Replace array elements through a ``key -> value`` table, in order.

    A missing element is an error, as in a dictionary lookup.
    """
    few = small_enough(table.select(key, value))
    entries = F.broadcast(table.select(key, value)) if few else table.select(key, value)
    source = df.repartition(*keys) if few else df
    found = (
        source.select(*keys, F.posexplode_outer(values).alias("pos", key))
        .join(entries, key, "left")
        .withColumn(
            value,
            F.when(
                F.col("pos").isNotNull() & F.col(value).isNull(),
                F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.col(key).cast("string"))),
            ).otherwise(F.col(value)),
        )
    )
    ordered = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", value))))
    grouped = found.groupBy(*keys).agg(ordered.alias("ordered"))
    return grouped.select(*keys, F.col(f"ordered.{value}").alias(values))


def tokens_to_ids(df, keys, tokens, vocab):
    return lookup(df, keys, tokens, vocab, "token", "token_id")


def ids_to_tokens(df, keys, ids, vocab):
    return lookup(df, keys, ids, vocab, "token_id", "token")


def missing_tokens(df: DataFrame, tokens: str, vocab: DataFrame) -> DataFrame:
    """Tokens absent from the vocabulary, with counts (empty when all is well)."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts.join(vocab, "token", "left_anti")


def alignment(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """Per unit: index of its first piece and its number of pieces.

    ``piece_units`` is ascending, so a unit's pieces are one contiguous run.
    """

    rows = encoded.select(*keys, "piece_units")

    def runs(batches):
        for whole in batches:
            for batch in portions(whole, pc.list_value_length, 1 << 20):
                column = batch.column(len(keys))
                lists = column.fill_null([]) if column.null_count else column
                cuts = lists.offsets.to_numpy().astype(np.int64)
                units = lists.values.to_numpy(zero_copy_only=False)[cuts[0] : cuts[-1]]
                cuts -= cuts[0]
                new = np.append(True, units[1:] != units[:-1])[: len(units)]
                new[cuts[:-1][np.diff(cuts) > 0]] = True
                first = np.flatnonzero(new)
                row = np.searchsorted(cuts, first, side="right") - 1
                n = np.diff(np.append(first, len(units)))
                found = [pa.array(x.astype(np.int32)) for x in (units[first], first - cuts[row], n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(row)) for k in range(len(keys))), *found], out.names)

    out = T.StructType(rows.schema.fields[:-1])
    for name in ("unit", "first_piece", "n_pieces"):
        out = out.add(name, T.IntegerType())
    return rows.mapInArrow(runs, out)


def project_labels(encoded: DataFrame, labels: str) -> DataFrame:
    """Word-level labels repeated on every piece of the word."""
    return encoded.withColumn(
        f"piece_{labels}",
        gather(F.col(labels), F.col("piece_units")),
    )
