"""Exact duplicates against a history held in minimal perfect hash tables.

Texts are equal when they are identical after ``A``-``Z`` are lower-cased. Each
text becomes a SHA-256 digest. The distinct digests of rows seen before form the
history; digests are dealt over shards by their first bytes, and each shard maps
its digests one to one to slots ``0 .. n-1`` by a minimal perfect hash (levels of
bit arrays: a digest sits where it is alone in its cell, the others go on to the
next level; its slot is the number of set bits before it). A slot holds the full
digest, where the best row of its text is (``doc_id`` and row locator) and how
many rows have it. New digests are looked up by slot and compared byte by byte;
members are repeats and update their slot, the others are grouped among
themselves. Of equal texts the row with the largest ``doc_id`` stays.

Rows of one text are combined in each task before anything is shuffled, so a
text that a third of all rows share sends about one row per task. Shards are as many as the
measured numbers of digests ask for, so each stays a bounded size. Only texts
that occur again are joined back to their rows, in a join that Spark splits where
it is skewed.

Defined cases: a null text equals an empty one. Null ``doc_id``s are smaller than
all others. Of rows alike in id and text one stays, the last of the written
digests. An empty table gives no rows. Columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import chunks, mix64, texts_of, written

#: Digests a shard holds at most, about: 56 bytes each in the slots.
SHARD_DIGESTS = 20_000
#: Distinct texts that a task combines before it sends them on.
COMBINED = 100_000
#: Bits per digest of each level of the hash, and levels before the rest is listed.
SPARE, LEVELS = 2.0, 40

DIGEST_SCHEMA = "doc_id long, loc long, digest binary"
COMBINED_SCHEMA = "shard int, digest binary, doc_id long, loc long, n long"
INDEX_SCHEMA = "shard int, bits array<binary>, rest binary, digests binary, doc_ids array<long>, locs array<long>, counts array<long>"
GROUP_SCHEMA = "digest binary, doc_id long, loc long, n long, member boolean"


class PerfectHash:
    """Slots ``0 .. n-1`` of n distinct 32-byte digests, without the digests.

    ``levels`` are bit arrays; ``rest`` lists digests that no level could place,
    which take the last slots.
    """

    def __init__(self, levels: list[np.ndarray], rest: list[bytes]):
        self.levels, self.rest = levels, {d: k for k, d in enumerate(rest)}
        #: Set bits before each word of 64 cells, over all levels.
        self.before, placed = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(placed + np.cumsum(ones) - ones)
            placed += int(ones.sum())
        self.placed = placed

    @staticmethod
    def _cells(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        lane = keys[:, level % 4]
        return (mix64(lane + seed) % np.uint64(words * 64)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> "PerfectHash":
        """``digests``: distinct rows of 32 bytes."""
        keys, left, levels = digests.view("<u8").reshape(-1, 4), np.arange(len(digests)), []
        while len(left) and len(levels) < LEVELS:
            words = max(1, int(np.ceil(SPARE * len(left) / 64)))
            cells = cls._cells(keys[left], len(levels), words)
            alone = np.bincount(cells, minlength=words * 64) == 1
            level = np.packbits(alone, bitorder="little").view("<u8")
            levels.append(level)
            left = left[~alone[cells]]
        return cls(levels, [digests[k].tobytes() for k in left])

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest; for one that is not in the table any slot, or -1."""
        keys = digests.view("<u8").reshape(-1, 4)
        out, left = np.full(len(digests), -1, dtype=np.int64), np.arange(len(digests))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            cells = self._cells(keys[left], level, len(words))
            word, bit = words[cells >> 6], (cells & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            lower = word & ((np.uint64(1) << bit) - np.uint64(1))
            slots = before[cells >> 6] + np.bitwise_count(lower)
            out[left[here]] = slots[here]
            left = left[~here]
        for k in left if self.rest else ():
            out[k] = self.placed + self.rest.get(digests[k].tobytes(), -1 - self.placed)
        return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """32-byte values as rows of bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    joined = b"".join(column.cast(pa.large_binary()).to_pylist())
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, 32)


def _binary(matrix: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(matrix).tobytes()
    return pa.array([raw[k : k + 32] for k in range(0, len(raw), 32)], pa.binary())


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, loc, digest`` of every row, written; ``loc`` tells rows apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("loc"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]):
        for batch in chunks(batches, "text"):
            lower = pc.ascii_lower(texts_of(batch)).cast(pa.large_binary())
            found = [hashlib.sha256(t.as_buffer()).digest() for t in lower]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "loc", "digest"]
            )

    return written(rows.mapInArrow(hashed, DIGEST_SCHEMA), "digests")


def _shard(count: int) -> Column:
    """Shard of a digest, from its first four bytes."""
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return F.pmod(first, F.lit(count)).cast("int")


def combined(rows: DataFrame, shards: int) -> DataFrame:
    """Rows ``doc_id, loc, digest`` combined by digest inside each task."""

    def best(held: dict):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int.from_bytes(d[:4]) % shards for d in held], pa.int32()),
                pa.array(list(held), pa.binary()),
                pa.array([v[0] for v in held.values()], pa.int64()),
                pa.array([v[1] for v in held.values()], pa.int64()),
                pa.array([v[2] for v in held.values()], pa.int64()),
            ],
            ["shard", "digest", "doc_id", "loc", "n"],
        )

    def combine(batches: Iterator[pa.RecordBatch]):
        held: dict = {}
        for batch in batches:
            for doc, loc, digest in zip(*(c.to_pylist() for c in batch.columns)):
                old = held.get(digest)
                if old is None:
                    held[digest] = (doc, loc, 1)
                else:
                    held[digest] = (*_later((doc, loc), old[:2]), old[2] + 1)
            if len(held) >= COMBINED:
                yield from best(held)
                held = {}
        if held:
            yield from best(held)

    return rows.select("doc_id", "loc", "digest").mapInArrow(combine, COMBINED_SCHEMA)


def _later(a: tuple, b: tuple) -> tuple:
    """The row of the larger id, null ids first, then of the larger locator."""
    return max(a, b, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def grouped(partials: DataFrame) -> DataFrame:
    """One row per digest: ``digest, doc_id, loc, n``."""
    return (
        partials.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "loc")).alias("best"), F.sum("n").alias("n"))
        .select("digest", "best.doc_id", "best.loc", "n")
    )


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """Distinct digests ``digest, doc_id, loc, n`` as one hash table per shard, written."""

    def build(key, table):
        digests = _matrix(table["digest"])
        hashed = PerfectHash.build(digests)
        order = np.empty(len(digests), dtype=np.int64)
        order[hashed.slots(digests)] = np.arange(len(digests))
        ordered = table.take(pa.array(order))
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()),
                pa.array([[w.tobytes() for w in hashed.levels]], pa.list_(pa.binary())),
                pa.array([b"".join(hashed.rest)], pa.binary()),
                pa.array([digests[order].tobytes()], pa.binary()),
                *[pa.array([ordered[c].to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "loc", "n")],
            ],
            ["shard", "bits", "rest", "digests", "doc_ids", "locs", "counts"],
        )

    dealt = groups.select("*", _shard(shards).alias("shard"))
    return written(dealt.groupBy("shard").applyInArrow(build, INDEX_SCHEMA), "digest_index")


def look_up(index: DataFrame, partials: DataFrame) -> DataFrame:
    """New rows against the index: ``digest, doc_id, loc, n, member``.

    Members come as one row per slot of the index, with what the new rows added
    to it (slots nobody asked for included); other rows pass unchanged.
    """

    def answer(key, shard, new):
        digest, doc, loc, n = (new[c] for c in ("digest", "doc_id", "loc", "n"))
        if not shard.num_rows:
            return pa.Table.from_arrays(
                [digest.cast(pa.binary()), doc, loc, n, pa.array([False] * new.num_rows, pa.bool_())],
                ["digest", "doc_id", "loc", "n", "member"],
            )
        row = shard.slice(0, 1).to_pylist()[0]
        rest = [row["rest"][k : k + 32] for k in range(0, len(row["rest"]), 32)]
        hashed = PerfectHash([np.frombuffer(b, dtype="<u8") for b in row["bits"]], rest)
        held = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, 32)
        doc_ids, locs, counts = row["doc_ids"], row["locs"], row["counts"]
        asked = _matrix(digest)
        slots = hashed.slots(asked)
        # A digest that was never put in lands on some slot: only its bytes tell.
        member = (slots >= 0) & (held[slots] == asked).all(axis=1)
        docs, places, sizes = doc.to_pylist(), loc.to_pylist(), n.to_pylist()
        for k in np.flatnonzero(member):
            s = slots[k]
            doc_ids[s], locs[s] = _later((docs[k], places[k]), (doc_ids[s], locs[s]))
            counts[s] += sizes[k]
        others = pa.array(np.flatnonzero(~member))
        return pa.Table.from_arrays(
            [
                pa.concat_arrays([_binary(held), _binary(asked[~member])]),
                pa.array(doc_ids + doc.take(others).to_pylist(), pa.int64()),
                pa.array(locs + loc.take(others).to_pylist(), pa.int64()),
                pa.array(counts + n.take(others).to_pylist(), pa.int64()),
                pa.array([True] * len(held) + [False] * len(others), pa.bool_()),
            ],
            ["digest", "doc_id", "loc", "n", "member"],
        )

    return index.groupBy("shard").cogroup(partials.groupBy("shard")).applyInArrow(answer, GROUP_SCHEMA)


def copies(docs: DataFrame, history: Column) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    ``history``, a condition on ``doc_id``, says which rows count as seen
    before; the result does not depend on it, only the way there.
    """
    rows = text_digests(docs)
    seen = F.coalesce(history, F.lit(False))
    sizes = rows.agg(F.count_if(seen).alias("old"), F.count_if(~seen).alias("new")).first()
    shards = 1 + max(sizes["old"], sizes["new"]) // SHARD_DIGESTS
    index = build_index(grouped(combined(rows.filter(seen), shards)), shards)
    answers = written(look_up(index, combined(rows.filter(~seen), shards)), "answers")
    members = answers.filter("member").drop("member")
    newcomers = grouped(answers.filter("not member"))
    repeated = members.unionByName(newcomers).filter("n > 1")
    found = rows.join(
        repeated.select("digest", F.col("doc_id").alias("keep_id"), F.col("loc").alias("keep_loc"), "n"),
        "digest",
        "left",
    )
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("loc") == F.col("keep_loc"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
