"""Ranked lexical search over an index whose documents are grouped by length.

Terms are runs of ASCII letters and digits and of all other non-ASCII
characters, with ``A``-``Z`` in lower case. N documents have a term, L terms in
all; a document of n terms has the normaliser m = 50 + (50 n N) div L, and a
term with tf occurrences adds its weight times (10^9 tf) div (1000 tf + 20 m).

Index: documents are dealt by m, in ranges of equal bytes that the counts of all
lengths give, and those of equal m form a stratum. A block
of the index holds a run of strata; within a stratum the postings of a term lie by
falling tf, so a term's impact there is computed once for each tf, and its first
tf bounds it. A block row has the strata and the largest tf in one part and the
documents of the postings in another, so that bounds and document counts are
read without them.

Search: queries come in portions of bounded size. Each goes over the index three
times: document counts of the portion's terms; bounds of all strata, of which
the best blocks of each query are searched at once, whose k-th score
becomes its threshold; then every block, strata in the order of their bounds
until none can reach the threshold. Only documents at or above it leave a task.

Everything is exact: a term is compared by its text, and scores are whole numbers.
A stratum of any size is divided over blocks; nothing collects a stratum or the hits of a
query in one task beyond k per block run.

Defined cases: a null text has no term; a document without terms is in no
count and never found. Rows of one ``doc_id`` count as different documents;
null ids come first among equal scores. A query row without known terms gives no
rows; query rows of one ``item_id`` are ranked apart, as ``query_no`` tells.
Empty tables give no rows. Columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.common import chunks, ragged, texts_of, tidy, written
from textloom.operators.order import running_start
from textloom.session import broadcast_if_small

#: Text and documents of one block at most; a longer text is a block of its own.
BLOCK_BYTES, BLOCK_DOCS = 2 << 20, 60_000
#: Text of one partition of the index, about.
PARTITION_BYTES = 16 << 20
#: Documents added to a block at once; places in a block have two bytes.
MOST_ROWS = 5000
#: Text of the queries that are searched in one go.
PORTION_BYTES = 4 << 20
#: Blocks of each query that are searched first.
FIRST_BLOCKS = 2

#: Byte to byte: separators become spaces, A-Z lower case.
_BYTES = np.array(
    [b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)], dtype=np.uint8
)
_BYTES[ord("A") : ord("Z") + 1] += 32

#: Parts of a block: what bounds and counts need, and the postings.
HEAD = "strata stratum_docs terms holders entries entry_strata first_tf".split()
TAIL = "ids known groups group_tf group_docs docs".split()
INDEX_SCHEMA = "block long, head binary, tail binary"
HIT_SCHEMA = "query_no long, doc_id long, score long"


@dataclass(frozen=True)
class CorpusSize:
    documents: int
    terms: int

    def normaliser(self, n: np.ndarray) -> np.ndarray:
        return np.array([50 + 50 * int(x) * self.documents // self.terms for x in n], dtype=np.int64)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts in one array, and where each text starts."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    plain = pa.py_buffer(_BYTES[raw])
    starts = pa.py_buffer(np.ascontiguousarray(offsets - offsets[0]))
    clean = pa.LargeStringArray.from_buffers(len(texts), starts, plain)
    split = pc.ascii_split_whitespace(clean)
    places = split.offsets.to_numpy().astype(np.int64)
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return (words if full.all() else words.filter(pa.array(full))), before[places - places[0]]


def _counts(texts: pa.Array) -> np.ndarray:
    """Number of terms of each text: places where a run of term bytes begins."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    inside = _BYTES[raw] != 0x20
    offsets = offsets - offsets[0]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[offsets[1:]] - total[offsets[:-1]]


def lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n`` with the number of terms, documents without terms left out."""

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in chunks(batches, "text"):
            n = _counts(texts_of(batch))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], ["doc_id", "text", "n"])
            yield out.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(count), f"doc_id long, text {docs.schema['text'].dataType.simpleString()}, n long")


def length_counts(docs: DataFrame) -> DataFrame:
    """``n, docs, bytes`` for each number of terms that occurs, written."""
    return written(
        lengths(docs).groupBy("n").agg(F.count("*").alias("docs"), F.sum(F.octet_length("text")).alias("bytes")), "lengths"
    )


def corpus_size(counts: DataFrame) -> CorpusSize:
    row = counts.agg(F.sum("docs").alias("d"), F.sum(F.col("n") * F.col("docs")).alias("t")).first()
    return CorpusSize(row["d"] or 0, row["t"] or 0)


def _deal(counts: DataFrame, size: CorpusSize) -> tuple[DataFrame, int]:
    """``m, first, parts``: partitions of each stratum, so that all hold about the same bytes.

    Strata follow one another; one of more bytes than a partition takes several.
    """
    strata = counts.groupBy(_normaliser(size).alias("m")).agg(F.sum("bytes").alias("bytes"))
    before = F.sum("bytes").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1))  # a row per normaliser
    first = F.floor(F.coalesce(before, F.lit(0)) / PARTITION_BYTES).cast("int")
    dealt = strata.select("m", first.alias("first"), F.ceil(F.col("bytes") / PARTITION_BYTES).cast("int").alias("parts"))
    total = counts.agg(F.sum("bytes")).first()[0]
    return dealt, int(total // PARTITION_BYTES) + 2


def _normaliser(size: CorpusSize) -> Column:
    return F.expr(f"50 + (50 * n * {size.documents}L) div {size.terms}L")


def _packed(parts: list[bytes]) -> bytes:
    """Parts as one compressed value, so that Spark handles a fraction of the bytes."""
    import zstandard

    sizes = np.array([len(parts), *map(len, parts)], dtype="<u8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(parts))


def _unpacked(value: bytes) -> list[memoryview]:
    import zstandard

    raw = memoryview(zstandard.ZstdDecompressor().decompress(value))
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    ends = 8 + 8 * n + np.cumsum(np.frombuffer(raw, "<u8", n, 8)).astype(np.int64)
    return [raw[a:b] for a, b in zip([8 + 8 * n, *ends], ends)]


def _block(ids: pa.Array, m: np.ndarray, texts: pa.Array) -> dict:
    """Index of some documents in the order of their normalisers."""
    words, starts = _tokens(texts)
    coded = words.dictionary_encode()
    terms, width = coded.dictionary, len(m)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(width), np.diff(starts))
    pairs, tf = np.unique(code * width + doc, return_counts=True)
    code, doc = pairs // width, pairs % width
    fresh = np.concatenate([[True], m[1:] != m[:-1]])
    stratum = np.cumsum(fresh) - 1
    strata = m[fresh]
    entry = code * len(strata) + stratum[doc]
    order = np.lexsort((-tf, entry))  # stable: documents stay in order within a tf
    entry, tf, doc, code = entry[order], tf[order], doc[order], code[order]
    new_entry = np.concatenate([[True], entry[1:] != entry[:-1]])
    new_group = new_entry | np.concatenate([[True], tf[1:] != tf[:-1]])
    entry_at, group_at = np.flatnonzero(new_entry), np.flatnonzero(new_group)
    sizes = lambda at, n: np.diff(np.concatenate([at, [n]]))
    small = lambda x: x.astype(np.uint16).tobytes()
    return {
        "strata": strata.tobytes(),
        "stratum_docs": sizes(np.flatnonzero(fresh), width).astype(np.uint32).tobytes(),
        "terms": " ".join(terms.to_pylist()).encode(),
        "holders": np.bincount(code, minlength=len(terms)).astype(np.uint32).tobytes(),
        "entries": np.bincount(code[entry_at], minlength=len(terms)).astype(np.uint32).tobytes(),
        "entry_strata": small(stratum[doc[entry_at]]),
        "first_tf": tf[entry_at].astype(np.uint32).tobytes(),
        "ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
        "known": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
        "groups": small(np.diff(np.searchsorted(group_at, np.concatenate([entry_at, [len(doc)]])))),
        "group_tf": tf[group_at].astype(np.uint32).tobytes(),
        "group_docs": small(sizes(group_at, len(doc))),
        "docs": small(doc),
    }


def build_index(docs: DataFrame, counts: DataFrame, size: CorpusSize) -> DataFrame:
    """The index of all documents as a written table, a row per block."""
    if not size.terms:
        return docs.sparkSession.createDataFrame([], INDEX_SCHEMA)
    rows = lengths(docs).select(_normaliser(size).alias("m"), "doc_id", "text", F.monotonically_increasing_id().alias("place"))
    deal, partitions = _deal(counts, size)

    def build(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held, held_bytes, held_docs = [], 0, 0

        def block():
            nonlocal number
            ids, m, text = (
                pa.concat_arrays([b.column(c) for b in held]) for c in (1, 0, 2)
            )
            row = _block(ids, m.to_numpy(zero_copy_only=False), text)
            number += 1
            packed = [pa.array([_packed([row[c] for c in part])], pa.binary()) for part in (HEAD, TAIL)]
            return pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), *packed], ["block", "head", "tail"])

        for batch in (b.slice(k, MOST_ROWS) for b in chunks(batches, "text", BLOCK_BYTES // 4) for k in range(0, b.num_rows, MOST_ROWS)):
            texts = texts_of(batch)
            length = int(pc.sum(pc.binary_length(texts)).as_py() or 0)
            if held and (held_bytes + length > BLOCK_BYTES or held_docs + len(texts) > BLOCK_DOCS):
                yield block()
                held, held_bytes, held_docs = [], 0, 0
            held.append(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["m", "doc_id", "text"]))
            held_bytes, held_docs = held_bytes + length, held_docs + len(texts)
        if held:
            yield block()

    spread = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int")
    dealt = rows.join(broadcast_if_small(deal), "m").withColumn("part", F.least(F.col("first") + spread, F.lit(partitions - 1)))
    ordered = dealt.repartitionById(partitions, "part").sortWithinPartitions("m", "doc_id", "place")
    return written(ordered.select("m", "doc_id", "text").mapInArrow(tidy(build), INDEX_SCHEMA), "lexical_index")


def query_terms(texts: list[str | None]) -> list[list[str]]:
    """Distinct terms of each query."""
    words, starts = _tokens(pa.array([t or "" for t in texts], pa.large_string()))
    words = words.to_pylist()
    return [sorted(set(words[a:b])) for a, b in zip(starts[:-1], starts[1:])]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class _Reader:
    """One index row; ``docs`` parts only where they were read."""

    def __init__(self, row: dict):
        get = lambda name, kind: np.frombuffer(row[name], dtype=kind).astype(np.int64)
        self.block = row["block"]
        raw = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.m, self.entry_stratum = raw("strata", np.int64), raw("entry_strata", np.uint16)
        self.stratum_docs = get("stratum_docs", np.uint32)
        self.first_tf, self.entries = get("first_tf", np.uint32), get("entries", np.uint32)
        self.entry_at = np.cumsum(self.entries) - self.entries
        self.first_impact = impacts(self.first_tf, self.m[self.entry_stratum])
        if "docs" in row:
            self.ids, self.known = get("ids", np.int64), np.frombuffer(row["known"], dtype=np.bool_)
            self.groups, self.group_docs = get("groups", np.uint16), get("group_docs", np.uint16)
            self.group_at = np.cumsum(self.groups) - self.groups
            self.docs, self.docs_at = raw("docs", np.uint16), np.cumsum(self.group_docs) - self.group_docs
            # Computed once for each tf of a term in a stratum, for all queries.
            of_group = np.repeat(self.m[self.entry_stratum], self.groups)
            self.impact = impacts(get("group_tf", np.uint32), of_group)

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Most that a document of each stratum can score, and the entries behind it."""
        entries = ragged(self.entry_at[terms], self.entries[terms])
        weight = np.repeat(weights, self.entries[terms])
        return _summed(self.entry_stratum[entries], weight * self.first_impact[entries], len(self.m)), entries, weight

    def scores(self, entries: np.ndarray, weight: np.ndarray) -> np.ndarray:
        groups = ragged(self.group_at[entries], self.groups[entries])
        impact = np.repeat(weight, self.groups[entries]) * self.impact[groups]
        sizes = self.group_docs[groups]
        docs = self.docs[ragged(self.docs_at[groups], sizes)]
        return _summed(docs, np.repeat(impact, sizes), len(self.ids))


def _summed(keys: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums by key; exact in doubles while they stay below 2^53."""
    if not len(keys) or int(values.max()) * len(keys) < 1 << 53:
        return np.bincount(keys, weights=values, minlength=n).astype(np.int64)
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, keys, values)
    return out


class _Best:
    """The k best ``(score, id)`` of one query seen so far, and the least score still wanted."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, max(1, least)
        self.score, self.known, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        score, known, ids = (np.concatenate(x) for x in ((self.score, score), (self.known, known), (self.ids, ids)))
        if len(score) > self.k:
            cut = np.partition(score, len(score) - self.k)[len(score) - self.k]
            near = np.flatnonzero(score >= cut)
            order = near[np.lexsort((ids[near], known[near], -score[near]))][: self.k]
            score, known, ids = score[order], known[order], ids[order]
            self.least = max(self.least, int(score[-1]))
        self.score, self.known, self.ids = score, known, ids


def _search(block: _Reader, found: np.ndarray, weights: np.ndarray, best: _Best) -> int:
    """Visit the strata that can matter, best bounds first; returns how many."""
    bounds, entries, weight = block.bounds(found, weights)
    todo, visited = bounds >= best.least, 0
    while todo.any():
        # Enough of the best strata to hold k documents, then all that still can reach the k-th.
        now = todo
        if len(best.score) < best.k:
            order = np.flatnonzero(todo)[np.argsort(-bounds[todo], kind="stable")]
            enough = np.searchsorted(np.cumsum(block.stratum_docs[order]), best.k) + 1
            now = np.zeros(len(bounds), dtype=bool)
            now[order[:enough]] = True
        here = now[block.entry_stratum[entries]]
        scores = block.scores(entries[here], weight[here])
        hits = np.flatnonzero(scores >= best.least)
        best.add(scores[hits], block.known[hits], block.ids[hits])
        visited += int(now.sum())
        todo = todo & ~now & (bounds >= best.least)
    return visited


@dataclass(frozen=True)
class Portion:
    """Queries of one go: number and terms of each, all terms, their weights."""

    numbers: list[int]
    terms: pa.Array
    places: list[np.ndarray]
    weights: np.ndarray | None = None

    @classmethod
    def of(cls, numbers: list[int], texts: list[str | None]) -> "Portion":
        each = query_terms(texts)
        every = sorted({t for terms in each for t in terms})
        at = {t: k for k, t in enumerate(every)}
        return cls(numbers, pa.array(every, pa.large_string()), [np.array([at[t] for t in x], dtype=np.int64) for x in each])

    def in_block(self, row: dict) -> np.ndarray:
        """Place of each of the portion's terms in a block, or -1."""
        block = pa.array(bytes(row["terms"]).decode().split(" "), pa.large_string())
        return pc.fill_null(pc.index_in(self.terms, value_set=block), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def asked(self, row: dict):
        """For each query with terms in the block: its place, their places, their weights."""
        at = self.in_block(row)
        for k, places in enumerate(self.places):
            mine = at[places]
            there = mine >= 0
            if there.any():
                yield k, mine[there], self.weights[places[there]]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Parts of one block after another."""
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            row = {"block": batch.column(0)[k].as_py()}
            for name, parts in (("head", HEAD), ("tail", TAIL)):
                if name in names:
                    row |= zip(parts, _unpacked(batch.column(names.index(name))[k].as_buffer()))
            yield row


def _holders(index: DataFrame, portion: Portion) -> np.ndarray:
    """Documents that hold each term of the portion."""

    def count(batches):
        total = np.zeros(len(portion.terms), dtype=np.int64)
        for row in _rows(batches):
            at = portion.in_block(row)
            n = np.frombuffer(row["holders"], dtype=np.uint32).astype(np.int64)
            total[at >= 0] += n[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["term", "df"])

    out = np.zeros(len(portion.terms), dtype=np.int64)
    # At most one number per term of the portion.
    for row in index.select("block", "head").mapInArrow(tidy(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def _first_blocks(index: DataFrame, portion: Portion) -> DataFrame:
    """``query, block``: for each query the blocks whose strata promise most."""
    def bound(batches):
        held: dict[int, list] = {}
        for row in _rows(batches):
            block = _Reader(row)
            for k, found, weights in portion.asked(row):
                top = int(block.bounds(found, weights)[0].max())
                held[k] = sorted([*held.get(k, []), (-top, block.block)])[:FIRST_BLOCKS]
        flat = [(k, b, -t) for k, x in held.items() for t, b in x]
        names = ["query", "block", "bound"]
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in flat], pa.int64()) for c in range(3)], names)

    rows = index.select("block", "head").mapInArrow(tidy(bound), "query long, block long, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "block")
    return rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= FIRST_BLOCKS).select("query", "block")


def _hits(index: DataFrame, portion: Portion, k: int, least: np.ndarray, only: dict[int, set] | None = None) -> DataFrame:
    """Up to k documents of each query from each task, all at or above ``least``."""

    def search(batches):
        best: dict[int, _Best] = {}
        for row in _rows(batches):
            block = None
            for q, found, weights in portion.asked(row):
                if only is None or row["block"] in only.get(q, ()):
                    block = block or _Reader(row)
                    if q not in best:
                        best[q] = _Best(k, int(least[q]))
                    _search(block, found, weights, best[q])
        for q, b in best.items():
            ids = pa.array(b.ids, pa.int64(), mask=~b.known)
            numbers = pa.array(np.full(len(b.ids), portion.numbers[q]), pa.int64())
            yield pa.RecordBatch.from_arrays([numbers, ids, pa.array(b.score, pa.int64())], ["query_no", "doc_id", "score"])

    if only is not None:
        index = index.filter(F.col("block").isin(sorted({b for x in only.values() for b in x})))
    return index.mapInArrow(tidy(search), HIT_SCHEMA)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: DataFrame, size: CorpusSize, portion: Portion, k: int) -> DataFrame:
    """``query_no, doc_id, score, rank`` of a portion's queries."""
    weights = np.array([size.weight(int(df)) for df in _holders(index, portion)], dtype=np.int64)
    portion = Portion(portion.numbers, portion.terms, portion.places, weights)
    only: dict[int, set] = {}
    for row in _first_blocks(index, portion).collect():  # FIRST_BLOCKS for each query
        only.setdefault(row["query"], set()).add(row["block"])
    least = np.zeros(len(portion.numbers), dtype=np.int64)
    if only:
        at = {n: q for q, n in enumerate(portion.numbers)}
        first = _ranked(_hits(index, portion, k, least, only), k).filter(F.col("rank") == k)
        for row in first.select("query_no", "score").collect():
            least[at[row["query_no"]]] = row["score"]
    return _ranked(_hits(index, portion, k, least), k)


def top_documents(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """``item_id, query_no, rank, doc_id, score``: the k best documents for each item.

    ``items (item_id, text)`` are cut into portions by the running size of
    their texts, and the driver holds the terms of one portion at a time.
    """
    counts = length_counts(docs)
    size = corpus_size(counts)
    index = build_index(docs, counts, size)
    asked = items.select("item_id", "text").withColumn("chars", 64 + F.coalesce(F.octet_length("text"), F.lit(0)))
    placed = written(running_start(asked, ["item_id", "text"], "chars", "query_no"), "queries")
    portions = placed.select((F.col("query_no") / PORTION_BYTES).cast("long").alias("portion")).distinct()
    results = []
    for row in portions.orderBy("portion").toLocalIterator():
        begin = row["portion"] * PORTION_BYTES
        here = placed.filter((F.col("query_no") >= begin) & (F.col("query_no") < begin + PORTION_BYTES)).select("query_no", "text").collect()
        portion = Portion.of([r["query_no"] for r in here], [r["text"] for r in here])
        if len(portion.terms) and size.terms:
            results.append(written(search(index, size, portion, k), "ranked"))
    if not results:
        results = [docs.sparkSession.createDataFrame([], HIT_SCHEMA + ", rank int")]
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found.join(placed.select("query_no", "item_id"), "query_no").select(
        "item_id", "query_no", "rank", "doc_id", "score"
    )
