"""Token ids in Parquet list columns.

Documents are put in ascending id order over the files, encoded inside the
tasks and written with Spark's Parquet writer: dictionary encoding for the
ids, row groups and pages of stated sizes, and page indexes, so that a reader
of a few ids or of the metadata columns skips all other pages.

Columns: ``doc_id``, ``part`` (the file's number in id order), ``part_start``
(ids in the part before the document), ``n_tokens`` and ``tokens``. An id's
place in the whole corpus is ``part_start`` plus the ids of earlier parts.

Defined results: a null or empty text has the end id alone; a null id comes
first; rows with equal ids and texts are alike, so their order is of no
account; an empty table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunks, ragged, texts_of, tidy, worker_state
from textloom.session import shared_folder

# Fixed value: the split pattern of byte-level pair encoding.
PIECE = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: A space after which a piece does not start for certain: white space or the end follows.
_ODD = (
    r" (?:[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]|\z)"
)
#: Pieces whose ids a worker keeps, and the characters of all it keeps; once full,
#: others are encoded each time they come.
KEPT_PIECES, KEPT_CHARS = 300_000, 12_000_000
#: Text encoded at once.
ENCODE_BYTES = 2 * 1024 * 1024
# Fixed value: ASCII signs that a piece of letters or digits never runs into.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FILE_SCHEMA = "doc_id long, part long, part_start long, n_tokens long, tokens array<int>"


class Encoder:
    """Encodes many texts with a tokenizer of the ``tokenizers`` library.

    For byte-level pair encoding, what starts with a single space is encoded
    alike wherever it stands, and so are signs behind it; each distinct piece
    is encoded once. All other tokenizers, and texts with runs of white space
    after a space or with special tokens in them, are encoded whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        facts = json.loads(self.whole.to_str())
        before = facts.get("pre_tokenizer") or {}
        self.by_piece = (
            facts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex") is True
            and before.get("add_prefix_space") is False
            and facts["model"]["type"] == "BPE"
        )
        added = [t["content"] for t in facts["added_tokens"]]
        self.odd = "|".join([_ODD, *map(regex.escape, added)])
        self.model, self.piece = self.whole.model, regex.compile(PIECE)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        assert sorted(names.values()) == sorted(pre_tokenizers.ByteLevel.alphabet())
        self.bytes = str.maketrans({chr(b): c for b, c in names.items()})
        self.known: dict[str, int] = {}
        #: Whole strings, signs at the end included, and where their ids stand.
        self.strings: dict[str, int] = {}
        self.chars = 0
        self.ids, self.ends = array("i"), array("q", [0])
        self.known[""] = self._add([])
        self.kept = len(self.ends)

    def _add(self, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return len(self.ends) - 2

    def _ids(self, piece: str) -> list[int]:
        coded = piece.encode().decode("latin1").translate(self.bytes)
        return [t.id for t in self.model.tokenize(coded)]

    def _places(self, strings: list[str]) -> np.ndarray:
        """Where the ids of each string stand."""
        found = list(map(self.strings.get, strings))
        known, add, tokens, ends, ids = self.known, self._add, self._ids, self.ends, self.ids
        # Without room, what is added here goes after this batch.
        room = len(known) < KEPT_PIECES and self.chars < KEPT_CHARS
        made = known if room else {}

        def place(piece: str) -> int:
            at = known.get(piece)
            if at is None:
                at = made.get(piece)
                if at is None:
                    at = made[piece] = add(tokens(piece))
            return at

        for k in [k for k, at in enumerate(found) if at is None]:
            string = strings[k]
            core = string.rstrip(_SIGNS)
            if not core[-1:].isalnum():
                core = string
            if core in known or not core or core.lstrip(" ").isalpha():
                parts = [place(core)]
            else:
                parts = [place(p) for p in self.piece.findall(core)]
            if len(core) < len(string):
                parts.append(place(string[len(core) :]))
            if len(parts) > 1:
                whole = ids[ends[parts[0]] : ends[parts[0] + 1]]
                for p in parts[1:]:
                    whole += ids[ends[p] : ends[p + 1]]
                parts = [add(whole)]
            found[k] = parts[0]
            if room:
                self.strings[string] = parts[0]
                self.chars += len(string)
        if room:
            self.kept = len(ends)
        return np.array(found, dtype=np.int64)

    def _forget(self):
        """Give up the ids that are not kept."""
        del self.ends[self.kept :]
        del self.ids[self.ends[-1] :]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by ``end_id``, and the ids of each text."""
        if self.by_piece:
            odd = pc.match_substring_regex(texts, self.odd)
            odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        else:
            odd = np.arange(len(texts))
        if len(odd):
            mask = np.zeros(len(texts), dtype=bool)
            mask[odd] = True
            strange = texts.take(pa.array(odd)).to_pylist()
            texts = pc.if_else(pa.array(mask), pa.scalar("", texts.type), texts)
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        flat = split.flatten()
        first = np.zeros(len(flat), dtype=bool)
        first[offsets[:-1]] = True
        lead = pc.if_else(pa.array(first), pa.scalar("", flat.type), pa.scalar(" ", flat.type))
        coded = pc.binary_join_element_wise(lead, flat, pa.scalar("", flat.type)).dictionary_encode()
        codes = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        if len(odd):
            whole = self.whole.encode_batch(strange, add_special_tokens=False)
            codes[offsets[odd]] = [self._add(e.ids) for e in whole]
        ends = np.frombuffer(self.ends, dtype=np.int64)
        begin = ends[codes]
        sizes = ends[codes + 1] - begin
        total = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        close = total[1:] + np.arange(len(offsets) - 1)
        out = np.empty(int(total[-1]) + len(close), dtype=np.int32)
        inside = np.ones(len(out), dtype=bool)
        inside[close] = False
        out[inside] = np.frombuffer(self.ids, dtype=np.int32)[ragged(begin, sizes)]
        out[close] = end_id
        del ends  # a live view would keep the arrays from changing
        self._forget()
        return out, np.diff(np.concatenate([[-1], close]))


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """The rows of the token files, in ascending id order over the partitions."""

    def encode(batches):
        encoder = worker_state(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path))
        part, start = TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "text", ENCODE_BYTES):
            ids, sizes = encoder.encode(texts_of(batch), end_id)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(np.full(len(sizes), part, dtype=np.int64)),
                    pa.array(start + ends - sizes),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)
                    ),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "tokens"],
            )
            start += int(ends[-1])

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(tidy(encode), FILE_SCHEMA)


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    path: str | None = None,
    row_group_bytes: int = 32 * 1024 * 1024,
    page_rows: int = 256,
) -> str:
    """Encode ``docs`` and write the token files; returns their folder."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    (
        encoded(docs, tokenizer_path, end_id)
        .write.option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", 1024 * 1024)
        .parquet(path)
    )
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``, the ids of all documents before each."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("ids"))
    shifts = parts.select("_part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("shift"))
    return rows.join(F.broadcast(shifts), F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("shift") + F.col("part_start")).alias("start"), "n_tokens", "tokens"
    )


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the ids that were read."""

    def digest(batches):
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            bytes_ = memoryview(raw).cast("B") if len(raw) else memoryview(b"")
            crc = [zlib.crc32(bytes_[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(offsets)),
                    pa.array(np.array(crc, dtype=np.int64)),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "start", "tokens").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
