"""Token files against the tokenizers library, and their layout on disk."""

import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from textloom.llm import token_files

TEXTS = [
    "Hello world, it's  a  test.\nNew line\n\n two  spaces ",
    " leading",
    "trailing ",
    "",
    None,
    "   ",
    "tabs\tand no-break   space 　x",
    "don't we'll THEY'RE 123 4567 !!! ??? éß中文 \U0001f600 \U0001f600",
    "a<|endoftext|>b <|endoftext|>",
    "a" * 5000,
    "same text",
    "same text",
    "\r\n x\r\n",
    "x \ny",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k * 3 % 14, t, k, "t") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, part int, tokens string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_round_trip(spark, docs, name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    folder = token_files.write_tokens(docs.repartition(3), path, 2)
    rows = {r.doc_id: r for r in token_files.read_tokens(spark, folder).collect()}
    digests = {r.doc_id: r for r in token_files.digests(token_files.read_tokens(spark, folder)).collect()}
    start = 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert list(rows[r.doc_id].tokens) == ids
        assert rows[r.doc_id].start == start == digests[r.doc_id].start
        assert digests[r.doc_id].n_tokens == len(ids)
        assert digests[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_slices_are_read_right():
    """Batches cut from a larger one, as tasks get them."""
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"word{k} and more {k * k}" for k in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    from textloom.llm.common import chunks, texts_of

    ids = []
    for part in chunks([batch], "text", 500):
        some, sizes = encoder.encode(texts_of(part), 2)
        ids += some.tolist()
    plain = [i for t in texts for i in [*encoder.whole.encode(t).ids, 2]]
    assert ids == plain


def test_ids_in_order_over_files_and_page_index(spark, docs):
    folder = token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, page_rows=2)
    last = -1
    for f in sorted(glob.glob(folder.removeprefix("file:") + "/part-*")):
        file = pq.ParquetFile(f)
        found = file.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert found == sorted(found) and (not found or found[0] > last)
        last = found[-1] if found else last
        if found:
            group = file.metadata.row_group(0)
            tokens = group.column(group.num_columns - 1)
            assert any("DICTIONARY" in e for e in tokens.encodings)
            assert tokens.has_column_index or group.column(0).has_column_index


def test_repeats_nulls_and_empty(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = token_files.read_tokens(spark, token_files.write_tokens(df, path, 2)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1] and rows[1].tokens == rows[2].tokens
    none = token_files.write_tokens(df.limit(0), path, 2)
    assert token_files.digests(token_files.read_tokens(spark, none)).count() == 0
