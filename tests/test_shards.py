"""Permutations of dense numbers and files of equal size."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textloom.functions.permute import permuted
from textloom.sources import sinks as K


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 255, 256, 257, 5000])
def test_every_number_once(n):
    places = permuted(np.arange(n), n, "s")
    assert sorted(places.tolist()) == list(range(n))
    assert places.tolist() == [int(permuted(np.array([k]), n, "s")[0]) for k in range(n)][: len(places)]


def test_order_is_mixed_and_keyed():
    n = 20_000
    places = permuted(np.arange(n), n, "s")
    assert (places != permuted(np.arange(n), n, "t")).mean() > 0.99
    assert (np.abs(np.diff(places)) < n // 100).mean() < 0.05
    assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.03


def _files(path):
    return [pq.read_table(f).column("id").to_pylist() for f in sorted(path.glob("part-*"))]


def test_files_differ_by_one_row_at_most(spark, tmp_path):
    df = spark.range(1003).select((F.col("id") / 10).cast("int").alias("doc"), "id")
    seen = []
    for parts in (1, 7):
        for keys in (["doc", "id"], None):
            path = tmp_path / f"{parts}-{keys is None}"
            assert K.write_shards(df.repartition(parts), str(path), 16, keys=keys) == 1003
            files = _files(path)
            assert len(files) == 16 and {len(f) for f in files} == {62, 63}
            assert sorted(sum(files, [])) == list(range(1003))
            if keys:
                seen.append(files)
    assert seen[0] == seen[1]
    docs = [k // 10 for k in seen[0][0]]
    assert sum(a == b for a, b in zip(docs, docs[1:])) < len(docs) / 5


def test_fewer_rows_than_files(spark, tmp_path):
    assert K.write_shards(spark.range(3), str(tmp_path / "few"), 8, keys=["id"]) == 3
    assert spark.read.parquet(str(tmp_path / "few")).count() == 3
    assert K.write_shards(spark.range(0), str(tmp_path / "none"), 4, keys=["id"]) == 0


def test_one_file_a_text(spark, tmp_path):
    """Also from several tasks, each of which moves its own files into place."""
    texts = [f"text {k}\nof two lines" for k in range(40)] + ["text 0\nof two lines", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    K.write_texts(rows, f"{tmp_path}/pos")
    K.write_texts(rows.limit(0), f"{tmp_path}/neg")
    files = [p for p in (tmp_path / "pos").iterdir() if p.name.startswith("part-")]
    assert sorted(p.read_text() for p in files) == sorted(t + "\n" for t in texts)
    assert not list((tmp_path / "pos").glob("_temporary"))


def test_texts_are_written_by_the_tasks_themselves(spark, tmp_path):
    """No process is started for a file, so there are neither rights nor checksums; a task run again changes nothing."""
    rows = spark.createDataFrame([("é",), ("a",), ("a",), (None,)], "text string").coalesce(1)
    K.write_texts(rows, f"file:{tmp_path}/new")
    files = sorted((tmp_path / "new").iterdir())
    assert sorted(f.read_text() for f in files if f.name != "_SUCCESS") == ["\n", "a\n", "a\n", "é\n"]
    assert not [f for f in files if f.name.startswith(".")]
    rows.orderBy(rows.text.desc()).coalesce(1).mapInArrow(K._text_files(f"{tmp_path}/new"), "n long").collect()
    assert sorted((tmp_path / "new").iterdir()) == files
    try:
        K.write_texts(rows, f"{tmp_path}/new")
    except FileExistsError:
        return
    raise AssertionError("a folder was written twice")
