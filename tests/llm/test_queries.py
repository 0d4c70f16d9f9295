"""Registered queries against their SQL, and the pipeline against its parts."""

import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import decontamination, mixing, toxicity
from textloom.llm.queries import ORACLES, QUERIES, id_remainder
from tests_llm_plain import near_roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    mine = sorted((tuple(tidy(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    result = tables.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    places = [names.index(c) for c in sorted(df.columns)]
    assert sorted(names) == sorted(df.columns)
    assert mine == sorted((tuple(tidy(r[p]) for p in places) for r in result.fetchall()), key=repr)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "source_mix", "token_files"]


def test_pipeline_by_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), id_remainder(3) != 1)
    score = {r.doc_id: r.score for r in toxicity.scores(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if score[r.doc_id] < 0.7}
    roots = near_roots(texts)
    kept = {d for d in texts if roots[d] == d}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    words = lambda t: [w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or w for w in re.findall(r"\S+", t.lower())]
    items = [words(r.text) for r in bench.collect()]
    clean = set()
    for d in kept:
        text = words(texts[d])
        runs = {tuple(text[k : k + 4]) for k in range(len(text) - 3)}
        near = [i for i in items if any(tuple(i[k : k + 4]) in runs for k in range(len(i) - 3))]
        if not any(decontamination.tile_pair([hash(w) for w in i], [hash(w) for w in text], 4) >= 0.6 * len(i) for i in near):
            clean.add(d)
    plan = mixing.mix_plan(docs.filter(F.col("doc_id").isin(sorted(clean)))).collect()
    want = Counter({r.doc_id: r.copies for r in plan if r.copies})
    found = corpus_pipeline.run(spark, SF).orderBy("start").collect()
    assert Counter(r.doc_id for r in found) == want
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {d: len(plain.encode(texts[d], add_special_tokens=False).ids) + 1 for d in want}
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, sizes[r.doc_id])
        start += r.n_tokens
