"""Headline timings: one JSON line with seconds and rows per second.

The vocabulary is an input of every step, so it is built before timing. Each
step is timed once, cold, from the tables to a hash over all columns of its
rows, so that no column can be left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.functions import text as X  # noqa: E402
from textloom.operators import answers, pretrain, subword, windows  # noqa: E402
from textloom.plans import datasets  # noqa: E402
from textloom.plans.catalog import answers as catalog_answers  # noqa: E402
from textloom.plans.catalog import datasets as catalog_datasets  # noqa: E402
from textloom.plans.catalog.registry import table, vocabulary  # noqa: E402
from textloom.plans.questions import document_paragraphs  # noqa: E402
from textloom.session import cut  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def steps(spark: SparkSession, sf: str):
    docs = table(spark, sf, "documents")
    vocab = vocabulary(spark, sf)
    cfg = pretrain.PairConfig(dupe_factor=2)

    def tokens():
        return docs.select("doc_id", X.basic_tokens(F.col("text")).alias("t"))

    def encoded():
        units = docs.select("doc_id", X.unit_tokens(F.col("text")).alias("units"))
        return subword.encode(units, ["doc_id"], "units", vocab, with_pieces=True)

    def pairs():
        return pretrain.training_rows(docs, vocab, cfg)

    built = {}

    def question_windows():
        paragraphs = document_paragraphs(docs)
        built["rows"] = cut(windows.question_windows(paragraphs, vocab, windows.WindowConfig(negatives=True)))
        return built["rows"]

    def ranked():
        rows = catalog_answers.with_hash_logits(built["rows"])
        examples = built["rows"].select("qas_id").distinct()
        return answers.n_best(rows, examples, answers.AnswerConfig(negatives=True), built["rows"])

    def tagged():
        return datasets.tagged_dataset(
            catalog_datasets.tagged_documents(spark, sf), catalog_datasets.TAGS
        )[0]

    return {
        "txt8_basic_tokens": tokens,
        "tok2_full_tokens": encoded,
        "pt7_training_rows": pairs,
        "qa8_window_features": question_windows,
        "qa12_n_best": ranked,
        "lbl4_tagged_dataset": tagged,
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    vocabulary(spark, sf).count()
    seconds, rates = {}, {}
    for name, build in steps(spark, sf).items():
        begin = time.time()
        rows = build()
        seen = rows.agg(
            F.count("*").alias("n"), F.max(F.xxhash64(*rows.columns))
        ).first()
        seconds[name] = round(time.time() - begin, 2)
        rates[name] = round(seen["n"] / seconds[name], 1)
        print(f"{name}: {seconds[name]}s {seen['n']} rows", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "text dataset steps",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
