import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="textloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_vocab(spark):
    tokens = "[UNK] [CLS] [SEP] want ##want ##ed wa un runn ##ing ,".split()
    return spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, token_id int")


QA_SCHEMA = (
    "context_id string, context string, qas array<struct<id:string,question:string,"
    "is_impossible:boolean,answers:array<struct<text:string,answer_start:int>>>>"
)


@pytest.fixture(scope="session")
def qa_vocab(spark):
    words = (
        "[PAD] [UNK] [CLS] [SEP] [MASK] the man went to store and bought a gallon of milk "
        "( 1895 - 1943 ) . , leader was john smith steve ' s when ? japanese japan industry"
    ).split()
    return spark.createDataFrame([(t, i) for i, t in enumerate(words)], "token string, token_id int")
