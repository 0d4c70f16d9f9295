import unicodedata

from pyspark.sql import functions as F

from textloom.functions import arrays as A
from textloom.functions import text as X

GOLDEN = [
    ("UNwantéd,running", "unwanted , running", "UNwantéd , running"),
    ("ah博推zz", "ah 博 推 zz", "ah 博 推 zz"),
    (" \tHeLLo!how  \n Are yoU?  ", "hello ! how are you ?", "HeLLo ! how Are yoU ?"),
    ("Héllo", "hello", "Héllo"),
    ("", "", ""),
    ("ab­cd a\u000bb x​y \u0005", "abcd ab xy", "abcd ab xy"),
    ("a b c　d", "a b c d", "a b c d"),
    ("a-b$c`d.e^f", "a - b $ c ` d . e ^ f", "a - b $ c ` d . e ^ f"),
    ("a�b\u0000c", "abc", "abc"),
    ("かカ一", "かカ 一", "かカ 一"),
]


def test_golden_tokens(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(GOLDEN)], "i int, t string")
    rows = df.select(
        "i",
        F.array_join(X.basic_tokens(F.col("t")), " ").alias("u"),
        F.array_join(X.basic_tokens(F.col("t"), False), " ").alias("c"),
    ).collect()
    for r in rows:
        assert (r.u, r.c) == GOLDEN[r.i][1:]


def test_accents_follow_the_unicode_database(spark):
    """Marks that this Java's older Unicode tables do not know are skipped."""

    def spec(char):
        opened = unicodedata.normalize("NFD", char.lower())
        return "".join(c for c in opened if unicodedata.category(c) != "Mn")

    chars = [chr(i) for i in range(1, 0x30000) if not 0xD800 <= i <= 0xDFFF]
    rows = (
        spark.createDataFrame([(c,) for c in chars], "c string")
        .select("c", X.strip_accents(F.lower("c")).alias("s"))
        .collect()
    )
    wrong = [r.c for r in rows if r.s != spec(r.c)]
    assert all(len(c) == 1 and not ("가" <= c <= "힣") for c in wrong)
    assert len(wrong) < 250
    assert not [c for c in wrong if ord(c) < 0x300 or 0x1E00 <= ord(c) < 0x2000]


def test_hangul_opens_into_jamo(spark):
    word = "한글"
    got = spark.createDataFrame([(word,)], "t string").select(X.strip_accents(F.col("t"))).first()[0]
    assert got == unicodedata.normalize("NFD", word)


def test_invalid_bytes_are_dropped(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff\xfeb\xc3\xa9"),)], "b binary")
    assert df.select(X.utf8_text(F.col("b"))).first()[0] == "abé"


def test_small_steps(spark):
    def one(text, fn):
        return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]

    assert one("see http://x.y/z @me ok #tag end", X.strip_handles) == "see   ok  end"
    assert one("a\nb\tc\rd", X.flat_lines) == "a b cd"
    assert one("naïve café", X.ascii_only) == "nave caf"
    assert one("  a   b\n", X.squeeze) == "a b"
    assert one("One. Two! three? Four", X.sentences) == ["One.", "Two! three?", "Four"]
    assert one(" big  label\tname ", X.label_name) == "big_label_name"
    assert one("un ##want ##ed , runn ##ing", X.join_pieces) == "unwanted , running"
    assert one("don''t  Stop", lambda c: X.joined_lower(X.words_of(c), True)) == "dont stop"


def test_softmax_and_ranking(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],), ([],)], "x array<double>")
    rows = df.select(
        A.softmax(F.col("x")).alias("p"), A.best_indexes(F.col("x"), 3).alias("b"), A.argmax(F.col("x")).alias("m")
    ).collect()
    assert abs(sum(rows[0].p) - 1) < 1e-12
    assert rows[0].b == [1, 2, 3] and rows[0].m == 1
    assert rows[1].p == [] and rows[1].b == []


def test_a_text_is_cleaned_once(spark):
    df = spark.createDataFrame([("a",)], "t string")
    for tokens in (X.basic_tokens(F.col("t")), X.unit_tokens(F.col("t"))):
        plan = df.select(tokens.alias("v"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("\\x{FFFD}") == 1


def test_words_of_normalised_texts_end_at_any_space(spark):
    spaces = " \t\x0b\x1c\x85  　\r"
    df = spark.createDataFrame([("a" + "b".join(spaces) + "É\n c  d\n",), (None,), ("",), ("\nṩx",)], "t string")
    rows = df.select(
        X.basic_tokens(F.col("t")).alias("got"),
        X.words_of(X.basic_text(F.col("t"))).alias("want"),
        X.unit_tokens(F.col("t")).alias("units"),
    ).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert [(u.unit, u.word) for u in rows[0].units][-3:] == [(0, "e"), (1, "c"), (1, "d")]
    assert rows[1].units is None and rows[3].got == ["sx"]
