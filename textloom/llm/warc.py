"""WARC archives: writing with revisits, reading by boundary-chain verification.

Reading, of WARC 1.0 and 1.1. Archives are cut at every place where a version line
may stand, in parallel and whatever is around it, so a version line inside a payload is cut
as well. Each piece whose header can be read is a candidate record; its
``Content-Length`` tells where its successor must start. Pieces whose
successor is the very next piece form runs; a run is left at its last piece
only, so runs are the nodes of a much smaller graph of offsets. Pointer
jumping from the start of each file finds the runs on its chain, and in each
the place where the chain enters it. What the chain doesn't visit is payload,
and is joined to the record that holds it.

Moved are offsets and header fields alone. Payload bytes are digested where
they are read; only records with a version line inside are put together from
their pieces, one record at a time.

Writing. Records are lines of a text file whose line end closes a record.
Of records with equal payloads of ``revisit_from`` bytes or more, that with
the largest id is the response, and the others refer to it.

Defined results: a null payload is empty; a null id is written as an empty id
and read as null, and refers to a response like any other; rows with the
largest id of equal payloads are all responses; line ends inside a URL are
percent-encoded, a null URL is left out; an empty table gives archives without
records; other columns are ignored. A file that begins with the line of another
version is an error; one that begins with no version line has no chain and gives
no records.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import written
from textloom.session import shared_folder

# The format's version line, line end, revisit profile and base-32 alphabet.
VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_BLANK = END + END
# What the version lines that are read begin with, and how they end.
_MAGIC = "WARC/1."
_KNOWN = ("0" + END, "1" + END)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary column in base 32, as eight strings of four letters."""
    words = [F.conv(F.substring(F.sha1(payload), 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    letter = lambda w, k: F.substring(
        F.lit(BASE32), F.shiftright(w, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1)
    )
    return F.transform(
        F.array(*words), lambda w: F.concat(*[letter(w, k) for k in range(4)])
    )


def records(pages: DataFrame, revisit_from: int, date: str) -> DataFrame:
    """One record per row as text, without its last line end."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    keepers = (
        rows.filter(F.octet_length("html") >= revisit_from)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("equal"))
        .filter("equal > 1")
        .select("sha1", "keeper")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(END))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + END),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length("html").cast("string")),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    text = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Refers-To", name(F.col("keeper"))),
            ),
        ).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.array_join(base32_sha1(F.col("html").cast("binary")), ""))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(END),
        F.col("block"),
        F.lit(END),
    )
    return rows.join(keepers, "sha1", "left").withColumn("block", block).select(text.alias("record"))


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    revisit_from: int = 0,
    compression: str = "gzip",
    date: str = "2020-01-01T00:00:00Z",
) -> str:
    """Write ``pages (page_id, url, html)``; returns the archives' folder."""
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    (
        records(pages, revisit_from, date)
        .write.option("lineSep", END)
        .option("compression", compression)
        .text(path)
    )
    return path


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, turn`` (order in the file) and ``piece``, the text between version lines."""
    return spark.read.option("lineSep", _MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("turn"),
        F.col("value").alias("piece"),
    )


def _field(head: Column, name: str) -> Column:
    value = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", F.trim(value))


def _bytes_of(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def _with_payload(rows: DataFrame) -> DataFrame:
    """Replace ``body``, a record's block, by the facts of its HTTP head and payload."""
    head = F.substring_index(F.col("body").cast("string"), _BLANK, 1)
    start = F.least(_bytes_of(head) + len(_BLANK), F.octet_length("body").cast("long")) + 1
    return (
        rows.withColumn("http_bytes", _field(head, "Content-Length"))
        .withColumn("http_bytes", F.expr("try_cast(http_bytes as bigint)"))
        .withColumn("body", F.substring("body", start.cast("int"), F.lit(2**31 - 1)))
        .withColumn("body_bytes", F.octet_length("body").cast("long"))
        .withColumn("digest", F.array_join(base32_sha1(F.col("body")), ""))
        .drop("body")
    )


def _chain(pieces: DataFrame) -> DataFrame:
    """The candidates that the chain from their file's start visits.

    ``pieces``: written rows ``file, split, turn, bytes, head, length``; the
    offsets are those behind the version line.
    """
    in_file = Window.partitionBy("file").orderBy("split", "turn")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        pieces.withColumn("at", F.coalesce(F.sum(F.col("bytes") + len(_MAGIC)).over(before), F.lit(0)))
        .withColumn("next", F.col("at") + F.col("head") + F.col("length") + len(_BLANK) + len(_MAGIC))
        .withColumn("follows", F.col("next").eqNullSafe(F.lead("at").over(in_file)))
        .withColumn(
            "run", F.coalesce(F.sum((~F.col("follows")).cast("long")).over(before), F.lit(0))
        )
    )
    placed = written(placed, "warc-offsets")
    leaps = placed.filter("not follows and next is not null").select(
        "file", "run", F.col("next").alias("at")
    )
    edges = written(
        leaps.join(placed.select("file", "at", F.col("run").alias("to")), ["file", "at"]).select(
            "file", "run", "to", "at"
        ),
        "warc-leaps",
    )
    root = placed.filter(F.col("at") == len(_MAGIC)).select("file", "run", F.col("at").alias("entry"))
    entries = root
    if not edges.isEmpty():
        reached, jump = root.select("file", "run"), edges.select("file", "run", "to")
        known = -1
        while True:
            reached = written(
                reached.union(
                    reached.join(jump, ["file", "run"]).select("file", F.col("to").alias("run"))
                ).distinct(),
                "warc-reached",
            )
            size = reached.count()
            if size == known:
                break
            known = size
            there = jump.select("file", F.col("run").alias("to"), F.col("to").alias("far"))
            jump = written(
                jump.join(there, ["file", "to"]).select("file", "run", F.col("far").alias("to")),
                "warc-jump",
            )
        entered = edges.join(reached, ["file", "run"]).select(
            "file", F.col("to").alias("run"), F.col("at").alias("entry")
        )
        entries = root.union(entered).groupBy("file", "run").agg(F.min("entry").alias("entry"))
    return placed.join(entries, ["file", "run"], "left").withColumn(
        "visited", F.col("next").isNotNull() & F.coalesce(F.col("at") >= F.col("entry"), F.lit(False))
    )


_FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "stated_digest": "WARC-Payload-Digest",
}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record on the chains of the archives in ``path``.

    Columns ``record_id, record_type, refers_to, target_uri, payload_bytes,
    payload_digest, intact``. A response is digested from its bytes and
    ``intact`` if they agree with its header; a revisit, which has no payload,
    has the digest its header states and the length its HTTP head gives.
    """
    pieces = _pieces(spark, path)
    head, length = F.col("header"), F.col("length")
    start = (F.col("head") + 1).cast("int")
    facts = (
        pieces.withColumn("header", F.substring_index("piece", _BLANK, 1))
        .withColumn("bytes", _bytes_of(F.col("piece")))
        .withColumn("head", _bytes_of(head) + len(_BLANK))
        .withColumn("known", F.substring("piece", 1, 3).isin(*_KNOWN))
        .withColumn("strange", F.col("piece").startswith("WARC/"))
        .withColumns({c: _field(head, f) for c, f in _FIELDS.items()})
        .withColumn("length", _field(head, "Content-Length"))
        .withColumn("length", F.expr("try_cast(length as bigint)"))
        .withColumn("length", F.when(F.col("known") & (F.col("head") <= F.col("bytes")) & (length >= 0), length))
        .withColumn("whole", F.col("head") + length <= F.col("bytes"))
        .withColumn("body", F.substring(F.col("piece").cast("binary"), start, length.cast("int")))
        .withColumn("body", F.when(F.col("whole"), F.col("body")))
        .drop("piece", "header")
    )
    chain = written(_chain(written(_with_payload(facts), "warc-pieces")), "warc-chain")
    # Only a file's own first line is sure to be a version line.
    first = (F.col("at") == len(_MAGIC)) & ~F.col("known") | (F.col("at") == 0) & F.col("strange")
    strange = chain.filter(first).select("file").first()
    if strange is not None:
        raise ValueError(f"unknown version line at the start of {strange['file']}")
    found = chain.filter("visited and whole")
    parted = chain.filter("visited and not whole")
    if not parted.isEmpty():
        names = [c for c in found.columns if c not in ("http_bytes", "body_bytes", "digest")]
        so_far = (
            Window.partitionBy("file")
            .orderBy("split", "turn")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        owner = F.last(F.when(F.col("visited"), F.col("at")), True).over(so_far)
        owned = chain.withColumn("owner", owner).select("file", "split", "turn", "owner", "at")
        owned = owned.join(
            parted.select("file", F.col("at").alias("owner"), "next"), ["file", "owner"]
        ).filter("at < next")
        parts = F.transform(
            F.sort_array(F.collect_list(F.struct("at", F.col("piece").cast("binary").alias("bytes")))),
            lambda p: p["bytes"],
        )
        together = F.aggregate(
            F.slice("parts", 2, F.size("parts")),
            F.element_at("parts", 1),
            lambda all_, part: F.concat(all_, F.lit(_MAGIC).cast("binary"), part),
        )
        whole = (
            pieces.join(owned, ["file", "split", "turn"])
            .groupBy("file", "owner")
            .agg(parts.alias("parts"))
            .select("file", F.col("owner").alias("at"), together.alias("piece"))
        )
        rebuilt = parted.select(*names).join(whole, ["file", "at"]).withColumn(
            "body", F.substring("piece", start, length.cast("int"))
        )
        # A last record that its file cuts off is not a record.
        rebuilt = rebuilt.filter(F.octet_length("body") == length).drop("piece")
        found = found.unionByName(_with_payload(rebuilt))
    revisit = F.col("record_type") == "revisit"
    stated = F.regexp_replace("stated_digest", "^sha1:", "")
    return found.select(
        "record_id",
        "record_type",
        "refers_to",
        "target_uri",
        F.when(revisit, F.col("http_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.col("digest")).alias("payload_digest"),
        (revisit | (F.col("digest") == stated)).alias("intact"),
    )


def page_number(name: Column) -> Column:
    """The page id in a record id that ``write_archives`` made."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
