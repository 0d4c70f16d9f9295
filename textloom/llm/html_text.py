"""Main text of web pages, with a suffix array over the pages of each host.

A page is cut into blocks of text. What the markup says is believed: text of
an article element belongs to the article, text of menus, footers, forms,
adverts and the like (by element, role or class) does not. Other text of the
main element or, without one, of the page is open beside an article and where
there is none, and repetition on the host decides. Only a main element without
an article is taken whole.

For that, the tokens of each page outside its article, in page order, are
concatenated over the pages of a host, a suffix array sorts all places, and
places whose next ``run`` tokens are equal stand together. A run found on
``pages`` or more distinct pages is boilerplate; every token that such a run
covers is removed from the open text, and the unique runs are kept. Text of
articles takes no part: copies and quotations repeat there and stay.

Hosts are of any size, so a host's pages are dealt into portions of bounded
number; each portion has its own suffix array, and the counts of its runs are
added up. Pages with equal tokens, the article's included, count once, so that
copies of a page don't remove each other. Different pages with equal text
outside their articles stand in a suffix array once, with their number as weight.

Defined results: null or empty html has an empty text; a null URL is a host
of its own; html that ends inside a tag, comment or reference is read as far
as it goes; repeated rows are results of their own; an empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import html as html_codes
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import chunks, window_hashes, written


@dataclass(frozen=True)
class ExtractConfig:
    run: int = 8
    pages: int = 3
    portion_pages: int = 2000


_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW = ("script", "style", "textarea", "title", "xmp", "iframe")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
_APART = frozenset(
    "nav footer aside form dialog menu button select option head noscript template svg".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu".split()
)
_NAMES = frozenset(
    "ad ads adv advert nav navbar navigation menu header masthead footer sidebar aside rail cookie "
    "cookies consent gdpr privacy notice notices alert newsletter subscribe signup popup modal overlay "
    "share sharing social breadcrumb breadcrumbs pagination pager respond disqus related recommended "
    "widget toolbar login search skip copyright legal paywall form replies reactions".split()
)
_STEMS = ("advert", "adsense", "sponsor", "promo", "banner", "comment", "sidebar", "cookie")
_UNLESS = frozenset("has with no without free".split())
_HELD = frozenset("header masthead".split())
#: Words that a part's name adds without telling what the part is about.
_FILL = frozenset(
    "box bar list lists links link wrapper wrap container block blocks section area panel item items slot unit "
    "button buttons inner outer top bottom left right main content text inline row col group holder module "
    "posts post articles article stories story tools icons icon message msg title body site page global js".split()
)
_NEVER = frozenset("html body main article".split())
_SPACED = frozenset("br td th hr img".split())


def _named_apart(attributes: str, held: bool) -> bool:
    """Whether class, id or role name a part that is not the article.

    Names that tell of something a part has or lacks don't count. Inside an
    article (``held``) a header is the article's own, and a name counts only as a
    whole: a word beside the known ones makes it the name of something else.
    """
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        key = key.lower()
        if key == "role" and value in _ROLES:
            return True
        if key in ("class", "id"):
            for name in value.split():
                words = re.split(r"[_\-]+", name)
                if _UNLESS.intersection(words):
                    continue
                known = lambda w: w in _NAMES or w in _FILL or w.startswith(_STEMS) or not w.strip("0123456789")
                if held and not all(map(known, words)):
                    continue
                for word in words:
                    if (word in _NAMES and not (held and word in _HELD)) or word.startswith(_STEMS):
                        return True
    return False


def blocks(page: str) -> list[tuple[str, str]]:
    """``(zone, text)`` of each block; zones: article, main, open, apart."""
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and the zone inside each
    inside: list[str] = []
    aside: list[str] = []
    zone = kept_zone = "open"

    def flush():
        for parts, of in ((inside, kept_zone), (aside, "apart")):
            if parts:
                text = " ".join(html_codes.unescape("".join(parts)).split())
                if text:
                    found.append((of, text))
                parts.clear()

    def add(text: str):
        nonlocal kept_zone
        if zone == "apart":
            aside.append(text)
        else:
            kept_zone = zone
            inside.append(text)

    def close(at: int):
        nonlocal zone
        del stack[at:]
        zone = stack[-1][1] if stack else "open"

    at = 0
    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if name in _BLOCK:
            flush()
        elif name in _SPACED:
            add(" ")
        if tag[1]:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if place is not None:
                close(place)
            continue
        if name in _RAW_END:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _VOID or tag[3].rstrip().endswith("/") and name not in _BLOCK:
            continue
        if name in ("p", "li"):
            # A new one closes the open one of the same container.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in _BLOCK and stack[k][0] != "p":
                    break
        elif name in _BLOCK and stack:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in _BLOCK:
                    break
        if name in _BLOCK:
            # HTML's own blocks end a drawing, except in its islands of HTML.
            open_ = [n for n, _ in stack]
            if "svg" in open_ and "foreignobject" not in open_:
                close(open_.index("svg"))
        new = zone
        if zone != "apart":
            held = zone in ("article", "main")
            if name in _APART or (name == "header" and not held):
                new = "apart"
            elif tag[3] and name not in _NEVER and _named_apart(tag[3], held):
                new = "apart"
            elif name == "article":
                new = "article"
            elif zone == "open" and (
                name == "main" or re.search(r"role=[\"']?main\b|articleBody", tag[3] or "")
            ):
                new = "main"
        stack.append((name, new))
        zone = new
    flush()
    return found


def parsed(page: str) -> tuple[str | None, list[str], list[int], list[str], str]:
    """The text if the markup settles it, else None and the blocks that may stay.

    Then where each of these begins in the stream of outside tokens, -1 where the
    markup alone keeps it; the blocks that repetition is looked for in; and all tokens.
    """
    found = blocks(page)
    zones = {z for z, _ in found}
    body = next((z for z in ("article", "main") if z in zones), "open")
    beside = "main" if "main" in zones else "open"
    kept, outside, place = [], [], 0
    for zone, text in found:
        apart = zone != "article" and (zone != "main" or "article" in zones)
        if zone in (body, beside):
            kept.append((text, -1 if zone == "article" else place))
        if apart:
            outside.append(text)
            place += len(text.split())
    tokens = " ".join(t for _, t in found)
    if not kept or body == "main" or all(at < 0 for _, at in kept):
        return "\n".join(t for t, _ in kept), [], [], outside, tokens
    return None, [t for t, _ in kept], [at for _, at in kept], outside, tokens


_PARSED = (
    "row string, page_id long, url string, host string, text string, open array<string>, "
    "begins array<int>, outside array<string>, outside_tokens long, print long, outside_print long"
)


def parse_pages(pages: DataFrame) -> DataFrame:
    """Written rows with each page's settled text or open blocks, and the blocks outside."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host.alias("host"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.monotonically_increasing_id().cast("string").alias("row"),
    )

    def parse(batches):
        for batch in chunks(batches, "html"):
            text, open_, begins, outside, sizes, prints, outside_prints = [], [], [], [], [], [], []
            for page in batch.column(3).to_pylist():
                settled, unsettled, at, apart, tokens = parsed(page)
                text.append(settled)
                open_.append(unsettled)
                begins.append(at)
                outside.append(apart)
                sizes.append(sum(len(b.split()) for b in apart))
                prints.append(xxhash.xxh3_64_intdigest(tokens) >> 1)
                outside_prints.append(xxhash.xxh3_64_intdigest(" ".join(apart)) >> 1)
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(4),
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(text, pa.string()),
                    pa.array(open_, lists),
                    pa.array(begins, pa.list_(pa.int32())),
                    pa.array(outside, lists),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.int64()),
                    pa.array(outside_prints, pa.int64()),
                ],
                names=[f.split()[0] for f in _PARSED.split(", ")],
            )

    return written(rows.mapInArrow(parse, _PARSED), "pages")


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``tokens`` sorted to ``depth`` tokens, and each place's rank.

    Prefix doubling: places ranked by their first k tokens are ranked by
    2 k through the ranks k further on. Equal ranks mean equal prefixes.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < depth:
        step = min(width, depth - width)
        ahead = np.full(n, -1, dtype=np.int64)
        ahead[: n - step] = rank[step:]
        order = np.lexsort((ahead, rank))
        change = (rank[order][1:] != rank[order][:-1]) | (ahead[order][1:] != ahead[order][:-1])
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(change)])
        rank, width = new, width + step
    return order, rank


def _token_stream(texts: list[str]) -> np.ndarray:
    words = " ".join(texts).split()
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def portion_runs(
    streams: list[np.ndarray], depth: int, weights: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``depth`` tokens in the pages, and on how many pages it stands.

    A stream stands for as many pages as its weight tells, or for one.
    """
    weights = np.array([w for s, w in zip(streams, weights or [1] * len(streams)) if len(s) >= depth], np.int64)
    streams = [s for s in streams if len(s) >= depth]
    if not streams:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(s) + 1 for s in streams])
    joined = np.concatenate([np.append(s, np.uint64(0)) for s in streams])
    _, tokens = np.unique(joined, return_inverse=True)
    ends = np.cumsum(sizes) - 1
    tokens = tokens.astype(np.int64)
    tokens[ends] = tokens.max() + 1 + np.arange(len(ends))  # a mark that no other page has
    order, rank = suffix_order(tokens, depth)
    page = np.repeat(np.arange(len(streams)), sizes)
    room = ends[page] - np.arange(len(tokens)) >= depth
    order = order[room[order]]
    seen = np.unique(np.stack([rank[order], page[order]], axis=1), axis=0)
    ranks, at = np.unique(seen[:, 0], return_index=True)
    pages = np.add.reduceat(weights[seen[:, 1]], at) if len(at) else np.zeros(0, np.int64)
    first = np.full(len(tokens), -1)
    first[rank[order[::-1]]] = order[::-1]
    return window_hashes(joined, depth)[first[ranks]], pages


def repeated_runs(rows: DataFrame, config: ExtractConfig) -> DataFrame:
    """``host, gram`` of the runs on ``config.pages`` or more distinct pages of a host."""
    apart = rows.filter(F.size("outside") > 0)
    weights = (
        apart.select("host", "outside_print", "print")
        .distinct()
        .groupBy("host", "outside_print")
        .agg(F.count("*").alias("weight"))
    )
    distinct = apart.select("host", "outside_print", "outside").dropDuplicates(["host", "outside_print"])
    portions = distinct.groupBy("host").agg(
        F.ceil(F.count("*") / config.portion_pages).alias("portions")
    )
    dealt = (
        distinct.join(weights, ["host", "outside_print"])
        .join(portions, "host")
        .select(
            "host", "outside", "weight", F.pmod("outside_print", "portions").alias("portion"), "portions"
        )
    )

    def runs(pdf):
        import pandas as pd

        streams = [_token_stream(list(t)) for t in pdf["outside"]]
        grams, pages = portion_runs(streams, config.run, pdf["weight"].tolist())
        if pdf["portions"].iloc[0] == 1:
            often = pages >= config.pages
            grams, pages = grams[often], pages[often]
        return pd.DataFrame({"host": pdf["host"].iloc[0], "gram": grams.view(np.int64), "pages": pages})

    return (
        dealt.groupBy("host", "portion")
        .applyInPandas(runs, "host string, gram long, pages long")
        .groupBy("host", "gram")
        .agg(F.sum("pages").alias("pages"))
        .filter(F.col("pages") >= config.pages)
        .select("host", "gram")
    )


def unique_text(open_blocks: list[str], begins: list[int], covered: set[int]) -> str:
    """The blocks that begin nowhere outside, and the others without their ``covered`` places."""
    kept = []
    for block, first in zip(open_blocks, begins):
        if first >= 0:
            block = " ".join(w for k, w in enumerate(block.split()) if first + k not in covered)
        if block:
            kept.append(block)
    return "\n".join(kept)


def main_text(pages: DataFrame, config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """``page_id, url, text, outside_tokens, boilerplate_tokens`` of every row of ``pages``.

    The last two tell how many tokens of the page stand outside its article,
    and how many of these repeated runs cover.
    """
    rows = parse_pages(pages)
    common = repeated_runs(rows, config)
    width = config.run

    def places(batches):
        for batch in batches:
            row, host, place, gram = [], [], [], []
            for r, h, outside in zip(*(batch.column(k).to_pylist() for k in range(3))):
                stream = _token_stream(outside)
                if len(stream) >= width:
                    found = window_hashes(stream, width)[: len(stream) - width + 1].view(np.int64)
                    row += [r] * len(found)
                    host += [h] * len(found)
                    place += range(len(found))
                    gram += found.tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(row, pa.string()),
                    "host": pa.array(host, pa.string()),
                    "place": pa.array(place, pa.int32()),
                    "gram": pa.array(gram, pa.int64()),
                }
            )

    covered = (
        rows.filter(F.size("outside") > 0)
        .select("row", "host", "outside")
        .mapInArrow(places, "row string, host string, place int, gram long")
        .join(common, ["host", "gram"])
        .groupBy("row")
        .agg(F.collect_list("place").alias("places"))
    )

    def keep(batches):
        for batch in batches:
            texts, outside_tokens, hidden_tokens = [], [], []
            for text, open_, begins, size, starts in zip(
                *(batch.column(k).to_pylist() for k in range(2, 7))
            ):
                hidden = {p + k for p in starts or () for k in range(width)}
                texts.append(unique_text(open_, begins, hidden) if text is None else text)
                outside_tokens.append(size)
                hidden_tokens.append(len(hidden))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(outside_tokens, pa.int64()),
                    pa.array(hidden_tokens, pa.int64()),
                ],
                names=["page_id", "url", "text", "outside_tokens", "boilerplate_tokens"],
            )

    return (
        rows.join(covered, "row", "left")
        .select("page_id", "url", "text", "open", "begins", "outside_tokens", "places")
        .mapInArrow(
            keep,
            "page_id long, url string, text string, outside_tokens long, boilerplate_tokens long",
        )
    )
