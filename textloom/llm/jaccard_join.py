"""N-gram Jaccard join by prefixes under several global token orders.

A document's tokens are its distinct shingles. Two documents alike by at
least t share a token among the first ``n - ceil(t n) + 1`` of each, in any
total order of all tokens. Several orders give several such conditions, and a
pair that fails one of them needs no comparison.

1. Shingles that many documents hold go to the end of the first order, so a
   passage common to unlike documents leads nowhere. Any set of tokens may go
   there; the set only has to be the same for all, so a bounded one is taken.
2. Equal token sets are one class. The classes' prefixes under the first
   order meet by token. Each token's classes are tied to one of them, the
   centre: as many candidates as classes, not as pairs. The first centres are
   the classes with most shared tokens, as the original of many copies is;
   further rounds take others by chance, for what is still apart.
3. The closer the sizes of two sets, the earlier must both have tokens in
   common: with o common tokens, l of them are among the first ``n - o + l`` of
   each. Candidates that have so many are tested under the other orders and then exactly. Components of the
   true links follow.
4. Only where such tokens join classes of different components may a link be
   missing. Those pairs are tested the same way. All pairs inside a component
   are left alone: they can't change the components.

No pair of different components that may be alike is left untested, so the
components are exact, up to clashes of 64-bit hashes.

Defined results: null or empty texts, or texts without words, have no tokens
and are linked with nothing; texts with fewer words than a shingle have one
token, the whole sequence; repeated rows and equal texts are one class; an
empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import chunks, mix64, ragged, texts_of, window_hashes, word_hashes, written
from textloom.llm.links import components
from textloom.session import broadcast_if_small


@dataclass(frozen=True)
class JaccardConfig:
    width: int = 5
    percent: int = 80
    orders: int = 3
    #: A token is common if this many documents hold it; counted per task from ``local`` on.
    common: int = 6
    local: int = 2
    most_common: int = 1_000_000
    #: Partners tested beside one copy of a centre's text.
    partners: int = 256
    #: Early tokens that two sets must share, as far as they overlap by as many.
    shared: int = 2
    #: Rounds in which each token's classes meet one centre only.
    turns: int = 1


_SEEDS = [0x51ED270B7F4A7C15, 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47, 0xD1342543DE82EF95]


def token_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, starts = word_hashes(texts)
    sizes = np.diff(starts)
    runs = window_hashes(hashes, width)
    places = np.where(sizes >= width, sizes - width + 1, 0)
    values = runs[ragged(starts[:-1], places)]
    ends = np.cumsum(places)
    sets = [np.unique(values[a:b]) for a, b in zip(ends - places, ends)]
    for k in np.flatnonzero((sizes > 0) & (sizes < width)):
        sets[k] = window_hashes(hashes[starts[k] : starts[k + 1]], int(sizes[k]))[:1]
    return sets


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(
    tokens: np.ndarray, seed: int, percent: int, common: np.ndarray | None = None, more: int = 0
) -> np.ndarray:
    """Keys of the first tokens in the order of ``seed``, common tokens last; ``more`` beyond need."""
    size = min(len(tokens), prefix_size(len(tokens), percent) + more)
    keys = mix64(tokens ^ np.uint64(seed))
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        late = common[at] == tokens
        rare = keys[~late]
        if len(rare) < size:
            return np.concatenate([np.sort(rare), np.sort(keys[late])[: size - len(rare)]])
        keys = rare
    return np.sort(np.partition(keys, size - 1)[:size] if size < len(keys) else keys)


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two token sets reaches ``percent``."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def common_tokens(docs: DataFrame, config: JaccardConfig) -> np.ndarray:
    """Tokens of many documents, at most ``most_common``; sorted.

    Counted in every task over all its documents; what a task sees seldom is
    not sent. This chooses an order and so the speed, never the result.
    """

    def count(batches):
        kept: list[np.ndarray] = []
        size = 0

        def counts():
            values, n = np.unique(np.concatenate(kept), return_counts=True)
            often = n >= config.local
            return pa.RecordBatch.from_pydict(
                {"token": values[often].view(np.int64), "n": n[often].astype(np.int64)}
            )

        for batch in chunks(batches, "text"):
            sets = token_sets(texts_of(batch), config.width)
            kept += sets
            size += sum(map(len, sets))
            if size > 8_000_000:
                yield counts()
                kept, size = [], 0
        if kept:
            yield counts()

    found = (
        docs.select("text")
        .mapInArrow(count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= config.common)
        .orderBy(F.desc("n"), "token")
        .limit(config.most_common)
        .select("token")
        .toArrow()
    )
    return np.sort(found["token"].to_numpy().view(np.uint64))


def profiles(docs: DataFrame, key: str, common: np.ndarray, buckets: int, config) -> DataFrame:
    """Written rows of two kinds: documents (``id, print, n, class``), packed prefixes by bucket."""
    spread = docs.sparkSession.sparkContext.broadcast(common)
    schema = "id long, print long, n long, class long, bucket int, tokens binary, classes binary, "
    schema += "places binary"
    names = ["id", "print", "n", "class", "bucket", "tokens", "classes", "places"]

    def pack(keys, owners, classes):
        places = np.concatenate([np.arange(len(k), dtype=np.int32) for k in keys])
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, owners, bucket = keys[order], np.array(classes, np.int64)[owners[order]], bucket[order]
        places = places[order]
        used, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(keys))
        none = pa.nulls(len(used), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                none,
                none,
                none,
                none,
                pa.array(used, pa.int32()),
                pa.array([keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                pa.array([owners[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                pa.array([places[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            ],
            names=names,
        )

    def profile(batches):
        late = spread.value
        keys, owners, classes, seen, size = [], [], [], set(), 0
        for batch in chunks(batches, "text"):
            sets = token_sets(texts_of(batch), config.width)
            marks = [xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            marks = np.array(marks, dtype=np.uint64).view(np.int64)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            none = pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n),
                    pa.array(marks, mask=n == 0),
                    pa.nulls(len(sets), pa.int32()),
                    none,
                    none,
                    none,
                ],
                names=names,
            )
            for tokens, mark in zip(sets, marks.tolist()):
                if len(tokens) and mark not in seen:
                    seen.add(mark)
                    keys.append(prefix(tokens, _SEEDS[0], config.percent, late, config.shared - 1))
                    owners.append(np.full(len(keys[-1]), len(classes)))
                    classes.append(mark)
                    size += len(keys[-1])
            if size > 2_000_000:
                yield pack(keys, owners, classes)
                keys, owners, classes, size = [], [], [], 0
        if keys:
            yield pack(keys, owners, classes)

    return written(_named(docs, key).mapInArrow(profile, schema), "profiles")


def _named(docs: DataFrame, key: str) -> DataFrame:
    """``id, text, print``: an id may repeat, with a print of the text it tells rows apart."""
    return docs.select(F.col(key).cast("long").alias("id"), "text", F.xxhash64("text").alias("print"))


def _read(pdf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, classes and the tokens' places in the classes' prefixes, of packed rows."""
    kinds = (("tokens", np.uint64), ("classes", np.int64), ("places", np.int32))
    return tuple(np.concatenate([np.frombuffer(b, kind) for b in pdf[name]]) for name, kind in kinds)


def _groups(tokens: np.ndarray, classes: np.ndarray, places: np.ndarray):
    """Distinct (token, class) rows of tokens with two classes or more, and group starts."""
    order = np.lexsort((classes, tokens))
    tokens, classes, places = tokens[order], classes[order], places[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])
    tokens, classes, places = tokens[new], classes[new], places[new]
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, int)
    sizes = np.diff(np.append(first, len(tokens)))
    shared = sizes > 1
    rows = ragged(first[shared], sizes[shared])
    sizes = sizes[shared]
    return tokens[rows], classes[rows], places[rows], np.cumsum(sizes) - sizes, sizes


def meetings(packed: DataFrame, buckets: int) -> DataFrame:
    """Written rows per bucket: its packed groups, and how many group tokens each class has."""

    def meet(pdf):
        import pandas as pd

        tokens, classes, places, _, _ = _groups(*_read(pdf))
        if not len(tokens):
            return pd.DataFrame({c: [] for c in ("bucket", "class", "shared", "tokens", "classes", "places")})
        members, shared = np.unique(classes, return_counts=True)
        n = len(members)
        return pd.DataFrame(
            {
                "bucket": [int(pdf["bucket"].iloc[0])] * (n + 1),
                "class": pd.array([*members.tolist(), None], dtype="Int64"),
                "shared": pd.array([*shared.tolist(), None], dtype="Int64"),
                "tokens": [None] * n + [tokens.tobytes()],
                "classes": [None] * n + [classes.tobytes()],
                "places": [None] * n + [places.tobytes()],
            }
        )

    return written(
        packed.repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInPandas(meet, "bucket int, class long, shared long, tokens binary, classes binary, places binary"),
        "meetings",
    )


def _early(left, right, at, place, n, config) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of one token count as early for two classes, and how many must be shared.

    Sets that overlap by o share l tokens among the first ``n - o + l`` of each.
    """
    x, y = n[at[left]], n[at[right]]
    overlap = -(-config.percent * (x + y) // (100 + config.percent))
    need = np.minimum(config.shared, overlap)
    early = (place[left] < x - overlap + need) & (place[right] < y - overlap + need)
    fits = overlap <= np.minimum(x, y)
    return early & fits, need


class _Pairs:
    """Distinct pairs of classes with the tokens they share and must share."""

    def __init__(self, base: int):
        self.base, self.held = base, 0
        self.codes, self.shared, self.need = [], [], []

    def add(self, left: np.ndarray, right: np.ndarray, need: np.ndarray):
        self.codes.append(np.minimum(left, right).astype(np.int64) * self.base + np.maximum(left, right))
        self.shared.append(np.ones(len(left), np.int64))
        self.need.append(need)
        self.held += len(left)
        if self.held > 4_000_000:
            self.merge()
            self.held = 0

    def merge(self):
        if self.codes:
            codes, first, own = np.unique(np.concatenate(self.codes), return_index=True, return_inverse=True)
            shared = np.bincount(own, weights=np.concatenate(self.shared), minlength=len(codes))
            need = np.concatenate(self.need)[first]
            self.codes, self.shared, self.need = [codes], [shared.astype(np.int64)], [need]

    def frame(self, names: np.ndarray):
        import pandas as pd

        self.merge()
        codes = self.codes[0] if self.codes else np.zeros(0, np.int64)
        left, right = names[codes // self.base], names[codes % self.base]
        none = np.zeros(0, np.int64)
        return pd.DataFrame(
            {
                "a": np.minimum(left, right),
                "b": np.maximum(left, right),
                "shared": self.shared[0] if self.codes else none,
                "need": self.need[0] if self.codes else none,
            }
        )


def _star_pairs(pairs: _Pairs, first, sizes, at, place, root, n, key, config):
    """In each group, one centre with all classes of other components.

    The centre has the greatest ``key``, equal keys going to the first.
    """
    group = np.repeat(np.arange(len(first)), sizes)
    order = np.lexsort((-np.arange(len(at)), key[at], group))
    centre = order[np.cumsum(sizes) - 1][group]
    other = np.flatnonzero(root[at[centre]] != root[at])
    centre = centre[other]
    early, need = _early(centre, other, at, place, n, config)
    pairs.add(at[centre[early]], at[other[early]], need[early])


def _all_pairs(pairs: _Pairs, first, sizes, at, place, root, n, config):
    """All pairs of classes of different components, for their early tokens."""
    for a, m in zip(first.tolist(), sizes.tolist()):
        # By size: partners of a class that fit are the next ones in the order.
        group = np.arange(a, a + m)
        group = group[np.argsort(n[at[group]], kind="stable")]
        own_n = n[at[group]]
        reach = np.searchsorted(own_n, 100 * own_n // config.percent, side="right")
        own = np.arange(m)
        many = np.maximum(reach - own - 1, 0)
        part = np.cumsum(many) // 1_000_000
        for k in range(int(part[-1]) + 1):
            of = part == k
            left = group[np.repeat(own[of], many[of])]
            right = group[ragged(own[of] + 1, many[of])]
            early, need = _early(left, right, at, place, n, config)
            keep = early & (root[at[left]] != root[at[right]])
            pairs.add(at[left[keep]], at[right[keep]], need[keep])


def candidates(
    met: DataFrame, roots: DataFrame | None, sizes: DataFrame, buckets: int, config, turn: int | None
) -> DataFrame:
    """Pairs ``a, b`` of classes of different components that share enough early tokens.

    With a ``turn``, only pairs of each token's centre with its other classes:
    first the class with most shared tokens, the one that copies have most in
    common with, then others by chance. Without, all pairs that fit in size.
    """
    members = met.filter("class is not null")
    central = members.groupBy("class").agg(F.sum("shared").alias("central"))
    inside = members.select("bucket", "class").join(sizes, "class").join(central, "class")
    if roots is None:
        inside = inside.withColumn("root", F.col("class"))
    else:
        inside = inside.join(roots.withColumnRenamed("node", "class"), "class", "left")
    inside = inside.select(
        F.col("bucket").alias("own_bucket"), "class", "n", F.coalesce("root", "class").alias("root"), "central"
    )

    def cross(key, groups, known):
        names = np.sort(known["class"].to_numpy())
        pairs = _Pairs(max(1, len(names)))
        if len(groups) and len(known):
            known = known.sort_values("class")
            n, root = known["n"].to_numpy(), known["root"].to_numpy()
            _, classes, place, first, sizes = _groups(*_read(groups))
            at = np.searchsorted(names, classes)
            mixed = np.maximum.reduceat(root[at], first) != np.minimum.reduceat(root[at], first)
            if mixed.any():
                rows = ragged(first[mixed], sizes[mixed])
                at, place = at[rows], place[rows]
                sizes = sizes[mixed]
                first = np.cumsum(sizes) - sizes
                if turn is None:
                    _all_pairs(pairs, first, sizes, at, place, root, n, config)
                else:
                    chance = (mix64(names.view(np.uint64) ^ np.uint64(turn)) >> np.uint64(1)).astype(np.int64)
                    key_of = known["central"].to_numpy() if turn == 0 else chance
                    _star_pairs(pairs, first, sizes, at, place, root, n, key_of, config)
        return pairs.frame(names)

    packed = met.filter("tokens is not null").select("bucket", "tokens", "classes", "places")
    return (
        packed.repartition(buckets, "bucket")
        .groupBy("bucket")
        .cogroup(inside.repartition(buckets, "own_bucket").groupBy("own_bucket"))
        .applyInPandas(cross, "a long, b long, shared long, need long")
        .groupBy("a", "b")
        .agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
        .filter("shared >= need")
        .select("a", "b")
    )


def true_links(pairs: DataFrame, texts: DataFrame, config: JaccardConfig) -> DataFrame:
    """Those of ``pairs (a, b)`` whose texts are alike; ``texts``: ``class, text``.

    A centre's partners come in portions, so no task gets more than a bounded
    number with one copy of the centre.
    """
    portions = pairs.groupBy("a").agg(F.ceil(F.count("*") / config.partners).alias("portions"))
    dealt = pairs.join(portions, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("portions")).alias("portion"), "b"
    )
    wanted = dealt.select("a", "portion", F.col("b").alias("class"), F.lit(1).alias("place")).union(
        dealt.select("a", "portion", F.col("a").alias("class"), F.lit(0).alias("place")).distinct()
    )
    rows = wanted.join(texts, "class")

    def test(batches):
        centre, tokens, fronts = None, None, None
        for batch in chunks(batches, "text"):
            a, portion, name = (batch.column(k).to_pylist() for k in range(3))
            place = batch.column(3).to_pylist()
            left, right = [], []
            for k, own in enumerate(token_sets(texts_of(batch), config.width)):
                if place[k] == 0:
                    centre, tokens = (a[k], portion[k]), own
                    fronts = [
                        np.sort(prefix(own, s, config.percent)) for s in _SEEDS[1 : config.orders]
                    ]
                    continue
                if centre != (a[k], portion[k]):
                    continue
                n, m = len(own), len(tokens)
                if 100 * min(n, m) < config.percent * max(n, m):
                    continue
                if all(
                    _meet(front, prefix(own, s, config.percent))
                    for front, s in zip(fronts, _SEEDS[1 : config.orders])
                ) and alike(tokens, own, config.percent):
                    left.append(a[k])
                    right.append(name[k])
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())}
            )

    return (
        rows.select("a", "portion", "class", "place", "text")
        .repartition("a", "portion")
        .sortWithinPartitions("a", "portion", "place")
        .mapInArrow(test, "a long, b long")
    )


def _meet(ordered: np.ndarray, keys: np.ndarray) -> bool:
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return bool((ordered[at] == keys).any())


def near_groups(docs: DataFrame, key: str = "doc_id", config=JaccardConfig()) -> DataFrame:
    """``key, n, class, root`` of every row: tokens, class and component.

    ``class`` and ``root`` are null for rows without tokens.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    common = common_tokens(docs, config)
    rows = profiles(docs, key, common, buckets, config)
    members = rows.filter("bucket is null").select("id", "print", "n", "class")
    classes = (
        members.filter("class is not null")
        .groupBy("class")
        .agg(F.min(F.struct("id", "print")).alias("first"), F.max("n").alias("n"))
        .select("class", "n", F.col("first.id").alias("_id"), F.col("first.print").alias("_print"))
    )
    met = meetings(rows.filter("bucket is not null").select("bucket", "tokens", "classes", "places"), buckets)
    sizes = classes.select("class", "n")
    repeats = _repeats(members)
    roots = links = tested = None
    for turn in [*range(config.turns), None]:
        pairs = candidates(met, roots, sizes, buckets, config, turn)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if roots is not None and pairs.isEmpty():
            continue
        texts = _class_texts(docs, key, classes, pairs, repeats)
        new = written(true_links(pairs, texts, config), "links")
        tested = pairs if tested is None else tested.union(pairs)
        links = new if links is None else links.union(new)
        if roots is None or not new.isEmpty():
            roots = components(links)
    return members.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        F.col("id").alias(key), "print", "n", "class", F.coalesce("root", "class").alias("root")
    )


def _class_texts(docs: DataFrame, key: str, classes: DataFrame, pairs: DataFrame, repeats: bool):
    """Written ``class, text`` of the classes in ``pairs``.

    Where those are proven few, they are sent to the documents; else both meet by id.
    """
    inside = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = written(classes.join(inside, "class").select("class", "_id", "_print"), "wanted")
    found = (
        _named(docs, key)
        .join(
            broadcast_if_small(wanted),
            F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")),
        )
        .select("class", "text")
    )
    if repeats:
        found = found.groupBy("class").agg(F.first("text").alias("text"))
    return written(found, "texts")


def _repeats(members: DataFrame) -> bool:
    return not members.groupBy("id", "print").count().filter("count > 1").isEmpty()


def component_ids(groups: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, n, component_id`` from ``near_groups``: the smallest id of each component."""
    smallest = groups.filter("root is not null").groupBy("root").agg(F.min(key).alias("least"))
    return groups.join(smallest, "root", "left").select(
        key, "n", F.when(F.col("root").isNull(), F.col(key)).otherwise(F.col("least")).alias("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", config=JaccardConfig()) -> DataFrame:
    """The rows of ``docs`` without all but the first of each component.

    First by id, then by a print of the text; rows alike in both are the same
    document, and one of them stays. Rows without tokens all stay.
    """
    groups = near_groups(docs, key, config).filter("root is not null")
    row = F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), "print")
    first = groups.groupBy("root").agg(F.min(row).alias("first"), F.count("*").alias("size"))
    others = (
        groups.join(first.filter("size > 1"), "root")
        .filter(~row.eqNullSafe(F.col("first")))
        .select(F.col(key).alias("__join_id"), F.col("print").alias("__join_print"))
        .distinct()
    )
    own = F.col(key).cast("long").eqNullSafe(F.col("__join_id")) & (
        F.xxhash64("text") == F.col("__join_print")
    )
    kept = docs.join(others, own, "left_anti")
    twice = (
        groups.groupBy(F.col(key).alias("__join_id"), F.col("print").alias("__join_print"))
        .count()
        .filter("count > 1")
        .drop("count")
    )
    if twice.isEmpty():
        return kept
    same = Window.partitionBy(key, F.xxhash64("text")).orderBy(F.lit(1))
    return (
        kept.join(twice, own, "left_anti")
        .unionByName(
            kept.join(twice, own, "left_semi")
            .withColumn("__join_row", F.row_number().over(same))
            .filter("__join_row = 1")
            .drop("__join_row")
        )
    )
