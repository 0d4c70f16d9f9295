"""Turn order of conversations repaired at least cost by a Viterbi search.

A conversation's rows are put in order and each gets its first fault: ``blank``
(no character but ASCII white space), ``duplicate`` (role and text seen
earlier), ``truncated`` (last character that is not white space is none of
``.!?``). The edits are Keep (0), Rerole to user or assistant (2), Delete (3;
the only choice for blank and duplicate rows) and Insert of an empty user or
assistant turn anywhere (2); a truncated row that stays costs 1 more. The
cheapest edits that give role initials ``(s?(ua)+)?`` win, and of equally cheap
ones those whose initials are least in ASCII order.

The search keeps one survivor for each of the four states of that pattern. Their
histories form a backpointer tree with reference counts: a branch goes when its
last survivor does, runs without a branch are one node, and edits that all
survivors share leave the tree at once. Equal costs are decided on the complete
unresolved histories; as those of one row never begin one another, their order
is known from the order one row earlier, so that a comparison takes constant time.

Two passes read the rows in order, neither holding a conversation: the first
sees only narrow facts and plans the edits, the second applies them to the
texts. A conversation is one sequence, and so is read by one task; that task
holds a row at a time, the plan, and the unresolved part of it.

Defined cases: a null role or text is one space; an empty role has no initial,
is legal nowhere and can't be kept. Rows of one turn are ordered by role, then by
SHA-256 of the text; null turns come first. Null ``conv_id``s form one
conversation. An empty table gives no rows. Columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import written

START, SYSTEM, USER, ASSISTANT = range(4)
#: The pattern's states: which initial leads where, and which turn is due next.
MOVES = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
DUE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Inserts that end the pattern from each state.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
REROLE, DELETE, INSERT, CUT_TURN = 2, 3, 2, 1
#: What state p needs at most, beyond state q, to follow any edits that q follows.
BEHIND = {
    START: {SYSTEM: 0, USER: 2, ASSISTANT: 0},
    SYSTEM: {START: 4, USER: 2, ASSISTANT: 4},
    USER: {START: 2, SYSTEM: 2, ASSISTANT: 2},
    ASSISTANT: {START: 3, SYSTEM: 0, USER: 2},
}
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
#: Output rows or bytes that a task gathers before it passes them on.
FLUSH_ROWS, FLUSH_BYTES = 2000, 4 << 20


def steps(initial: str, fault: int) -> list[tuple[int, int, int, bytes]]:
    """``(from, to, cost, letters)``: inserts before a row, then what becomes of it."""
    best: dict[tuple[int, int], tuple[int, bytes]] = {}

    def offer(a: int, b: int | None, cost: int, letters: bytes) -> None:
        if b is not None and (cost, letters) < best.get((a, b), (1 << 30, b"")):
            best[a, b] = (cost, letters)

    extra = CUT_TURN if fault == TRUNCATED else 0
    for state in range(4):
        at = state
        for n in range(3):
            ahead, spent = b"I" * n, INSERT * n
            offer(state, at, spent + DELETE, ahead + b"D")
            if fault <= TRUNCATED:
                offer(state, MOVES.get((at, initial)), spent + extra, ahead + b"K")
                offer(state, MOVES[at, DUE[at][0]], spent + REROLE + extra, ahead + b"R")
            at = MOVES[at, DUE[at][0]]
    return [(a, b, cost, letters) for (a, b), (cost, letters) in sorted(best.items())]


class _Node:
    """Edits between two branches; ``refs`` counts its branches and survivors."""

    __slots__ = ("parent", "letters", "kids", "refs")

    def __init__(self, parent: "_Node | None", letters: bytes):
        self.parent, self.letters, self.kids, self.refs = parent, bytearray(letters), [], 1
        if parent is not None:
            parent.kids.append(self)
            parent.refs += 1


class Repairer:
    """Plan of one conversation, fed row by row in order."""

    def __init__(self) -> None:
        self.root = _Node(None, b"")
        self.decided = bytearray()
        #: state -> (cost, place among the survivors' histories, node)
        self.survivors = {START: (0, 0, self.root)}
        self.known: dict[tuple[str, int], list] = {}

    def feed(self, initial: str, fault: int) -> None:
        """Take the next row."""
        if (initial, fault) not in self.known:
            self.known[initial, fault] = steps(initial, fault)
        best: dict[int, tuple] = {}
        for a, b, cost, letters in self.known[initial, fault]:
            if a in self.survivors:
                before, place, node = self.survivors[a]
                # Histories of one row differ before either ends: the earlier
                # order decides, and the step where both go on from the same one.
                offer = (before + cost, place, letters, node)
                if b not in best or offer[:3] < best[b][:3]:
                    best[b] = offer
        for q in [q for q in best if any(p != q and best[p][0] + BEHIND[p][q] < best[q][0] for p in best)]:
            del best[q]
        old = [x[2] for x in self.survivors.values()]
        ranked = sorted(best, key=lambda s: best[s][1:3])
        self.survivors = {
            s: (best[s][0], k, _Node(best[s][3], best[s][2])) for k, s in enumerate(ranked)
        }
        for node in old:
            self._release(node)
        self._resolve()

    def _release(self, node: _Node) -> None:
        """A survivor moved on from ``node``: drop what nothing needs, join what no longer branches."""
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            above = node.parent
            above.kids.remove(node)
            above.refs -= 1
            node = above
        if node.refs == 1 and len(node.kids) == 1 and node.parent is not None:
            below = node.kids[0]
            node.letters += below.letters
            below.letters = node.letters
            below.parent = node.parent
            node.parent.kids[node.parent.kids.index(node)] = below

    def _resolve(self) -> None:
        """Edits that all survivors share are final."""
        while self.root.refs == 1 and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.decided += self.root.letters
            self.root.letters, self.root.parent = bytearray(), None

    def unresolved(self) -> int:
        """Letters that the tree holds."""
        open_nodes, total = list(self.root.kids), 0
        while open_nodes:
            node = open_nodes.pop()
            total += len(node.letters)
            open_nodes += node.kids
        return total

    def finish(self) -> tuple[int, str]:
        """Cost and letters of the best plan."""
        cost, _, state = min(
            (cost + INSERT * CLOSING[s], place, s) for s, (cost, place, _) in self.survivors.items()
        )
        parts, node = [b"I" * CLOSING[state]], self.survivors[state][2]
        while node is not self.root:
            parts.append(bytes(node.letters))
            node = node.parent
        return cost, (bytes(self.decided) + b"".join(reversed(parts))).decode()


def in_order(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _flushed(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of ``(row, bytes)``, passed on in small portions."""
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n
        if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def told(rows: DataFrame) -> DataFrame:
    """Rows with nulls replaced, and the digest of the text that orders them within a turn."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def facts_of(rows: DataFrame) -> DataFrame:
    """Narrow facts of each row: fault by its own text, and whether an earlier turn says the same.

    Turns of equal role and text are found by digest, combined before the
    shuffle; only texts that occur again are joined back. Equal rows of the
    same turn stay neighbours in the order and are told apart there.
    """
    text = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    last = F.substring(text, -1, 1)
    mark = F.when(text == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    facts = told(rows).select("conv_id", "turn", "role", "digest", mark.cast("int").alias("mark"))
    again = (
        facts.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return facts.join(again, same, "left").select("conv_id", "turn", "role", "digest", "mark", later.alias("again"))


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations in each partition, in order."""
    order = [F.col("conv_id"), *first, F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def plans(rows: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Faults, cost and cheapest edits of each conversation.

    ``rows (conv_id, turn, role, text)``; ``expected (conv_id)`` names
    conversations that get a result even when they have no rows. Returns
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    """
    facts = facts_of(rows)
    if expected is not None:
        facts = facts.unionByName(expected.select("conv_id").distinct(), allowMissingColumns=True)
    names = "gaps blank duplicate truncated illegal cost".split()
    out = T.StructType(
        [facts.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("audit", T.StringType())]
    )
    schema = _arrow(out)

    def conversations(batches):
        here = planner = None
        known: dict = {}

        def result():
            cost, audit = planner.finish()
            gaps = 0 if low is None else high - low + 1 - distinct
            return (here, gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost, audit), len(audit) + 64

        for conv, turn, role, digest, mark, again in in_order(batches, ["conv_id", "turn", "role", "digest", "mark", "again"]):
            if planner is None or conv != here:
                if planner is not None:
                    yield result()
                here, planner = conv, Repairer()
                planner.known = known
                counts, illegal, low, high, distinct = [0] * 4, 0, None, None, 0
                previous, before = None, None
            if role is None:  # the conversation is named, but this is no row of it
                continue
            if turn is not None and turn != high:
                low, high, distinct = turn if low is None else low, turn, distinct + 1
            fault = mark
            if mark != BLANK and (again or (turn, role, digest) == previous):
                fault = DUPLICATE
            previous = (turn, role, digest)
            counts[fault] += 1
            initial = role[:1]
            if before is not None and before + initial not in ("su", "ua", "au"):
                illegal += 1
            before = initial
            # A few classes of rows: the steps are the same for all other initials.
            planner.feed(initial if initial in ("s", "u", "a") else "-", DUPLICATE if fault == BLANK else fault)
        if planner is not None:
            yield result()

    return _sorted(facts).mapInArrow(lambda batches: _flushed(conversations(batches), schema), out)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Turns after the edits: ``conv_id, place, role, text``, in order inside each partition.

    The plan of a conversation comes before its rows in the sort order, so the
    task reads it, then changes the rows as they pass. ``place`` counts from 1.
    """
    turns = told(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "digest")
    notes = planned.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text"))
    both = turns.unionByName(notes, allowMissingColumns=True)
    out = T.StructType(
        [
            both.schema["conv_id"],
            T.StructField("place", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    schema = _arrow(out)

    def edited(batches):
        audit, at, here, place, state = "", 0, None, 0, START

        def inserted():
            """Inserted turns up to the next letter of another kind."""
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                role = DUE[state]
                state = MOVES[state, role[0]]
                at, place = at + 1, place + 1
                yield (here, place, role, ""), 32

        for conv, kind, role, text in in_order(batches, ["conv_id", "kind", "role", "text"]):
            if kind == 0:
                yield from inserted()
                audit, at, here, place, state = text, 0, conv, 0, START
                continue
            yield from inserted()
            letter = audit[at]
            at += 1
            if letter == "D":
                continue
            role = DUE[state] if letter == "R" else role
            state = MOVES[state, role[0]]
            place += 1
            yield (here, place, role, text), len(text) + 32
        yield from inserted()

    return _sorted(both, "kind").mapInArrow(lambda batches: _flushed(edited(batches), schema), out)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines, from rows in the order of ``repaired``.

    SHA-256 takes its input in order, so a conversation's rows stream through one task.
    """
    out = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    schema = _arrow(out)

    def hashed(batches):
        here = state = None
        for conv, place, role, text in in_order(batches, ["conv_id", "place", "role", "text"]):
            line = f"{role}:{text}".encode()
            if place == 1:
                if state is not None:
                    yield (here, state.hexdigest()), 80
                here, state = conv, hashlib.sha256(line)
            else:
                state.update(b"\n")
                state.update(line)
        if state is not None:
            yield (here, state.hexdigest()), 80

    return turns.mapInArrow(lambda batches: _flushed(hashed(batches), schema), out)


def with_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans with the digest of each repaired conversation; that of an empty text where nothing is left."""
    planned = written(planned, "repair_plans")
    found = digests(repaired(rows, planned)).select(F.col("conv_id").alias("_c"), "repaired_sha256")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return planned.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select(
        *planned.columns, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a fixed share of faults, drawn from crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes the role user. Nulls in the key, the role and the text are one space.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    draw = F.crc32(key.cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(draw == 0, F.array().cast("array<int>")).when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")
