"""Conversation repair against all plans kept as whole strings."""

import hashlib
import random

from pyspark.sql import functions as F

from textloom.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain_plan(rows):
    """(cost, audit, turns) of the best edits; every history is a whole string."""
    best = {"": (0, "", [])}  # role initials given so far, by their pattern state
    state = lambda s: "" if s == "" else s[-1]
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    for fault, role, text in rows:
        new = {}

        def offer(key, plan):
            if key not in new or plan[:2] < new[key][:2]:
                new[key] = plan

        for key, (cost, audit, turns) in best.items():
            ahead, at = [], key
            for n in range(4):
                c, a, t = cost + 2 * n, audit + "I" * n, turns + ahead
                offer(at, (c + 3, a + "D", t))
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    if role[:1] and role[0] in follow[at]:
                        offer(role[0], (c + extra, a + "K", t + [(role, text)]))
                    for other in ("user", "assistant"):
                        if other[0] in follow[at]:
                            offer(other[0], (c + 2 + extra, a + "R", t + [(other, text)]))
                due = "assistant" if at == "u" else "user"
                ahead, at = ahead + [(due, "")], due[0]
        best = new
    ends = []
    for key, (cost, audit, turns) in best.items():
        add = {"": [], "s": ["user", "assistant"], "u": ["assistant"], "a": []}[key]
        ends.append((cost + 2 * len(add), audit + "I" * len(add), turns + [(r, "") for r in add]))
    return min(ends, key=lambda e: e[:2])


def plain(rows):
    """Result of one conversation from its rows after damage, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit, turns = plain_plan([(f, r, t) for f, (_, r, t) in zip(faults, rows)])
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in turns)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, hashlib.sha256(text.encode()).hexdigest()), turns


def ordered(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
    return sorted(rows, key=key)


def test_random_conversations(spark):
    rng = random.Random(5)
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", " ", None, "usher"]
    texts = ["a.", "b", "c!", "", " \n", "d?\t", "é.", None, "x" * 50]
    rows = []
    for conv in [*range(400), None]:
        for _ in range(rng.randint(1, 14)):
            rows.append((conv, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)))
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.conv_id: tuple(r)[1:] for r in repair.with_digests(df, repair.plans(df)).collect()}
    turns = {}
    for r in repair.repaired(df, repair.plans(df)).orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv in [*range(400), None]:
        mine = ordered([(t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv])
        want, want_turns = plain(mine)
        assert found[conv] == want, (conv, mine)
        assert turns.get(conv, []) == want_turns


def test_long_unresolved_runs():
    """Ties over hundreds of rows, and the tree stays a few long edges."""
    rng = random.Random(1)
    for rows in (
        [("user", 0)] * 301,
        [("user", 0)] * 150 + [("assistant", 1)] * 151,
        [("-", 2)] * 200 + [("system", 0)] + [("user", 1), ("user", 0)] * 60,
        [(rng.choice(["user", "assistant", "system", "-"]), rng.randint(0, 2)) for _ in range(400)],
        [(rng.choice(["user", "user", "assistant"]), rng.choice([0, 0, 0, 1])) for _ in range(400)],
    ):
        planner = repair.Repairer()
        for role, fault in rows:
            planner.feed(role[0], fault)
        names = {0: "", 1: "truncated", 2: "blank"}
        cost, audit, _ = plain_plan([(names[f], r, "") for r, f in rows])
        assert planner.finish() == (cost, audit)


def test_decided_edits_leave_the_tree():
    planner = repair.Repairer()
    for k in range(5000):
        planner.feed("ua"[k % 2], repair.TRUNCATED if k % 7 == 0 else repair.FINE)
        assert planner.unresolved() <= 8
    assert len(planner.decided) >= 4990


def test_bounds_between_states():
    """BEHIND holds for random continuations: dropping a survivor by it loses nothing."""
    rng = random.Random(3)

    def cost_from(state, rows):
        best = {state: 0}
        for initial, fault in rows:
            new = {}
            for a, b, cost, _ in repair.steps(initial, fault):
                if a in best:
                    new[b] = min(new.get(b, 1 << 30), best[a] + cost)
            best = new
        return min(c + 2 * repair.CLOSING[s] for s, c in best.items())

    for _ in range(3000):
        rows = [(rng.choice("suua a-"), rng.randint(0, 2)) for _ in range(rng.randint(0, 7))]
        costs = [cost_from(s, rows) for s in range(4)]
        for p in range(4):
            for q, behind in repair.BEHIND[p].items():
                assert costs[p] <= costs[q] + behind, (p, q, rows)


def test_damage_and_edge_cases(spark):
    import zlib

    rows = [(c, t, "assistant", "Yes. No? Go!") for c in range(40) for t in range(10)] + [(None, None, None, None)]
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA).withColumn("draw", F.lit(1)).withColumn("digest", F.lit("x")))
    want = []
    for c, t, r, x in rows:
        r, x = r or " ", x or " "
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if n == 0:
            continue
        x = "" if n == 1 else x.translate(dict.fromkeys(map(ord, ".!?"))) if n == 2 else x
        want += [(c, t, "user" if n == 4 else r, x)] * (2 if n == 3 else 1)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.with_digests(empty, repair.plans(empty)).count() == 0
    named = spark.createDataFrame([(7,), (None,)], "conv_id long")
    for r in repair.with_digests(empty, repair.plans(empty, named)).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
