"""Conversation repair against a search over all edit sequences."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

from clickflow.llm import conversation_repair as repair
from tests.llm.cases import SF

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def _faults(rows):
    """Fault of each (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        if body:
            seen.add((role, text))
    return out


def _cheapest(rows):
    """(cost, audit, repaired lines): the least over every sequence of edits."""
    faults = _faults(rows)

    @lru_cache(None)
    def best(i, state, insertions):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if insertions < 3:
            role = NEXT[state]
            cost, audit, lines = best(i, role[0], insertions + 1)
            found.append((cost + 2, "I" + audit, (role + ":", *lines)))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, lines))
            if faults[i] in ("", "truncated"):
                extra = faults[i] != ""
                if role and state + role[0] in ("s", "u", "su", "ua", "au"):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    found.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                new = NEXT[state]
                cost, audit, lines = best(i + 1, new[0], 0)
                found.append((cost + 2 + extra, "R" + audit, (f"{new}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    for i in reversed(range(len(rows))):  # from the end, so that recursion stays flat
        for state in NEXT:
            best(i, state, 0)
    return best(0, "", 0)


def _expected(rows):
    """The report of one conversation's (turn, role, text) rows."""
    key = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
    pairs = [(r[1], r[2]) for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    faults = _faults(pairs)
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    cost, audit, lines = _cheapest(pairs)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum((a[0][:1], b[0][:1]) not in legal for a, b in zip(pairs, pairs[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        if fate == 0:
            continue
        if fate in (1, 2):
            text = "" if fate == 1 else re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def _reports(rows):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in columns) for r in rows}


def _check(spark, rows):
    schema = "conv_id long, turn long, role string, text string, key string, edits string, _run int, place long, state int"
    df = spark.createDataFrame([(*r, "x", "D", 1, 1, 1) for r in rows], schema).repartition(3)
    damaged = _damaged(rows)
    want = {c: _expected([r[1:] for r in damaged if r[0] == c]) for c in {r[0] for r in rows}}
    report = repair.repair_report(df, repair.damage(df)).collect()
    assert len(report) == len(want) and _reports(report) == want


def test_weights_decide_as_search_does():
    rng = random.Random(1)
    roles = ["system", "user", "assistant", "tool"]
    for _ in range(300):
        rows = [(rng.choice(roles), rng.choice(["", "a.", "b.", "c", f"{rng.random()}?"])) for _ in range(rng.randrange(7))]
        fault = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        symbols = "".join(
            chr(repair.BASE + 4 * roles.index(role) + fault[f]) for (role, _), f in zip(rows, _faults(rows))
        )
        want = _cheapest(rows)[:2]
        assert repair.repair(symbols) == want == repair.repair(symbols, 1) == repair.repair(symbols, 3)


def test_blocks_do_not_change_long_repairs():
    rng = random.Random(2)
    for _ in range(50):
        symbols = "".join(chr(repair.BASE + rng.randrange(16)) for _ in range(rng.randrange(400)))
        assert repair.repair(symbols, 10_000) == repair.repair(symbols, 5) == repair.repair(symbols)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    _check(spark, rows)


def test_odd_conversations(spark):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool", None, "", "Über"]
    texts = ["Yes.", "No!", "", " \n", None, "cut off", "Why?  ", "x" * 300_000 + ".", "naïve …"]
    rows = [
        (rng.choice([*range(30), None]), rng.choice([None, *range(-2, 9)]), rng.choice(roles), rng.choice(texts))
        for _ in range(260)
    ]
    rows += rows[:40] + [(50, None, "user", "only nulls.")] * 5 + [(51, 3, None, None)]
    _check(spark, rows)


def test_hot_conversation_is_cut(spark):
    rng = random.Random(4)
    rows = [(1, t, "user" if t % 2 else "assistant", rng.choice(["Yes.", f"n{t}.", "cut", f"m{t}?"])) for t in range(700)]
    rows += [(1, 350, "user", f"tie {i}.") for i in range(300)] + [(c, 0, "user", "Hi.") for c in range(2, 150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    decided, cuts = repair.decide(df)
    assert cuts is not None and len(decided.where("conv_id = 1").first().pieces) > 1
    want = {c: _expected([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert _reports(repair.repair_report(df, df).collect()) == want
    out = repair.repaired_rows(df, decided, cuts).where("conv_id = 1").orderBy("_run", "place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in out))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_report(df, repair.damage(df)).count() == 0
    one = spark.createDataFrame([(7, 0, "user", "Hi.")], df.schema)
    r = repair.repair_report(one, one.where("false")).first()
    assert (r.conv_id, r.cost, r.audit, r.repaired_sha256) == (7, 0, "", hashlib.sha256(b"").hexdigest())
