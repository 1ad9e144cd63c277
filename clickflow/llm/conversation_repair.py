"""Conversation structure repair by scalar big-integer weights.

A conversation is repaired by the cheapest sequence of edits after which its roles read
``(s?(ua)+)?``. The row-by-row choices form a DAG of (row, role state) nodes. A path's weight
is one integer: its high digits are the cost, its low digits the audit (one letter for each
edit) in fixed-width places from the left, with zeros after the end. The dynamic program runs from the last row to the
first, so that prefixing an edit shifts the low digits one place to the right and adds a
digit on top; the smallest integer is then the cheapest repair, and among those the one of
the ASCII-least audit. No tie-break exists besides integer order.

Long conversations are worked in blocks of ``BLOCK`` rows, so that integers stay short: time
is linear in the rows. Insertions stand only before a row or at the conversation's end, so
every audit of a block ends with a row's letter and none is a prefix of another; which of two
is less is decided inside the block, and of the blocks after it only the cost counts.

In Spark: rows shrink to one symbol (role initial and fault) and are read in conversation
order by tasks that keep nothing but the symbols; a conversation larger than a task's share is
cut into runs (``hot_cuts``). Decisions go back to the texts in one shuffle, as a stream of
edits ahead of each run's rows.

Defined results: null roles and texts are one space; a null ``conv_id`` is a conversation of
its own; rows are ordered by turn, nulls first, and rows of one turn by the MD5 of role and
text; repeated rows are duplicates of each other; very long texts pass whole (one at a time);
an empty table gives an empty result; extra columns are ignored, whatever their names. An
audit is one value of its row, so a conversation has at most about 2**30 rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.shared import small_batches, written
from clickflow.operators.ordered import RUN, hot_cuts, with_runs

DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
#: Rows of a conversation whose weights are one integer.
BLOCK = 256

# Role states: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled row leads to.
EXPECTED = (USER, USER, ASSISTANT, USER)
ROLE_NAME = {USER: "user", ASSISTANT: "assistant"}
# A symbol is chr(BASE + 4 * role + fault); the roles are s, u, a and any other.
BASE = ord("A")
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = ("blank", "duplicate", "truncated")
#: Digits of the audit letters, in ASCII order; zero is the end.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {d: c for c, d in DIGIT.items()}


def _kept_state(state: int, role: int) -> int | None:
    """The state after keeping a row of ``role`` (0 s, 1 u, 2 a, 3 other), if it may stand."""
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def _block(symbols: str, end_costs: list[int | None], last: bool) -> list[int | None]:
    """The least weight of the block's edits and all that follows from each state, as integers
    of ``_width`` low bits."""
    width = _width(len(symbols))
    mask, top = (1 << width) - 1, width - 3

    def put(letter: str, cost: int, weight: int | None) -> int | None:
        if weight is None:
            return None
        return ((weight >> width) + cost << width) | (DIGIT[letter] << top) | ((weight & mask) >> 3)

    def least(*weights: int | None) -> int | None:
        return min((w for w in weights if w is not None), default=None)

    def inserted(after: list[int | None]) -> list[int | None]:
        # One or two insertions reach every state; more cost more and come back.
        once = [put("I", INSERT_COST, after[EXPECTED[s]]) for s in range(4)]
        twice = [put("I", INSERT_COST, once[EXPECTED[s]]) for s in range(4)]
        return [least(*w) for w in zip(after, once, twice)]

    after = [None if c is None else c << width for c in end_costs]
    if last:
        after = inserted(after)
    for symbol in reversed(symbols):
        role, fault = divmod(ord(symbol) - BASE, 4)
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        here: list[int | None] = []
        for s in range(4):
            best = put("D", DELETE_COST, after[s])
            if fault not in (BLANK, DUPLICATE):
                to = _kept_state(s, role)
                kept = None if to is None else put("K", extra, after[to])
                best = least(best, kept, put("R", REROLE_COST + extra, after[EXPECTED[s]]))
            here.append(best)
        after = inserted(here)
    return after


def _width(rows: int) -> int:
    # At most two insertions before each row and at the end, and a letter for each row.
    return 3 * (3 * rows + 2)


def _letters(weight: int, width: int) -> str:
    low, out = weight & ((1 << width) - 1), []
    while low:
        out.append(LETTER[low >> (width - 3)])
        low = (low << 3) & ((1 << width) - 1)
    return "".join(out)


def _replay(state: int, letters: str, roles: list[int]) -> int:
    """The state after ``letters`` over rows of ``roles``."""
    row = 0
    for c in letters:
        if c in "IR":
            state = EXPECTED[state]
        elif c == "K":
            state = _kept_state(state, roles[row])
        row += c != "I"
    return state


def repair(symbols: str, block: int = BLOCK) -> tuple[int, str]:
    """The least cost and its ASCII-least audit for a conversation of ``symbols``."""
    if not symbols:
        return 0, ""
    starts = range(0, len(symbols), block)
    costs: list[int | None] = [0, None, None, 0]
    choices: list[list[str | None]] = []
    for at in reversed(starts):
        part = symbols[at : at + block]
        weights = _block(part, costs, last=at + block >= len(symbols))
        width = _width(len(part))
        costs = [None if w is None else w >> width for w in weights]
        choices.append([None if w is None else _letters(w, width) for w in weights])
    state, audit = START, []
    for at, choice in zip(starts, reversed(choices)):
        audit.append(choice[state])
        state = _replay(state, choice[state], [(ord(c) - BASE) // 4 for c in symbols[at : at + block]])
    return costs[START], "".join(audit)


@lru_cache(maxsize=1 << 16)
def short_repair(symbols: str) -> tuple[int, str]:
    """``repair``, remembered: most conversations are short and alike."""
    return repair(symbols)


def illegal_pairs(symbols: str) -> int:
    """Neighbours whose role initials are not su, ua or au."""
    roles = [(ord(c) - BASE) // 4 for c in symbols]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))


def _normal(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls, and ``key``, which names role and text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("key"),
    )


def _symbol_rows(rows: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """One row for each (conversation, turn, key) with its symbol's parts and its copies."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut_off = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, BLANK).when(cut_off, TRUNCATED).otherwise(FINE)
    seen = rows.select("conv_id", "turn", "key", role.alias("_role"), fault.alias("_fault"))
    seen = seen.groupBy("conv_id", "turn", "key").agg(
        F.first("_role").alias("_role"), F.first("_fault").alias("_fault"), F.count(F.lit(1)).alias("_copies")
    )
    seen = with_runs(seen, cuts, "conv_id", ["turn", "key"])
    # The first turn of a role and text that several turns hold.
    again = seen.where(F.col("_fault") != BLANK).groupBy("conv_id", "key").agg(
        F.min(F.struct("turn")).alias("_first"), F.count(F.lit(1)).alias("_turns")
    )
    again = again.where("_turns > 1").select(F.col("conv_id").alias("_c"), F.col("key").alias("_k"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k"))
    later = F.coalesce(F.struct("turn") > F.col("_first"), F.lit(False)) & (F.col("_fault") != BLANK)
    return seen.join(again, same, "left").select(
        "conv_id", RUN, "turn", "key", "_role", F.when(later, DUPLICATE).otherwise(F.col("_fault")).alias("_fault"), "_copies"
    )


def _runs_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, dict | None]]:
    """(key, row) of sorted batches, with (key, None) after the last row of each key."""
    current: tuple | None = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if current is not None and key != current:
                yield current, None
            current = key
            yield key, row
    if current is not None:
        yield current, None


def _symbols(kind: pa.DataType):
    schema = pa.schema([
        ("conv_id", kind), (RUN, pa.int32()), ("symbols", pa.string()),
        ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_turns", pa.int64()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        parts: list[str] = []
        first = last = None
        turns = held = 0
        for (conv, run), row in _runs_of(batches, ("conv_id", RUN)):
            if row is not None:
                role, fault, copies, turn = row["_role"], row["_fault"], row["_copies"], row["turn"]
                copy_fault = fault if fault == BLANK else DUPLICATE
                parts.append(chr(BASE + 4 * role + fault) + chr(BASE + 4 * role + copy_fault) * (copies - 1))
                if len(parts) == 4096:
                    parts = ["".join(parts)]
                if turn is not None and turn != last:
                    first, last, turns = turn if first is None else first, turn, turns + 1
                continue
            out.append({"conv_id": conv, RUN: run, "symbols": "".join(parts), "first_turn": first, "last_turn": last, "n_turns": turns})
            held += len(out[-1]["symbols"]) + 64
            parts, first, last, turns = [], None, None, 0
            if held > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    return task


def _decide(kind: pa.DataType):
    piece = pa.struct([(RUN, pa.int32()), ("state", pa.int32()), ("edits", pa.string())])
    schema = pa.schema([
        ("conv_id", kind), ("gaps", pa.int64()), *[(f, pa.int64()) for f in FAULTS], ("illegal", pa.int64()),
        ("cost", pa.int64()), ("audit", pa.string()), ("pieces", pa.list_(piece)),
    ])

    def one(row: dict) -> dict:
        runs = row["runs"]
        symbols = "".join(r["symbols"] for r in runs)
        cost, audit = short_repair(symbols) if len(symbols) <= 32 else repair(symbols)
        dated = [r for r in runs if r["n_turns"]]
        turns = sum(r["n_turns"] for r in dated)
        # A turn on both sides of a cut was counted twice.
        turns -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0
        counts = [sum(symbols.count(chr(BASE + 4 * r + f)) for r in range(4)) for f in (BLANK, DUPLICATE, TRUNCATED)]
        pieces, at, state = [], 0, START
        for r in runs:
            to, rows, letters = at, 0, len(r["symbols"])
            while rows < letters:
                rows += audit[to] != "I"
                to += 1
            if r is runs[-1]:
                to = len(audit)
            pieces.append({RUN: r[RUN], "state": state, "edits": audit[at:to]})
            state = _replay(state, audit[at:to], [(ord(c) - BASE) // 4 for c in r["symbols"]])
            at = to
        return {
            "conv_id": row["conv_id"], "gaps": gaps, **dict(zip(FAULTS, counts)), "illegal": illegal_pairs(symbols),
            "cost": cost, "audit": audit, "pieces": pieces,
        }

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield pa.RecordBatch.from_pylist([one(r) for r in batch.slice(at, 1000).to_pylist()], schema)

    return task


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv_id"].dataType)


def decide(conversations: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """What to do with each conversation of (conv_id, turn, role, text): its faults, ``cost``,
    ``audit`` and ``pieces`` (the audit by runs of the conversation), written to the shared
    folder; and the cuts of conversations larger than a task's share."""
    rows = _normal(conversations)
    kind, name = _arrow_type(rows), rows.schema["conv_id"].dataType.simpleString()
    cuts = hot_cuts(rows, "conv_id", ["turn", "key"])
    ordered = _symbol_rows(rows, cuts).repartition("conv_id", RUN).sortWithinPartitions("conv_id", RUN, "turn", "key")
    runs = ordered.mapInArrow(
        _symbols(kind), f"conv_id {name}, {RUN} int, symbols string, first_turn long, last_turn long, n_turns long"
    )
    run = F.struct(RUN, "symbols", "first_turn", "last_turn", "n_turns")
    if cuts is None:
        whole = runs.select("conv_id", F.array(run).alias("runs"))
    else:
        whole = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    decided = whole.mapInArrow(
        _decide(kind),
        f"conv_id {name}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        f"pieces array<struct<{RUN}: int, state: int, edits: string>>",
    )
    return written(decided, "repair"), cuts


def _apply(kind: pa.DataType):
    schema = pa.schema([
        ("conv_id", kind), (RUN, pa.int32()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
        ("role", pa.string()), ("text", pa.string()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = place = at = 0
        edits, state = "", START

        def put(key: tuple, edit: str, turn: int | None, role: str, text: str) -> None:
            nonlocal place, held
            out.append({"conv_id": key[0], RUN: key[1], "place": place, "edit": edit, "turn": turn, "role": role, "text": text})
            place, held = place + 1, held + len(text) + 64

        def insertions(key: tuple) -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                state, at = EXPECTED[state], at + 1
                put(key, "I", None, ROLE_NAME[state], "")

        for key, row in _runs_of(batches, ("conv_id", RUN)):
            if row is None:
                insertions(key)
                place = 0
            elif row["edits"] is not None:
                edits, state, at = row["edits"], row["state"], 0
            else:
                insertions(key)
                edit, at = edits[at], at + 1
                if edit == "K":
                    initial = "sua".find(row["role"][:1]) if row["role"] else 3
                    state = _kept_state(state, initial)
                    put(key, edit, row["turn"], row["role"], row["text"])
                elif edit == "R":
                    state = EXPECTED[state]
                    put(key, edit, row["turn"], ROLE_NAME[state], row["text"])
            if held > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    return task


def repaired_rows(conversations: DataFrame, decided: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """The rows of the repaired conversations: (conv_id, _run, place, edit, turn, role, text),
    in conversation order by (_run, place), nulls first. Inserted rows have no turn and an empty text."""
    rows = with_runs(_normal(conversations), cuts, "conv_id", ["turn", "key"]).withColumns(
        {"edits": F.lit(None).cast("string"), "state": F.lit(None).cast("int")}
    )
    heads = decided.select("conv_id", F.explode("pieces").alias("p")).select("conv_id", f"p.{RUN}", "p.edits", "p.state")
    both = rows.unionByName(heads, allowMissingColumns=True)
    # The edits of a run stand before its rows.
    both = both.repartition("conv_id", RUN).sortWithinPartitions("conv_id", RUN, F.col("edits").isNull(), "turn", "key")
    name = rows.schema["conv_id"].dataType.simpleString()
    return small_batches(both).mapInArrow(
        _apply(_arrow_type(rows)),
        f"conv_id {name}, {RUN} int, place long, edit string, turn long, role string, text string",
    )


def _digests(kind: pa.DataType):
    schema = pa.schema([("conv_id", kind), ("repaired_sha256", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        digest = None
        for (conv,), row in _runs_of(batches, ("conv_id",)):
            if row is None:
                out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest = None
            else:
                line = f"{row['role']}:{row['text']}".encode()
                if digest is None:
                    digest = hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
        yield pa.RecordBatch.from_pylist(out, schema)

    return task


def repaired_digests(repaired: DataFrame, whole: bool) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired_rows``, the rows as ``role:text`` lines. A hash of
    a whole conversation is taken line by line in one task, which holds one line. ``whole``: no
    conversation is cut, so each lies in one task in order already."""
    if not whole:
        repaired = repaired.repartition("conv_id").sortWithinPartitions("conv_id", RUN, "place")
    name = repaired.schema["conv_id"].dataType.simpleString()
    return repaired.select("conv_id", "role", "text").mapInArrow(
        _digests(_arrow_type(repaired)), f"conv_id {name}, repaired_sha256 string"
    )


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults dealt by a checksum of ``conv_id:turn``: of 20
    rows one is dropped, one emptied, one loses its sentence ends, one is repeated and one
    becomes the user's. Nulls read as one space."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    fate = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    hit = conversations.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        fate.alias("_fate"),
    )
    copies = F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hit.where("_fate <> 0").select("conv_id", "turn", "role", "text", copies.alias("_copy")).drop("_copy")


def repair_report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the faults of its ``damaged`` rows, the cost
    and audit of their repair and the digest of the repaired rows."""
    decided, cuts = decide(damaged)
    digests = repaired_digests(repaired_rows(damaged, decided, cuts), whole=cuts is None)
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    digests = digests.select(F.col("conv_id").alias("_d"), "repaired_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (
        ids.join(decided, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
        .join(digests, F.col("_id").eqNullSafe(F.col("_d")), "left")
        .select(
            F.col("_id").alias("conv_id"), *[zero(c) for c in ("gaps", *FAULTS, "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )
