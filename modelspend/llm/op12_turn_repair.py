"""Conversation structure repair: the cheapest edits that make a conversation alternate.

A repaired conversation is empty, or an optional system turn followed by pairs
of user and assistant turns.  Rows are kept (free), given another role (2) or deleted (3),
and empty turns are inserted (2); a truncated row that stays costs 1 more; blank
and repeated rows have to go.  Of equally cheap edits the one whose letters
(K, R, D, I) are ASCII-least is taken.

Rows are repartitioned by conversation and sorted by turn within the partition
(secondary sort), and one pass streams over them.  The dynamic program has four
states: nothing yet, after a system, a user, an assistant turn.  For each it carries
the cost, the running hash of the repaired text on its cheapest path, and the rank
of that path's letters among the four, from one Arrow batch to the next.  Equal
costs are settled by rank: paths over the same rows end with a letter that uses up a
row, so none is the beginning of another, and their order can't change later.  An
insertion belongs to the kept or reroled row after it, since D sorts before I.
What is stored per row is one byte for each state: where the path came from and how.
These back-pointers go to an unlinked scratch file of the task beyond
``SPILL`` bytes, as a sort's runs do, so a conversation of any length takes
constant memory apart from its audit string.  Repeated rows are found by a window over
(conversation, role, text), which needs no further shuffle and spills.

A conversation is a sequence, so one task streams through it whatever its share
of all rows; it is never collected.

Edge cases: null ids, turns, roles and texts count as one space when damage is
drawn, and null roles and texts are one space from then on; rows without a turn come
first; rows of one turn are ordered by role and text; a null conv_id is a
conversation of its own; an empty role can't be kept; a conversation without
rows after damage has zeros, an empty audit and the hash of nothing; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelspend.llm.shared import read_table

# ASCII white space and the ends of a complete text.
WHITE = " \t\n\v\f\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Bytes of back-pointers held in memory.
SPILL = 8 << 20
#: Finished conversations in one output batch.
OUT = 2000

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {"s": "system", "u": "user", "a": "assistant"}
#: What may stand after each state, and the state after it.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What an insertion adds after each state.
ADDED = ("u", "u", "a", "u")
LEGAL = frozenset(("su", "ua", "au"))
LETTERS = ("D", "K", "R", "IK", "IR")
FAR = 1 << 40

PLAN = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): rows damaged by their id's checksum.

    A dropped row stays with ``present`` false, so its conversation is not forgotten.
    """
    blank = F.lit(" ")
    spelled = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (draw != 0).alias("present"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def fault(text: Column, seen: Column) -> Column:
    """The first fault of a row: B(lank), R(epeated), T(runcated) or none."""
    trimmed = F.rtrim(text, F.lit(WHITE))
    return F.when(trimmed == "", "B").when(seen, "R").when(~F.right(trimmed, F.lit(1)).isin(*ENDS), "T").otherwise("")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """The rows of each conversation in one partition, in order, with their faults."""
    turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(turn)
    marked = (
        rows.select("conv_id", "turn", "role", "text", "present")
        .repartition("conv_id")
        .withColumn("seen", F.row_number().over(same) > 1)
    )
    order = (F.col("conv_id").asc_nulls_first(), turn, "role", "text", "seen")
    return marked.sortWithinPartitions(*order).select(
        F.col("conv_id").cast("string").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("has_turn"),
        "role",
        "text",
        "present",
        fault(F.col("text"), F.col("seen")).alias("fault"),
    )


# ---------------------------------------------------------------- in the tasks


def steps(costs: tuple, ranks: tuple, initial: str, fault: str) -> tuple:
    """For each state, the way to it over one row: (cost, from, letters, state), or None."""
    best: list = [None] * 4

    def offer(to: int, cost: int, came: int, how: int) -> None:
        new = (cost, ranks[came], LETTERS[how], came, how)
        if best[to] is None or new < best[to]:
            best[to] = new

    for state in range(4):
        if costs[state] >= FAR:
            continue
        offer(state, costs[state] + DELETE, state, 0)
        if fault in ("B", "R"):
            continue
        stays = costs[state] + (TRUNCATED if fault == "T" else 0)
        after = NEXT[state][ADDED[state]]
        for at, paid, shift in ((state, 0, 0), (after, INSERT, 2)):
            if initial in NEXT[at]:
                offer(NEXT[at][initial], stays + paid, state, 1 + shift)
            for role in ("u", "a"):
                if role in NEXT[at]:
                    offer(NEXT[at][role], stays + paid + REROLE, state, 2 + shift)
    order = sorted((b[1], b[2], to) for to, b in enumerate(best) if b)
    new_ranks = [9] * 4
    for place, (_, _, to) in enumerate(order):
        new_ranks[to] = place
    low = min(b[0] for b in best if b)
    return (
        low,
        tuple(b[0] - low if b else FAR for b in best),
        tuple(new_ranks),
        tuple((b[3], b[4]) if b else None for b in best),
    )


class Conversation:
    """What is carried from row to row, and from batch to batch."""

    def __init__(self, conv: str | None, cache: dict):
        self.conv, self.cache = conv, cache
        self.base, self.costs, self.ranks = 0, (0, FAR, FAR, FAR), (0, 9, 9, 9)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.faults = {"B": 0, "R": 0, "T": 0}
        self.rows = self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.pointers = tempfile.SpooledTemporaryFile(SPILL)

    def add(self, turn: int, has_turn: bool, role: str, text: str, fault: str) -> None:
        if has_turn and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.rows and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.rows += 1
        if fault:
            self.faults[fault] += 1
        key = (self.costs, self.ranks, initial, fault)
        found = self.cache.get(key)
        if found is None:
            found = self.cache[key] = steps(*key)
        low, self.costs, self.ranks, ways = found
        self.base += low
        body, before = b":" + text.encode("utf-8", "surrogatepass"), self.hashes
        self.hashes = [self.hashed(before, way, to, role, body) for to, way in enumerate(ways)]
        self.pointers.write(bytes(255 if w is None else w[0] | w[1] << 2 for w in ways))

    @staticmethod
    def hashed(before: list, way: tuple | None, to: int, role: str, body: bytes):
        """The running hash of the repaired text on the way to a state."""
        if way is None:
            return None
        state, how = way
        new = before[state]
        if how == 0:
            return new.copy()
        new, empty = new.copy(), state == START
        if how > 2:
            new.update((b"" if empty else b"\n") + NAMES[ADDED[state]].encode() + b":")
            empty = False
        if how in (2, 4):
            role = NAMES["u" if to == USER else "a"]
        new.update((b"" if empty else b"\n") + role.encode("utf-8", "surrogatepass") + body)
        return new

    def finish(self) -> tuple:
        ends = [(c + INSERT * extra, self.ranks[s], "I" * extra, s) for s, c, extra in
                ((START, self.costs[START], 0), (ASSISTANT, self.costs[ASSISTANT], 0), (USER, self.costs[USER], 1), (SYSTEM, self.costs[SYSTEM], 2))
                if c < FAR]
        cost, _, added, state = min(ends)
        final = self.hashes[state]
        for role in (("user", "assistant") if added == "II" else ("assistant",) if added else ()):
            final.update((b"" if state == START else b"\n") + role.encode() + b":")
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        blank, repeated, cut = self.faults.values()
        audit = self.walk_back(state) + added
        return (self.conv, gaps, blank, repeated, cut, self.illegal, self.base + cost, audit, final.hexdigest())

    def walk_back(self, state: int) -> str:
        """The letters of the chosen path, read from the last back-pointer to the first."""
        out, chunk = [], 1 << 18
        end = 4 * self.rows
        while end:
            start = max(0, end - 4 * chunk)
            self.pointers.seek(start)
            block = self.pointers.read(end - start)
            letters = []
            for at in range(end - start - 4, -1, -4):
                way = block[at + state]
                letters.append(LETTERS[way >> 2])
                state = way & 3
            out.append("".join(reversed(letters)))
            end = start
        self.pointers.close()
        return "".join(reversed(out))


def plan_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from rows that come conversation by conversation, in order."""
    cache: dict = {}
    now: Conversation | None = None
    done: list[tuple] = []
    names = [c.split()[0] for c in PLAN.split(", ")]
    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv", "turn", "has_turn", "role", "text", "present", "fault")]
        for conv, turn, has_turn, role, text, present, fault in zip(*columns, strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.finish())
                now = Conversation(conv, cache)
            if present:
                now.add(turn, has_turn, role, text, fault)
        if len(cache) > 100_000:
            cache.clear()
        if len(done) >= OUT:
            yield pd.DataFrame(done, columns=names)
            done = []
    if now is not None:
        done.append(now.finish())
    yield pd.DataFrame(done, columns=names)


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, present): its faults, cheapest edits and repaired text's hash."""
    kind = rows.schema["conv_id"].dataType
    found = ordered_rows(rows).mapInPandas(plan_batches, PLAN)
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])


# ---------------------------------------------------------------- the repaired rows


def edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired turns; each conversation's audit comes before its rows."""
    conv, audit, at, number, state = None, "", 0, 0, START
    out: list[tuple] = []

    def put(role: str, text: str, to: int) -> None:
        nonlocal number, state
        out.append((conv, number, role, text))
        number, state = number + 1, to

    def insertions() -> None:
        nonlocal at
        while audit[at : at + 1] == "I":
            at += 1
            put(NAMES[ADDED[state]], "", NEXT[state][ADDED[state]])

    for batch in batches:
        columns = [batch[c].tolist() for c in ("conv", "role", "text", "audit")]
        for key, role, text, plan in zip(*columns, strict=True):
            if plan is not None:
                insertions()
                conv, audit, at, number, state = key, plan, 0, 0, START
                continue
            if audit[at] != "D":
                insertions()
            letter, at = audit[at], at + 1
            if letter == "K":
                put(role, text, NEXT[state][role[:1]])
            elif letter == "R":
                to = "a" if state == USER else "u"
                put(NAMES[to], text, NEXT[state][to])
            if len(out) >= OUT:
                yield pd.DataFrame(out, columns=["conv", "turn", "role", "text"])
                out = []
    insertions()
    yield pd.DataFrame(out, columns=["conv", "turn", "role", "text"])


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the repaired conversations, turns numbered from 0."""
    kind = rows.schema["conv_id"].dataType
    present = rows.filter("present").select("conv_id", "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    both = present.unionByName(plans.select("conv_id", "audit"), allowMissingColumns=True)
    order = (F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "text")
    parted = both.repartition("conv_id").sortWithinPartitions(*order)
    parted = parted.select(F.col("conv_id").cast("string").alias("conv"), "role", "text", "audit")
    found = parted.mapInPandas(edited, "conv string, turn bigint, role string, text string")
    return found.select(F.col("conv").cast(kind).alias("conv_id"), "turn", "role", "text")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text's hash of every damaged conversation."""
    return plan_repairs(damage(read_table(spark, sf_dir, "conversations")))
