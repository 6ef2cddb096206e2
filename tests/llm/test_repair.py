"""The repair of conversations against a search over all edits, and its rows against its hashes."""

import hashlib
import heapq
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from modelspend.llm import op12_turn_repair as O12

WHITE = " \t\n\v\f\r"
WHOLE = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Rows per conversation after damage, by turn."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        here = out[conv]
        spelled = ":".join(" " if v is None else str(v) for v in (conv, turn))
        draw = zlib.crc32(spelled.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        here.extend([(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1))
    for here in out.values():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kind = ""
        if not text.strip(WHITE):
            kind = "B"
        elif (role, text) in seen:
            kind = "R"
        elif text.rstrip(WHITE)[-1] not in ".!?":
            kind = "T"
        seen.add((role, text))
        out.append(kind)
    return out


def cheapest(rows, kinds):
    """Cheapest edits by uniform-cost search over whole strings: (cost, letters, roles and texts)."""
    best = None
    heap = [(0, "", 0, ())]
    seen = set()
    while heap:
        cost, letters, at, kept = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        initials = "".join(r[:1] for r, _ in kept)
        state = (cost, letters, at, initials)
        if state in seen:
            continue
        seen.add(state)
        if at == len(rows) and WHOLE.fullmatch(initials):
            if best is None or (cost, letters) < best[:2]:
                best = (cost, letters, kept)
        # only beginnings of legal sequences
        if not re.fullmatch(r"(s?(ua)*u?)", initials):
            continue
        if len(letters) - at < 4:
            for role in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, letters + "I", at, (*kept, (role, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, kept))
            if kinds[at] not in ("B", "R"):
                more = kinds[at] == "T"
                if role:
                    heapq.heappush(heap, (cost + more, letters + "K", at + 1, (*kept, (role, text))))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + more, letters + "R", at + 1, (*kept, (other, text))))
    return best


def expected(rows):
    out = {}
    for conv, here in damaged(rows).items():
        kinds = faults(here)
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(here))
        cost, audit, kept = cheapest(here, kinds)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out[conv] = (gaps, *(kinds.count(k) for k in "BRT"), illegal, cost, audit, digest), kept
    return out


def odd_rows():
    rng = np.random.default_rng(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usr"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why?", "é. ", "Long " * 3000 + "end.", "Yes."]
    rows = []
    for conv in range(150):
        for turn in range(int(rng.integers(1, 7))):
            number = None if rng.random() < 0.05 else int(turn + rng.integers(0, 2))
            rows.append((conv, number, roles[rng.integers(0, len(roles))], texts[rng.integers(0, len(texts))]))
    rows += [(None, 0, "user", "Null id."), (None, None, None, None)]
    rows += [rows[0], rows[1]]
    return rows


def check(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS seen", "2 AS conv")
    marked = O12.damage(frame)
    plans = O12.plan_repairs(marked)
    want = expected(rows)
    got = {r.conv_id: tuple(r)[1:] for r in plans.collect()}
    assert got == {conv: values for conv, (values, _) in want.items()}
    turns = defaultdict(list)
    for r in O12.repaired_turns(marked, plans).collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    for conv, (_, kept) in want.items():
        assert [t[1:] for t in sorted(turns[conv])] == list(kept)
        assert [t[0] for t in sorted(turns[conv])] == list(range(len(kept)))


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_given_conversations(spark):
    table = pd.read_parquet("/root/testdata/sf0.01/conversations.parquet")
    check(spark, [tuple(None if pd.isna(v) else v for v in r) for r in table.astype(object).itertuples(index=False)])


def test_a_giant_conversation_spills_and_goes_across_batches(spark, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(30_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        (row,) = O12.plan_repairs(O12.damage(frame)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    here = damaged(rows)[1]
    kinds = faults(here)
    assert (row.blank, row.duplicate, row.truncated) == tuple(kinds.count(k) for k in "BRT")
    assert len(row.audit) - row.audit.count("I") == len(here)
    # in the process itself, with a scratch file from the first kilobyte on
    monkeypatch.setattr(O12, "SPILL", 1024)
    batch = pd.DataFrame(here, columns=["turn", "role", "text"]).assign(conv="1", has_turn=True, present=True, fault=kinds)
    parts = (batch.iloc[i : i + 777] for i in range(0, len(batch), 777))
    (result,) = [r for part in O12.plan_batches(parts) for r in part.itertuples(index=False)]
    assert (result.audit, result.cost, result.repaired_sha256) == (row.audit, row.cost, row.repaired_sha256)


def test_ids_of_other_types(spark):
    frame = spark.createDataFrame([("a", 1, "user", "Hello."), ("b", 2, "assistant", "Hi.")], "conv_id string, turn int, role string, text string")
    assert sorted(r.conv_id for r in O12.plan_repairs(O12.damage(frame)).collect()) == ["a", "b"]


@pytest.mark.parametrize("text", ["", " \t\n", None])
def test_only_blank_rows(spark, text):
    frame = spark.createDataFrame([(1, 5, "user", text)], "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "true AS present")
    frame = frame.fillna(" ", ["text"])
    (row,) = O12.plan_repairs(frame).collect()
    assert (row.blank, row.audit, row.cost, row.repaired_sha256) == (1, "D", 3, hashlib.sha256().hexdigest())
