"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from meterlake.llm import repair
from meterlake.llm.common import table

SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SCHEMA = "conv_id long, turn long, role string, text string, conv string, position int, letter string, one int"


def cheapest(rows):
    """(cost, audit, repaired turns) of rows (role, text, fault)."""

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            cost, audit, turns = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, turns))
            if fault in ("", "truncated"):
                late = 3 if fault else 0
                if role[:1] in NEXT[state]:
                    cost, audit, turns = best(i + 1, role[:1], 0)
                    options.append((cost + late, "K" + audit, ((role, text), *turns)))
                for to in ("user", "assistant"):
                    if to[0] in NEXT[state]:
                        cost, audit, turns = best(i + 1, to[0], 0)
                        options.append((cost + late + 3, "R" + audit, ((to, text), *turns)))
        if inserted < 3:
            for to in ("user", "assistant"):
                if to[0] in NEXT[state]:
                    cost, audit, turns = best(i, to[0], inserted + 1)
                    options.append((cost + 3, "I" + audit, ((to, ""), *turns)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def audit(rows):
    groups = {conv: [] for conv, *_ in rows}
    for conv, *rest in damage(rows):
        groups[conv].append(tuple(rest))
    out = []
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faulty, count = set(), [], defaultdict(int)
        for _, role, text in mine:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            faulty.append((role, text, fault))
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, letters, repaired = cheapest(tuple(faulty))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def odd_rows():
    rng = random.Random(13)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "User", "tool", "agent", "ünder"]
    texts = ["Yes.", "No!", "Why?", "cut short", "", " \n", None, "end. \t", "a.\x85", "😀", "Hello there. And", "x" * 5000 + "."]
    rows = []
    for conv in [None, *range(-3, 120)]:
        for turn in range(rng.randrange(1, 14)):
            used = rng.choice([turn, turn, turn, turn + 5, None])
            rows.append((conv, used, rng.choice(roles[: rng.choice([3, 5, 11])]), rng.choice(texts)))
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "l", 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [repair.CHUNK, 3, 1])
def test_audit_equals_a_plain_search(spark, size):
    rows = odd_rows()
    assert rows_of(repair.audited(spark, frame_of(spark, rows), size)) == audit(rows)


@pytest.mark.parametrize("block", [1, 2, 5, 16])
def test_blocks_change_nothing(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(200):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), "", rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(12))]
        codes = "".join("!" if f == "blank" else ("?" if r == "x" else r[0].upper()) if f else ("." if r == "x" else r[0]) for r, _, f in rows)
        prices, ((edits, end),) = repair.solved(codes, repair.END_PRICES, (repair.NOTHING,))
        cost, audit_of, _ = cheapest(tuple(rows))
        assert (prices[0], "".join(letter for letter, _ in edits) + "I" * len(repair.ENDINGS[end])) == (cost, audit_of)


def test_tables(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.audited(spark, conversations)) == audit(rows)


def test_no_rows(spark):
    assert rows_of(repair.audited(spark, frame_of(spark, []).where("false"))) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert rows_of(repair.audited(spark, frame_of(spark, [(gone, 0, "user", "Hi.")]))) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_one_long_conversation(spark):
    """Cost and letters of a conversation over many chunks are those of the whole lattice."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["ok.", "cut", f"t{i}.", ""])) for i in range(250)]
    assert rows_of(repair.audited(spark, frame_of(spark, rows), 64)) == audit(rows)


def test_auction_prices_are_distances():
    rng = random.Random(1)
    for _ in range(300):
        codes = "".join(rng.choice("suaSUA!.?") for _ in range(rng.randrange(1, 9)))
        ends = tuple(rng.choice([None, *range(8)]) for _ in range(3)) + (rng.randrange(8),)
        prices = repair.auctioned(codes, ends)
        exact = [ends[s] for s in range(4)]
        for row in range(len(codes) - 1, -1, -1):
            ahead, exact = exact, [None] * 4
            for _ in range(4):
                for s in range(4):
                    ways = []
                    for _, cost, to in repair.arcs(codes, row, s):
                        beyond = (ahead if to // 4 == row + 1 else exact)[to % 4]
                        if beyond is not None:
                            ways.append(cost + beyond)
                    exact[s] = min(ways, default=None)
        assert list(prices[:4]) == exact


def test_repaired_dialogues_keep_the_pattern(spark):
    rows = odd_rows()
    turns = repair.repaired(spark, repair.damaged(frame_of(spark, rows)))
    assert turns.columns == ["conv_id", "place", "role", "text", "inserted"]
    spoken = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("t")).collect()
    digests = {r[0]: r[-1] for r in audit(rows)}
    for r in spoken:
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in r["t"]))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in r["t"]).encode()).hexdigest() == digests[r["conv_id"]]
