import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from hearthline.llm import conversation_repair as cr

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, repaired) by a search over whole edit strings, least (cost, audit) first."""
    seen, faults = set(), []
    for _, role, text in turns:
        solid = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], {}
    best = None
    while queue:
        cost, audit, i, initials, lines = heapq.heappop(queue)
        if best is not None and cost > best[0]:
            break
        if i == len(turns) and GRAMMAR.match(initials):
            if best is None or audit < best[1]:
                best = (cost, audit, lines)
            continue
        state = (i, initials[-1:] if initials != "" else "")
        if done.setdefault(state, cost) < cost:
            continue
        fits = lambda c: c == "u" and initials[-1:] in ("", "s", "a") or c == "a" and initials[-1:] == "u" or c == "s" and not initials
        for c, role in (("u", "user"), ("a", "assistant")):
            if fits(c):
                heapq.heappush(queue, (cost + 3, audit + "I", i, initials + c, (*lines, f"{role}:")))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, initials, lines))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                if role and fits(role[0]):
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, initials + role[0], (*lines, f"{role}:{text}")))
                for c, other in (("u", "user"), ("a", "assistant")):
                    if fits(c):
                        heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, initials + c, (*lines, f"{other}:{text}")))
    return best, faults


def brute(rows, hurt=True):
    out, after = {}, damage(rows) if hurt else [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        turns = [(t, r, x) for c, t, r, x in after if c == conv]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        (cost, audit, lines), faults = cheapest(turns)
        known = {t[0] for t in turns if t[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(turns)]
        out[conv] = (max(known) - min(known) + 1 - len(known) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(seed=4, convs=60, longest=7):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, 2 * turn, None]), role,
                         rng.choice(["Yes.", "No!", "Well then?", "cut off", "", None, " \n", f"Turn {turn}. ", "é ü\x0b"])))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS pos", "2 AS blk", "'x' AS copy").coalesce(1)


@pytest.mark.parametrize("bits", [12, 1])
def test_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(cr, "BLOCK_BITS", bits)  # 1: every conversation of three turns or more is cut into blocks
    monkeypatch.setattr(cr, "BLOCK", 1 << bits)
    rows = rows_of()
    got = cr.repair_damaged(table(spark, rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == 61


def test_one_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_BITS", 6)
    monkeypatch.setattr(cr, "BLOCK", 64)
    rng = random.Random(9)
    hot = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", f"Turn {t}.", f"and {t}", ""])) for t in range(3000)]
    rows = hot + [(1, 5000, "user", "Yes.")] * 400 + [(2, k, "user", f"{k}.") for k in range(5)]
    turns = table(spark, rows)
    got = {r.conv_id: r for r in cr.repair_damaged(turns).collect()}
    # the same kernel on the whole conversation in one piece
    monkeypatch.setattr(cr, "BLOCK_BITS", 20)
    monkeypatch.setattr(cr, "BLOCK", 1 << 20)
    whole = {r.conv_id: r for r in cr.repair_damaged(turns.union(table(spark, [(0, 0, "user", "a."), (3, 0, "user", "b.")])).coalesce(1)).collect()}
    assert {k: tuple(r) for k, r in got.items()} == {k: tuple(whole[k]) for k in got}


def test_repaired_rows(spark, monkeypatch):
    rows = [r for r in rows_of(5, 30) if r[1] is not None]
    want = brute(rows, hurt=False)
    for bits in (12, 1):
        monkeypatch.setattr(cr, "BLOCK_BITS", bits)
        monkeypatch.setattr(cr, "BLOCK", 1 << bits)
        found = {}
        for r in sorted(cr.repaired(table(spark, rows)).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place)):
            found.setdefault(r.conv_id, []).append(r)
        assert {c: "".join(r.edit for r in own) for c, own in found.items()} == {c: w[6] for c, w in want.items() if w[6]}
        for c, own in found.items():
            text = "\n".join(f"{r.role}:{r.text}" for r in own if r.role is not None)
            assert hashlib.sha256(text.encode()).hexdigest() == want[c][7]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_damaged(empty).collect() == [] and cr.repaired(empty).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert [tuple(r) for r in cr.repair_damaged(table(spark, [(5, gone, "user", "Dropped.")])).collect()] == [
        (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
