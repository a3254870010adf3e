"""Conversations repaired at least cost: cost DP over their turns, then prefix-doubling path ranking.

A repair is a string of edits (Keep, Rerole, Delete, Insert) that leads through the states of a grammar of roles.
Costs to the end are worked out from the last turn back; the arcs that keep to the least cost form a graph. Its
arcs are ranked by their first letter, then by their first 2, 4, 8 ... letters: the rank of twice the length is the
rank of the pair (own rank, rank of the best arc where the pointer leads), and pointers double along. At each node
the arc of least rank is on the least path; the letters of a path are read at all its places at once through the
doubled pointers. In the grammar no state lets more than one role be inserted, so arcs of a node differ in letter.

Rows are sorted once, by ranges of (conversation, turn). A conversation that lies within a task's range is repaired
there. Any other (one at the edge of a range, or longer than a block) is cut into blocks of at most 4096 turns: a
block's costs are a 4 x 4 matrix in min-plus algebra, products of these give the costs at the blocks' edges, each
block then ranks its paths from every state on its own, and the states are chained. Repeats are found by the first
place of each (conversation, role, text), an aggregate joined back by the unique place. So no task holds more than a
block of a long conversation; only the digest of its whole text, sequential by nature, is read as one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import small_batches
from hearthline.session import written

# The grammar (s?(ua)+)? of role initials, costs of edits, and characters.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state -> initial -> state; 0 begins, 0 and 3 end
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}  # what may be inserted or given to a turn
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_END = (".", "!", "?")

STATES = len(NEXT)
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS  # turns that are repaired together, at most
HELD_BYTES = 16 << 20  # text of one conversation that a task holds before it leaves it to the blocks
FLUSH_ROWS, FLUSH_BYTES = 20_000, 16 << 20
LETTERS = " DIKR"  # in order; a space ends a path
FAR = 1 << 40

OTHER, CUT, GONE = 3, 4, 8  # a turn's code: place of its initial in "sua" or OTHER, plus these


def _inserted(state: int) -> int:
    return next(t for i, t in NEXT[state].items() if i in ROLES)


def _tails() -> tuple[list[int], list[int]]:
    """For each state what it costs to end there, and how many inserts."""
    n = []
    for state in range(STATES):
        k = 0
        while state not in ENDS:
            state, k = _inserted(state), k + 1
        n.append(k)
    return [INSERT * k for k in n], n


END, TAIL = _tails()


def _row_arcs(code: int, state: int) -> list[tuple[int, int, int]]:
    """(letter, cost, state after) of the edits that use up a turn."""
    out = [(LETTERS.index("D"), DELETE, state)]
    if not code & GONE:
        extra, initial = TRUNCATED * bool(code & CUT), "sua "[code & OTHER]
        if initial in NEXT[state]:
            out.append((LETTERS.index("K"), extra, NEXT[state][initial]))
        out.append((LETTERS.index("R"), REROLE + extra, _inserted(state)))
    return out


class Steps:
    """One turn of the DP from the costs after it, worked out once for each code and differences of costs."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.arcs: list[np.ndarray] = []  # rows (state, letter, node relative to the turn's first); -1 fills up

    def back(self, code: int, after: tuple) -> tuple[tuple, int]:
        """(costs before the turn, which of ``arcs``)."""
        base = min(after)
        key = code, tuple([x - base for x in after])
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = self._work_out(*key)
        return tuple([x + base for x in found[0]]), found[1]

    def _work_out(self, code: int, after: tuple) -> tuple[tuple, int]:
        rows = [_row_arcs(code, s) for s in range(STATES)]
        cost = [min(c + after[t] for _, c, t in own) for own in rows]
        for _ in range(STATES):
            cost = [min(c, INSERT + cost[_inserted(s)]) for s, c in enumerate(cost)]
        best = [(s, letter, STATES + t) for s, own in enumerate(rows) for letter, c, t in own if c + after[t] == cost[s]]
        best += [(s, LETTERS.index("I"), _inserted(s)) for s in range(STATES) if INSERT + cost[_inserted(s)] == cost[s]]
        table = np.full((4 * STATES, 3), -1, np.int64)
        table[:len(best)] = best
        self.arcs.append(table)
        return tuple(cost), len(self.arcs) - 1


def least_paths(src: np.ndarray, letter: np.ndarray, dst: np.ndarray, nodes: int, starts: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, letters, ends): the least letter string from each start through the arcs of a graph without cycles.

    ``letters[first[k]:first[k + 1]]`` is that of start k, ``ends[k]`` the node without arcs where it ends.
    """
    last = np.ones(nodes, bool)
    last[src] = False
    src, letter, dst = (np.concatenate(p) for p in (
        (src, np.flatnonzero(last)), (letter, np.zeros(last.sum(), np.int64)), (dst, np.flatnonzero(last))))
    rank, at = letter, dst

    def best() -> np.ndarray:
        order = np.lexsort((rank, src))
        return order[np.searchsorted(src[order], np.arange(nodes))]
    while not last[at].all():  # ranks of twice the letters, from pairs of ranks
        onward = best()[at]
        _, rank = np.unique(rank * (len(src) + len(LETTERS)) + rank[onward], return_inverse=True)
        at = at[onward]
    own = best()
    jumps, length = [dst[own]], (~last).astype(np.int64)
    while not last[jumps[-1]].all():
        length = length + length[jumps[-1]]
        jumps.append(jumps[-1][jumps[-1]])
    first = np.concatenate([[0], np.cumsum(length[starts])])
    node = np.repeat(starts, length[starts])
    place = np.arange(len(node)) - np.repeat(first[:-1], length[starts])
    for k, jump in enumerate(jumps):
        node = np.where(place >> k & 1, jump[node], node)
    return first, letter[own][node], jumps[-1][starts]


def repair_paths(blocks: list[tuple[bytes, tuple]], steps: Steps, states: int = STATES) -> list[tuple[tuple, list[str], list[int]]]:
    """For each block (codes, costs after it): costs before it, and from each of the first ``states`` states the least
    of the cheapest edits within the block and the state after it."""
    if not blocks:
        return []
    which, offsets, before, total = [], [0], [], 0
    for codes, after in blocks:
        own = []
        for code in reversed(codes):
            after, arcs = steps.back(code, after)
            own.append(arcs)
        before.append(after)
        which += own[::-1] + [-1]
        total += STATES * (len(codes) + 1)
        offsets.append(total)
    which = np.array(which)
    level = np.flatnonzero(which >= 0)
    found = (np.stack(steps.arcs) if steps.arcs else np.zeros((0, 1, 3), np.int64))[which[level]]
    src, letter, dst = (found[:, :, k].ravel() for k in range(3))
    base, there = np.repeat(STATES * level, found.shape[1]), src >= 0
    starts = (np.array(offsets[:-1])[:, None] + np.arange(states)).ravel()
    first, letters, ends = least_paths((base + src)[there], letter[there], (base + dst)[there], total, starts)
    text = np.frombuffer(LETTERS.encode(), np.uint8)[letters].tobytes().decode()
    return [(before[k], [text[first[j]:first[j + 1]] for j in range(k * states, (k + 1) * states)],
             [int(ends[j]) % STATES for j in range(k * states, (k + 1) * states)]) for k in range(len(blocks))]


def block_matrix(codes: bytes) -> np.ndarray:
    """Least costs from each state before a block to each state after it: a min-plus product in pairs."""
    products = np.array([_MATRICES[c] for c in codes]).reshape(-1, STATES, STATES)
    while len(products) > 1:
        rest = products[len(products) - len(products) % 2:]
        a, b = products[:-1:2][:len(products) // 2], products[1::2]
        products = np.concatenate([(a[:, :, :, None] + b[:, None]).min(2), rest])
    return products[0] if len(products) else np.where(np.eye(STATES, dtype=bool), 0, FAR)


def _matrix(code: int) -> np.ndarray:
    inserts = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for s in range(STATES):
        t, cost = s, 0
        for _ in range(STATES):
            t, cost = _inserted(t), cost + INSERT
            inserts[s, t] = min(inserts[s, t], cost)
    row = np.full((STATES, STATES), FAR)
    for s in range(STATES):
        for _, cost, t in _row_arcs(code, s):
            row[s, t] = min(row[s, t], cost)
    return np.minimum((inserts[:, :, None] + row[None]).min(1), FAR)


_MATRICES = {code: _matrix(code) for code in range(16)}


def _edited(letters: str, state: int, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None, str]]:
    """(letter, role, text) of each edit; the role of a deleted turn is null."""
    for letter in letters:
        if letter == "I":
            state = _inserted(state)
            yield letter, ROLES["a" if state == 3 else "u"], ""
            continue
        role, text = next(turns)
        if letter == "D":
            yield letter, None, text
            continue
        if letter == "R":
            state = _inserted(state)
            role = ROLES["a" if state == 3 else "u"]
        else:
            state = NEXT[state][role[0]]
        yield letter, role, text


def _code(role: str, solid: str, gone: bool) -> int:
    initial = "sua".find(role[:1]) if role else -1
    return (OTHER if initial < 0 else initial) | (0 if not solid or solid[-1] in SENTENCE_END else CUT) | (GONE if gone else 0)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", audit: string, repaired_sha256: string>"
ROW = f"conv_id long, pos long, turn long, role string, text string, edit string, report {REPORT}"


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


class _Out:
    """Rows of ``ROW``, handed on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, **row) -> None:
        self.rows.append(row)
        self.size += len(row.get("text") or "")

    def full(self) -> bool:
        return len(self.rows) >= FLUSH_ROWS or self.size >= FLUSH_BYTES

    def take(self) -> pa.RecordBatch:
        rows, self.rows, self.size = self.rows, [], 0
        return pa.RecordBatch.from_pylist(rows, self.schema)


def _arrow_schema() -> pa.Schema:
    report = pa.struct([*((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                      ("text", pa.string()), ("edit", pa.string()), ("report", report)])


def _repair_whole(held: list[tuple], steps: Steps, out: _Out, rows: bool) -> None:
    """Conversations (conv_id, turns (pos, turn, role, text)) that a task has as a whole."""
    blocks, counts = [], []
    for _, turns in held:
        seen, codes, n = set(), bytearray(), dict.fromkeys(COUNTS, 0)
        for _, _, role, text in turns:
            solid = text.strip(SPACES)
            blank, repeat = not solid, (role, text) in seen
            seen.add((role, text))
            code = _code(role, solid, blank or repeat)
            if blank or repeat:
                n["blank" if blank else "duplicate"] += 1
                code &= ~CUT
            n["truncated"] += bool(code & CUT)
            codes.append(code)
        initials = [t[2][:1] for t in turns]
        n["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        n["gaps"] = _gaps([t[1] for t in turns])
        blocks.append((bytes(codes), tuple(END)))
        counts.append(n)
    for (conv, turns), n, (before, audits, ends) in zip(held, counts, repair_paths(blocks, steps, 1)):
        audit = audits[0] + "I" * TAIL[ends[0]]
        edits = list(_edited(audit, 0, ((r, t) for _, _, r, t in turns)))
        if rows:
            for k, (letter, role, text) in enumerate(edits):
                out.add(conv_id=conv, pos=k, role=role, text=text, edit=letter)
        else:
            whole = "\n".join(f"{role}:{text}" for _, role, text in edits if role is not None)
            out.add(conv_id=conv, report=n | {"cost": before[0], "audit": audit,
                                              "repaired_sha256": hashlib.sha256(whole.encode()).hexdigest()})


def _sorted_rows(turns: DataFrame) -> DataFrame:
    keys = ["conv_id", "turn", "input", "copy"]
    return turns.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("input", "copy")


def _repair_ranges(turns: DataFrame, rows: bool) -> DataFrame:
    """What the tasks of the sorted rows find: results of whole conversations, and the rows of all others with their place."""
    schema = _arrow_schema()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, out, place = Steps(), _Out(schema), TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # whole conversations
        n_held = size_held = size = 0
        conv, now, first, passing = None, None, True, True  # the present conversation; ``passing``: its rows go on as they are

        def pass_on(turn: tuple) -> None:
            out.add(conv_id=conv, pos=turn[0], turn=turn[1], role=turn[2], text=turn[3])
        for b in found:
            for key, turn, role, text in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                if now is None or key != conv:
                    if now is not None and not passing:
                        held.append((conv, now))
                        n_held, size_held = n_held + len(now), size_held + size
                    conv, passing, first, now, size = key, first, False, [], 0
                if passing:
                    pass_on((place, turn, role, text))
                elif text is not None:
                    now.append((place, turn, role, text))
                    size += len(text)
                    if len(now) > BLOCK or size > HELD_BYTES:
                        passing = True
                        for x in now:
                            pass_on(x)
                place += 1
                if n_held >= FLUSH_ROWS or size_held >= FLUSH_BYTES:
                    _repair_whole(held, steps, out, rows)
                    held, n_held, size_held = [], 0, 0
                if out.full():
                    yield out.take()
        if now is not None and not passing:  # the last one may go on in the next range
            for x in now or [(place, None, None, None)]:
                pass_on(x)
        _repair_whole(held, steps, out, rows)
        yield out.take()
    return written(turns.mapInArrow(batches, ROW), "repair-ranges")


_BLOCK_COLUMNS = ("blank long, duplicate long, truncated long, illegal long, begins string, ends string, "
                  "low long, high long, turns long")


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Rows of equal keys, which follow one another; each group is held whole."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and any(held[0][k] != row[k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, blk, codes, matrix and counts), written: one row for each block of at most 4096 turns."""
    solid = F.expr("trim(BOTH ' \\t\\n\\u000b\\f\\r' FROM text)")
    facts = rows.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), F.col("text").isNull().alias("dropped"),
                        (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(*SENTENCE_END)).alias("cut"))
    firsts = (rows.where("text IS NOT NULL").groupBy("conv_id", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
              .agg(F.min("pos").alias("first")).select("first"))
    facts = (facts.join(firsts, F.col("pos") == F.col("first"), "left").withColumn("blk", F.shiftright("pos", BLOCK_BITS))
             .withColumn("repeat", F.col("first").isNull()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("conv_id", "blk")):
            codes, initials, turns = bytearray(), [], []
            n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            for r in group:
                if r["dropped"]:
                    continue
                cut = r["cut"] and not r["blank"] and not r["repeat"]
                n["blank"] += r["blank"]
                n["duplicate"] += r["repeat"] and not r["blank"]
                n["truncated"] += cut
                codes.append(_code(r["initial"], "", r["blank"] or r["repeat"]) | (CUT if cut else 0))
                initials.append(r["initial"])
                turns += [] if r["turn"] is None else [r["turn"]]
            n["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            yield pa.RecordBatch.from_pylist([n | {
                "conv_id": group[0]["conv_id"], "blk": group[0]["blk"], "codes": bytes(codes),
                "matrix": block_matrix(codes).ravel().tolist(), "begins": initials[0] if initials else None,
                "ends": initials[-1] if initials else None, "low": min(turns, default=None), "high": max(turns, default=None),
                "turns": len(set(turns))}], pack_schema)
    names = [("conv_id", pa.int64()), ("blk", pa.int64()), ("codes", pa.binary()), ("matrix", pa.list_(pa.int64()))]
    pack_schema = pa.schema(names + [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in _BLOCK_COLUMNS.split(", ")])
    by = ["conv_id", "blk"]
    facts = facts.select("conv_id", "blk", "pos", "turn", "initial", "dropped", "blank", "cut", "repeat")
    return written(facts.repartition(*by).sortWithinPartitions(*by, "pos").mapInArrow(
        pack, "conv_id long, blk long, codes binary, matrix array<long>, " + _BLOCK_COLUMNS), "repair-blocks")


def _after(blocks: DataFrame) -> DataFrame:
    """(conv_id, blk, after): the costs at the end of each block, by one product a block from the last block back."""
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, costs, begun = None, None, False
        for b in found:
            after = []
            ids = b["conv_id"].to_pylist()
            for key, matrix in zip(ids, b["matrix"].to_pylist()):
                if not begun or key != conv:
                    conv, costs, begun = key, np.array(END), True
                after.append(costs.tolist())
                costs = (np.array(matrix).reshape(STATES, STATES) + costs).min(1)
            yield pa.RecordBatch.from_pydict({"key": b["conv_id"], "place": b["blk"], "after": pa.array(after, pa.list_(pa.int64()))})
    return (blocks.select("conv_id", "blk", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("blk"))
            .mapInArrow(batches, "key long, place long, after array<long>"))


def _edits(blocks: DataFrame) -> DataFrame:
    """Adds to each block its edits and the state after it, from each state before it, and the costs before it; written."""
    found = blocks.drop("matrix").join(_after(blocks), F.col("conv_id").eqNullSafe(F.col("key")) & (F.col("blk") == F.col("place")))
    found = found.drop("key", "place")
    kept = [c for c in found.columns if c not in ("codes", "after")]
    more = ", before array<long>, audits array<string>, states array<int>"

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for b in rows:
            for k in range(0, b.num_rows, 16):
                part = b.slice(k, 16)
                solved = repair_paths([(c, tuple(a)) for c, a in zip(part["codes"].to_pylist(), part["after"].to_pylist())], steps)
                yield pa.RecordBatch.from_pydict({c: part[c] for c in kept} | {
                    "before": pa.array([list(x[0]) for x in solved], pa.list_(pa.int64())),
                    "audits": pa.array([x[1] for x in solved], pa.list_(pa.string())),
                    "states": pa.array([x[2] for x in solved], pa.list_(pa.int32()))})
    schema = ", ".join(f"{c} {t}" for c, t in found.dtypes if c in kept)
    return written(found.mapInArrow(batches, schema + more), "repair-edits")


def _chained(edits: DataFrame) -> DataFrame:
    """(conv_id, blk, state, audit, report): each block's edits from the state that the block before it ends in.

    A conversation's last block has its report, but for the digest and the whole audit.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("blk", pa.int64()), ("state", pa.int32()), ("audit", pa.string()),
                        ("report", _arrow_schema().field("report").type)])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(last: bool) -> pa.RecordBatch:
            audit = held["audits"][state] + ("I" * TAIL[held["states"][state]] if last else "")
            report = n | {"gaps": high - low + 1 - turns if turns else 0} if last else None
            return pa.RecordBatch.from_pylist([{"conv_id": held["conv_id"], "blk": held["blk"], "state": state, "audit": audit,
                                                "report": report}], schema)
        held = None
        for b in found:
            for r in b.to_pylist():
                new = held is None or r["conv_id"] != held["conv_id"]
                if held is not None:
                    yield row(new)
                    state = 0 if new else held["states"][state]
                if new:
                    state, turns, low, high, ends = 0, 0, None, None, None
                    n = dict.fromkeys(COUNTS, 0) | {"cost": r["before"][0]}
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    n[c] += r[c]
                if r["begins"] is not None:
                    n["illegal"] += ends is not None and ends + r["begins"] not in LEGAL
                    ends = r["ends"]
                if r["turns"]:
                    turns += r["turns"] - (high is not None and high == r["low"])
                    low, high = r["low"] if low is None else low, r["high"]
                held = r
        if held is not None:
            yield row(True)
    return edits.repartition("conv_id").sortWithinPartitions("conv_id", "blk").mapInArrow(
        batches, f"conv_id long, blk long, state int, audit string, report {REPORT}")


def _repair_blocks(rows: DataFrame, whole_rows: bool) -> DataFrame:
    """The result for the conversations of ``rows``, block by block."""
    chained = written(_chained(_edits(_blocks(rows))), "repair-chain")
    both = (rows.where("text IS NOT NULL").select("conv_id", F.shiftright("pos", BLOCK_BITS).alias("blk"), "pos", "role", "text")
            .unionByName(chained, allowMissingColumns=True))
    schema = _arrow_schema()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's edits come before its rows."""
        out = _Out(schema)
        block, edits = None, iter(())
        turns: list = []
        audit, digest, begun = [], hashlib.sha256(), False

        def written_out() -> None:
            nonlocal begun, turns
            if block is None:
                return
            for k, (letter, role, text) in enumerate(_edited(block["audit"], block["state"], iter(turns))):
                if whole_rows:
                    out.add(conv_id=block["conv_id"], pos=(block["blk"] << BLOCK_BITS + 2) + k, role=role, text=text, edit=letter)
                elif role is not None:
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
            turns = []
        for b in found:
            for r in b.to_pylist():
                if r["pos"] is not None:
                    turns.append((r["role"], r["text"]))
                    continue
                written_out()
                if not whole_rows:
                    if block is not None and block["report"] is not None:
                        out.add(conv_id=block["conv_id"], report=block["report"] | {
                            "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
                        audit, digest, begun = [], hashlib.sha256(), False
                    audit.append(r["audit"])
                block = r
                if out.full():
                    yield out.take()
        written_out()
        if block is not None and not whole_rows:
            out.add(conv_id=block["conv_id"], report=block["report"] | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
        yield out.take()
    by = ["conv_id", "blk"] if whole_rows else ["conv_id"]
    return both.repartition(*by).sortWithinPartitions("conv_id", "blk", F.asc_nulls_first("pos")).mapInArrow(batches, ROW)


def _solved(turns: DataFrame, rows: bool) -> DataFrame:
    ranges = _repair_ranges(_sorted_rows(turns), rows)
    done = "edit IS NOT NULL" if rows else "report IS NOT NULL"
    return ranges.where(done).union(_repair_blocks(ranges.where("edit IS NULL AND report IS NULL"), rows))


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("input"))


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) for every edit of the cheapest repair of ``conversations`` (conv_id, turn, role, text).

    Turns are taken by turn, nulls first, those of one turn as they come in the input. Blank turns, and turns whose role
    and text came before in the conversation, are deleted; what is left must have role initials (s?(ua)+)?. A deleted
    turn has a null role; places order a conversation's edits. A null role or text is one space, a null conv_id is a
    conversation of its own. Other columns are ignored. An empty table has no edits.
    """
    small_batches(conversations.sparkSession)
    return (_solved(_turns(conversations).withColumn("copy", F.lit(1)), rows=True)
            .select("conv_id", F.col("pos").alias("place"), "edit", "role", "text"))


def report(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation.

    ``turns`` has conv_id, turn, role, text, input and copy (which order turns of one number); a null text is a turn
    that was dropped. Blank and repeated turns and those that do not end a sentence are counted by their first fault.
    A conversation with no turn has zeros, an empty audit and the digest of the empty string.
    """
    return _solved(turns, rows=False).select("conv_id", "report.*")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns for ``report``, damaged by crc32(conv_id:turn) % 20 with one space for a null: 0 drops a turn, 1 empties it,
    2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    fate = F.crc32(key.cast("binary")) % 20
    return (_turns(conversations).withColumn("fate", fate)
            .withColumn("text", F.expr("CASE fate WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END"))
            .withColumn("role", F.expr("IF(fate = 4, 'user', role)"))
            .withColumn("copy", F.expr("explode(sequence(1, IF(fate = 3, 2, 1)))")).drop("fate"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``report`` of ``conversations`` (conv_id, turn, role, text) after ``damaged``, one row for each conv_id, null included."""
    small_batches(conversations.sparkSession)
    return report(damaged(conversations))
