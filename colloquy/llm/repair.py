"""Repair of broken turn sequences (operator 12).

1. Rows get a fault (blank, duplicate, truncated) and become one symbol each:
   must go, or the role's kind with or without a missing end. Duplicates
   across turns come from an aggregate per (conversation, role, text) that
   meets the rows by a skew-safe join; equal rows of one turn lie together.
2. The rows are range-partitioned by (conversation, turn, role, text hash), so
   a hot conversation spreads over many partitions, and checkpointed.
3. Blocks of symbols of many conversations are compressed together: Re-Pair
   replaces the most frequent pair of neighbours by a rule, again and again.
   Every rule has one transfer matrix over the four states of the role
   grammar in the (min, +) sense: entry (p, q) is the least cost of edits that
   lead from p to q, with the edits' letters as a rope. A rule's matrix is the
   product of its two parts' matrices, so it is worked out once, bottom-up,
   and serves every conversation of the batch.
4. A conversation that spans partitions is joined by numbers: the first pass
   gives cost and order of letters of its part in each partition (two rows a
   partition), from which the driver tells every part its first state and the
   cost of what follows. The second pass then works each part out alone.
   Whole conversations are finished there; of spanning ones the pieces go, in
   order, through one streaming digest (a hash is a sequential reduction).

Why letters decide greedily: from a given state the letters alone determine
the states, and every piece ends with the letter of a row, so of two best
pieces with other end states neither is a prefix of the other.

Defined results: a null conv_id is one conversation; null role and text are
one space; turns may repeat, have gaps or be null (first); rows of one turn
are ordered by role and hash of role and text; equal rows after the first are
duplicates; an empty role has no initial and must be changed or go; other
columns are ignored; a conversation without rows has zeros, an empty audit
and the hash of the empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import cut, slices, stored
from colloquy.operators.skew import lookup_join

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STATES = 4                   # nothing out, after s, after u, after a
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
CLOSING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))  # from each state to an accepted end
INSERTS = {(0, 0): 0, (0, 2): 1, (0, 3): 2, (1, 1): 0, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
BLOCK = 256                  # symbols of a sequence worked out as one
BATCH = 16_384               # symbols compressed together
MIN_PAIR = 3                 # a pair seen less often makes no rule
PIECE = 1 << 18              # characters of a piece of a spanning conversation
NEVER = 1 << 60

ENDS = "".join(chr(c) for c in (32, 9, 10, 11, 12, 13))
ORDER = ["conv_id", "turn", "role", "h1", "h2"]


# ------------------------------------------------------------ algebra
class Rope:
    """Text as a tree of its parts; joined when it is first read."""

    __slots__ = ("left", "right", "flat")

    def __init__(self, left=None, right=None, flat=None):
        self.left, self.right, self.flat = left, right, flat

    def text(self) -> str:
        if self.flat is None:
            parts, open_ = [], [self]
            while open_:
                node = open_.pop()
                if node.flat is not None:
                    parts.append(node.flat)
                else:
                    open_ += [node.right, node.left]
            self.flat, self.left, self.right = "".join(parts), None, None
        return self.flat


def terminal(symbol: str) -> list:
    """Transfer matrix of one row, insertions before it included. Symbols:
    x must go; s u a o the role's kind, in capitals when truncated."""
    out = [None] * (STATES * STATES)
    kind, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for (p, m), n in INSERTS.items():
        moves = [(m, DELETE, "D")]
        if symbol != "x":
            moves += [(STEP.get((m, kind)), KEEP + extra, "K")] + [(STEP.get((m, r)), REROLE + extra, "R") for r in "ua"]
        for q, cost, letter in moves:
            if q is not None:
                entry = (n * INSERT + cost, "I" * n + letter)
                old = out[p * STATES + q]
                if old is None or entry < (old[0], old[1].flat):
                    out[p * STATES + q] = (entry[0], Rope(flat=entry[1]))
    return out


def product(a: list, b: list) -> list:
    """Matrix of ``a`` followed by ``b``: least cost, then least letters."""
    out = [None] * (STATES * STATES)
    for p in range(STATES):
        for q in range(STATES):
            best, ties = NEVER, []
            for m in range(STATES):
                x, y = a[p * STATES + m], b[m * STATES + q]
                if x is not None and y is not None:
                    cost = x[0] + y[0]
                    if cost < best:
                        best, ties = cost, [(x[1], y[1])]
                    elif cost == best:
                        ties.append((x[1], y[1]))
            if ties:
                if len(ties) > 1:
                    ties.sort(key=lambda t: t[0].text() + t[1].text())
                out[p * STATES + q] = (best, Rope(*ties[0]))
    return out


def re_pair(sequences: list[str]) -> tuple[list[str], list[tuple[int, int]], list[list[int]]]:
    """(terminals, rules, sequences over both): rule k stands for symbol
    ``len(terminals) + k`` and is a pair of earlier symbols."""
    terminals = sorted(set("".join(sequences)))
    number = {c: i for i, c in enumerate(terminals)}
    flat: list[int] = []
    for s in sequences:
        flat += [number[c] for c in s]
        flat.append(-1)
    text, rules = np.array(flat, dtype=np.int64), []
    while len(text) > 1:
        width = len(terminals) + len(rules) + 1
        code = np.where((text[:-1] >= 0) & (text[1:] >= 0), text[:-1] * width + text[1:], -1)
        pairs, counts = np.unique(code[code >= 0], return_counts=True)
        if not len(pairs) or counts.max() < MIN_PAIR:
            break
        pair = int(pairs[counts.argmax()])
        at = np.flatnonzero(code == pair)
        a, b = divmod(pair, width)
        if a == b:  # of a run of equal symbols, every other place
            start = np.r_[True, np.diff(at) > 1]
            at = at[(at - np.maximum.accumulate(np.where(start, at, 0))) % 2 == 0]
        text[at] = width - 1
        text = np.delete(text, at + 1)
        rules.append((a, b))
    ends = np.flatnonzero(text < 0)
    return terminals, rules, [p[p >= 0].tolist() for p in np.split(text, ends)[:len(sequences)]]


class Matrices:
    """Transfer matrices of blocks, by way of one grammar a batch. Blocks met
    before are remembered, up to a bound on their number."""

    LIMIT = 20_000

    def __init__(self):
        self.known: dict[str, list] = {}

    def learn(self, blocks: list[str]) -> None:
        if len(self.known) > self.LIMIT:
            self.known = {}
        new = sorted({b for b in blocks if b not in self.known})
        if not new:
            return
        terminals, rules, compressed = re_pair(new)
        matrix = [terminal(c) for c in terminals]
        for a, b in rules:
            matrix.append(product(matrix[a], matrix[b]))
        for block, symbols in zip(new, compressed):
            total = matrix[symbols[0]]
            for k in symbols[1:]:
                total = product(total, matrix[k])
            self.known[block] = total


def cut_blocks(symbols: str) -> list[str]:
    return [symbols[k:k + BLOCK] for k in range(0, len(symbols), BLOCK)]


def costs_after(matrix: list, after: list[int]) -> list[int]:
    return [min([matrix[p * STATES + q][0] + after[q] for q in range(STATES) if matrix[p * STATES + q] is not None], default=NEVER)
            for p in range(STATES)]


def choose(matrix: list, state: int, after: list[int]) -> tuple[int, str]:
    """(state reached, letters) of the best way on from ``state``."""
    row = [(q, matrix[state * STATES + q]) for q in range(STATES)]
    best = min(e[0] + after[q] for q, e in row if e is not None)
    return min(((e[1].text(), q) for q, e in row if e is not None and e[0] + after[q] == best))[::-1]


def edits(blocks: list[str], known: dict[str, list], state: int, after: list[int]) -> tuple[list[str], int, list[int]]:
    """(letters of each block, state reached, cost from each state on) for a
    run of blocks entered in ``state`` when ``after`` is still to come."""
    ahead = [after]
    for b in reversed(blocks):
        ahead.append(costs_after(known[b], ahead[-1]))
    letters = []
    for b, follow in zip(blocks, ahead[-2::-1]):
        state, piece = choose(known[b], state, follow)
        letters.append(piece)
    return letters, state, ahead[-1]


# ------------------------------------------------------------ rows
def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows dropped (kept as ``gone``), emptied,
    without sentence ends, repeated or given to the user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                                F.concat(space("conv_id"), F.lit(":"), space("turn")).alias("_name"))
    d = F.crc32(F.col("_name").cast("binary")) % 20
    text = F.when(d == 1, "").when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (d == 0).alias("gone"), F.explode(F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
                       ).drop("_copy")


def symbols(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, gone) with hashes h1, h2 and ``mark``:
    fault (- gone, b blank, d duplicate, t truncated, k none) and role kind."""
    last = F.right(F.rtrim(F.col("text"), F.lit(ENDS)), F.lit(1))
    fault = F.when(F.col("gone"), "-").when(last == "", "b").when(~last.isin(".", "!", "?"), "t").otherwise("k")
    initial = F.substring("role", 1, 1)
    marked = rows.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"),
                         fault.alias("fault"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("kind"))
    keys = ["conv_id", "h1", "h2"]
    again = (marked.where(F.col("fault").isin("t", "k")).groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("_last"))
             .where(~F.col("first").eqNullSafe(F.col("_last"))).drop("_last"))
    met = lookup_join(marked, stored(again, "repeated-turns"), keys, "n", F.col("turn"))
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn")) & F.col("fault").isin("t", "k")
    return met.select("conv_id", "turn", "role", "text", "h1", "h2", F.concat(F.when(later, "d").otherwise(F.col("fault")), "kind").alias("mark"))


def _symbol(mark: str) -> str:
    return "x" if mark[0] in "bd" else mark[1].upper() if mark[0] == "t" else mark[1]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, marks, turns, slices) of each run of equal conv_id in
    sorted rows; marks without gone rows, equal rows of a turn as duplicates;
    slices hold (batch, places) for the rows that are left."""
    conv, marks, turns, held, before, begun = None, [], [], [], None, False
    for batch in batches:
        for part in slices(batch, 4096):
            ids, turn, role, h1, h2, mark = (part.column(part.schema.get_field_index(c)).to_pylist()
                                             for c in ("conv_id", "turn", "role", "h1", "h2", "mark"))
            places: list[int] = []
            for k in range(len(ids)):
                if not begun or ids[k] != conv:
                    if begun:
                        yield conv, marks, turns, [*held, (part, places)]
                    conv, marks, turns, held, places, before, begun = ids[k], [], [], [], [], None, True
                m = mark[k]
                if m[0] == "-":
                    continue
                key = (turn[k], role[k], h1[k], h2[k])
                if key == before and m[0] != "b":
                    m = "d" + m[1]
                before = key
                marks.append(m)
                turns.append(turn[k])
                places.append(k)
            held.append((part, places))
    if begun:
        yield conv, marks, turns, held


def _counts(marks: list[str], turns: list) -> list[int]:
    """blank, duplicate, truncated, illegal, and the turns' least, greatest
    and number of values (None, None, 0 without any)."""
    faults = [m[0] for m in marks]
    legal = {"su", "ua", "au"}
    told = [t for t in turns if t is not None]
    return [faults.count("b"), faults.count("d"), faults.count("t"), sum(a[1] + b[1] not in legal for a, b in zip(marks, marks[1:])),
            min(told, default=None), max(told, default=None), len(set(told))]


_EDGE = ("pid int, at string, conv_id {}, first_kind string, last_kind string, n long, costs array<long>, ranks array<int>, "
         "low long, high long, turns long")


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last part of a partition with their matrices as numbers:
    costs, and each entry's place among those of its first state by letters."""
    kinds = [pa.int32(), pa.string(), None, pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
             pa.int64(), pa.int64(), pa.int64()]
    names = ["pid", "at", "conv_id", "first_kind", "last_kind", "n", "costs", "ranks", "low", "high", "turns"]
    pid, first, last = None, None, None

    def kept():
        for batch in batches:
            nonlocal pid
            if batch.num_rows:
                pid = batch.column(batch.schema.get_field_index("_pid"))[0].as_py()
                kinds[2] = batch.schema.field("conv_id").type
                yield batch

    for conv, marks, turns, _ in _parts(kept()):
        part = conv, marks, turns
        first = part if first is None else first
        last = part
    if first is None:
        return
    out = []
    for at, (conv, marks, turns) in ([("only", first)] if first is last else [("first", first), ("last", last)]):
        costs = ranks = None
        if marks:
            blocks, memo = cut_blocks("".join(map(_symbol, marks))), Matrices()
            memo.learn(blocks)
            # letters are compared per first state, over whole parts
            costs, ranks = [], []
            for p in range(STATES):
                ways = []
                for q in range(STATES):
                    goal = [0 if k == q else NEVER for k in range(STATES)]
                    total = goal
                    for b in reversed(blocks):
                        total = [min(c, NEVER) for c in costs_after(memo.known[b], total)]
                    ways.append((total[p], "".join(edits(blocks, memo.known, p, goal)[0]) if total[p] < NEVER else "~", q))
                costs += [w[0] for w in ways]
                place = {q: r for r, (_, q) in enumerate(sorted((w[1], w[2]) for w in ways))}
                ranks += [place[q] for q in range(STATES)]
        tally = _counts(marks, turns)
        out.append((pid, at, conv, marks[0][1] if marks else None, marks[-1][1] if marks else None, len(marks), costs, ranks, *tally[4:]))
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)


def _plan(edges: list) -> dict[int, dict]:
    """Per partition and part of a spanning conversation: entry state, role
    kind and greatest turn before it, cost of what follows from each state,
    whether it is the first part and whether the closing insertions are its.
    ``edges`` has at most two rows a partition."""
    edges = sorted(edges, key=lambda e: (e["pid"], e["at"] == "last"))
    plan: dict[int, dict] = {}
    chains, now = [], []
    for e in edges:
        if now and e["conv_id"] == now[-1]["conv_id"] and e["pid"] != now[-1]["pid"]:
            now.append(e)
        else:
            chains.append(now)
            now = [e]
    chains.append(now)
    for chain in chains:
        if len(chain) < 2:
            continue
        after = [[c for c, _ in CLOSING]]
        for e in reversed(chain):
            m = e["costs"]
            after.append(after[-1] if m is None else [min(min(m[p * STATES + q] + after[-1][q] for q in range(STATES)), NEVER) for p in range(STATES)])
        after = after[::-1]
        state, kind, high, final = 0, None, None, max((i for i, e in enumerate(chain) if e["n"]), default=None)
        for i, e in enumerate(chain):
            here = {"state": state, "kind": kind, "high": high, "after": after[i + 1], "first": i == 0, "close": i == final}
            plan.setdefault(e["pid"], {})[e["at"]] = here
            if e["costs"] is None:
                continue
            row = e["costs"][state * STATES:(state + 1) * STATES]
            total = [c + a for c, a in zip(row, after[i + 1])]
            state = min((e["ranks"][state * STATES + q], q) for q in range(STATES) if total[q] == min(total))[1]
            kind = e["last_kind"]
            high = e["high"] if e["high"] is not None else high
    return plan


_OUT = ("conv_id {}, seq long, whole boolean, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, "
        "cost long, audit string, lines long, repaired string, repaired_sha256 string")


def _lines(letters: Iterator[str], held: list, state: int) -> Iterator[str]:
    """Repaired ``role:text`` lines for the letters of a part entered in ``state``."""
    kind = "u" if state == 2 else ""  # initial of the role before
    rows = ((r, t) for part, places in held for sub in range(0, len(places), 512)
            for r, t in _texts(part, places[sub:sub + 512]))
    for letter in letters:
        role, text = next(rows) if letter in "DKR" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if kind == "u" else "user"
        kind = role[:1]
        yield f"{role}:{text}"


def _texts(part: pa.RecordBatch, places: list[int]) -> Iterator[tuple[str, str]]:
    some = part.select(["role", "text"]).take(pa.array(places, pa.int64()))
    return zip(some.column(0).to_pylist(), some.column(1).to_pylist())


def _worked(plan: dict[int, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, waiting, size, pid, kind = Matrices(), [], 0, None, None

        def kept():
            nonlocal pid, kind
            for batch in batches:
                if batch.num_rows:
                    pid = batch.column(batch.schema.get_field_index("_pid"))[0].as_py()
                    kind = batch.schema.field("conv_id").type
                    yield batch

        def emit(parts):
            memo.learn([b for p in parts for b in p[4]])
            out = []
            for conv, marks, turns, held, blocks, span in parts:
                out += _finished(conv, marks, turns, held, blocks, span, memo.known, pid)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), [kind, *_KINDS])], names=_NAMES)

        last = None  # the open part: whether it is the last one is known when the next one comes
        seen = 0
        for conv, marks, turns, held in _parts(kept()):
            if last is not None:
                waiting.append((*last, plan.get(pid, {}).get("first") if seen == 1 else None))
                size += len(last[1])
                if size >= BATCH:
                    yield from emit(waiting)
                    waiting, size = [], 0
            seen += 1
            last = (conv, marks, turns, held, cut_blocks("".join(map(_symbol, marks))))
        if last is not None:
            here = plan.get(pid, {})
            waiting.append((*last, here.get("only") if seen == 1 else here.get("last")))
            yield from emit(waiting)
    return run


_KINDS = [pa.int64(), pa.bool_(), *[pa.int64()] * 8, pa.string(), pa.int64(), pa.string(), pa.string()]
_NAMES = ["conv_id", "seq", "whole", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "cost", "audit", "lines",
          "repaired", "repaired_sha256"]


def _finished(conv, marks, turns, held, blocks, span, known, pid) -> list[tuple]:
    """Output rows of one part: one for a whole conversation, else its pieces."""
    here = span or {"state": 0, "after": [c for c, _ in CLOSING], "close": True}
    letters, state, ahead = edits(blocks, known, here["state"], here["after"]) if blocks else ([], here["state"], here["after"])
    if here["close"]:
        letters.append(CLOSING[state][1])
    tally = _counts(marks, turns)
    if span and marks and here["kind"] is not None:
        tally[3] += here["kind"] + marks[0][1] not in ("su", "ua", "au")
    if span and here["high"] is not None and here["high"] == tally[4]:
        tally[6] -= 1  # this turn is counted in the part before
    lines = _lines((x for piece in letters for x in piece), held, here["state"])
    if not span:
        digest, n = hashlib.sha256(), 0
        for line in lines:
            digest.update((("\n" if n else "") + line).encode("utf-8", "surrogatepass"))
            n += 1
        return [(conv, 0, True, *tally, ahead[0], "".join(letters), n, None, digest.hexdigest())]
    out, text, n, size, seq = [], [], 0, 0, pid << 32
    cost = ahead[0] if here["first"] else 0  # of the whole conversation, told by its first part
    for line in lines:
        text.append(line)
        size += len(line)
        if size >= PIECE:
            out.append((conv, seq + len(out), False, 0, 0, 0, 0, None, None, 0, 0, "", len(text), "\n".join(text), None))
            text, size = [], 0
    out.append((conv, seq + len(out), False, *tally, cost, "".join(letters), len(text), "\n".join(text), None))
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of spanning conversations, in order, to one row each."""
    now, kind = None, None

    def row():
        conv, sums, low, high, audit, lines, digest = now
        return (conv, 0, True, *sums[:4], low, high, sums[4], sums[5], "".join(audit), lines, None, digest.hexdigest())

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for part in slices(batch, 64):
            out = []
            for r in part.to_pylist():
                if now is None or now[0] != r["conv_id"]:
                    if now is not None:
                        out.append(row())
                    now = [r["conv_id"], [0] * 6, None, None, [], 0, hashlib.sha256()]
                for k, c in enumerate(("blank", "duplicate", "truncated", "illegal", "turns", "cost")):
                    now[1][k] += r[c]
                now[2] = min((x for x in (now[2], r["low"]) if x is not None), default=None)
                now[3] = max((x for x in (now[3], r["high"]) if x is not None), default=None)
                now[4].append(r["audit"])
                if r["lines"]:
                    now[6].update((("\n" if now[5] else "") + r["repaired"]).encode("utf-8", "surrogatepass"))
                    now[5] += r["lines"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), [kind, *_KINDS])], names=_NAMES)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), [kind, *_KINDS])], names=_NAMES)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, gone):
    fault counts, cost, audit (letters of the cheapest edits) and
    repaired_sha256."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    marked = symbols(rows)
    laid = cut(marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("_pid", F.spark_partition_id()))
    edges = laid.mapInArrow(_edges, _EDGE.format(conv)).collect()  # at most two rows a partition
    plan = _plan([e.asDict() for e in edges])
    out = stored(laid.mapInArrow(_worked(plan), _OUT.format(conv)), "repaired")
    pieces = out.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    done = out.where("whole").unionAll(pieces.mapInArrow(_joined, _OUT.format(conv)))
    gaps: Column = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    return done.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_query(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return repair(damage(rows))


def _oracle() -> str:
    """DuckDB SQL: a recursion over the rows of a conversation holds, per
    state, the best edits as text (cost in eight digits, then the letters, so
    that the least text is the least cost and then the least letters)."""
    def add(s: str, cost, letters: str) -> str:
        return f"(lpad((substr({s}, 1, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({s}, 9) || '{letters}')"

    def when(cond: str, s: str) -> str:
        return f"CASE WHEN {cond} THEN {s} END"

    late = f"(CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END)"
    stays = "fault NOT IN ('blank', 'duplicate')"
    keep = lambda s, r: when(f"{stays} AND kind = '{r}'", add(s, late, "K"))  # noqa: E731
    role = lambda s: when(stays, add(s, f"{REROLE} + {late}", "R"))  # noqa: E731
    drop = lambda s: add(s, DELETE, "D")  # noqa: E731
    ins = lambda s, n=1: add(s, n * INSERT, "I" * n)  # noqa: E731
    n = [drop("z0"), f"least({drop('z1')}, {keep('z0', 's')})",
         f"least({drop('z2')}, " + ", ".join(f(z) for z in ("z0", "z1", "z3") for f in (lambda z: keep(z, "u"), role)) + ")",
         f"least({drop('z3')}, {keep('z2', 'a')}, {role('z2')})"]
    return rf"""
WITH RECURSIVE
poly AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], [0,0,0,0,0,0,0,0]),
           lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS tbl),
base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda s: unicode(s)::BIGINT)),
             lambda c, x: xor(c >> 8, poly.tbl[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS d FROM conversations, poly),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy FROM base WHERE d <> 0),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM damaged),
rows AS (
  SELECT *, substr(role, 1, 1) AS kind, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS kind_before,
         CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault FROM seen),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, max(i) AS n_rows,
         count(*) FILTER (i > 1 AND kind_before || kind NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
dp(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, '00000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counts
  UNION ALL
  SELECT conv_id, i, {n[0]}, {n[1]}, {n[2]}, {n[3]} FROM (
    SELECT r.*, s0 AS z0, s1 AS z1, least(s2, {ins('s0')}, {ins('s1')}, {ins('s3')}) AS z2,
           least(s3, {ins('s2')}, {ins('s0', 2)}, {ins('s1', 2)}) AS z3
    FROM dp JOIN rows r ON r.conv_id = dp.conv_id AND r.i = dp.i + 1)),
best AS (
  SELECT c.*, least(s0, s3, {ins('s2')}, {ins('s1', 2)}) AS way
  FROM dp JOIN counts c ON c.conv_id = dp.conv_id AND c.n_rows = dp.i),
walk(conv_id, k, i, kind, done, audit) AS (
  SELECT conv_id, 1, 0::BIGINT, '', NULL::VARCHAR, substr(way, 9) FROM best
  UNION ALL
  SELECT w.conv_id, w.k + 1, CASE WHEN letter = 'I' THEN w.i ELSE w.i + 1 END,
         CASE letter WHEN 'D' THEN w.kind WHEN 'K' THEN r.kind ELSE CASE w.kind WHEN 'u' THEN 'a' ELSE 'u' END END,
         CASE letter WHEN 'D' THEN done ELSE coalesce(done || chr(10), '') ||
           CASE letter WHEN 'K' THEN r.role ELSE CASE w.kind WHEN 'u' THEN 'assistant' ELSE 'user' END END || ':' ||
           CASE letter WHEN 'I' THEN '' ELSE r.text END END, audit
  FROM (SELECT *, substr(audit, k, 1) AS letter FROM walk WHERE k <= length(audit)) w
  LEFT JOIN rows r ON r.conv_id = w.conv_id AND r.i = w.i + 1),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(b.gaps, 0)::BIGINT AS gaps, coalesce(b.blank, 0)::BIGINT AS blank, coalesce(b.duplicate, 0)::BIGINT AS duplicate,
       coalesce(b.truncated, 0)::BIGINT AS truncated, coalesce(b.illegal, 0)::BIGINT AS illegal,
       coalesce(substr(b.way, 1, 8)::BIGINT, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(w.done, '')) AS repaired_sha256
FROM ids LEFT JOIN best b ON b.conv_id = ids.conv_id LEFT JOIN walk w ON w.conv_id = ids.conv_id AND w.k = length(w.audit) + 1
"""


OP12_SQL = _oracle()
