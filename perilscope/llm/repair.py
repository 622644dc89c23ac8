"""Conversation structure repair: least-cost edits, the least audit by prefix-doubling path ranking.

A conversation, rows in the order of their turns, is edited until its roles read ``(s?(ua)+)?``.  The
edits are paths through a graph of (row, what was emitted last): delete, keep and rerole go on by a row,
insert stays at it.  Costs are summed from the end; an arc is optimal if its cost and that of its end
are the cost of its beginning.  Of the optimal paths the one with the least string of initials is
wanted.  Nodes are ranked by the least string of 1, 2, 4, ... letters that begins there: the rank for
twice the letters is the rank of the pair (rank here, rank behind the letters), and the pointer behind
twice the letters is the pointer's pointer.  A letter and a node fix the next node (a row is deleted,
kept, or takes the one role that may follow), so the least string also fixes the path, and the path is
read off the doubled pointers, all places at once.

Conversations of any length are split: rows, reduced to one byte each, are dealt by ranges of
(conversation, turn), cut into pieces, and a piece is summed up by its 4 x 4 matrix of costs.  Only
conversations that span pieces are joined again, by their matrices; then all pieces are ranked on
their own, for each state in which they can be entered.  Rows of one text are found by the SHA-256 of
role and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import materialize

#: cells of a piece; a conversation's audit is one string, so it has at most 2 ** 31 of them
PIECE = 16_384
#: cells that a task works on at a time
WORK = 1_000_000

# fixed values: roles by number, costs
_ROLES = ("s", "u", "a")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: initials of the edits in ASCII order; 0 is the end
LETTERS = "\0DIKR"
# status of a cell
OK, CUT, DUPLICATE, BLANK = 0, 1, 2, 3
# states: nothing emitted, a system row, a user's, an assistant's
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: state after the role that may follow is inserted or given
NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])
#: state after a row with initial s, u, a or another is kept; -1: it may not be
KEPT = np.array([[AFTER_S, AFTER_U, -1, -1], [-1, AFTER_U, -1, -1], [-1, -1, AFTER_A, -1], [-1, AFTER_U, -1, -1]])
FAR = np.int64(1) << 40
_LEGAL = ((0, 1), (1, 2), (2, 1))

WHITE = " \t\n\x0b\x0c\r"


# rows ----------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with their faults: ``conv_id, turn, role, text, times`` (0: dropped, 2: repeated).

    Nulls of role and text, and of id and turn in the hash, are one blank.
    """
    blank = F.lit(" ")

    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), blank)
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, F.lit(0)).when(fault == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"))


def _marked(rows: DataFrame) -> DataFrame:
    """``digest`` of role and text, and ``code``: the initial's number + 4 * status (not yet duplicates)."""
    initial = F.substring("role", 1, 1)
    number = F.lit(3)
    for i, r in enumerate(_ROLES):
        number = F.when(initial == r, F.lit(i)).otherwise(number)
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    status = F.when(last == "", F.lit(BLANK)).when(last.isin(".", "!", "?"), F.lit(OK)).otherwise(F.lit(CUT))
    framed = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(framed, 256))).withColumn("code", (number + 4 * status).cast("int"))


def runs(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text: ``conv_id, turn, digest, n, code, first``.

    ``first``: no equal role and text comes earlier in the conversation.  Counts and first turns are
    combined within tasks before they are shuffled, so a text that fills a conversation is no hot key.
    """
    slim = _marked(rows.where("times > 0")).select("conv_id", "turn", "digest", "times", "code")
    each = slim.groupBy("conv_id", "turn", "digest").agg(F.sum("times").alias("n"), F.max("code").alias("code"))
    firsts = slim.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("t")).select(   # nulls first
        "conv_id", F.col("t.turn").alias("turn"), "digest", F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("code"),
        F.lit(True).alias("first"))
    return each.withColumn("first", F.lit(False)).unionByName(firsts).groupBy("conv_id", "turn", "digest").agg(
        F.sum("n").alias("n"), F.max("code").alias("code"), F.max("first").alias("first"))


# costs ---------------------------------------------------------------------------------------------

def costs(cells: np.ndarray, off: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cost to the end from every node of many pieces: shape (cells + pieces, 4 states, columns of ``end``).

    Piece p has cells off[p]:off[p + 1] and nodes of rows off[p] + p ... off[p + 1] + p; ``end``
    (pieces, 4, m) is what remains behind its last row.
    """
    n = np.diff(off)
    out = np.empty((len(cells) + len(n), 4, end.shape[2]), np.int64)
    at_end = off[1:] + np.arange(len(n))
    out[at_end] = end
    longest = np.argsort(-n, kind="stable")
    for t in range(1, int(n.max(initial=0)) + 1):
        p = longest[:np.searchsorted(-n[longest], -t, side="right")]
        row = at_end[p] - t
        code = cells[off[p + 1] - t]
        nxt, initial, status = out[row + 1], code & 3, code >> 2
        extra = (status == CUT).astype(np.int64)[:, None, None] * TRUNCATED
        to = KEPT[:, initial].T
        keep = np.where((to < 0)[:, :, None], FAR, np.take_along_axis(nxt, np.maximum(to, 0)[:, :, None], 1) + extra + KEEP)
        stay = np.minimum(keep, nxt[:, NEXT] + extra + REROLE)
        stay[status >= DUPLICATE] = FAR
        best = np.minimum(nxt + DELETE, stay)
        for _ in range(2):                                   # two inserts at most pay between two rows
            best = np.minimum(best, best[:, NEXT] + INSERT)
        out[row] = best
    return np.minimum(out, FAR)


def final_end() -> np.ndarray:
    """What remains behind the last row of a conversation: nothing where it may end, else inserts."""
    c = np.array([0, FAR, FAR, 0], np.int64)
    for _ in range(2):
        c = np.minimum(c, c[NEXT] + INSERT)
    return c


def matrix(cells: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Costs from each state before a piece to each behind it: (pieces, 4, 4)."""
    unit = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(unit, 0)
    table = costs(cells, off, np.broadcast_to(unit, (len(off) - 1, 4, 4)))
    return table[off[:-1] + np.arange(len(off) - 1)]


# the least audit -----------------------------------------------------------------------------------

def optimal(cells: np.ndarray, off: np.ndarray, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Optimal arcs of every node: (targets, whether optimal), both (nodes, 4 letters).

    A node is 4 * row + state; letters in the order of ``LETTERS[1:]``.  ``last``: the piece ends its
    conversation, so that inserts may follow its last row; other pieces are left there.
    """
    rows, pieces = len(cost), len(off) - 1
    at_end = np.zeros(rows, bool)
    at_end[off[1:] + np.arange(pieces)] = True
    code = np.zeros(rows, np.int64)
    code[~at_end] = cells
    initial, status = code & 3, code >> 2
    row = np.arange(rows)[:, None]
    state = np.broadcast_to(np.arange(4), (rows, 4))
    kept = KEPT[:, initial].T
    free = ((status < DUPLICATE) & ~at_end)[:, None]
    extra = ((status == CUT) * TRUNCATED)[:, None]
    beyond = np.minimum(row + 1, rows - 1)
    open_end = np.zeros(rows, bool)
    open_end[(off[1:] + np.arange(pieces))[last]] = True
    may = [np.broadcast_to(~at_end[:, None], (rows, 4)), np.broadcast_to((~at_end | open_end)[:, None], (rows, 4)),
           free & (kept >= 0), np.broadcast_to(free, (rows, 4))]
    to = [4 * beyond + state, 4 * row + NEXT[state], 4 * beyond + np.maximum(kept, 0), 4 * beyond + NEXT[state]]
    price = [np.full((rows, 1), DELETE), np.full((rows, 1), INSERT), extra + KEEP, extra + REROLE]
    flat = cost.reshape(-1)
    target = np.stack([t.reshape(-1) for t in to], 1)
    paid = np.stack([np.broadcast_to(p, (rows, 4)).reshape(-1) for p in price], 1) + flat[target]
    allowed = np.stack([m.reshape(-1) for m in may], 1)
    return target, allowed & (paid == flat[:, None]) & (flat < FAR)[:, None]


def rank_paths(target: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(letter of each node's arc on its least path, pointers behind 1, 2, 4, ... letters, ranks).

    Ranks are those of the least strings; the end sorts before every letter.
    """
    nodes = np.arange(len(target))
    ends = ~good.any(1)
    pick = np.where(ends, 0, good.argmax(1))                 # a node's least letter: its string of one
    letter = np.where(ends, 0, pick + 1).astype(np.int8)
    pointer = np.where(ends, nodes, target[nodes, pick]).astype(np.int32)
    rank, pointers = letter.astype(np.int64), [pointer]
    while letter[pointer].any():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        # of the arcs that begin with the least string, the one with the least rank behind it
        behind = np.where(good, (np.arange(1, 5) * (int(rank.max()) + 1)) + rank[target], np.iinfo(np.int64).max)
        pick = np.where(ends, 0, behind.argmin(1))
        letter = np.where(ends, 0, pick + 1).astype(np.int8)
        pointer = pointer[pointer]
        pointers.append(pointer)
    return letter, pointers, rank


def read_paths(letter: np.ndarray, pointers: list[np.ndarray], begin: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The least strings from the nodes ``begin``, and the nodes where they end."""
    # lengths: the largest number of letters that does not reach the end, by bits, plus one
    node, length = begin.astype(np.int64), np.zeros(len(begin), np.int64)
    for k in range(len(pointers) - 1, -1, -1):
        far = pointers[k][node]
        go = letter[far] > 0
        node, length = np.where(go, far, node), length + (go.astype(np.int64) << k)
    some = letter[begin] > 0
    length = np.where(some, length + 1, 0)
    ends = np.where(some, pointers[0][node], begin)
    starts = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(starts, length)
    node = np.repeat(begin.astype(np.int64), length)
    for k, p in enumerate(pointers):
        node = np.where(place >> k & 1, p[node], node)
    text = np.frombuffer(LETTERS.encode(), np.uint8)[letter[node]].tobytes()
    return [text[a:a + n] for a, n in zip(starts.tolist(), length.tolist())], ends


def audits(cells: np.ndarray, off: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Per piece: the least audit from each state, the state behind it, and the cost to the end."""
    cost = costs(cells, off, end[:, :, None])[:, :, 0]
    target, good = optimal(cells, off, cost, last)
    letter, pointers, _ = rank_paths(target, good)
    first = off[:-1] + np.arange(len(off) - 1)
    begin = (4 * first[:, None] + np.arange(4)).reshape(-1)
    strings, ends = read_paths(letter, pointers, begin)
    return [strings[i:i + 4] for i in range(0, len(strings), 4)], (ends % 4).reshape(-1, 4), cost[first]


# pieces --------------------------------------------------------------------------------------------

_PIECE = ("conv_id bigint, part int, piece bigint, whole boolean, cells binary, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint, initial int, final int, low bigint, high bigint, turns bigint, costs array<bigint>")


def _column(b, name):
    c = b.column(name)
    return c.fill_null(0).to_numpy(zero_copy_only=False), c.is_null().to_numpy(zero_copy_only=False)


def _cut(batches, piece_cells: int):
    """Sorted runs of one partition -> its pieces.  The last conversation of a batch waits for the next."""
    import pyarrow as pa

    done = 0
    waiting: list = []

    def emit(t, edge_first, edge_last):
        nonlocal done
        conv, conv_null = _column(t, "conv_id")
        turn, turn_null = _column(t, "turn")
        n, code = t.column("n").to_numpy(), t.column("code").to_numpy()
        first = t.column("first").to_numpy(zero_copy_only=False)
        new = np.concatenate([[True], (conv[1:] != conv[:-1]) | (conv_null[1:] != conv_null[:-1])])
        heads = np.flatnonzero(new)
        cum = np.concatenate([[0], np.cumsum(n)])
        begin, stop = cum[heads], cum[np.concatenate([heads[1:], [len(conv)]])]
        count = -(-(stop - begin) // piece_cells)
        of = np.repeat(np.arange(len(heads)), count)
        k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        lo = begin[of] + k * piece_cells
        hi = np.minimum(lo + piece_cells, stop[of])
        # a conversation within the partition and one piece has no other rows anywhere
        whole = (count[of] == 1) & ~(edge_first & (of == 0)) & ~(edge_last & (of == len(heads) - 1))
        work = np.flatnonzero(np.diff(np.concatenate([[-1], (np.cumsum(hi - lo) - 1) // WORK])))
        for a, z in zip(work, np.concatenate([work[1:], [len(of)]])):
            size = hi[a:z] - lo[a:z]
            off = np.concatenate([[0], np.cumsum(size)])
            place = np.arange(off[-1]) - np.repeat(off[:-1], size) + np.repeat(lo[a:z], size)
            run = np.searchsorted(cum, place, side="right") - 1
            status = np.where(code[run] >> 2 == BLANK, BLANK, np.where(first[run] & (place == cum[run]), code[run] >> 2, DUPLICATE))
            initial = code[run] & 3
            cells = (initial + 4 * status).astype(np.uint8)
            start = off[:-1]

            def total(x):
                return pa.array(np.add.reduceat(x.astype(np.int64), start))
            same = np.ones(len(place), bool)
            same[start] = False                            # has a cell before it in its piece
            before = np.concatenate([[3], initial[:-1]])
            legal = np.isin(before * 4 + initial, [x * 4 + y for x, y in _LEGAL])
            known = ~turn_null[run]
            t_ = turn[run]
            fresh = known & (~same | np.concatenate([[True], (t_[1:] != t_[:-1]) | ~known[:-1]]))
            any_known = np.add.reduceat(known.astype(np.int64), start) > 0
            first_known = np.minimum(start + np.add.reduceat((~known).astype(np.int64), start), off[1:] - 1)
            off_b = pa.array(off.astype(np.int32))
            table = matrix(cells, off) if not whole[a:z].all() else np.zeros((z - a, 4, 4), np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * (z - a) + 1, 16).astype(np.int32)), pa.array(table.reshape(-1)))
            yield pa.RecordBatch.from_arrays([
                t.column("conv_id").take(pa.array(heads[of[a:z]])), t.column("part").take(pa.array(heads[of[a:z]])),
                pa.array(done + np.arange(z - a)), pa.array(whole[a:z]),
                pa.Array.from_buffers(pa.binary(), z - a, [None, off_b.buffers()[1], pa.py_buffer(cells.tobytes())]),
                total(status == BLANK), total(status == DUPLICATE), total(status == CUT), total(same & ~legal),
                pa.array(initial[start].astype(np.int32)), pa.array(initial[off[1:] - 1].astype(np.int32)),
                pa.array(t_[first_known], mask=~any_known), pa.array(t_[off[1:] - 1], mask=~any_known), total(fresh), flat],
                [f.split()[0] for f in _PIECE.split(", ")])
            done += z - a

    def flush(edge_last):
        t = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        return t, done == 0, edge_last

    for b in batches:
        if not b.num_rows:
            continue
        c, null = _column(b, "conv_id")
        change = np.flatnonzero((c[1:] != c[:-1]) | (null[1:] != null[:-1])) + 1
        if waiting:
            last = waiting[-1]
            lc, ln = _column(last.slice(last.num_rows - 1), "conv_id")
            if lc[0] != c[0] or ln[0] != null[0]:
                change = np.concatenate([[0], change])
        if len(change):
            waiting.append(b.slice(0, int(change[-1])))
            yield from emit(*flush(False))
            waiting = [b.slice(int(change[-1]))]
        else:
            waiting.append(b)
    if waiting:
        yield from emit(*flush(True))


def pieces(run_rows: DataFrame, *, piece_cells: int = PIECE) -> DataFrame:
    """Runs dealt by ranges of (conversation, turn) and cut into pieces (``_PIECE``)."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "digest")]
    s = run_rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    return s.select("conv_id", "turn", "n", "code", "first", "part").mapInArrow(lambda it: _cut(it, piece_cells), _PIECE)


def chains(cut: DataFrame) -> DataFrame:
    """``part, piece, end, last`` of pieces whose conversation may have others.

    ``end``: the costs that remain behind the piece.  A partition has two such conversations at most
    besides those longer than a piece; each piece is 16 numbers here, whatever its rows.
    """
    edge = cut.where("not whole").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "costs"))).alias("m"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            out = [[], [], [], []]
            for m in b.column(0).to_pylist():
                end = final_end()
                for i, p in enumerate(reversed(m)):
                    for column, v in zip(out, (p["part"], p["piece"], end.tolist(), i == 0)):
                        column.append(v)
                    end = np.minimum((np.array(p["costs"], np.int64).reshape(4, 4) + end[None, :]).min(1), FAR)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.bool_())],
                ["part", "piece", "end", "last"])
    return edge.select("m").mapInArrow(run, "part int, piece bigint, end array<bigint>, last boolean")


_DONE = "audits array<string>, exits array<int>, cost array<bigint>"


def ranked(cut: DataFrame) -> DataFrame:
    """Pieces with ``audits`` and ``exits`` by the state in which they are entered, and ``cost`` from there."""
    keep = [c.split()[0] for c in _PIECE.split(", ") if c.split()[0] not in ("whole", "cells", "costs")]
    whole = cut.where("whole").withColumn("end", F.lit(None).cast("array<bigint>")).withColumn("last", F.lit(True))
    parts = cut.where("not whole").join(chains(cut), ["part", "piece"])
    rows = whole.unionByName(parts).select(*keep, "cells", "end", "last")

    def run(batches):
        import pyarrow as pa
        closing = final_end()
        for b in batches:
            size = np.array([len(c.as_buffer()) for c in b.column("cells")], np.int64)
            work = (np.cumsum(size) - 1) // WORK
            bounds = np.concatenate([np.flatnonzero(np.diff(np.concatenate([[-1], work]))), [b.num_rows]])
            for a, z in zip(bounds[:-1], bounds[1:]):
                s = b.slice(int(a), int(z - a))
                cells = np.frombuffer(b"".join(s.column("cells").to_pylist()), np.uint8).astype(np.int64)
                off = np.concatenate([[0], np.cumsum(size[a:z])])
                ends = np.array([closing if e is None else e for e in s.column("end").to_pylist()], np.int64)
                strings, exits, cost = audits(cells, off, ends, s.column("last").to_numpy(zero_copy_only=False))
                one = s.column("end").is_null().to_numpy(zero_copy_only=False)      # a whole conversation begins at the start
                strings = [[x.decode() for x in (v[:1] if o else v)] for v, o in zip(strings, one)]
                yield pa.RecordBatch.from_arrays(
                    [*[s.column(c) for c in keep], pa.array(strings, pa.list_(pa.string())),
                     pa.array(exits.tolist(), pa.list_(pa.int32())), pa.array(cost.tolist(), pa.list_(pa.int64()))],
                    [*keep, "audits", "exits", "cost"])
    types = {c.split()[0]: c for c in _PIECE.split(", ")}
    return rows.mapInArrow(run, ", ".join(types[c] for c in keep) + ", " + _DONE)


# the result ----------------------------------------------------------------------------------------

class _Conversation:
    """One conversation on its way through ``_write``: its pieces first, then its rows in order."""

    def __init__(self, key):
        self.key = key
        self.audit, self.state, self.cost = [], START, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.final = None
        self.hash, self.lines, self.at, self.role, self.edits = hashlib.sha256(), 0, 0, START, None

    def piece(self, p):
        if self.final is None:
            self.cost = p["cost"][START]
        elif (self.final, p["initial"]) not in _LEGAL:
            self.illegal += 1
        self.audit.append(p["audits"][self.state])
        self.state, self.final = p["exits"][self.state], p["final"]
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, k, getattr(self, k) + p[k])
        if p["low"] is not None:
            self.turns -= p["low"] == self.high                # one turn on both sides of a cut
            self.low = p["low"] if self.low is None else self.low
            self.high = p["high"]

    def line(self, role, text):
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def give(self, text):
        """A row with the one role that may follow."""
        self.role = int(NEXT[self.role])
        self.line("user" if self.role == AFTER_U else "assistant", text)

    def inserts(self):
        if self.edits is None:
            self.edits = "".join(self.audit)
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.give("")
            self.at += 1

    def row(self, role, text):
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.role = int(KEPT[self.role][_ROLES.index(role[0])])
            self.line(role, text)
        elif edit == "R":
            self.give(text)

    def result(self):
        self.inserts()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.edits, self.hash.hexdigest())


_RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")


def _write(batches):
    """Pieces and rows, sorted by conversation -> one row per conversation."""
    import pyarrow as pa

    names = [c.split()[0] for c in _RESULT.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in _RESULT.split(", ")]

    def out(results):
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*results), types)], names)

    current, results, size = None, [], 0
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            s = b.slice(lo, 1024)
            columns = (s.column(c).to_pylist() for c in ("conv_id", "role", "text", "times", "p"))
            for key, role, text, times, p in zip(*columns):
                if current is None or current.key != key:
                    if current is not None:
                        results.append(current.result())
                        size += 200 + len(results[-1][7])
                        if size > 4_000_000:
                            yield out(results)
                            results, size = [], 0
                    current = _Conversation(key)
                if p is not None:
                    current.piece(p)
                else:
                    for _ in range(times):
                        current.row(role, text)
    if current is not None:
        results.append(current.result())
    if results:
        yield out(results)


def repair(conversations: DataFrame, *, piece_cells: int = PIECE) -> DataFrame:
    """Every conversation after damage and repair: its faults, cost, audit and the repaired rows' hash.

    Rows go by turn, nulls first; rows of one turn by the SHA-256 of role and text, so repeats stand
    together; a null conversation is one of its own.  A null role or text is one blank (such a row is
    blank if its text is).  A conversation that lost all of its rows has zeros and the hash of nothing;
    an empty table gives no rows.  Other columns are not read.

    The hash of a conversation's rows is one sequence, so its rows pass through one task, read as a
    stream; all else is done by pieces.
    """
    rows = damaged(conversations)
    cut = materialize(pieces(runs(rows), piece_cells=piece_cells), "repair-pieces")
    done = ranked(cut)
    stats = F.struct(*[F.col(c) for c in done.columns if c not in ("conv_id", "part", "piece")])
    empty = F.lit(None)
    a = done.select("conv_id", F.lit(0).alias("kind"), "part", "piece", empty.cast("bigint").alias("turn"),
                    empty.cast("binary").alias("digest"), empty.cast("string").alias("role"), empty.cast("string").alias("text"),
                    F.lit(0).alias("times"), stats.alias("p"))
    dropped = F.col("times") == 0
    b = _marked(rows).select(
        "conv_id", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("piece"), "turn", "digest",
        "role", F.when(~dropped, F.col("text")).alias("text"), "times", empty.cast(a.schema["p"].dataType).alias("p"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "part", "piece", "turn", "digest")]
    return a.unionByName(b).repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "role", "text", "times", "p").mapInArrow(_write, _RESULT)
