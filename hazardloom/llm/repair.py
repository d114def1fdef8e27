"""Cheapest repair of conversation structure, by lazy weighted determinisation.

A repaired conversation is empty or an optional system turn and then user and assistant turns by pairs. Reading the turns
of a broken one, a weighted automaton has four states (nothing yet, behind the system turn, behind a user turn, behind an
assistant turn) and arcs for keeping, re-roling, deleting and inserting turns. Going backwards over the turns, the costs
from each state to the end form a vector; less its smallest entry it is one of a small, finite number of vectors. Those
are the states of a deterministic automaton, made on first use and kept in a transition table, so a scan is one look-up
a turn. The trace goes the other way, over *tight* arcs alone (those that the scan's costs rest on), and takes the
ASCII-least letter at each, which gives the least of all cheapest edits; its steps are kept in a table, too.

Conversations are split: turns are range-sorted over the cluster, a task turns each conversation's run of turns into one
byte a turn, in pieces of at most ``PIECE`` bytes, and solves it at once if it surely lies there whole. Of a conversation
over several pieces, each piece gives its min-plus matrix; folding these backwards gives every piece's end vector, with
which it is traced from each of the four states; the way through the pieces then picks one trace of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import WHITE, cut

#: Most turns of a piece.
PIECE = 1 << 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: What may follow a state as the next inserted or re-roled turn.
NEXT = (USER, USER, ASSISTANT, USER)
#: Class of a role by its initial; other initials have class 3. A turn's symbol is 4 * class + fault.
CLASSES = "sua"
FINE, CUT_OFF, BLANK, COPY = range(4)
_FAR = 1 << 40


class Machine:
    """The determinised automaton of costs to the end, made as far as it was needed."""

    def __init__(self):
        self.vectors, self.ids, self.next, self.acts = [], {}, [], []
        self.end = self.state((0, 2 * INSERT, INSERT, 0))[0]

    def state(self, costs: tuple[int, ...]) -> tuple[int, int]:
        """Number of a vector of costs less its smallest entry, and that entry."""
        least = min(costs)
        vector = tuple(c - least if c < _FAR else _FAR for c in costs)
        if vector not in self.ids:
            self.ids[vector] = len(self.vectors)
            self.vectors.append(vector), self.next.append([None] * 16), self.acts.append([None] * 64)
        return self.ids[vector], least

    def _arcs(self, symbol: int, q: int) -> list[tuple[str, int, int]]:
        """``(letter, cost, state)`` of the arcs that read the turn in state ``q``, in the order of their letters."""
        kind, fault = divmod(symbol, 4)
        arcs = [("D", DELETE, q)]
        if fault < BLANK:
            extra = TRUNCATED * (fault == CUT_OFF)
            if kind == 0 and q == EMPTY or kind in (1, 2) and NEXT[q] == kind + 1:
                arcs.append(("K", KEEP + extra, kind + 1))
            arcs.append(("R", REROLE + extra, NEXT[q]))
        return arcs

    def _before(self, at: int, symbol: int) -> list[int]:
        """Costs before the turn, where those behind it are the vector ``at``."""
        behind = self.vectors[at]
        costs = [min(c + behind[to] for _, c, to in self._arcs(symbol, q)) for q in range(4)]
        for _ in range(3):
            costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
        return [min(c, _FAR) for c in costs]

    def scan(self, symbols: bytes, at: int) -> tuple[list[int], int]:
        """The vectors before each turn and behind the last, and what was taken off their smallest entries."""
        path, total, table = [at], 0, self.next
        for symbol in reversed(symbols):
            step = table[at][symbol]
            if step is None:
                step = table[at][symbol] = self.state(tuple(self._before(at, symbol)))
            at = step[0]
            total += step[1]
            path.append(at)
        path.reverse()
        return path, total

    def _act(self, at: int, symbol: int, q: int) -> tuple[str, int]:
        """Letters up to and with the turn, and the state behind it, over tight arcs."""
        costs, behind, letters = self._before(at, symbol), self.vectors[at], ""
        while True:
            tight = [(letter, to) for letter, c, to in self._arcs(symbol, q) if c + behind[to] == costs[q]]
            if tight and tight[0][0] == "D" or costs[q] != INSERT + costs[NEXT[q]]:
                return letters + tight[0][0], tight[0][1]
            letters, q = letters + "I", NEXT[q]

    def trace(self, symbols: bytes, path: list[int], q: int) -> tuple[str, int]:
        """The least of the cheapest edits from state ``q``, and the state behind the last turn."""
        out, acts = [], self.acts
        for symbol, at in zip(symbols, path[1:], strict=True):
            act = acts[at][4 * symbol + q]
            if act is None:
                act = acts[at][4 * symbol + q] = self._act(at, symbol, q)
            out.append(act[0])
            q = act[1]
        return "".join(out), q

    def solve(self, symbols: bytes) -> tuple[int, str]:
        path, total = self.scan(symbols, self.end)
        audit, q = self.trace(symbols, path, EMPTY)
        return total + self.vectors[path[0]][EMPTY], audit + closing(q)

    def matrix(self, symbols: bytes) -> list[int]:
        """Cost from state q before to state r behind the turns, at 4 * q + r."""
        columns = []
        for r in range(4):
            path, total = self.scan(symbols, self.state(tuple(0 if q == r else _FAR for q in range(4)))[0])
            columns.append([min(total + c, _FAR) for c in self.vectors[path[0]]])
        return [columns[r][q] for q in range(4) for r in range(4)]


def closing(q: int) -> str:
    """The inserts behind the last turn."""
    return {SYSTEM: "II", USER: "I"}.get(q, "")


_machine: list[Machine] = []


def machine() -> Machine:
    """The machine of this Python process."""
    if not _machine:
        _machine.append(Machine())
    return _machine[0]


def _illegal(kinds: np.ndarray) -> int:
    """Neighbours other than system-user, user-assistant and assistant-user."""
    pairs = kinds[:-1].astype(np.int32) * 4 + kinds[1:]
    return int((~np.isin(pairs, (1, 6, 9))).sum())


_PIECE = "conv string, part int, piece int, symbols binary, matrix array<long>, first int, last int, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _record(conv: str, part: int, piece: int, symbols: bytes, whole: bool) -> tuple:
    codes = np.frombuffer(symbols, dtype=np.uint8)
    faults, kinds = np.bincount(codes % 4, minlength=4).tolist(), codes // 4
    counts = (faults[BLANK], faults[COPY], faults[CUT_OFF], _illegal(kinds))
    if whole:
        return (conv, part, piece, None, None, None, None, *counts, *machine().solve(symbols))
    return (conv, part, piece, symbols, machine().matrix(symbols), int(kinds[0]), int(kinds[-1]), *counts, None, None)


def _pieces(size: int):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The runs of a sorted partition; its first and its last conversation may go on in the next ones."""
        part, out, conv, piece, first = TaskContext.get().partitionId(), [], None, 0, True
        held = bytearray()
        for batch in batches:
            for c, symbol, n in zip(batch["conv"].tolist(), batch["symbol"].tolist(), batch["copies"].tolist(), strict=True):
                if c != conv:
                    if conv is not None:
                        out.append(_record(conv, part, piece, bytes(held), not first and not piece))
                        first = False
                    conv, piece = c, 0
                    held.clear()
                again = symbol if symbol % 4 == BLANK else symbol - symbol % 4 + COPY
                symbol_left = True
                while n:
                    if len(held) == size:
                        out.append(_record(conv, part, piece, bytes(held), False))
                        piece += 1
                        held.clear()
                    if symbol_left:
                        held.append(symbol)
                        symbol_left, n = False, n - 1
                    else:
                        m = min(n, size - len(held))
                        held += bytes([again]) * m
                        n -= m
                if len(out) >= 2_000 or len(out) * size > 1 << 26:
                    yield pd.DataFrame(out, columns=_names(_PIECE))
                    out = []
        if conv is not None:
            out.append(_record(conv, part, piece, bytes(held), False))
        yield pd.DataFrame(out, columns=_names(_PIECE))

    return pieces


def _names(schema: str) -> list[str]:
    return [f.split(" ")[0] for f in schema.split(", ")]


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    """Each piece's end vector, from the matrices of those behind it; the cost is that of the whole conversation."""
    group = group.sort_values(["part", "piece"])
    vector, ends = np.array(machine().vectors[machine().end], dtype=np.int64), []
    for m in reversed(group["matrix"].tolist()):
        ends.append((vector - vector.min()).tolist())
        vector = np.minimum((np.array(m, dtype=np.int64).reshape(4, 4) + vector).min(axis=1), _FAR)
    firsts, lasts = group["first"].to_numpy(), group["last"].to_numpy()
    seams = [0] + [_illegal(np.array([a, b])) for a, b in zip(lasts[:-1], firsts[1:], strict=True)]
    closes = [False] * (len(group) - 1) + [True]
    return group[["conv", "part", "piece"]].assign(end=ends[::-1], seam=seams, closes=closes, total=int(vector[EMPTY]))


def _trace_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    m = machine()
    for batch in batches:
        audits, behind = [], []
        for symbols, end, closes in zip(batch["symbols"], batch["end"], batch["closes"], strict=True):
            path, _ = m.scan(symbols, m.state(tuple(int(x) for x in end))[0])
            found = [m.trace(symbols, path, q) for q in range(4)]
            audits.append([audit + closing(q) if closes else audit for audit, q in found]), behind.append([q for _, q in found])
        yield batch[["conv", "part", "piece", "seam", "total", "blank", "duplicate", "truncated", "illegal"]].assign(audits=audits, behind=behind)


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece begins."""
    group = group.sort_values(["part", "piece"])
    starts = [EMPTY]
    for behind in group["behind"].tolist()[:-1]:
        starts.append(int(behind[starts[-1]]))
    return group[["conv", "part", "piece"]].assign(start=starts)


def _key(conv_col: str) -> Column:
    """A conversation's id as text, which tells the null id from every other."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("-")).alias("conv")


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = rows.select(_key(conv_col), F.col(turn_col).cast("long").alias("turn"), given(role_col).alias("role"), given(text_col).alias("text"))
    return turns.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order() -> list:
    return ["conv", F.asc_nulls_first("turn"), "role", "digest"]


def plan_repairs(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per conversation: its id, ``conv`` (the id as a key), ``gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Turns are taken by number, nulls first, equal numbers by role and text; a null role or text is one space. The first
    fault of a turn counts: *blank* (white space alone), *duplicate* (role and text came before), *truncated* (the last
    visible character ends no sentence). Blank and duplicate turns must be deleted; a truncated turn that stays costs
    extra. ``illegal`` counts neighbours whose roles cannot follow each other; ``gaps`` the numbers missing between the
    smallest and the largest (nulls do not count; at most 2^63 - 1). ``audit`` has a letter for each edit: D delete, I
    insert, K keep, R re-role; of the cheapest the ASCII-least. The null id is one conversation. Turns that are equal in
    everything are one row with a count until they are written as bytes; an empty role cannot be kept; texts of any length travel as digests. An empty
    table gives an empty result; extra columns of any name are ignored.
    """
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    visible = F.btrim("text", F.lit(WHITE))
    blank, cut_off = visible == "", ~F.right(visible, F.lit(1)).isin(".", "!", "?")
    fault = F.when(blank, BLANK).when(cut_off, CUT_OFF).otherwise(FINE)
    turns = turns.withColumn("fault", fault).groupBy("conv", "turn", "role", "digest", "fault").agg(F.count(F.lit(1)).alias("copies"))
    number = F.struct(F.col("turn").isNotNull().alias("named"), "turn")
    firsts = turns.groupBy("conv", "role", "digest").agg(F.min(number).alias("earliest"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    turns = turns.join(firsts, ["conv", "role", "digest"], "left")
    again = F.coalesce(F.col("earliest") < number, F.lit(False)) & (F.col("fault") != BLANK)
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    coded = turns.select("conv", "turn", "role", "digest", (4 * kind + F.when(again, COPY).otherwise(F.col("fault"))).alias("symbol"), "copies")
    ordered = coded.repartitionByRange(*_order()).sortWithinPartitions(*_order()).select("conv", "symbol", "copies")
    pieces = cut(ordered.mapInPandas(_pieces(piece), _PIECE))

    counts = ["blank", "duplicate", "truncated", "illegal"]
    at = ["conv", "part", "piece"]
    open_ = pieces.where("symbols is not null")
    ends = open_.select(*at, "matrix", "first", "last").groupBy("conv").applyInPandas(_fold, "conv string, part int, piece int, end array<long>, seam long, closes boolean, total long")
    traced = cut(
        open_.join(ends, at).mapInPandas(_trace_all, "conv string, part int, piece int, seam long, total long, blank long, duplicate long, truncated long, illegal long, audits array<string>, behind array<int>")
    )
    starts = traced.select(*at, "behind").groupBy("conv").applyInPandas(_walk, "conv string, part int, piece int, start int")
    chosen = traced.join(starts, at).withColumn("audit", F.get("audits", F.col("start"))).withColumn("illegal", F.col("illegal") + F.col("seam"))
    parts = F.array_sort(F.collect_list(F.struct("part", "piece", "audit")))
    split = chosen.groupBy("conv").agg(*(F.sum(c).alias(c) for c in counts), F.max("total").alias("cost"), F.array_join(F.transform(parts, lambda p: p.audit), "").alias("audit"))
    solved = pieces.where("symbols is null").select("conv", *counts, "cost", "audit").unionByName(split)

    facts = rows.select(F.col(conv_col).alias("id"), _key(conv_col), F.col(turn_col).cast("long").alias("turn"))
    wide = lambda c: c.cast("decimal(20,0)")
    gaps = F.least(wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn"), wide(F.lit((1 << 63) - 1)))
    facts = facts.groupBy("conv").agg(F.min("id").alias(conv_col), F.when(F.max("turn").isNull(), 0).otherwise(gaps).cast("long").alias("gaps"))
    return facts.join(solved, "conv").select(conv_col, "conv", "gaps", *counts, "cost", "audit")


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Applies each conversation's audit, which comes first, to its turns behind it."""
    names, conv, audit, at, q, position = ("user", "assistant"), None, "", 0, EMPTY, 0

    def inserted(out: list) -> None:
        nonlocal at, q, position
        while at < len(audit) and audit[at] == "I":
            out.append((conv, position, names[NEXT[q] == ASSISTANT], ""))
            at, q, position = at + 1, NEXT[q], position + 1

    for batch in batches:
        out = []
        for c, tag, role, text in zip(batch["conv"].tolist(), batch["tag"].tolist(), batch["role"].tolist(), batch["text"].tolist(), strict=True):
            if tag == 0:
                inserted(out)
                conv, audit, at, q, position = c, text, 0, EMPTY, 0
                continue
            inserted(out)
            letter, at = audit[at], at + 1
            if letter != "D":
                q = NEXT[q] if letter == "R" else CLASSES.index(role[0]) + 1
                out.append((conv, position, names[q == ASSISTANT] if letter == "R" else role, text))
                position += 1
        yield pd.DataFrame(out, columns=["conv", "position", "role", "text"])
    out = []
    inserted(out)
    yield pd.DataFrame(out, columns=["conv", "position", "role", "text"])


def repaired(rows: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, position, role, text``: the turns of the repaired conversations, by the ``plan`` of ``plan_repairs``.

    A conversation's turns come in order, next to each other, in one partition; they stream through its task one batch
    at a time, behind the audit. A conversation that is repaired to nothing has no rows.
    """
    turns = _turns(rows, conv_col, turn_col, role_col, text_col).withColumn("tag", F.lit(1))
    null = F.lit(None)
    heads = plan.select("conv", null.cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), null.cast("binary").alias("digest"), F.lit(0).alias("tag"))
    order = ["conv", "tag", *_order()[1:]]
    dealt = heads.unionByName(turns).repartition("conv").sortWithinPartitions(*order).select("conv", "tag", "role", "text")
    return dealt.mapInPandas(_edited, "conv string, position long, role string, text string")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, running = None, None
    for batch in batches:
        out = []
        for c, role, text in zip(batch["conv"].tolist(), batch["role"].tolist(), batch["text"].tolist(), strict=True):
            if c != conv:
                if running is not None:
                    out.append((conv, running.hexdigest()))
                conv, running = c, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        yield pd.DataFrame(out, columns=["conv", "sha256"])
    yield pd.DataFrame([(conv, running.hexdigest())] if running is not None else [], columns=["conv", "sha256"])


def text_digests(turns: DataFrame) -> DataFrame:
    """``conv, sha256`` of ``role:text`` of a conversation's turns, joined by line feeds; ``turns`` as ``repaired`` gives them.

    A SHA-256 is made byte by byte in order, so a conversation's turns stream through one task, without being held there.
    """
    return turns.mapInPandas(_digests, "conv string, sha256 string")
