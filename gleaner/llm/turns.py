"""Conversation structure repair with block tables (the method of the Four Russians).

A row of a conversation is one of nine symbols: its role's initial (s, u, a or another),
complete or truncated, or that it must go. The repaired conversation must be read by an automaton of
four states, so what the rest of a conversation costs from each state is a vector of four
numbers; less its least number it is one of a few normal vectors. A table holds, for each
normal vector and each block of ``BLOCK`` symbols, the vector in front of the block and what is added,
so a conversation is priced from its end with one look-up per block. Edits are then
read from the start: each block is expanded backward from the vector behind it, and of the
edits that cost least the first letter is taken, so ties go to the ASCII-least edits.

Rows are put in order over all tasks, and the part of a conversation in one task becomes chunks of bounded
size. A chunk's effect is a table too, from each vector behind it to the one in front,
so chunks of one conversation are put together without their rows: a conversation may
be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import BLANKS, bounded_batches, column
from gleaner.operators.skew import lookup
from gleaner.session import store

BLOCK = 4
#: A chunk is closed at so many bytes of text or rows.
CHUNK_BYTES = 2_000_000
CHUNK_ROWS = 50_000

RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
INITIALS = "sua"
GONE = 8  # symbols: 2 * initial + truncated, with 3 for other initials; GONE must be deleted
#: States: nothing yet, after s, after u, after a. What s, u, a lead to; None where they can't stand.
STEP = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
#: The state behind the one initial that may be inserted or given to a row.
NEXT = (2, 2, 3, 2)
NAME = ("user", "user", "assistant", "user")
FINAL = (0, 3)
_NEVER = 10**6


def _with_inserts(base: list[int]) -> list[int]:
    """Two inserts lead back, so more never pay."""
    return [min(base[q], INSERT + base[NEXT[q]], 2 * INSERT + base[NEXT[NEXT[q]]]) for q in range(4)]


def _options(symbol: int, behind: tuple[int, ...], q: int) -> list[tuple[str, int, int]]:
    """``(edit, cost of it and all that follows, state behind)`` for the row alone, in the order of their letters."""
    out = [("D", DELETE + behind[q], q)]
    if symbol != GONE:
        initial, extra = symbol >> 1, TRUNCATED * (symbol & 1)
        after = STEP[q][initial] if initial < 3 else None
        if after is not None:
            out.append(("K", extra + behind[after], after))
        out.append(("R", RETYPE + extra + behind[NEXT[q]], NEXT[q]))
    return out


class Tables:
    """Normal vectors; for one symbol and for blocks the vector in front and what is added; the edits."""

    def __init__(self):
        end = tuple(_with_inserts([0 if q in FINAL else _NEVER for q in range(4)]))
        self.vectors, number = [end], {end: 0}
        step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows until no symbol leads to a new vector
            row = []
            for symbol in range(GONE + 1):
                base = [min(c for _, c, _ in _options(symbol, vector, q)) for q in range(4)]
                front = _with_inserts(base)
                least = min(front)
                normal = tuple(c - least for c in front)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], least))
            step.append(row)
        self.front = np.array([[s[0] for s in row] for row in step]).T.copy()  # symbol, vector behind
        self.added = np.array([[s[1] for s in row] for row in step]).T.copy()
        self.blocks = {0: (np.arange(len(self.vectors))[None, :], np.zeros((1, len(self.vectors)), dtype=np.int64))}
        for n in range(1, BLOCK + 1):  # a block of n: its first symbol before a block of n - 1
            front, added = self.blocks[n - 1]
            self.blocks[n] = (
                np.concatenate([self.front[s][front] for s in range(GONE + 1)]),
                np.concatenate([added + self.added[s][front] for s in range(GONE + 1)]),
            )
        self.edits = {
            (s, v, q): self._edit(s, vector, q) for s in range(GONE + 1) for v, vector in enumerate(self.vectors) for q in range(4)
        }

    @staticmethod
    def _edit(symbol: int, behind: tuple[int, ...], q: int) -> tuple[str, int]:
        """The edits up to and with this row, and the state behind them: least cost, then ASCII-least."""
        options = lambda p: _options(symbol, behind, p)
        base = [min(c for _, c, _ in options(p)) for p in range(4)]
        cost = _with_inserts(base)
        edits = ""
        while True:
            choices = [(e, c, p) for e, c, p in options(q)] + [("I", INSERT + cost[NEXT[q]], NEXT[q])]
            edit, _, p = min(x for x in choices if x[1] == cost[q])
            edits += edit
            q = p
            if edit != "I":
                return edits, q

    def cut(self, symbols: bytes) -> list[tuple[int, int, int]]:
        """``(first, length, number)`` of the blocks; the last may be shorter."""
        out = []
        for at in range(0, len(symbols), BLOCK):
            block = symbols[at : at + BLOCK]
            number = 0
            for s in block:
                number = number * (GONE + 1) + s
            out.append((at, len(block), number))
        return out

    def price(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind the symbols: the vector in front and what is added."""
        front = np.arange(len(self.vectors))
        added = np.zeros(len(front), dtype=np.int64)
        for _, n, number in reversed(self.cut(symbols)):
            table, more = self.blocks[n]
            added += more[number][front]
            front = table[number][front]
        return front, added

    def trace(self, symbols: bytes, behind: int, q: int) -> tuple[list[str], int]:
        """The edits of each row, given the vector behind the last and the state before the first."""
        blocks = self.cut(symbols)
        vectors = [0] * len(blocks)
        for i in range(len(blocks) - 1, -1, -1):
            vectors[i] = behind
            _, n, number = blocks[i]
            behind = int(self.blocks[n][0][number, behind])
        out = []
        for (at, n, _), v in zip(blocks, vectors):
            inside = [0] * n
            for j in range(n - 1, -1, -1):
                inside[j] = v
                v = int(self.front[symbols[at + j], v])
            for j in range(n):
                edits, q = self.edits[symbols[at + j], inside[j], q]
                out.append(edits)
        return out, q

    def closing(self, q: int) -> str:
        """Inserts that end a conversation."""
        out = ""
        while q not in FINAL:
            out, q = out + "I", NEXT[q]
        return out


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# -- rows ------------------------------------------------------------------------------


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by the checksum of ``conv_id:turn``.

    A null counts as one blank in the checksum, and as a role or text. ``copies`` is 0 for a dropped row, 2 for a repeated one.
    """
    or_blank = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    h = F.crc32(F.encode(F.concat(or_blank(conv), F.lit(":"), or_blank(turn)), "UTF-8")) % 20
    words = or_blank(text)
    kept = rows.select(column(conv).alias("conv_id"), column(turn).alias("turn"), or_blank(role).alias("role"), words.alias("text"), h.alias("h"))
    return kept.select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") <= 1, F.lit("")).when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1).alias("copies"),
    )


def plain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows as they are, in the form of :func:`damaged`."""
    or_blank = lambda c: F.coalesce(column(c).cast("string"), F.lit(" "))
    return rows.select(column(conv).alias("conv_id"), column(turn).alias("turn"), or_blank(role).alias("role"), or_blank(text).alias("text"), F.lit(1).alias("copies"))


def _key(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])))


def _ordered(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with ``copies``; ``later``: an earlier turn has this role and text. Sorted and dealt out in order.

    Only rows with an equal one are gathered, reduced before they move; the others move once, into their order.
    """
    body = F.md5("text")
    keyed = rows.select(
        "*",
        body.alias("body"),
        _key(F.col("conv_id"), F.col("turn"), F.col("role"), body, F.col("copies") > 0).alias("same"),
        _key(F.col("conv_id"), F.col("role"), body).alias("said"),
    )
    equal = keyed.groupBy("same").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    again = (
        keyed.filter("copies > 0")
        .groupBy("said")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))).alias("first"))
        .filter("rows > 1")
    )
    equal = store(equal, "equal-rows")
    alone = lookup(keyed, equal, "same", spread_by="said", size_col="rows", how="left_anti")
    together = lookup(keyed, equal, "same", spread_by="said", size_col="rows")
    one = together.groupBy("same").agg(
        *[F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text", "body", "said")], F.sum("copies").alias("copies")
    )
    narrow = ["conv_id", "turn", "role", "text", "body", "said"]
    all_rows = alone.select(*narrow, F.col("copies").cast("bigint").alias("copies")).unionByName(one.select(*narrow, "copies"))
    told = lookup(all_rows, again, "said", spread_by="body", size_col="rows", how="left")
    own = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    told = told.withColumn("later", F.coalesce(F.col("first") < own, F.lit(False)))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    narrow = told.select(
        "conv_id",
        "turn",
        "role",
        "body",
        "text",
        "copies",
        "later",
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"),
        F.coalesce(F.array_position(F.array(*[F.lit(c) for c in INITIALS]), initial).cast("int") - 1, F.lit(-1)).alias("initial"),
    )
    order = ["conv_id", "turn", "role", "body"]
    return narrow.repartitionByRange(*order).sortWithinPartitions(*order)


# -- chunks ----------------------------------------------------------------------------

_SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")
CHUNK = (
    "conv string, slice bigint, number bigint, last boolean, symbols binary, extra array<bigint>, roles array<string>, texts array<string>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_initial int, last_initial int, "
    "first_turn string, last_turn string, front binary, added array<bigint>, exits binary"
)
_BODY = ("symbols", "extra", "roles", "texts")
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Chunk:
    """Rows of one conversation in order, a bounded number of them."""

    def __init__(self, conv: str | None):
        self.conv = conv
        self.symbols, self.extra, self.roles, self.texts = bytearray(), [], [], []
        self.sums = dict.fromkeys(_SUMS, 0)
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None
        self.bytes = 0

    def add(self, turn, role, text, copies, later, blank, is_open, initial) -> None:
        symbol, spare = GONE, copies - 1
        if blank:
            self.sums["blank"] += copies
        else:
            self.sums["duplicate"] += copies if later else copies - 1
            if not later:
                self.sums["truncated"] += is_open
                symbol = 2 * (initial if initial >= 0 else 3) + is_open
        if self.last_initial is not None:
            self.sums["illegal"] += (self.last_initial, initial) not in _LEGAL
        self.sums["illegal"] += copies - 1  # beside a copy of itself
        if self.first_initial is None:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.sums["turns"] += turn != self.last_turn
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn
        self.symbols.append(symbol)
        self.extra.append(spare)
        self.roles.append(role)
        self.texts.append(None if symbol == GONE else text)
        self.bytes += len(text)

    def row(self, place: int, number: int, last: bool) -> tuple:
        """``last``: the conversation doesn't go on in this slice."""
        t, symbols = tables(), bytes(self.symbols)
        front, added = t.price(symbols)
        exits = bytes(t.trace(symbols, v, q)[1] for v in range(len(t.vectors)) for q in range(4)) if self.crosses(number, last) else b""
        return (
            self.conv, place, number, last, symbols, self.extra, self.roles, self.texts, *self.sums.values(), self.first_initial, self.last_initial,
            _text(self.first_turn), _text(self.last_turn), front.astype(np.uint8).tobytes(), (added + DELETE * sum(self.extra)).tolist(), exits,
        )

    first_of_slice = last_of_slice = False

    def crosses(self, number: int, last: bool) -> bool:
        """May the conversation have other chunks?"""
        return number > 0 or not last or self.first_of_slice or self.last_of_slice


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in CHUNK.split(", ")]
    place = TaskContext.get().partitionId()
    chunk, number, begun, out, held = None, 0, False, [], 0
    fields = ("conv", "turn", "role", "text", "copies", "later", "blank", "open", "initial")

    for frame in frames:
        for conv, turn, role, text, copies, later, blank, is_open, initial in zip(*[frame[f].tolist() for f in fields]):
            if chunk is None or conv != chunk.conv:
                if chunk is not None:
                    out.append(chunk.row(place, number, True))
                    held += chunk.bytes
                chunk, number = _Chunk(conv), 0
                chunk.first_of_slice, begun = not begun, True
            elif chunk.bytes >= CHUNK_BYTES or len(chunk.symbols) >= CHUNK_ROWS:
                out.append(chunk.row(place, number, False))
                held += chunk.bytes
                chunk, number = _Chunk(conv), number + 1
            if copies:
                chunk.add(None if turn is None else int(turn), role, text, copies, bool(later), bool(blank), bool(is_open), initial)
            if held >= CHUNK_BYTES or len(out) >= 2000:
                yield pd.DataFrame(out, columns=names)
                out, held = [], 0
    if chunk is not None:
        chunk.last_of_slice = True
        out.append(chunk.row(place, number, True))
    if out:
        yield pd.DataFrame(out, columns=names)


# -- from chunks to conversations --------------------------------------------------------

TOTALS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_TOTALS = [f.split()[0] for f in TOTALS.split(", ")]


def _total(chunks: list) -> tuple[dict, list[tuple[int, int]]]:
    """Sums of a conversation's chunks, and for each the vector behind it and the state before it."""
    t = tables()
    sums = {k: sum(int(getattr(c, k)) for c in chunks) for k in _SUMS}
    initial = turn = low = None
    for c in chunks:
        if len(c.symbols):
            if initial is not None:
                sums["illegal"] += (initial, int(c.first_initial)) not in _LEGAL
            initial = int(c.last_initial)
        if c.first_turn is not None:
            sums["turns"] -= turn is not None and turn == int(c.first_turn)
            low = int(c.first_turn) if low is None else low
            turn = int(c.last_turn)
    behind, cost, vectors = 0, 0, []
    for c in reversed(chunks):
        vectors.append(behind)
        cost += int(c.added[behind])
        behind = c.front[behind]
    states, q = [], 0
    for c, v in zip(chunks, reversed(vectors)):
        states.append((v, q))
        q = c.exits[4 * v + q] if c.exits else q
    n = sums.pop("turns")
    gaps = 0 if low is None else turn - low + 1 - n
    return {"gaps": gaps, **sums, "cost": cost + t.vectors[behind][0]}, states


def _text(turn: int | None) -> str | None:
    """Whole numbers beside nulls would become floating in a frame."""
    return None if turn is None else str(turn)


def _pieces(c, behind: int, q: int) -> tuple[list[str], list[str], int]:
    """Edits and repaired rows of one chunk, and the state behind it."""
    t = tables()
    edits, lines = [], []
    traced, end = t.trace(bytes(c.symbols), behind, q)
    for letters, extra, role, text in zip(traced, c.extra, c.roles, c.texts):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "I":
                lines.append(f"{NAME[q]}:")
                q = NEXT[q]
            elif letter == "R":
                lines.append(f"{NAME[q]}:{text}")
                q = NEXT[q]
            else:
                lines.append(f"{role}:{text}")
                q = STEP[q][INITIALS.index(role[0])]
        edits.append(letters + "D" * int(extra))
    return edits, lines, end


def _closed(edits: list[str], lines: list[str], q: int) -> None:
    for _ in tables().closing(q):
        edits.append("I")
        lines.append(f"{NAME[q]}:")
        q = NEXT[q]


WHOLE = f"conv string, {TOTALS}, audit string, repaired_sha256 string"
_WHOLE = [f.split()[0] for f in WHOLE.split(", ")]


def _alone(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations of one chunk."""
    for frame in frames:
        out = []
        for c in frame.itertuples(index=False):
            totals, _ = _total([c])
            edits, lines, q = _pieces(c, 0, 0)
            _closed(edits, lines, q)
            out.append((c.conv, *totals.values(), "".join(edits), hashlib.sha256("\n".join(lines).encode()).hexdigest()))
        yield pd.DataFrame(out, columns=_WHOLE)


def _by_conversation(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, Iterator]]:
    """Runs of rows with one ``conv``, each to be read before the next."""
    rows = (r for f in frames for r in f.itertuples(index=False))
    ahead = next(rows, None)
    while ahead is not None:
        conv = ahead.conv

        def run():
            nonlocal ahead
            while ahead is not None and ahead.conv == conv:
                row, ahead = ahead, next(rows, None)
                yield row

        yield conv, run()


FOLDED = f"conv string, slice bigint, number bigint, behind int, state int, final boolean, {TOTALS}"


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations of several chunks put together from the effects of their chunks, without rows."""
    for conv, run in _by_conversation(frames):
        chunks = list(run)
        totals, states = _total(chunks)
        rows = [(conv, c.slice, c.number, v, q, i == len(chunks) - 1, *totals.values()) for i, (c, (v, q)) in enumerate(zip(chunks, states))]
        yield pd.DataFrame(rows, columns=["conv", "slice", "number", "behind", "state", "final", *_TOTALS])


def _written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits and repaired text of each chunk of the long conversations."""
    names = ["conv", "slice", "number", *_TOTALS, "edits", "repaired", "rows"]
    for frame in frames:
        out = []
        for c in frame.itertuples(index=False):
            edits, lines, q = _pieces(c, int(c.behind), int(c.state))
            if c.final:
                _closed(edits, lines, q)
            out.append((c.conv, c.slice, c.number, *[getattr(c, k) for k in _TOTALS], "".join(edits), "\n".join(lines), len(lines)))
        yield pd.DataFrame(out, columns=names)


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of a long conversation, chunk by chunk: SHA-256 can't be put together from parts."""
    for conv, run in _by_conversation(frames):
        digest, edits, begun, totals = hashlib.sha256(), [], False, ()
        for c in run:
            totals = [getattr(c, k) for k in _TOTALS]
            edits.append(c.edits)
            if c.rows:
                digest.update((("\n" if begun else "") + c.repaired).encode())
                begun = True
        yield pd.DataFrame([(conv, *totals, "".join(edits), digest.hexdigest())], columns=_WHOLE)


def repaired(rows: DataFrame) -> DataFrame:
    """Audit and repair of conversations in the form of :func:`damaged`, one row for each id.

    Columns as in :func:`repair_rows`. Rows of one turn come by role, then by the MD5 of their text; copies lie together.
    """
    bounded_batches(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]
    named = [F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("none")).alias("conv"), F.col("turn").cast("string").alias("turn")]
    ordered = _ordered(rows).select(*named, "role", "text", "copies", "later", "blank", "open", "initial")
    chunks = store(ordered.mapInPandas(_packed, CHUNK), "chunks")
    several = store(chunks.groupBy("conv").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "long-conversations")
    alone = lookup(chunks, several, "conv", spread_by="slice", size_col="rows", how="left_anti").mapInPandas(_alone, WHOLE)
    effects = lookup(chunks.drop(*_BODY[1:]), several, "conv", spread_by="slice", size_col="rows")
    folded = effects.repartition("conv").sortWithinPartitions("conv", "slice", "number").mapInPandas(_folded, FOLDED)
    folded = folded.withColumn("chunk", F.concat_ws(":", "slice", "number", "conv")).drop("conv", "slice", "number")
    bodies = chunks.select("conv", "slice", "number", *_BODY, F.concat_ws(":", "slice", "number", "conv").alias("chunk"))
    long = lookup(bodies, folded, "chunk", spread_by="slice").mapInPandas(
        _written, f"conv string, slice bigint, number bigint, {TOTALS}, edits string, repaired string, rows bigint"
    )
    long = long.repartition("conv").sortWithinPartitions("conv", "slice", "number").mapInPandas(_joined, WHOLE)
    out = alone.unionByName(long)
    conv = F.when(F.col("conv") != "none", F.substr(F.col("conv"), F.lit(2))).cast(kind)
    return out.select(conv.alias("conv_id"), *[c for c in _WHOLE if c != "conv"])


def repair_rows(conversations: DataFrame) -> DataFrame:
    """Damage, audit and repair ``conversations``, one row for each id:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Nulls count as one blank; a null id is a conversation, null turns come first. A conversation
    without rows has zeros, an empty audit and the digest of an empty text; an empty table gives an
    empty table; further columns are ignored. Long texts are read whole.
    """
    return repaired(damaged(conversations))
