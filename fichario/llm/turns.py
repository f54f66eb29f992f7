"""Repair of conversations: the cheapest edits that give `(system? (user assistant)+)?`.

Every row is kept, given another role or deleted, and empty turns may be inserted. The cheapest way is
a shortest path through a layered graph of (row, state) nodes, found by a plain minimum of integers:
a weight is one big integer whose high digits are the cost and whose low digits, of fixed width, are
the audit letters from the left, with zeros behind the last letter. So the smallest weight is the
cheapest path and, among equals, the one with the ASCII-least audit, and nothing else decides.

A conversation is cut into pieces of at most PIECE rows along a range partitioning by (conversation,
turn), so that a conversation of any length is spread over tasks. A piece gives a table of weights from
every state to every state; tables are put together by the same integers, last piece first. This is
exact: two ways through a piece that cost the same hold as many row letters, so neither audit is a
beginning of the other (it would hold an insertion more, which costs), and what follows can't change
their order. The texts are then read once more in order, as a stream: neither a conversation's texts
nor its rows are ever held at once, only its audit, which is a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fichario.llm.common import saved, small_batches

PIECE = 256
START, SYSTEM, USER, ASSISTANT = range(4)
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
# What may follow: a system turn only at the start, then user and assistant in turns.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 0, 1, 2, 5, 5
LETTERS = "DIKR"  # ASCII order: digits 1 to 4, zero is the end
BITS = 3
FINE, CUT, GONE = range(3)  # of a row: kept as it is, truncated, to be deleted

PIECES = ("part int, seq long, n long, blank long, duplicate long, truncated long, illegal long, "
          "first string, last string, turns long, low long, high long, weights array<binary>")


def row_edges(initial: str, fault: int) -> list[tuple[int, int, int, int]]:
    """(state before, state after, cost, digit) of what may happen to a row."""
    edges = [(s, s, DELETE_COST, 1) for s in range(4)]
    if fault != GONE:
        more = CUT_COST if fault == CUT else 0
        for before, after in NEXT.items():
            edges.append((before, after, ROLE_COST + more, 4))
            if STATE_OF.get(initial) == after:
                edges.append((before, after, KEEP_COST + more, 3))
        if initial == "s":
            edges.append((START, SYSTEM, KEEP_COST + more, 3))
    return edges


EDGES = {(i, f): row_edges(i, f) for i in ("s", "u", "a", "") for f in (FINE, CUT, GONE)}


def piece_weights(rows: list[tuple[str, int]]) -> list[int | None]:
    """Weights of the best ways from state i to state j over rows (initial, fault), at 4 * i + j.

    At most one insertion before a row: two in a row never pay, as they lead back to the state they
    start from or cost more than to delete the system turn before them. So a way has at most two
    letters a row, the width of the low digits.
    """
    width = 2 * len(rows)
    digits = BITS * width
    mask, top = (1 << digits) - 1, digits - BITS

    def ahead(weight: int, cost: int, digit: int) -> int:
        low = weight & mask
        return weight - low + (cost << digits) + (digit << top) + (low >> BITS)

    table: list[int | None] = [None] * 16
    for goal in range(4):
        best: list[int | None] = [None] * 4
        best[goal] = 0
        for initial, fault in reversed(rows):
            new: list[int | None] = [None] * 4
            for before, after, cost, digit in EDGES[initial, fault]:
                if best[after] is not None:
                    weight = ahead(best[after], cost, digit)
                    if new[before] is None or weight < new[before]:
                        new[before] = weight
            best = list(new)
            for before, after in NEXT.items():
                if new[after] is not None:
                    weight = ahead(new[after], INSERT_COST, 2)
                    if best[before] is None or weight < best[before]:
                        best[before] = weight
        for begin in range(4):
            table[4 * begin + goal] = best[begin]
    return table


def joined(front: int, front_width: int, back: int, back_width: int) -> int:
    """Weight of a way followed by another; the width is the sum of both widths."""
    low = front & ((1 << BITS * front_width) - 1)
    zeros = ((low & -low).bit_length() - 1) // BITS if low else front_width
    back_low = back & ((1 << BITS * back_width) - 1)
    cost = (front >> BITS * front_width) + (back >> BITS * back_width)
    return (cost << BITS * (front_width + back_width)) + (low << BITS * back_width) + (back_low << BITS * zeros)


def solve(pieces: list[tuple[int, list[int | None]]]) -> tuple[int, str]:
    """Cost and audit of a conversation of pieces (rows, weights) in order."""
    best: list[int | None] = [0, None, (INSERT_COST << BITS) + 2, 0]  # after the last row; width 1
    width = 1
    for rows, table in reversed(pieces):
        new: list[int | None] = [None] * 4
        for begin in range(4):
            ways = [joined(table[4 * begin + k], 2 * rows, best[k], width) for k in range(4)
                    if table[4 * begin + k] is not None and best[k] is not None]
            new[begin] = min(ways, default=None)
        best, width = new, width + 2 * rows
    weight = best[START]
    low = weight & ((1 << BITS * width) - 1)
    digits = f"{low:0{width}o}".rstrip("0")
    return weight >> BITS * width, digits.translate(str.maketrans("1234", LETTERS))


class _Piece:
    def __init__(self):
        self.rows, self.illegal, self.turns = [], 0, 0
        self.blank = self.duplicate = self.truncated = 0
        self.first = self.last = self.low = self.high = None

    def add(self, initial: str, blank: bool, again: bool, cut: bool, turn: int | None) -> None:
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not (blank or again)
        self.rows.append((initial if initial in STATE_OF else "", GONE if blank or again else CUT if cut else FINE))
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def fields(self) -> tuple:
        weights = [None if w is None else w.to_bytes((w.bit_length() + 7) // 8, "big")
                   for w in piece_weights(self.rows)]
        return (len(self.rows), self.blank, self.duplicate, self.truncated, self.illegal, self.first,
                self.last, self.turns, self.low, self.high, weights)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of a task's rows, which are sorted; batches in, batches out."""
    part, out, held, conv, kind, seq = TaskContext.get().partitionId(), [], _Piece(), None, None, 0
    names = ("conv_id", "turn", "role", "blank", "cut", "again", "copies")
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for key, turn, role, blank, cut, again, copies in zip(*(batch.column(c).to_pylist() for c in names)):
            for copy in range(copies):
                if key != conv or len(held.rows) >= PIECE:
                    if held.rows:
                        out.append((conv, part, seq, *held.fields()))
                    conv, held, seq = key, _Piece(), seq + 1
                held.add(role[:1], blank, again or copy > 0, cut, turn)
        if out:
            yield _piece_batch(out, kind)
            out = []
    if held.rows:
        yield _piece_batch([(conv, part, seq, *held.fields())], kind)


def _piece_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, pa.int32(), *[pa.int64()] * 6, pa.string(), pa.string(), *[pa.int64()] * 3,
             pa.list_(pa.binary())]
    names = ["conv_id", *(f.split()[0] for f in PIECES.split(", "))]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(map(list, zip(*rows)), types)], names=names)


class _Walk:
    """One conversation: its pieces first, then its rows in order; gives the repaired turns."""

    def __init__(self):
        self.pieces: list[dict] = []
        self.audit: str | None = None
        self.at, self.state, self.cost = 0, START, 0

    def begin(self) -> None:
        if self.audit is None:
            self.cost, self.audit = solve([
                (p["n"], [None if w is None else int.from_bytes(w, "big") for w in p["weights"]])
                for p in self.pieces])
            for piece in self.pieces:
                piece["weights"] = None

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield NAMES[self.state], ""

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str]]:
        self.begin()
        for _ in range(copies):
            yield from self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = STATE_OF[role[0]]
                yield role, text
            elif letter == "R":
                self.state = NEXT[self.state]
                yield NAMES[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        self.begin()
        yield from self.inserted()

    def counts(self) -> dict[str, int]:
        total = {k: sum(p[k] for p in self.pieces) for k in ("blank", "duplicate", "truncated", "illegal")}
        total["illegal"] += sum(
            a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(self.pieces, self.pieces[1:]))
        numbered = [p for p in self.pieces if p["turns"]]
        turns = sum(p["turns"] for p in numbered) - sum(
            a["high"] == b["low"] for a, b in zip(numbered, numbered[1:]))
        total["gaps"] = numbered[-1]["high"] - numbered[0]["low"] + 1 - turns if numbered else 0
        return total


REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """('turn', conv, walk, role, text) per repaired turn and ('end', conv, walk) per conversation;
    None after each batch."""
    walk, conv, known = None, None, False
    for batch in batches:
        names = ("conv_id", "tag", "piece", "role", "text", "copies")
        for key, tag, piece, role, text, copies in zip(*(batch.column(c).to_pylist() for c in names)):
            if not known or key != conv:
                if known:
                    yield from (("turn", conv, walk, *t) for t in walk.end())
                    yield "end", conv, walk
                walk, conv, known = _Walk(), key, True
            if tag == 1:
                walk.pieces.append(piece)
            elif tag == 2:
                yield from (("turn", conv, walk, *t) for t in walk.row(role, text, copies))
        yield None
    if known:
        yield from (("turn", conv, walk, *t) for t in walk.end())
        yield "end", conv, walk
    yield None


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, digest, first, kind = [], hashlib.sha256(), True, None

    def kinds(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in source:
            kind = batch.schema.field("conv_id").type
            yield batch

    for event in _walked(kinds(batches)):
        if event is None:
            if rows:
                names = ["conv_id", *(f.split()[0] for f in REPORT.split(", "))]
                types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(map(list, zip(*rows)), types)], names=names)
                rows = []
        elif event[0] == "turn":
            digest.update(("" if first else "\n").encode())
            digest.update(f"{event[3]}:{event[4]}".encode("utf-8", "surrogatepass"))
            first = False
        else:
            _, conv, walk = event
            c = walk.counts()
            rows.append((conv, c["gaps"], c["blank"], c["duplicate"], c["truncated"], c["illegal"],
                         walk.cost, walk.audit, digest.hexdigest()))
            digest, first = hashlib.sha256(), True


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, place, kind = [], 0, None

    def kinds(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in source:
            kind = batch.schema.field("conv_id").type
            yield batch

    for event in _walked(kinds(batches)):
        if event is None:
            if rows:
                conv, at, role, text = map(list, zip(*rows))
                yield pa.RecordBatch.from_pydict({
                    "conv_id": pa.array(conv, kind), "turn": pa.array(at, pa.int64()),
                    "role": pa.array(role, pa.string()), "text": pa.array(text, pa.string())})
                rows = []
        elif event[0] == "turn":
            rows.append((event[1], place, event[3], event[4]))
            place += 1
        else:
            place = 0


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage by crc32 of `conv_id:turn`, modulo 20.

    0 drops the row, 1 empties its text, 2 takes `[.!?]` out of it, 3 repeats it, 4 sets role user.
    Nulls count as one space, in the key, the role and the text. Other columns do not stay.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key) % 20).alias("harm")).filter("harm <> 0")
    harm = F.col("harm")
    return rows.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(harm == 3, 2).otherwise(1).cast("long").alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, copies), equal ones as one, with their faults.

    A row is a duplicate if the conversation has its role and text at an earlier turn (a null turn comes
    first); the copies of a row are duplicates of it. Sums and minima are made before the shuffle; a
    text that fills a conversation is one row of the counted side of the join.
    """
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    one = one.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    first = rows.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("d")).agg(
        F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("least"))
    met = one.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                   & (F.col("digest") == F.col("d")))
    return met.select(
        "conv_id", "turn", "role", "text", "copies", "digest",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        (F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("least")))).alias("again"))


def _walk_input(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation: a mark, its pieces in order, its rows in order; sorted within tasks."""
    spark = conversations.sparkSession
    small_batches(spark, 2_000)
    marked = saved(_marked(rows), "turns")
    order = ["conv_id", "turn", "role", "digest"]
    kind = conversations.schema["conv_id"].dataType.simpleString()
    pieces = (
        marked.select(*order, "blank", "cut", "again", "copies")
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .drop("digest").mapInArrow(_pieces, f"conv_id {kind}, {PIECES}"))
    fields = [f.split()[0] for f in PIECES.split(", ")]
    shape = "struct<" + ", ".join(":".join(f.split(maxsplit=1)) for f in PIECES.split(", ")) + ">"
    none = F.lit(None)
    marks = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("tag"), none.cast("int").alias("part"), none.cast("long").alias("seq"),
        none.cast(shape).alias("piece"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("binary").alias("digest"), none.cast("string").alias("text"), none.cast("long").alias("copies"))
    parts = pieces.select(
        "conv_id", F.lit(1).alias("tag"), "part", "seq", F.struct(*fields).cast(shape).alias("piece"),
        none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"),
        none.cast("string").alias("text"), none.cast("long").alias("copies"))
    texts = marked.select(
        "conv_id", F.lit(2).alias("tag"), none.cast("int").alias("part"), none.cast("long").alias("seq"),
        none.cast(shape).alias("piece"), F.col("turn").cast("long").alias("turn"), "role", "digest", "text", "copies")
    both = marks.unionByName(parts).unionByName(texts)
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", "tag", "part", "seq", "turn", "role", "digest").drop("part", "seq", "turn", "digest")


def _rows(conversations: DataFrame, copies: bool = False) -> DataFrame:
    more = [F.lit(1).cast("long").alias("copies")] if not copies else ["copies"]
    blank = F.lit(" ")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), *more)


def report(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """What ails the conversations and what their repair costs, one row per conv_id.

    conversations (conv_id, turn, role, text) names the conversations; rows, if given, are their rows
    with `copies` (else the same table). Columns: conv_id, gaps in the turn numbers, blank, duplicate,
    truncated (each row's first fault), illegal neighbours, cost, audit (K keep, R other role, D delete,
    I insert) and repaired_sha256 of the repaired `role:text` lines. Rows go by turn, null turns first,
    then by role and digest of the text. Null roles and texts are one space. A null conv_id is a conversation of its own. A
    conversation without rows has zeros, an empty audit and the digest of the empty text; an empty table
    gives no rows. Repeated rows count as often as they come.
    """
    given = _rows(conversations) if rows is None else _rows(rows, copies=True)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return _walk_input(conversations.select("conv_id"), given).mapInArrow(_report, f"conv_id {kind}, {REPORT}")


def repaired(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """conv_id, turn (from 0), role, text of the repaired conversations; arguments and order as in
    report. Conversations with nothing left have no row."""
    given = _rows(conversations) if rows is None else _rows(rows, copies=True)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return _walk_input(conversations.select("conv_id"), given).mapInArrow(
        _turns, f"conv_id {kind}, turn long, role string, text string")
