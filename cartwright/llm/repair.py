r"""Conversation structure repair: the cheapest edits that give a well-formed turn order.

A conversation is well formed when its role initials match ``(s?(ua)+)?``. A turn may be
kept (free), get the role user or assistant (3) or be deleted (4); an empty user or
assistant turn may be inserted anywhere (3). Blank turns and repeats of an earlier turn
must go; a turn that ends without a full stop costs 3 unless it goes.

Wagner-Fischer alignment: the turns are aligned to the string of every feasible length of
the grammar, nearest length first. The cheapest alignment so far bounds the diagonals of
the next table (Ukkonen) and ends the search once the difference in length alone costs
more. Each table is traced back to its audit, the initials of its edits; equal costs are
decided by the smaller audit.

A long conversation is aligned ``SEGMENT`` turns at a time, from every state of the
grammar to every other, and the pieces are joined by the cheapest way through the states.
That loses nothing: of two alignments of a piece with equal cost and ends, no audit begins
with the other (they have as many letters besides the inserts, and an insert is never
free), so the smallest whole audit is made of smallest pieces. Pieces are made where a
range sort put the turns, so a conversation of any length is spread over tasks; only its
audit, one letter per turn, meets in one. The texts of a conversation are put together one
after the other in one task that holds a single turn.

Defined results: a null role or text is one space. Turns are ordered by turn (null first),
then role, then SHA-256 of the text. Rows without a conversation id form one conversation.
Repeats are found by role and SHA-256 of the text. Other columns are not read; an empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import store

DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
SEGMENT = 24
NEVER = 1 << 60

# States of the grammar: nothing yet, after s, after u, after a. The whole may end in
# the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FINAL = (START, AFTER_A)

SPACE = " \t\n\x0b\x0c\r"

Edits = tuple[int, str]  # cost, audit
Ways = dict[tuple[int, int], Edits]  # by the states before and after


# ---- alignment ---------------------------------------------------------------------


def _shift(k: int) -> int:
    """Least cost of k more turns than before."""
    return INSERT * k if k > 0 else -DELETE * k


def _match_cost(unit: str, wanted: str) -> int:
    """Cost of making a turn the wanted one without deleting it."""
    if unit == "-":
        return NEVER
    extra = CUT_OFF if unit.isupper() else 0
    if unit.lower() == wanted:
        return extra
    return NEVER if wanted == "s" else REROLE + extra


MATCH = {u + w: _match_cost(u, w) for u in "suaoSUAO-" for w in "sua"}


def align(units: str, target: str, most: int) -> Edits | None:
    """Cheapest edits of ``units`` into ``target`` and the smallest audit of them; None
    if they cost more than ``most``.

    A unit is the initial of a turn, o for other roles, in capitals when the turn is cut
    off, and - when it must go.
    """
    m, n = len(units), len(target)
    low, high = min(0, n - m), max(0, n - m)
    if _shift(n - m) > most:
        return None
    while _shift(low - 1) + _shift(n - m - low + 1) <= most:
        low -= 1
    while _shift(high + 1) + _shift(n - m - high - 1) <= most:
        high += 1
    width = high - low + 1
    # table[i][j - i - low + 1]: cost of the edits from turn i and target place j on.
    table: list[list[int]] = [[]] * (m + 1)
    below = [NEVER] * (width + 2)
    for i in range(m, -1, -1):
        here = [NEVER] * (width + 2)
        for at in range(min(width, n - i - low + 1), max(0, -i - low), -1):
            j = i + low + at - 1
            if i == m and j == n:
                here[at] = 0
                continue
            best = NEVER
            if j < n and target[j] != "s":
                best = here[at + 1] + INSERT
            if i < m:
                best = min(best, below[at - 1] + DELETE)
                if j < n:
                    best = min(best, below[at] + MATCH[units[i] + target[j]])
            here[at] = min(best, NEVER)
        table[i] = below = here
    cost = table[0][1 - low]
    if cost > most or cost >= NEVER:
        return None
    i = j = 0
    audit = []
    while i < m or j < n:
        at = j - i - low + 1
        left = table[i][at]
        if i < m and table[i + 1][at - 1] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < n and target[j] != "s" and table[i][at + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if units[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def targets(start: int, end: int, lengths: range, system: bool) -> list[str]:
    """The strings of the given lengths that lead from one state to the other."""
    found = []
    for n in lengths:
        if n == 0:
            found += [""] if start == end else []
            continue
        opens = ["a"] if start == AFTER_U else ["u"]
        if start == START and system:
            opens.append("s")
        for first in opens:
            rest = "ua" if first in "sa" else "au"
            text = first + (rest * n)[: n - 1]
            if "sua".index(text[-1]) + 1 == end:
                found.append(text)
    return found


def cheapest(units: str, start: int, end: int) -> Edits | None:
    """The best edits of ``units`` between two states, over all lengths that can compete."""
    m = len(units)
    system = "s" in units or "S" in units
    candidates = targets(start, end, range(3 * m + 6), system)
    best: Edits | None = None
    for target in sorted(candidates, key=lambda t: (_shift(len(t) - m), t)):
        away = _shift(len(target) - m)
        if best is not None and away > best[0]:
            break
        whole = DELETE * m + INSERT * len(target) + CUT_OFF
        most = best[0] if best is not None else away + DELETE + INSERT
        found = align(units, target, most)
        while found is None and best is None and most < whole:
            most = min(2 * most, whole)
            found = align(units, target, most)
        if found is not None and (best is None or found < best):
            best = found
    return best


@lru_cache(maxsize=50_000)
def segment_ways(units: str) -> Ways:
    found = {(p, q): cheapest(units, p, q) for p in range(4) for q in range(4)}
    return {states: edits for states, edits in found.items() if edits is not None}


@lru_cache(maxsize=100_000)
def whole_edits(units: str) -> Edits:
    """The edits of a whole conversation of at most ``SEGMENT`` turns."""
    return min(e for q in FINAL if (e := cheapest(units, START, q)) is not None)


def join_ways(parts: list[Ways], starts: tuple[int, ...], ends: tuple[int, ...]) -> Ways:
    """The ways through all parts, one after the other, for the given outer states."""
    out: Ways = {}
    for end in ends:
        cost = [[NEVER] * 4 for _ in parts] + [[0 if q == end else NEVER for q in range(4)]]
        for i in range(len(parts) - 1, -1, -1):
            for (p, q), (c, _) in parts[i].items():
                cost[i][p] = min(cost[i][p], c + cost[i + 1][q])
        for start in starts:
            if cost[0][start] >= NEVER:
                continue
            state, audits = start, []
            for i, ways in enumerate(parts):
                audit, state = min(
                    (a, q)
                    for (p, q), (c, a) in ways.items()
                    if p == state and c + cost[i + 1][q] == cost[i][p]
                )
                audits.append(audit)
            out[start, end] = cost[0][start], "".join(audits)
    return out


# ---- turns to pieces ---------------------------------------------------------------


def _rows(turns: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("h"),
    )


ORDER = ["conv_id", "turn", "role", "h"]


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])


def _units(rows: DataFrame) -> DataFrame:
    """Equal turns of a conversation as one row: how many, what they are, and whether an
    equal turn with another number comes earlier."""
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    units = (
        rows.select(
            *ORDER,
            kind.alias("kind"),
            (body == "").alias("blank"),
            (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        )
        .groupBy(*ORDER, "kind", "blank", "cut")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("at")
    firsts = units.groupBy("conv_id", "role", "h").agg(earliest)
    firsts = firsts.select("conv_id", F.col("at.turn").alias("turn"), "role", "h")
    return (
        units.alias("u")
        .join(firsts.alias("f"), _same("u", "f", ORDER), "left")
        .select("u.*", F.col("f.h").isNotNull().alias("first"))
    )


PIECE = (
    "conv_id long, shard int, n long, blank long, duplicate long, truncated long, "
    "illegal long, opens string, closes string, low long, high long, numbers long, "
    "ways array<struct<start: int, end: int, cost: long, audit: string>>"
)
PIECE_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("shard", pa.int32()),
        *((c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")),
        ("opens", pa.string()),
        ("closes", pa.string()),
        *((c, pa.int64()) for c in ("low", "high", "numbers")),
        (
            "ways",
            pa.list_(
                pa.struct(
                    [
                        ("start", pa.int32()),
                        ("end", pa.int32()),
                        ("cost", pa.int64()),
                        ("audit", pa.string()),
                    ]
                )
            ),
        ),
    ]
)


class Piece:
    """Turns of one conversation that lie in one partition."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.opens = self.closes = ""
        self.low: int | None = None
        self.high: int | None = None
        self.segments: list[str] = []
        self.open_units = ""

    def add(self, turn, kind: str, blank: bool, cut: bool, first: bool, copies: int) -> None:
        if turn is not None and turn != self.high:
            self.numbers += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.n and self.closes + kind not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1
        self.opens = self.opens or kind
        self.closes = kind
        self.n += copies
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - first
            self.truncated += first and cut
        lead = "-" if blank or not first else kind.upper() if cut else kind
        units = self.open_units + lead + "-" * (copies - 1)
        whole = len(units) - len(units) % SEGMENT
        self.segments += [units[i : i + SEGMENT] for i in range(0, whole, SEGMENT)]
        self.open_units = units[whole:]

    def row(self, complete: bool) -> dict:
        units = [*self.segments, *filter(None, [self.open_units])]
        if complete and len(units) == 1:
            # Where a whole conversation ends does not matter any more.
            ways = {(START, AFTER_A): whole_edits(units[0])}
        else:
            states = (START,) if complete else (START, AFTER_S, AFTER_U, AFTER_A)
            ends = FINAL if complete else states
            ways = join_ways([segment_ways(u) for u in units], states, ends)
        out = {c: getattr(self, c) for c in PIECE_ARROW.names if hasattr(self, c)}
        names = ("start", "end", "cost", "audit")
        out["ways"] = [dict(zip(names, (*k, *v), strict=True)) for k, v in ways.items()]
        return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a sorted partition. The first and the last may go on
    in other partitions, so all their ways are kept."""
    shard = TaskContext.get().partitionId()
    piece: Piece | None = None
    done: list[dict] = []
    closed = 0
    for batch in batches:
        for conv_id, *unit in zip(*(batch.column(c).to_pylist() for c in UNIT), strict=True):
            if piece is None or conv_id != piece.conv_id:
                if piece is not None:
                    done.append(piece.row(complete=closed > 0))
                    closed += 1
                piece = Piece(conv_id)
            piece.add(*unit)
        if done:
            yield _piece_batch(done, shard)
            done = []
    if piece is not None:
        yield _piece_batch([piece.row(complete=False)], shard)


UNIT = ["conv_id", "turn", "kind", "blank", "cut", "first", "copies"]


def _piece_batch(rows: list[dict], shard: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{**r, "shard": shard} for r in rows], PIECE_ARROW)


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)
AUDIT_ARROW = pa.schema(
    [
        *((c.split()[0], pa.int64()) for c in AUDIT.split(", ")[:-1]),
        ("audit", pa.string()),
    ]
)
COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _together(pieces: list[dict]) -> dict:
    """The pieces of one conversation, in order, as its result."""
    out = {c: sum(r[c] for r in pieces) for c in COUNTS}
    for a, b in pairwise(pieces):
        out["illegal"] += a["closes"] + b["opens"] not in ("su", "ua", "au")
    numbered = [r for r in pieces if r["low"] is not None]
    distinct = sum(r["numbers"] for r in numbered)
    distinct -= sum(a["high"] == b["low"] for a, b in pairwise(numbered))
    out["gaps"] = numbered[-1]["high"] - numbered[0]["low"] + 1 - distinct if numbered else 0
    parts = [{(w["start"], w["end"]): (w["cost"], w["audit"]) for w in r["ways"]} for r in pieces]
    out["cost"], out["audit"] = min(join_ways(parts, (START,), FINAL).values())
    return out | {"conv_id": pieces[0]["conv_id"]}


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces: list[dict] = []
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if pieces and row["conv_id"] != pieces[0]["conv_id"]:
                done.append(_together(pieces))
                pieces = []
            pieces.append(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, AUDIT_ARROW)
    if pieces:
        yield pa.RecordBatch.from_pylist([_together(pieces)], AUDIT_ARROW)


def audit_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: gaps in its turn numbers, faults by kind, illegal
    neighbours, the cost of the cheapest repair and its audit."""
    ordered = _units(_rows(turns)).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    pieces = store(ordered.select(*UNIT).mapInArrow(_pieces, PIECE), "repair")
    gathered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "shard")
    return gathered.mapInArrow(_join_pieces, AUDIT)


# ---- repaired turns ----------------------------------------------------------------

TURN = "conv_id long, place long, edit string, role string, text string"
TURN_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("edit", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)
ROLES = {"u": "user", "a": "assistant"}


def wanted(place: int, length: int) -> str:
    """Initial at a place of the well-formed string of a length."""
    if length % 2:
        return "s" if place == 0 else "au"[place % 2]
    return "ua"[place % 2]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that the audits leave. Each audit comes right before its turns."""
    audit, at, place, length, conv_id = "", 0, 0, 0, None
    out: list[tuple] = []

    def inserts() -> None:
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            out.append((conv_id, place, "I", ROLES[wanted(place, length)], ""))
            at, place = at + 1, place + 1

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))
        for conv, new_audit, role, text in zip(*columns, strict=True):
            if new_audit is not None:
                audit, at, place, conv_id = new_audit, 0, 0, conv
                length = len(audit) - audit.count("D")
                inserts()
                continue
            edit = audit[at]
            at += 1
            if edit != "D":
                kept = role if edit == "K" else ROLES[wanted(place, length)]
                out.append((conv_id, place, edit, kept, text))
                place += 1
            inserts()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), TURN_ARROW.types)],
                schema=TURN_ARROW,
            )
            out.clear()


def apply_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 0), edit (K, R or I), role and text.

    The turns of a conversation come one after the other, in order, in one partition.
    """
    rows = _rows(turns).withColumn("audit", F.lit(None).cast("string"))
    heads = audits.select("conv_id", "audit")
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn(
        "later", F.col("audit").isNull()
    )
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "later", *ORDER[1:])
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(_apply, TURN)


DIGEST = "conv_id long, repaired_sha256 string"


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of the repaired turns as ``role:text`` lines, for conversations that have
    any. Reads the partitions of ``apply_audits`` as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def closed() -> tuple:
            return last, state.hexdigest()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            ids, hashes = zip(*rows, strict=True)
            arrays = [pa.array(ids, pa.int64()), pa.array(hashes, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))
            for conv_id, place, role, text in zip(*columns, strict=True):
                if place == 0:
                    if state is not None:
                        done.append(closed())
                    last, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([closed()])

    return repaired.mapInArrow(run, DIGEST)


def repair_conversations(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Audit and digest of every ``conv_id`` of ``conversations``; one without turns has
    zeros, an empty audit and the digest of nothing."""
    audits = store(audit_conversations(turns), "audits")
    repaired = digests(apply_audits(turns, audits))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    names = [c.split()[0] for c in AUDIT.split(", ")][1:]
    nothing = {c: F.lit("") if c == "audit" else F.lit(0).cast("long") for c in names}
    nothing["repaired_sha256"] = F.lit(hashlib.sha256().hexdigest())
    joined = (
        ids.alias("i")
        .join(audits.alias("a"), _same("i", "a", ["conv_id"]), "left")
        .join(repaired.alias("r"), _same("i", "r", ["conv_id"]), "left")
    )
    return joined.select("i.conv_id", *(F.coalesce(F.col(c), d).alias(c) for c, d in nothing.items()))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by a checksum of conversation and turn number: of twenty,
    one is dropped, one emptied, one loses its full stops, one is repeated and one gets
    the role user. Nulls count as one space, but a null turn stays null."""

    def or_space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    action = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = (
        F.when(action == 1, F.lit(""))
        .when(action == 2, F.regexp_replace(or_space("text"), "[.!?]", ""))
        .otherwise(or_space("text"))
    )
    copies = F.when(action == 0, 0).when(action == 3, 2).otherwise(1)
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(action == 4, F.lit("user")).otherwise(or_space("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")
