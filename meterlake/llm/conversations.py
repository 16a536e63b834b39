"""Repair of conversations: the cheapest edits that give each the form system?, (user, assistant)+.

The edits of a conversation form its audit, one letter an edit; of equally cheap audits the least by ASCII
counts. They are found by dynamic programming over the rows and the four states of the form. The audits of
all states share their prefixes as linked nodes (``Audits``), so a step costs one node a state.

A conversation need not fit into a task. Rows are sorted by range, so a long conversation spans partitions,
and are cut into segments of bounded size. What a segment costs between any two states does not depend on
the others: segments are solved apart, then folded in order, then edited apart.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.lookup import lookup_join
from ..session import settle, settle_measured
from ..sources.tables import ROW_ID

# The rules of the repair.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; an undeleted truncated row adds the last
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
_LEGAL = frozenset(["su", "ua", "au"])

# States: nothing yet, after system, after user, after assistant. A conversation may end in the first or last.
_STATES = range(4)
_FINAL = (0, 3)
_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_NEXT = (2, 2, 3, 2)  # where a row of the only fitting role of user and assistant leads
_ROLE = {2: "user", 3: "assistant"}

SEGMENT_ROWS = 4096
SEGMENT_BYTES = 8 << 20


class Audits:
    """Strings that grow at the end and share their beginnings: node 0 is the empty one, each other node a
    string one letter longer than its parent. A node has a rolling hash and its ancestors at the distances
    1, 2, 4, ..., so two strings are compared at the end of their longest common prefix, found by bisection
    over the ancestors. Equal hashes are verified letter by letter, up to the node where both meet."""

    def __init__(self, base: int = 0x1F35B7C3, modulus: int = (1 << 61) - 1):
        self._base, self._modulus = base, modulus
        self._letter, self._depth, self._hash = [""], [0], [0]
        self._up: list[tuple[int, ...]] = [()]

    def add(self, parent: int, letter: str) -> int:
        ups, far = [parent], 0
        while len(self._up[ups[far]]) > far:
            ups.append(self._up[ups[far]][far])
            far += 1
        self._letter.append(letter)
        self._depth.append(self._depth[parent] + 1)
        self._hash.append((self._hash[parent] * self._base + ord(letter)) % self._modulus)
        self._up.append(tuple(ups))
        return len(self._letter) - 1

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self._letter[node])
            node = self._up[node][0]
        return "".join(reversed(out))

    def _lift(self, node: int, depth: int) -> int:
        while self._depth[node] > depth:
            far = (self._depth[node] - depth).bit_length() - 1
            node = self._up[node][far]
        return node

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """Nodes of the first letter in which two strings of one length differ, letter by letter from the
        end to the node that both share."""
        found = None
        while a != b:
            if self._letter[a] != self._letter[b]:
                found = a, b
            a, b = self._up[a][0], self._up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the string of a comes before that of b; a beginning comes before the whole."""
        depth = min(self._depth[a], self._depth[b])
        x, y = self._lift(a, depth), self._lift(b, depth)
        if x == y:
            return self._depth[a] < self._depth[b]
        if self._hash[x] == self._hash[y]:
            differ = self._first_difference(x, y)
        else:
            for far in reversed(range(len(self._up[x]))):
                # Lifting makes the lists shorter; those of x and y are always of one length.
                if far < len(self._up[x]):
                    p, q = self._up[x][far], self._up[y][far]
                    if self._hash[p] != self._hash[q]:
                        x, y = p, q
            before = self._first_difference(self._up[x][0], self._up[y][0])
            differ = before or (x, y)
        if differ is None:
            return self._depth[a] < self._depth[b]
        return self._letter[differ[0]] < self._letter[differ[1]]


class Turn(NamedTuple):
    """What the search needs to know of a row: its role's initial, and whether it must go or is cut off."""

    initial: str
    must_go: bool
    truncated: bool


def search(turns: Sequence[Turn], start: int, audits: Audits | None = None) -> dict[int, tuple[int, str]]:
    """Cost and audit of the cheapest edits from a state to each state that can be reached."""
    audits = audits or Audits()
    Best = dict[int, tuple[int, int]]

    def offer(best: Best, state: int, cost: int, parent: int, letter: str) -> bool:
        old = best.get(state)
        if old is not None and old[0] < cost:
            return False
        node = audits.add(parent, letter)
        if old is not None and old[0] == cost and not audits.less(node, old[1]):
            return False
        best[state] = cost, node
        return True

    def with_inserts(best: Best) -> Best:
        changed = True
        while changed:
            changed = False
            for state in _STATES:
                if state in best:
                    cost, node = best[state]
                    changed |= offer(best, _NEXT[state], cost + INSERT, node, "I")
        return best

    best = with_inserts({start: (0, 0)})
    for turn in turns:
        after: Best = {}
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE, node, "D")
            if not turn.must_go:
                stays = cost + TRUNCATED * turn.truncated
                kept = _KEEP.get((turn.initial, state))
                if kept is not None:
                    offer(after, kept, stays, node, "K")
                offer(after, _NEXT[state], stays + REROLE, node, "R")
        best = with_inserts(after)
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def edited(audit: str, start: int, rows: Sequence[tuple]) -> Iterator[tuple[str, object, str, str]]:
    """(edit, turn, role, text) of each edit of an audit, from the rows (turn, role, text) it was made for."""
    state, given = start, iter(rows)
    for edit in audit:
        turn, role, text = (None, "", "") if edit == "I" else next(given)
        if edit in "IR":
            state = _NEXT[state]
            role = _ROLE[state]
        elif edit == "K":
            state = _KEEP[role[:1], state]
        yield edit, turn, role, text


class Tally(NamedTuple):
    """What a stretch of a conversation adds to its report: roles at both ends, the least, greatest and number
    of its turns, which come in order, and its faults."""

    first: str
    last: str
    low: int | None
    high: int | None
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int

    def gaps(self) -> int | None:
        """Turns missing between the least and the greatest; null if that is beyond a long."""
        missing = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return missing if missing < 1 << 63 else None


def tally(rows: Sequence[tuple]) -> Tally:
    initials = [role[:1] for _, role, _, _ in rows]
    turns = sorted({turn for turn, _, _, _ in rows if turn is not None})
    faults = [fault for _, _, _, fault in rows]
    return Tally(
        initials[0],
        initials[-1],
        turns[0] if turns else None,
        turns[-1] if turns else None,
        len(turns),
        *[faults.count(name) for name in ("blank", "duplicate", "truncated")],
        sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
    )


def chained(a: Tally, b: Tally) -> Tally:
    """Of two stretches that follow one another."""
    return Tally(
        a.first,
        b.last,
        b.low if a.low is None else a.low,
        a.high if b.high is None else b.high,
        a.turns + b.turns - (a.high is not None and a.high == b.low),
        a.blank + b.blank,
        a.duplicate + b.duplicate,
        a.truncated + b.truncated,
        a.illegal + b.illegal + (a.last + b.first not in _LEGAL),
    )


def _outcome(of: Tally, cost: int, audit: str, sha256: str | None) -> dict:
    counts = {name: getattr(of, name) for name in ("blank", "duplicate", "truncated", "illegal")}
    return {"gaps": of.gaps(), **counts, "cost": cost, "audit": audit, "sha256": sha256}


class Digest:
    """SHA-256 of lines joined by newlines, taken line by line."""

    def __init__(self):
        self._hash, self._first = hashlib.sha256(), True

    def add(self, edit: str, role: str, text: str) -> None:
        if edit != "D":
            self._hash.update(("" if self._first else "\n").encode() + f"{role}:{text}".encode())
            self._first = False

    def hex(self) -> str:
        return self._hash.hexdigest()


# Faults -----------------------------------------------------------------------------------------------
def mark(
    rows: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    row_id: Sequence[str] = ROW_ID,
) -> DataFrame:
    """Rows under the names conv, turn, role, text and ``row_id``, with their first fault: blank, duplicate
    (role and text of an earlier row of the conversation), truncated (does not end in a full stop,
    exclamation or question mark), or null; ``said`` is a hash of conversation, role and text. A null role
    or text is one space, a null conversation one of its own. ``row_id`` tells copies of a row apart.

    Texts stay where they are: only hashes are counted, and rows look up whether theirs came before. Hashes
    of repeated rows are broadcast up to a measured size and joined with salt beyond it.
    """
    picked = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
        *row_id,
    )
    name = F.col("conv").cast("string")
    parts = [F.coalesce(F.length(name), F.lit(-1)), F.coalesce(name, F.lit("")), F.length("role"), F.col("role")]
    said = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts], F.col("text")), 256)
    hashed = picked.withColumn("said", said)
    place = F.struct("turn", *row_id)
    first = (
        hashed.groupBy("said")
        .agg(F.count("*").alias("n"), F.min(place).alias("_first"))
        .where("n > 1")
        .select("said", *[F.col(f"_first.{c}").alias(f"_first_{c}") for c in ("turn", *row_id)])
    )
    known = lookup_join(hashed, settle_measured(first, "said-twice"), ["said"], spread_by=row_id)
    earliest = F.struct(*[F.col(f"_first_{c}").alias(c) for c in ("turn", *row_id)])
    body = F.rtrim("text", F.lit(_BLANKS))
    fault = (
        F.when(body == "", "blank")
        .when(F.col(f"_first_{row_id[0]}").isNotNull() & (place > earliest), "duplicate")
        .when(~F.substring(body, -1, 1).isin(*_ENDS), "truncated")
    )
    return known.select("conv", "turn", "role", "text", "said", *row_id, fault.alias("fault"))


# Segments ---------------------------------------------------------------------------------------------
class Segment(NamedTuple):
    conv: object
    number: int
    rows: list[tuple]  # turn, role, text, fault
    closed: bool  # holds a whole conversation


def segments(rows: Iterable[tuple], most_rows: int, most_bytes: int) -> Iterator[Segment]:
    """Cut sorted rows (conversation, turn, role, text, fault) of one partition. The first and the last
    conversation may go on in other partitions, and a longer one goes on in the next segment: these are not
    closed."""
    held: list[tuple] = []
    number = size = 0
    conv, whole = object(), False  # whole: the conversation began in the segment held
    for key, *row in rows:
        if key != conv and held:
            yield Segment(conv, number, held, whole)
            held, size, number, whole = [], 0, number + 1, True
        elif held and (len(held) >= most_rows or size >= most_bytes):
            yield Segment(conv, number, held, False)
            held, size, number, whole = [], 0, number + 1, False
        conv = key
        held.append(tuple(row))
        size += len(row[2])
    if held:
        yield Segment(conv, number, held, False)


def turns_of(rows: Iterable[tuple]) -> list[Turn]:
    return [Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for _, role, _, fault in rows]


_PATHS = "array<struct<from_state: int, to_state: int, cost: bigint, audit: string>>"
_SEGMENT = (
    "struct<first: string, last: string, low: bigint, high: bigint, turns: bigint, blank: bigint, "
    f"duplicate: bigint, truncated: bigint, illegal: bigint, paths: {_PATHS}>"
)
_WHOLE = (
    "struct<gaps: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, "
    "audit: string, sha256: string>"
)


def _schema(ddl: str, **types: T.DataType) -> T.StructType:
    """Columns of a DDL in which ``conv`` and ``turn`` stand for the types of the table."""
    fields = T.StructType.fromDDL(ddl)
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in fields])


_EDIT = "conv int, part int, seg bigint, nth bigint, edit string, turn int, role string, text string"


def _stream(
    frame: DataFrame, schema: T.StructType, made: Callable[[Iterator[tuple]], Iterator[tuple]], batch: int = 512
) -> DataFrame:
    """Rows that a generator makes from a task's rows in their order, a batch at a time."""
    arrow = to_arrow_schema(schema)

    def rows(batches):
        for part in batches:
            # Slices, so that few rows at a time are Python objects.
            for at in range(0, part.num_rows, batch):
                yield from zip(*[c.to_pylist() for c in part.slice(at, batch).columns], strict=True)

    def pack(held):
        columns = zip(*held, strict=True) if held else [[]] * len(arrow)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
        )

    def run(batches):
        held = []
        for row in made(rows(batches)):
            held.append(row)
            if len(held) >= batch:
                yield pack(held)
                held = []
        yield pack(held)

    return frame.mapInArrow(run, schema)


def _solve(most_rows: int, most_bytes: int) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Of closed segments the edits, with cost, audit and digest on the last; of others the rows, with what
    the segment costs between any two states on the last."""

    def made(rows):
        part = TaskContext.get().partitionId()
        for conv, number, held, closed in segments(rows, most_rows, most_bytes):
            turns, counted = turns_of(held), tally(held)
            here = conv, part, number
            if closed:
                reached = search(turns, 0)
                cost, audit = min(reached[state] for state in _FINAL if state in reached)
                out, digest = list(edited(audit, 0, [row[:3] for row in held])), Digest()
                for edit, _, role, text in out:
                    digest.add(edit, role, text)
                whole = _outcome(counted, cost, audit, digest.hex())
                for nth, row in enumerate(out):
                    last = nth == len(out) - 1
                    yield *here, nth, *row, None, None, whole if last else None
            else:
                paths = [
                    {"from_state": a, "to_state": b, "cost": cost, "audit": audit}
                    for a in _STATES
                    for b, (cost, audit) in search(turns, a).items()
                ]
                ends = {**counted._asdict(), "paths": paths}
                for nth, (turn, role, text, fault) in enumerate(held):
                    last = nth == len(held) - 1
                    yield *here, nth, None, turn, role, text, fault, ends if last else None, None

    return made


def _runs(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows with equal first columns. Each run must be used up before the next."""
    from itertools import groupby

    yield from groupby(rows, key=lambda row: row[:width])


def _fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Chain the segments of each conversation: the states between which each is passed, and on the last
    one cost and audit of the whole. What all states agree on leaves the comparison, so little is held but
    the audit itself."""
    for (conv,), parts in _runs(rows, 1):
        front, settled, back, places = {0: (0, "")}, [], [], []
        counted = None
        for _, part, number, segment in parts:
            after, came = {}, {}
            for path in segment["paths"]:
                if path["from_state"] in front:
                    cost, tail = front[path["from_state"]]
                    offer = cost + path["cost"], tail + path["audit"]
                    if path["to_state"] not in after or offer < after[path["to_state"]]:
                        after[path["to_state"]] = offer
                        came[path["to_state"]] = path["from_state"]
            shared = len(os.path.commonprefix([tail for _, tail in after.values()]))
            settled.append(next(iter(after.values()))[1][:shared])
            front = {state: (cost, tail[shared:]) for state, (cost, tail) in after.items()}
            back.append(came)
            places.append((part, number))
            here = Tally(*[segment[name] for name in Tally._fields])
            counted = here if counted is None else chained(counted, here)
        state = min((s for s in _FINAL if s in front), key=front.get)
        cost, tail = front[state]
        audit = "".join(settled) + tail
        for at in reversed(range(len(places))):
            origin = back[at][state]
            last = at == len(places) - 1
            whole = _outcome(counted, cost, audit, None) if last else None
            yield conv, *places[at], origin, state, whole
            state = origin


def _edit(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of each segment between the states that the fold has found."""
    for _, held in _runs(rows, 2):
        held = list(held)
        part, number, conv, start, end = held[0][:5]
        rest = [row[5:] for row in held]
        _, audit = search(turns_of(rest), start)[end]
        for nth, row in enumerate(edited(audit, start, [r[:3] for r in rest])):
            yield conv, part, number, nth, *row


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    for (conv,), lines in _runs(rows, 1):
        digest = Digest()
        for _, edit, role, text in lines:
            digest.add(edit, role, text)
        yield conv, digest.hex()


class Repaired(NamedTuple):
    """``edits``: one row an edit, in the order conv, part, seg, nth: (edit, turn, role, text), role and
    text as after the edit; those but "D" are the repaired conversation. ``report``: one row a conversation."""

    edits: DataFrame
    report: DataFrame


def repair(marked: DataFrame, *, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> Repaired:
    """Repair conversations whose rows ``mark`` has judged.

    Edits: keep a row (free), give it the role user or assistant (1), delete it (2, a must for a blank or
    duplicate row), insert an empty row of either role (5); a truncated row that stays costs 5 more. Rows go
    by turn, nulls first, then role, then a hash of the text. The report has conv, gaps (turns missing
    between the least and the greatest), the numbers of blank, duplicate and truncated rows and of illegal
    neighbours, cost, audit, and repaired_sha256 of the repaired lines ``role:text``. A conversation of
    which all rows are deleted has the hash of nothing. No rows give no report.

    Texts are shuffled once, by range; a task holds one segment. Only conversations at the border of two
    partitions, or longer than a segment, are folded and edited in a second step. The digest of a
    conversation goes through its lines one after the other, by its nature, holding none.
    """
    order = ["conv", "turn", "role", "said", *[c for c in marked.columns if c not in _MARKED]]
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    conv, turn = marked.schema["conv"].dataType, marked.schema["turn"].dataType
    solved = settle(
        _stream(
            sorted_rows.select("conv", "turn", "role", "text", "fault"),
            _schema(f"{_EDIT}, fault string, segment {_SEGMENT}, whole {_WHOLE}", conv=conv, turn=turn),
            _solve(segment_rows, segment_bytes),
        ),
        "conversation-edits",
    )
    names = ["conv", "part", "seg", "nth", "edit", "turn", "role", "text"]

    open_segments = solved.where("segment IS NOT NULL").select("conv", "part", "seg", "segment")
    folded = settle(
        _stream(
            open_segments.repartition("conv").sortWithinPartitions("conv", "part", "seg"),
            _schema(f"conv int, part int, seg bigint, from_state int, to_state int, whole {_WHOLE}", conv=conv),
            _fold,
        ),
        "conversation-paths",
    )
    paths = settle_measured(folded.select("part", "seg", "from_state", "to_state"), "conversation-states")
    open_rows = solved.where("edit IS NULL").select("conv", "part", "seg", "nth", "turn", "role", "text", "fault")
    passed = lookup_join(open_rows, paths, ["part", "seg"], spread_by=["nth"])
    edited_later = settle(
        _stream(
            passed.repartition("part", "seg")
            .sortWithinPartitions("part", "seg", "nth")
            .select("part", "seg", "conv", "from_state", "to_state", "turn", "role", "text", "fault"),
            _schema(_EDIT, conv=conv, turn=turn),
            _edit,
        ),
        "conversation-edits-later",
    )
    digests = _stream(
        edited_later.repartition("conv").sortWithinPartitions("conv", "part", "seg", "nth").select(
            "conv", "edit", "role", "text"
        ),
        _schema("conv int, sha256 string", conv=conv),
        _digests,
    )
    whole = [f.name for f in T.StructType.fromDDL(f"whole {_WHOLE}")["whole"].dataType]
    at_once = solved.where("whole IS NOT NULL").select("conv", "whole.*")
    later = folded.where("whole IS NOT NULL").select("conv", "whole.*")
    outcome = at_once.unionByName(later).unionByName(digests, allowMissingColumns=True)
    report = outcome.groupBy("conv").agg(*[F.max(c).alias(c) for c in whole])
    edits = solved.where("edit IS NOT NULL").select(*names).unionByName(edited_later.select(*names))
    return Repaired(edits, report.withColumnRenamed("sha256", "repaired_sha256"))


_MARKED = ("conv", "turn", "role", "text", "said", "fault")


# Damage -----------------------------------------------------------------------------------------------
def damaged(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            row_id: Sequence[str] = ROW_ID) -> DataFrame:
    """Rows with faults put in by the hash of conversation and turn: of twenty, one is dropped, one emptied,
    one loses its marks of sentence ends, one is repeated, and one becomes the user's. Nulls count as one
    space. Columns: as given, with ``copy`` (0, or 1 for the second of a repeated row)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = F.crc32(name.cast("binary")) % 20
    words, speaker = F.coalesce(text, F.lit(" ")), F.coalesce(role, F.lit(" "))
    return (
        rows.select(conv, turn, speaker.alias(role), words.alias(text), *row_id, kind.alias("_kind"))
        .where("_kind <> 0")
        .withColumn(text, F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)))
        .withColumn(role, F.when(F.col("_kind") == 4, "user").otherwise(F.col(role)))
        .withColumn("copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("_kind")
    )
