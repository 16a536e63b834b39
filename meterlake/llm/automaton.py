"""Secret scan with one deterministic automaton for all rules.

Each rule's expression is parsed into a nondeterministic automaton; all of them together are made
deterministic by subset construction, minimised, and laid out as one transition array over byte classes. A
text is read once, byte by byte, for all rules. Where a rule is first met, an automaton of its reversed head
finds how far to the left the match begins, and the run of its tail how far to the right it goes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from .text import map_texts


class Rule(NamedTuple):
    """A secret is ``head`` followed by as many bytes of the class ``tail`` as there are, at least
    ``least``; matches with fewer are found, and hide what they cover, but are not reported. ``fold``: ASCII
    letters of the head in either case."""

    kind: str
    head: str
    tail: str
    least: int
    fold: bool = False


# The base rules, in the order of their kinds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        "[A-Za-z0-9+/_.=-]",
        8,
        fold=True,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
# Formats of well-known public services' keys.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY", "[-]", 5),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 10),
    Rule("git_token", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("chat_token", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("maps_key", "AIza", "[0-9A-Za-z_-]", 35),
    Rule("pay_key", "sk_live_", "[0-9A-Za-z]", 24),
)
RULES = BASE_RULES + MORE_RULES

# Expressions ------------------------------------------------------------------------------------------
# A node is ("bytes", set), ("join", nodes), ("either", nodes) or ("repeat", node, least, most or None).


def parse(pattern: str, fold: bool = False):
    """Literals, classes with ranges, groups, alternatives, ``? * + {m} {m,} {m,n}``, and ``\\x`` escapes."""
    at = 0

    def literal(byte: int) -> frozenset[int]:
        char = chr(byte)
        return frozenset((ord(char.lower()), ord(char.upper()))) if fold and char.isalpha() else frozenset((byte,))

    def escape() -> int:
        nonlocal at
        at += 1
        if pattern[at] == "x":
            at += 3
            return int(pattern[at - 2 : at], 16)
        at += 1
        return ord(pattern[at - 1])

    def single() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escape()
        at += 1
        return ord(pattern[at - 1])

    def byte_class():
        nonlocal at
        at += 1
        found: set[int] = set()
        while pattern[at] != "]":
            low = single()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                for byte in range(low, single() + 1):
                    found |= literal(byte)
            else:
                found |= literal(low)
        at += 1
        return ("bytes", frozenset(found))

    def item():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            inside = either()
            at += 1
            return inside
        if pattern[at] == "[":
            return byte_class()
        return ("bytes", literal(single()))

    def repeated():
        nonlocal at
        node = item()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at + 1 : end].partition(",")
                node = ("repeat", node, int(low), int(high) if high else None if comma else int(low))
                at = end + 1
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                node = ("repeat", node, least, most)
                at += 1
        return node

    def joined():
        nodes = []
        while at < len(pattern) and pattern[at] not in "|)":
            nodes.append(repeated())
        return ("join", nodes)

    def either():
        nonlocal at
        nodes = [joined()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            nodes.append(joined())
        return ("either", nodes)

    node = either()
    if at != len(pattern):
        raise ValueError(f"cannot read {pattern!r} at {at}")
    return node


def reverse(node):
    if node[0] == "join":
        return ("join", [reverse(n) for n in reversed(node[1])])
    if node[0] == "either":
        return ("either", [reverse(n) for n in node[1]])
    return ("repeat", reverse(node[1]), *node[2:]) if node[0] == "repeat" else node


class Branches:
    """Nondeterministic automaton: ``empty[s]`` are moves without a byte, ``moves[s]`` those with one."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, begin: int) -> int:
        """Append a node after a state; returns the state it ends in."""
        kind = node[0]
        if kind == "bytes":
            end = self.state()
            self.moves[begin].append((node[1], end))
            return end
        if kind == "join":
            for part in node[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "either":
            end = self.state()
            for part in node[1]:
                start = self.state()
                self.empty[begin].append(start)
                self.empty[self.add(part, start)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            begin = self.add(part, begin)
        if most is None:
            loop = self.state()
            self.empty[begin].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[begin].append(end)
        for _ in range(most - least):
            begin = self.add(part, begin)
            self.empty[begin].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


class Automaton(NamedTuple):
    """``table[state + class_of[byte]]`` is the next state; states are multiples of the number of classes, the
    first is 0, and those of at least ``accepting`` accept the rules ``accepts[state]``."""

    class_of: bytes
    table: list[int]
    accepting: int
    accepts: dict[int, tuple[int, ...]]


def compile_rules(nodes: Sequence, anywhere: bool) -> Automaton:
    """One minimal deterministic automaton for all nodes. ``anywhere``: matches may begin at every byte."""
    net = Branches()
    start = net.state()
    ends = {}
    for number, node in enumerate(nodes):
        first = net.state()
        net.empty[start].append(first)
        ends[net.add(node, first)] = number
    # Bytes that no move tells apart are one class.
    kinds = sorted({m for moves in net.moves for m, _ in moves}, key=sorted)
    signature = [tuple(b in kind for kind in kinds) for b in range(256)]
    classes = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    class_of = bytes(classes[s] for s in signature)
    byte_of = [signature.index(s) for s in classes]
    begin = net.closure([start])
    numbers, rows, todo = {begin: 0}, [], [begin]
    for states in todo:
        row = []
        for byte in byte_of:
            reached = {to for s in states for kind, to in net.moves[s] if byte in kind}
            target = net.closure(reached | {start}) if anywhere else net.closure(reached)
            if target not in numbers:
                numbers[target] = len(numbers)
                todo.append(target)
            row.append(numbers[target])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in states if s in ends)) for states in todo]
    # Minimise: split blocks until all members of one agree on what they accept and where they go.
    block = [{a: i for i, a in enumerate(dict.fromkeys(accepts))}[a] for a in accepts]
    while True:
        keys = [(block[s], *[block[t] for t in rows[s]]) for s in range(len(rows))]
        found = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        if len(found) == len(set(block)):
            break
        block = [found[k] for k in keys]
    member = {}
    for s, b in enumerate(block):
        member.setdefault(b, s)
    # The first state stays first; accepting blocks come last.
    order = sorted(member, key=lambda b: (b != block[0], bool(accepts[member[b]]), b))
    if accepts[0]:
        raise ValueError("a rule that matches nothing at all would match everywhere")
    width = len(classes)
    place = {b: i * width for i, b in enumerate(order)}
    table = [place[block[t]] for b in order for t in rows[member[b]]]
    final = {place[b]: accepts[member[b]] for b in order if accepts[member[b]]}
    return Automaton(class_of, table, min(final, default=len(table)), final)


class Scanner:
    """Finds the secrets of all rules in a text."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = tuple(rules)
        whole, self.heads, self.tails, self.sure = [], [], [], []
        for rule in self.rules:
            head, tail = parse(rule.head, rule.fold), parse(rule.tail)
            # Without a head, a run that is too short hides nothing, so only long ones are met.
            sure = 1 if rule.head else rule.least
            whole.append(("join", [head, ("repeat", tail, sure, sure)]))
            self.heads.append(compile_rules([("join", [reverse(head)])], False) if rule.head else None)
            members = tail[1][0][1][0][1]
            self.tails.append(bytes(b in members for b in range(256)))
            self.sure.append(sure)
        self.automaton = compile_rules(whole, True)

    def begin(self, rule: int, data: bytes, end: int, bound: int) -> int:
        """The leftmost place, not before ``bound``, from which the head reaches to ``end``; -1 if none."""
        head = self.heads[rule]
        if head is None:
            return end
        found, state = -1, 0
        dead = self._dead(rule)
        for at in range(end - 1, bound - 1, -1):
            state = head.table[state + head.class_of[data[at]]]
            if state in head.accepts:
                found = at
            elif state == dead:
                break
        return found

    @functools.lru_cache(maxsize=None)  # noqa: B019  (as many entries as rules)
    def _dead(self, rule: int) -> int:
        """The state that never leaves itself and does not accept."""
        head = self.heads[rule]
        width = len(set(head.class_of))
        for state in range(0, len(head.table), width):
            if state not in head.accepts and set(head.table[state : state + width]) == {state}:
                return state
        return -1

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of each secret, in bytes, by start and then rule. Leftmost and not overlapping
        within a rule."""
        class_of, table, accepting, accepts = self.automaton
        found, free = [], [0] * len(self.rules)
        state = 0
        for at, kind in enumerate(data.translate(class_of)):
            state = table[state + kind]
            if state >= accepting:
                for rule in accepts[state]:
                    if at < free[rule]:
                        continue
                    value = at + 1 - self.sure[rule]
                    start = self.begin(rule, data, value, free[rule])
                    if start < 0:
                        continue
                    tail, end = self.tails[rule], at + 1
                    while end < len(data) and tail[data[end]]:
                        end += 1
                    free[rule] = end
                    if end - value >= self.rules[rule].least:
                        found.append((start, rule, end))
        return sorted(found)


@functools.lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Built once per worker process."""
    return Scanner(rules)


def scan(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    *,
    base: int = len(BASE_RULES),
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """For every row: columns ``keep``, ``n_<kind>`` of the first ``base`` rules, ``base_sha256`` of their
    spans and ``spans`` of all rules, written ``kind:start:end`` in code points, end exclusive, by start and
    then rule, joined by commas. A null or empty text has none.

    A rule's head must not hold a whole match of the same rule, and its tail class must be ASCII; then
    matches are those of a leftmost greedy search.
    """
    rules = tuple(rules)
    kinds = [r.kind for r in rules]

    def score(data, offsets):
        machine = scanner(rules)
        counts: list[list[int]] = [[] for _ in range(base)]
        digests, spans = [], []
        raw = data.tobytes()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            found = machine.scan(raw[a:b])
            if found:
                points = np.concatenate(([0], np.cumsum((data[a:b] & 0xC0) != 0x80)))
                written = [(r, f"{kinds[r]}:{points[s]}:{points[e]}") for s, r, e in found]
            else:
                written = []
            for r in range(base):
                counts[r].append(sum(1 for x, _ in written if x == r))
            of_base = ",".join(w for r, w in written if r < base)
            digests.append(hashlib.sha256(of_base.encode()).hexdigest())
            spans.append(",".join(w for _, w in written))
        return *counts, digests, spans

    added = ", ".join([f"n_{k} bigint" for k in kinds[:base]] + ["base_sha256 string", "spans string"])
    return map_texts(docs, score, added, keep=keep, text=text)
