"""Conversation repair against a search over all edits, whole results against a plain version, long conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from meterlake.llm import conversations as c
from meterlake.llm import queries

BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def plain_audit(rows):
    """Cheapest edits, least by ASCII, by brute dynamic programming over whole strings. rows: (role, fault)."""
    keep = {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}
    free = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def better(table, state, offer):
        if state not in table or offer < table[state]:
            table[state] = offer

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit) in list(table.items()):
                better(table, free[state], (cost + 5, audit + "I"))
        return table

    inserted(best)
    for role, fault in rows:
        new = {}
        for state, (cost, audit) in best.items():
            better(new, state, (cost + 2, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (role[:1], state) in keep:
                    better(new, keep[role[:1], state], (cost + more, audit + "K"))
                better(new, free[state], (cost + more + 1, audit + "R"))
        best = inserted(new)
    return min(best[s] for s in ("", "a") if s in best)


def brute(rows):
    """The contract's report of rows (conv_id, turn, role, text), damage included."""
    damaged, convs = [], {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        damaged += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    for conv, turn, role, text in damaged:
        name = "" if conv is None else str(conv)
        said = f"{-1 if conv is None else len(name)}:{name}:{len(role)}:{role}:{text}"
        convs[conv].append((turn is not None, turn or 0, role, hashlib.sha256(said.encode()).hexdigest(), turn, text))
    out = []
    for conv, held in convs.items():
        seen, marked, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, _, role, _, turn, text in sorted(held, key=lambda r: r[:4]):
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = (
                "blank" if not body
                else "duplicate" if (role, text) in seen
                else "truncated" if body[-1] not in ".!?"
                else None
            )
            seen.add((role, text))
            counts.update({fault: counts[fault] + 1} if fault else {})
            marked.append((turn, role, text, fault))
        turns = {r[0] for r in marked} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[1][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain_audit([(r[1], r[3]) for r in marked])
        lines, state, given = [], "", iter(marked)
        for edit in audit:
            _, role, text, _ = (None, "", "", None) if edit == "I" else next(given)
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{text}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def found(spark, stored, rows, **options):
    folder = stored(conversations=table(spark, rows))
    return sorted(map(tuple, queries.conversation_report(spark, folder, **options).select(*COLUMNS).collect()), key=repr)


def random_rows(seed, convs=40, most=9):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Größe 中文。", "Yes.\n", ".", "a. b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    out = []
    for conv in range(convs):
        for turn in rng.sample(range(30), rng.randint(0, most)):
            out.append((conv if conv else None, turn or None, rng.choice(roles), rng.choice([*said, None])))
    return out


def test_all_short_sequences_of_edits():
    """Against an exhaustive search over edits, not another dynamic program."""
    roles = ["s", "u", "a", "x"]
    form = re.compile(r"(s?(ua)+)?\Z")

    def every(rows):
        best = None
        for ops in itertools.product("KRD", repeat=len(rows)):
            for gaps in itertools.product(range(3), repeat=len(rows) + 1):
                cost = 5 * sum(gaps) + sum({"K": 0, "R": 1, "D": 2}[o] for o in ops)
                if best is not None and cost > best[0]:
                    continue
                audit = "I" * gaps[0] + "".join(o + "I" * g for o, g in zip(ops, gaps[1:]))
                kept = [r for r, o in zip(rows, ops) if o != "D"]
                cost += sum(5 for (_, f), o in zip(rows, ops) if o != "D" and f == "truncated")
                if any(f == "blank" and o != "D" for (_, f), o in zip(rows, ops)) or (best and (cost, audit) >= best):
                    continue
                for roled in itertools.product("ua", repeat=sum(gaps) + ops.count("R")):
                    given, made, line = iter(kept), iter(roled), []
                    for edit in audit:
                        if edit == "K":
                            line.append(next(given)[0])
                        elif edit in "IR":
                            line.append(next(made))
                            next(given) if edit == "R" else None
                    if form.match("".join(line)):
                        best = (cost, audit)
                        break
        return best

    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(roles), rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 4))]
        turns = [c.Turn(r, f == "blank", f == "truncated") for r, f in rows]
        reached = c.search(turns, 0)
        assert min(reached[s] for s in (0, 3) if s in reached) == every(rows) == plain_audit(rows), rows


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 3, 1])
def test_shared_strings_compare_as_strings(modulus):
    """Also where hashes collide at every turn."""
    rng = random.Random(modulus)
    audits = c.Audits(base=5, modulus=modulus)
    texts = {0: ""}
    for _ in range(300):
        parent = rng.choice(list(texts))
        letter = rng.choice("DIKR")
        node = audits.add(parent, letter)
        texts[node] = texts[parent] + letter
    assert all(audits.text(n) == t for n, t in texts.items())
    for _ in range(4000):
        a, b = rng.choice(list(texts)), rng.choice(list(texts))
        assert audits.less(a, b) == (texts[a] < texts[b])


def test_deep_strings_compare_by_bisection():
    audits = c.Audits()
    left = right = 0
    for i in range(5000):
        left = audits.add(left, "DIKR"[i % 4])
        right = audits.add(right, "DIKR"[i % 4] if i != 2500 else "R")
    assert audits.less(left, right) and not audits.less(right, left)
    assert len(audits._up[left]) == 13


def test_report_equals_plain_version(spark, stored):
    rows = random_rows(3)
    assert found(spark, stored, rows) == brute(rows)


def test_long_conversations_are_cut_and_folded(spark, stored):
    """Segments of three rows: nearly every conversation is folded from several, over several partitions."""
    rows = random_rows(4, convs=12, most=25)
    assert found(spark, stored, rows, segment_rows=3) == brute(rows)


def test_bytes_cut_segments_too(spark, stored):
    rows = random_rows(5, convs=5, most=20)
    assert found(spark, stored, rows, segment_bytes=4) == brute(rows)


def test_one_hot_conversation(spark, stored):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", "c!", f"{t}."])) for t in range(600)]
    rows += random_rows(6, convs=6)
    assert found(spark, stored, rows, segment_rows=50) == brute(rows)


def test_repeated_rows_ties_and_extra_columns(spark, stored):
    rows = [(1, 1, "user", "Same."), (1, 1, "user", "Same."), (1, 1, "assistant", "Other."), (1, 1, "user", "Same")]
    df = table(spark, rows)
    for name in ("said", "fault", "copy", "part", "_kind", "edit"):
        df = df.selectExpr("*", f"'x' AS {name}")
    folder = stored(conversations=df)
    report = queries.conversation_report(spark, folder).select(*COLUMNS)
    assert sorted(map(tuple, report.collect())) == brute(rows)


def test_empty_table_and_conversations_without_rows(spark, stored):
    folder = stored(conversations=table(spark, []))
    assert queries.conversation_report(spark, folder).collect() == []


def test_all_rows_dropped(spark, stored):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    (row,) = found(spark, stored, [(5, gone, "user", "Hi.")])
    assert row == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edits_are_the_audit_and_the_repaired_rows(spark, stored):
    rows = random_rows(8, convs=8)
    df = queries.with_row_id(spark.read.parquet(stored(conversations=table(spark, rows)) + "/conversations.parquet"))
    marked = c.mark(c.damaged(df), row_id=queries.CONVERSATION_ROW)
    made = c.repair(marked, segment_rows=4)
    edits = {}
    for r in sorted(made.edits.collect(), key=lambda r: (r["part"], r["seg"], r["nth"])):
        edits.setdefault(r["conv"], []).append(r)
    for conv, *_, audit, sha in [r[:1] + r[1:] for r in map(tuple, made.report.collect())]:
        of = edits[conv]
        assert "".join(r["edit"] for r in of) == audit
        kept = [r for r in of if r["edit"] != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in kept))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == sha
