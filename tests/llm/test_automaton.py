import hashlib
import random
import re

import pytest

from meterlake.llm.automaton import BASE_RULES, MORE_RULES, RULES, Rule, Scanner, compile_rules, parse, scan

# The contract, in the words of a backtracking matcher: kind, expression, shortest length of which group.
CONTRACT = (
    (
        "assign",
        re.compile(
            r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
        lambda m: len(m[1]) >= 8,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def expected(text):
    spans = [
        (m.start(), number, f"{kind}:{m.start()}:{m.end()}")
        for number, (kind, pattern, good) in enumerate(CONTRACT)
        for m in pattern.finditer(text or "")
        if good(m)
    ]
    return [s for _, _, s in sorted(spans)]


def of_base(spans):
    return [s for s in spans.split(",") if s.split(":")[0] in {k for k, *_ in CONTRACT}]


@pytest.fixture(scope="module")
def machine():
    return Scanner(RULES)


TEXTS = [
    "password: hunter2hunter2 and TOKEN = 'abcdefgh12' API_KEY=\"x.y/z+1=-\"",
    "token=secret:abcdefgh12",
    "token=password: abcdefgh12 secret==abcdefghi",
    "passwordpassword=12345678 apikey  :   short token=token=token=1234",
    "AKIAAKIAAKIAAKIA AKIA AKIA12 XAKIAABCDEFGHIJKL akiaABCDEFGHIJKLM",
    "é😀 token=éabcdefgh token=abcdefghé " + "0123456789abcdef" * 2 + "g" + "a" * 31,
    "secret" * 10 + "=" * 12 + "a" * 100,
    "deadbeef" * 40,
    "",
    None,
]


@pytest.mark.parametrize("text", TEXTS)
def test_agrees_with_the_contract(machine, text):
    raw = (text or "").encode()
    points = lambda at: len(raw[:at].decode())
    found = [f"{RULES[r].kind}:{points(s)}:{points(e)}" for s, r, e in machine.scan(raw) if r < len(BASE_RULES)]
    assert found == expected(text)


def test_agrees_on_random_texts(machine):
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", "AKIA", "AK", "=", ":", " ", "  ", '"', "'"]
    parts += ["abcdefgh", "0123456789abcdef" * 2, "ABCD", "a", "Z9", "-", "/", "\n", "é", "pass", "sec", "api_"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        raw = text.encode()
        points = lambda at, raw=raw: len(raw[:at].decode())
        found = [f"{RULES[r].kind}:{points(s)}:{points(e)}" for s, r, e in machine.scan(raw) if r < len(BASE_RULES)]
        assert found == expected(text), text


def test_more_rules(machine):
    text = "-----BEGIN RSA PRIVATE KEY-----\nghp_" + "a1B2" * 9 + " eyJhbGciOi.eyJzdWIiOi.abcdefghijk xoxb-1234567890-x"
    kinds = [RULES[r].kind for _, r, _ in machine.scan(text.encode())]
    assert [k for k in kinds if k in {r.kind for r in MORE_RULES}] == [
        "private_key",
        "git_token",
        "web_token",
        "chat_token",
    ]


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[a-c]{2,3}x+", "(ab|a)(c|bcd)", r"\x41\.[^]?".replace("[^]?", "b")])
def test_automaton_accepts_what_the_expression_does(pattern):
    machine = compile_rules([("join", [parse(pattern)])], False)
    whole = re.compile(pattern)
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("abcdexA.") for _ in range(rng.randint(1, 6)))
        state = 0
        for byte in text.encode():
            state = machine.table[state + machine.class_of[byte]]
        assert (state >= machine.accepting) == bool(whole.fullmatch(text)), text


def test_automaton_is_minimal():
    width = lambda m: len(set(m.class_of))
    same = compile_rules([("join", [parse("(ab|ab|a[b])c")])], False)
    assert len(same.table) // width(same) == 5  # start, a, ab, abc and the dead state


def test_query_columns(documents, hard):
    rows = [(i, t) for i, t in enumerate(TEXTS + hard)] + [(None, TEXTS[0]), (0, TEXTS[0])]
    texts = dict(rows)
    found = scan(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        spans = expected(texts[r["doc_id"]])
        assert of_base(r["spans"]) == spans
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in spans)


def test_empty_table_other_rules_and_clashing_columns(spark, documents):
    assert scan(documents([])).collect() == []
    rows = spark.createDataFrame([(1, "id-12345", 9)], "doc_id int, text string, spans int")
    one = scan(rows, [Rule("ticket", "id-", "[0-9]", 4)], base=1, keep=("doc_id", "spans")).collect()
    assert [(r["n_ticket"], r["spans"]) for r in one] == [(1, "ticket:0:8")]
