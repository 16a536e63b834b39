import hashlib
import random
import re

from meterlake.llm import contamination

ITEMS = "item_id bigint, text string"


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=13):
    out = []
    for key, text in docs:
        words, hit, which = words_of(text), set(), set()
        for item, other in items:
            theirs = words_of(other)
            n = min(window, len(theirs))
            for i in range(len(theirs) - n + 1) if n else ():
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == theirs[i : i + n]:
                        hit |= set(range(at, at + n))
                        which.add(str(item))
        joined = ",".join(sorted(which))
        out.append(
            (
                key,
                len(words),
                len(hit),
                len(which),
                hashlib.sha256(joined.encode()).hexdigest(),
                bool(hit) and 20 * len(hit) >= len(words),
            )
        )
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def found(docs, items):
    return sorted((tuple(r) for r in contamination.report(docs, items).select(*COLUMNS).collect()), key=repr)


def test_agrees_with_brute_force(spark, documents, prose, hard):
    rng = random.Random(4)
    items = [(i, prose(rng.randint(14, 60), seed=i, words=60)) for i in range(12)]
    items += [(20, "Straße ÉCOLE école the end."), (21, "one"), (22, ""), (23, None), (24, items[0][1]), (20, "x x x")]
    items += [(30, "the " * 40), (31, prose(13, seed=3, words=60)), (None, prose(20, seed=50, words=60))]
    docs = []
    for i in range(60):
        theirs = (items[rng.randrange(12)][1]).split()
        low = rng.randrange(len(theirs))
        part = theirs[low : low + rng.randint(5, 40)]
        if rng.random() < 0.3:
            part[rng.randrange(len(part))] = "changed"
        docs.append((i, prose(rng.randint(0, 80), seed=200 + i, words=60) + ", " + "-".join(part).upper() + " tail"))
    docs += [(100, "STRASSE Straße ÉCOLE ÉCOLE the end"), (101, "straße École école The End"), (102, "x X,x x")]
    docs += [(103, "straße École École The End"), (104, "Straße ÉCOLE école THE end"), (105, "the " * 90)]
    docs += [(200 + i, t) for i, t in enumerate(hard)] + [docs[3], (3, "other text"), (None, items[0][1])]
    assert found(documents(docs), spark.createDataFrame(items, ITEMS)) == brute(docs, items)


def test_words_are_folded_one_by_one(spark, documents):
    # What lower makes of a capital sigma depends on the letters around it, also beyond the word's end.
    greek = "Σ Χ ΛΟΓΟΣ ΕΡΓΟΣ ΟΔΟΣ ΝΟΜΟΣ ΤΟΠΟΣ ΛΑΟΣ ΘΕΟΣ ΒΙΟΣ ΦΩΣ ΠΑΣ ΜΕΣΟΣ ΤΕΛΟΣ"
    items = [(1, "Σ"), (2, "ΛΟΓΟΣ"), (3, "λογος"), (4, greek), (5, "İstanbul TITLE")]
    docs = [(1, "Π.Α.Σ. Χ"), (2, "ΛΟΓΟΣ'Α"), (3, "λογος'α"), (4, "Π." + greek.replace(" ", "'"))]
    docs += [(5, "Π.Α." + greek.replace(" ", ".") + ".Α"), (6, "İstanbul title"), (7, "i̇stanbul title")]
    expected = brute(docs, items)
    assert [r[2] for r in expected] == [1, 1, 1, 14, 14, 2, 0]
    assert found(documents(docs), spark.createDataFrame(items, ITEMS)) == expected
    # Each item alone: no other item's anchors help.
    for item in items:
        assert found(documents(docs), spark.createDataFrame([item], ITEMS)) == brute(docs, [item])


def test_no_items_no_documents_and_clashing_columns(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert found(documents([(1, "a b")]), none) == brute([(1, "a b")], [])
    some = spark.createDataFrame([(1, "a b")], ITEMS)
    assert found(documents([]), some) == []
    clash = spark.createDataFrame([(1, "a b c", 7, 8)], "doc_id int, text string, item int, at int")
    assert contamination.report(clash, some).select("n_hit").first()[0] == 2


def brute_near(docs, items, window=13):
    """n_near of each document: at least two anchors of an item at about their distance."""
    from collections import Counter

    counts = Counter(w for _, t in docs for w in words_of(t))
    out = []
    for key, text in docs:
        words, near = words_of(text), set()
        for item, other in set(items):
            theirs = words_of(other)
            need = min(window, len(theirs))
            anchors = set()
            for s in range(len(theirs) - need + 1) if need else ():
                ranked = sorted((counts[theirs[q]], theirs[q].encode(), q) for q in range(s, s + need) if counts[theirs[q]])
                anchors |= {q for _, _, q in ranked[:1]}
            cells = {}
            for q in anchors if len(anchors) > 1 else ():
                for at, word in enumerate(words):
                    if word == theirs[q]:
                        for cell in ((at - q) // window, (at - q) // window + 1):
                            cells.setdefault(cell, set()).add(q)
            if any(len(qs) >= 2 for qs in cells.values()):
                near.add(item)
        out.append((key, len(near)))
    return sorted(out, key=repr)


def test_proximity_equals_brute_force(spark, documents, prose):
    items = [(i, prose(40, seed=i, words=300)) for i in range(6)] + [(9, "one"), (10, "a b"), (11, None), (12, prose(15, seed=2))]
    docs = [(i, "- " * (i % 2) + prose(90, seed=100 + i, words=300)) for i in range(15)]
    docs += [(50 + i, " ".join("new" if j % 5 == 0 else w for j, w in enumerate(items[i][1].split()))) for i in range(4)]
    docs += [(70, "b b b a"), (71, ""), (72, None)]
    rows = contamination.report(documents(docs), spark.createDataFrame(items, ITEMS)).select("doc_id", "n_near").collect()
    assert sorted(map(tuple, rows), key=repr) == brute_near(docs, items)
    assert sum(r["n_near"] for r in rows) >= 4


def test_windows_name_their_two_rarest_terms(spark):
    tests = spark.createDataFrame([(1, 5, "x", ["a", "b", "c", "b", "d"])], "test bigint, size int, item string, words array<string>")
    counts = spark.createDataFrame([(0, "a", 9), (1, "b", 2), (2, "c", 2), (3, "d", 0)], "term bigint, word string, n bigint")
    placed = contamination.placed_terms(tests, counts)
    rows = {r["s"]: r for r in contamination.windows_of(placed, 3).collect()}
    assert [(r["q1"], r["q2"], r["exact"], r["need"]) for _, r in sorted(rows.items())] == [
        (1, 2, True, 3),
        (1, 3, True, 3),
        (3, 2, False, 3),
    ]


def test_no_text_and_no_python_after_the_index(spark, documents, prose, plan):
    """Only the index and the word counts read texts; no array of words crosses an exchange."""
    items = spark.createDataFrame([(1, prose(40, seed=1))], ITEMS)
    docs = documents([(i, prose(100, seed=i)) for i in range(1, 9)])
    exact, near = contamination.search(docs, items)
    for frame in (exact, near):
        text = plan(frame)
        assert "words" not in text and "text" not in text.replace("_text_hash", "")
    text = plan(contamination.report(docs, items))
    assert "PythonUDF" not in text and "EvalPython" not in text and "InArrow" not in text
    shuffled = [line for line in text.split("\n") if line.startswith("Arguments: hashpartitioning")]
    assert shuffled and not any("words#" in line for line in shuffled)


def test_proximity_matches_allow_changed_words(spark, documents, prose):
    words = prose(40, seed=1, words=5000).split()
    items = spark.createDataFrame([(1, " ".join(words))], ITEMS)
    changed = " ".join("new" if i % 4 == 0 else w for i, w in enumerate(words))
    rows = contamination.report(documents([(1, changed), (2, prose(60, seed=9))]), items).collect()
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in rows} == {1: (0, 1), 2: (0, 0)}
