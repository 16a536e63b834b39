"""Language, quality, rules, toxicity and lines: against brute force where there is one, else held-out accuracy."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import language, likelihood, lines, quality, toxicity
from meterlake.llm.queries import held_out
from meterlake.llm.text import LOWER, NOT_SPACE, span_hashes, spans

SPACE = r"[^\x20\x09-\x0D]+"
LABELS = "doc_id bigint, quality int, toxic int"


# Words ------------------------------------------------------------------------------------------------
def test_words_and_hashes(hard):
    data, offsets = toxicity.joined([t or "" for t in hard])
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    raw = data.tobytes()
    for i, text in enumerate(hard):
        own = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        assert own == re.findall(SPACE, text or "")
    seen = {}
    for h, a, b in zip(span_hashes(data, starts, ends).tolist(), starts, ends, strict=True):
        assert seen.setdefault(raw[a:b], h) == h
    assert len(set(seen.values())) == len(seen)


# Language ---------------------------------------------------------------------------------------------
def brute_grams(text):
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f"\x01{word}\x01"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != "\x01":
                    found[gram] += 1
    return found


@pytest.mark.parametrize("text", ["Größe, ÄÖ x", "a", "  ab1cd ", "one two  two"])
def test_grams(text):
    codes, at = language.letters(*toxicity.joined(["", text, "", "zz"]))
    values, counts = np.unique(language.grams(codes[at[1] : at[2] + 1]), return_counts=True)
    names = {}
    for v, c in zip(values.tolist(), counts.tolist(), strict=True):
        points = [(v >> s * language.LETTER_BITS) & (2**language.LETTER_BITS - 1) for s in (2, 1, 0)]
        names["".join(chr(p) for p in points if p)] = c
    assert names == brute_grams(text)


def test_language_of_held_out_texts(documents, hard):
    rng = random.Random(1)
    parts = {"aa": "ka lo mi nu pe".split(), "bb": "sch tz ung ver ich".split()}
    rows = [
        (i, " ".join("".join(rng.choice(parts[l]) for _ in range(rng.randint(1, 4))) for _ in range(30)), l, "s", 1)
        for i, l in enumerate(["aa", "bb"] * 60)
    ]
    rows += [(1000 + i, t, None, "s", 1) for i, t in enumerate(hard)] + [(None, "ka lo", "zz", "s", 1), rows[0]]
    docs = documents(rows)
    found = language.predict(docs, language.fit(docs, ~held_out(3, 1))).collect()
    truth = {r[0]: r[2] for r in rows}
    texts = {r[0]: r[1] for r in rows}
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and r["doc_id"] < 1000:
            assert r["lang_pred"] == truth[r["doc_id"]]
        undetermined = not re.search(r"[^\W\d_]", texts[r["doc_id"]] or "")
        assert (r["lang_pred"] == "und") == undetermined
        assert r["lang_pred"] != "zz"  # a row without an id is never learned from


def test_language_with_nothing_to_learn_and_no_rows(documents):
    docs = documents([(1, "abc", None, "s", 3)])
    none = language.fit(docs, ~held_out(3, 1))
    assert [tuple(r) for r in language.predict(docs, none).collect()] == [(1, "und", 0.0)]
    assert language.predict(documents([]), none).collect() == []


def test_out_of_place_distance():
    profile = language.Profiles(["aa", "bb"], np.array([5, 6, 7], np.uint64), np.array([[0, 3], [1, 0], [3, 1]]), 3)
    found = np.array([6, 5])
    away = [abs(1 - 0) + abs(0 - 1), 0 + 3]
    where = np.searchsorted(profile.grams, found)
    theirs = profile.ranks[where]
    assert np.where(theirs == 3, 3, np.abs(theirs - np.arange(2)[:, None])).sum(axis=0).tolist() == away


# Quality ----------------------------------------------------------------------------------------------
def labelled(documents, spark, prose, make_bad, n=160, noise=()):
    rows = [(i, prose(40, seed=i) if i % 2 else make_bad(prose(40, seed=i))) for i in range(n)] + list(noise)
    labels = [(i, i % 2, 1 - i % 2) for i in range(n)]
    return documents(rows), spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (9999, 0, 1)], LABELS)


def test_quality_on_held_out_texts(spark, documents, prose, hard):
    noise = [(1000 + i, t) for i, t in enumerate(hard)] + [(None, "x y"), (1, prose(40, seed=1))]
    docs, labels = labelled(documents, spark, prose, lambda t: t.replace(" ", "### "), noise=noise)
    model = quality.fit(docs, labels, held_out(4, 2, "key"))
    found = quality.classify(docs, model).collect()
    assert len(found) == 160 + len(noise)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        if r["doc_id"] is not None and r["doc_id"] < 160:
            assert r["predicted"] == r["doc_id"] % 2
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    good = sorted((r["doc_id"] for r in found if r["predicted"] and r["doc_id"] is not None))
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == good


def test_quality_does_not_learn_from_the_held_out_fold(spark, documents, prose):
    docs, labels = labelled(documents, spark, prose, str.upper)
    turned = labels.withColumn(
        "quality", F.when(held_out(4, 2), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    scores = [
        {r["doc_id"]: r["score"] for r in quality.classify(docs, quality.fit(docs, x, held_out(4, 2, "key"))).collect()}
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_quality_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    docs = documents([(1, "a b c"), (2, None)])
    model = quality.fit(docs, none, held_out(4, 2, "key"))
    assert {r["score"] for r in quality.classify(docs, model).collect()} == {0.5}
    assert quality.classify(documents([]), model).collect() == []


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)) for _ in range(60)]
    labels = np.array([int((r < 25).sum() >= 4) for r in rows])
    ratios = np.zeros(1 << quality.BITS)
    ratios[:50] = rng.standard_normal(50)
    weights, bias = quality.dual_coordinate_descent(rows, labels, ratios, cost=100.0, rounds=400)
    inner = np.divide(weights[:50], ratios[:50])
    x = np.zeros((60, 50))
    for i, r in enumerate(rows):
        v = ratios[r]
        x[i, r] = v / np.sqrt(v @ v)
    y = np.where(labels == 1, 1.0, -1.0)
    c = np.where(labels == 1, 100 / (labels == 1).sum(), 100 / (labels == 0).sum())

    def objective(w, b):
        return 0.5 * (w @ w + b * b) + (c * np.maximum(0, 1 - y * (x @ w + b))).sum()

    best = objective(inner, bias)
    for _ in range(300):
        assert objective(inner + 0.02 * rng.standard_normal(50), bias + 0.02 * rng.standard_normal()) >= best - 1e-3


# Rules ------------------------------------------------------------------------------------------------
def brute_base(text):
    text = text or ""
    words = re.findall(SPACE, text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(SPACE, line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered), failed


def test_base_counts(documents, spark, prose, hard):
    rng = random.Random(2)
    texts = hard + [prose(n, seed=n, words=30) for n in (7, 8, 9, 19, 20, 21, 300)]
    texts += [prose(30) + "\n" + prose(30) + "\r\n" + prose(30) + "\n", "#*$%&|<> é|é " * 9, "a b c d e f g h " * 3]
    texts += ["\n".join(prose(3, seed=rng.randint(0, 4)) for _ in range(40))]
    rows = list(enumerate(texts)) + [(None, "x"), (0, None)]
    docs = documents(rows)
    rule = likelihood.fit(docs, docs.where("doc_id > 9"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = likelihood.apply(docs, rule).collect()
    assert len(found) == len(rows)
    by_id = dict(rows)
    for r in found:
        assert tuple(r[n] for n in names) == brute_base(by_id[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= rule.threshold)


def test_ratio_keeps_texts_like_the_target(documents, prose):
    good = [(i, prose(60, seed=i)) for i in range(80)]
    bad = [(1000 + i, " ".join(f"junk{j * i % 97}" for j in range(60))) for i in range(80)]
    docs = documents(good + bad)
    rule = likelihood.fit(docs, documents(good[:40]))
    kept = {r["doc_id"]: r["kept"] for r in likelihood.apply(docs, rule).collect()}
    assert np.mean([kept[i] for i, _ in good[40:]]) > 0.9 and not any(kept[i] for i, _ in bad)


def test_leaving_a_text_out_is_the_same_as_not_having_it(prose):
    texts = [prose(50, seed=i) for i in range(4)]
    counts = [
        np.bincount(likelihood.hashed_ngrams(*toxicity.joined([t]))[0], minlength=1 << likelihood.BITS) for t in texts
    ]
    raw = sum(counts)
    data, offsets = toxicity.joined(texts)
    found = likelihood.mean_ratio_without_itself(raw, raw, data, offsets)
    for i, text in enumerate(texts):
        ratios = likelihood.log_ratios(raw - counts[i], raw)
        assert found[i] == pytest.approx(likelihood.mean_ratio(ratios, *toxicity.joined([text]))[0])


def test_rules_without_target_or_rows(documents):
    docs = documents([(1, "word " * 25 + "a b c d e f"), (2, "short")])
    rule = likelihood.fit(docs, documents([]))
    assert rule.threshold == 0.0
    assert likelihood.apply(documents([]), rule).collect() == []


# Lines ------------------------------------------------------------------------------------------------
def brute_lines(rows, ratio, least):
    pages, said = Counter(r[1] for r in rows), Counter()
    strip = " \t\r\x0b\x0c"
    for _, host, text in rows:
        said.update({(host, x.strip(strip)) for x in (text or "").split("\n")})
    out = []
    for key, host, text in rows:
        if text is None:
            out.append((key, host, None, 0, 0))
            continue
        parts = text.split("\n")
        kept = [
            x
            for x in parts
            if not x.strip(strip)
            or not (said[host, x.strip(strip)] >= least and said[host, x.strip(strip)] > ratio * pages[host])
        ]
        out.append((key, host, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [lines.BROADCAST_ROWS, -1])
def test_lines_agree_with_brute_force(spark, hard, prose, limit, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", limit)
    rng = random.Random(6)
    rows = []
    for i in range(300):
        host = rng.choice(["a", "a", "a", "b", "c", None])
        parts = [prose(4, seed=rng.randint(0, 2000)) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, len(parts)), rng.choice(["  Menu ", "Menu", "footer\t", "home\r"]))
        rows.append((i, host, "\n".join(parts)))
    rows += [(1000 + i, "a", t) for i, t in enumerate(hard)] + [rows[0], (None, "b", "Menu\nx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)
    found = lines.clean(docs, host="source", ratio=0.1, min_pages=5)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_lines(rows, 0.1, 5)


def test_lines_of_no_rows_and_clashing_columns(spark):
    schema = "doc_id int, source string, text string, n_lines string"
    assert lines.clean(spark.createDataFrame([], schema), host="source").collect() == []
    one = lines.clean(spark.createDataFrame([(1, "a", "x\ny", "z")], schema), host="source").first()
    assert (one["text"], one["n_lines"], one["n_dropped"]) == ("x\ny", 2, 0)


# Toxicity ---------------------------------------------------------------------------------------------
def test_gradients_of_the_network(prose):
    data, offsets = toxicity.joined([prose(50, seed=i) for i in range(3)])
    words = toxicity.read_words(data, offsets, np.unique(span_hashes(LOWER[data], *spans(LOWER[data], offsets, toxicity.IS_WORD)[:2]))[::2])
    begin, length, _ = toxicity.windows_of(words.first)
    target = (np.arange(len(begin)) % 2).astype(np.float32)
    weight = np.ones(len(begin), np.float32)
    network = toxicity.Network(1)
    for k in network.p:
        network.p[k] = network.p[k].astype(np.float64)
    exact, _ = network.gradients(words, begin, length, target, weight)
    rng = np.random.default_rng(0)
    for k, p in network.p.items():
        live = np.argwhere(np.abs(exact[k]) > 1e-3)
        for at in live[rng.permutation(len(live))[:4]]:
            at, kept, values = tuple(at), p[tuple(at)], []
            for step in (3e-3, -3e-3):
                p[at] = kept + step
                values.append(network.gradients(words, begin, length, target, weight)[1])
            p[at] = kept
            assert (values[0] - values[1]) / 6e-3 == pytest.approx(exact[k][at], rel=0.1, abs=5e-3), (k, at)


def test_windows_overlap_and_cover_all_words():
    first = np.array([0, 0, 1, 33, 133, 133 + 1000])
    begin, length, owner = toxicity.windows_of(first)
    for text in range(5):
        seen = set()
        for b, n in zip(begin[owner == text], length[owner == text], strict=True):
            assert 0 < n <= toxicity.WINDOW
            seen |= set(range(b, b + n))
        assert seen == set(range(first[text], first[text + 1]))


def test_toxicity_on_held_out_texts(spark, documents, prose, hard):
    def spoil(text):
        words = text.split()
        words[len(words) // 2] = "vile" + random.Random(text).choice(["n", "st", "r", "d", "x"])
        return " ".join(words)

    noise = [(1000 + i, t) for i, t in enumerate(hard)]
    noise += [(2000, prose(300, seed=1)), (2001, prose(2000, seed=2) + " vilest " + prose(2000, seed=3)), (1, prose(40, seed=1))]
    docs, labels = labelled(documents, spark, prose, spoil, n=400, noise=noise)
    model = toxicity.fit(docs, labels, held_out(4, 2, "key"))
    found = {r["doc_id"]: r for r in toxicity.classify(docs, model).collect()}
    hits = [found[i]["predicted"] == 1 - i % 2 for i in range(400)]
    assert np.mean(hits) > 0.95
    assert found[2001]["predicted"] == 1 and found[2000]["predicted"] == 0
    assert found[1000]["score"] == found[1001]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_without_labels_or_rows(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    model = toxicity.fit(docs, spark.createDataFrame([], LABELS), held_out(4, 2, "key"))
    assert {r["score"] for r in toxicity.classify(docs, model).collect()} == {0.0}
    assert toxicity.classify(documents([]), model).collect() == []
