"""Whole results of the models against plain versions written from their definitions, leaks, samples, names."""

import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import jaccard, language, likelihood, lines, quality, ring, toxicity
from meterlake.llm.queries import held_out
from meterlake.llm.text import labelled_sample
from meterlake.sources.tables import ROW_ID, with_row_id
from meterlake.session import settle

LABELS = "doc_id bigint, quality int, toxic int"


def folds(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


# Language ---------------------------------------------------------------------------------------------
def grams_of(text):
    """n-grams of 1 to 3 within words of letters, a word's ends marked."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    out = Counter()
    for word in low.split():
        out.update(word)
        padded = f"\x01{word}\x01"
        for n in (2, 3):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def order(gram):
    number = 0
    for c in gram:
        number = number << 21 | ord(c)
    return number


def rank(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda e: (-e[1], order(e[0])))[:size]]


def brute_language(rows, size=400):
    totals = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and text and folds(i, 3) != 1:
            totals.setdefault(lang, Counter()).update(grams_of(text))
    profiles = {lang: {g: r for r, g in enumerate(rank(c, size))} for lang, c in totals.items()}
    out = []
    for i, text, _ in rows:
        found = rank(grams_of(text), size)
        if not found or not profiles:
            out.append((i, "und", 0.0))
            continue
        away = {
            lang: sum(abs(p[g] - r) if g in p else size for r, g in enumerate(found)) for lang, p in profiles.items()
        }
        best = min(sorted(away), key=away.get)
        out.append((i, best, 1 - away[best] / (size * len(found))))
    return out


def language_rows(hard):
    rng = random.Random(2)
    parts = {
        "aa": ["ka", "lo", "mi", "tur"], "bb": ["sch", "ein", "über", "ung"], "cc": ["čá", "ño", "þa"],
        # Two languages of one script beyond 16 bits.
        "dd": ["\U0001e900\U0001e901", "\U0001e902"], "ee": ["\U0001e910\U0001e911", "\U0001e912\U0001e905"],
    }
    rows = []
    for i in range(150):
        lang = list(parts)[i % 5]
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))]
        rows.append((i, rng.choice([" ", ", 1 "]).join(words).title(), lang if i % 11 else None))
    rows += [(1000 + i, t, None) for i, t in enumerate(hard)]
    return [r for r in rows if unicodedata.normalize("NFC", r[1] or "") is not None]


def test_language_equals_the_plain_version(spark, hard):
    rows = language_rows(hard)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs, ~held_out(3, 1))).collect()}
    right = []
    for i, lang, score in brute_language(rows):
        assert (found[i]["lang_pred"], found[i]["score"]) == (lang, pytest.approx(score, abs=1e-12)), i
        right += [lang == list({0: "aa", 1: "bb", 2: "cc", 3: "dd", 4: "ee"}.values())[i % 5]] if i < 150 else []
    assert np.mean(right) > 0.97  # scripts beyond 16 bits are told apart


def test_language_does_not_learn_from_the_held_out_fold(spark, hard):
    rows = language_rows(hard)
    scores = []
    for turned in (False, True):
        changed = [(i, t, "zz" if turned and folds(i, 3) == 1 and lang else lang) for i, t, lang in rows]
        docs = spark.createDataFrame(changed, "doc_id bigint, text string, lang string")
        found = language.predict(docs, language.fit(docs, ~held_out(3, 1))).collect()
        scores.append({r["doc_id"]: (r["lang_pred"], r["score"]) for r in found})
    assert scores[0] == scores[1]


# Quality ----------------------------------------------------------------------------------------------
def test_quality_scores_equal_the_plain_version(prose, hard):
    """Margin: weights of the distinct features over the length of their ratios; score: its logistic."""
    rng = np.random.default_rng(0)
    weights, ratios = rng.normal(size=(2, 1 << quality.BITS))
    model = quality.Model(weights.astype(np.float32), ratios.astype(np.float32), 0.25, 1.5, -0.5)
    texts = [t or "" for t in hard if len(t or "") < 60_000] + [prose(30, seed=i) for i in range(5)]
    data, offsets = toxicity.joined(texts)
    found = quality.probability(quality.margins(model, data, offsets), model.slope, model.shift)
    for text, score in zip(texts, found, strict=True):
        one, at = toxicity.joined([text])
        features = set(quality.indicators(one, at)[0].tolist())
        words = text.encode().split() if text.strip(" \t\n\x0b\x0c\r") else []
        assert len(features) <= len(set(words)) + len(words) + len(set(zip(one, one[1:], one[2:])))
        dot = sum(float(model.weights[f]) for f in features)
        length = math.sqrt(sum(float(model.ratios[f]) ** 2 for f in features))
        margin = dot / max(length, 1e-12) + 0.25
        assert score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, 1.5 * margin - 0.5)))), rel=1e-5)


def test_features_are_words_pairs_and_trigrams():
    count = lambda t: len(quality.indicators(*toxicity.joined([t]))[0])
    assert count("") == 0 and count("ab") == 1 and count("abc") == 2
    assert count("ab cd") == 2 + 1 + 3 and count("ab ab") == 1 + 1 + 3
    both = quality.indicators(*toxicity.joined(["ab cd", "x"]))
    assert both[1].tolist().count(0) == 6 and both[1].tolist().count(1) == 1


# Toxicity ---------------------------------------------------------------------------------------------
def plain_window(network, rows):
    """Probability of one window from the input vectors of its words, step by step."""
    p, h = network.p, toxicity.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))
    states = {}
    for side in "fb":
        state, out = np.zeros(h), []
        for x in rows if side == "f" else rows[::-1]:
            gates, u = x @ p[f"in_{side}"] + p[f"bias_{side}"][0], p[f"state_{side}"]
            z = sig(gates[:h] + state @ u[:, :h])
            r = sig(gates[h : 2 * h] + state @ u[:, h : 2 * h])
            c = np.tanh(gates[2 * h :] + (r * state) @ u[:, 2 * h :])
            state = (1 - z) * c + z * state
            out.append(state)
        states[side] = out if side == "f" else out[::-1]
    both = np.array([np.concatenate(s) for s in zip(states["f"], states["b"])])
    a = both @ p["attention"][:, 0]
    a = np.exp(a - a.max())
    mean = (a / a.sum()) @ both
    return float(sig(mean @ p["out"][:, 0] + p["out_bias"][0, 0]))


def test_toxicity_scores_equal_the_plain_version(prose, hard):
    """Each text's score is the highest of all its windows, each computed by itself."""
    texts = [prose(n, seed=n) for n in (1, 5, 31, 32, 33, 48, 49, 70, 200)] + ["", " . ", "é Größe 中文", "a"]
    data, offsets = toxicity.joined(texts)
    low = LOWER_OF(data)
    known = np.unique(low)[::2]
    network = toxicity.Network(3)
    model = toxicity.Model(known, network, 0.5)
    words = toxicity.read_words(data, offsets, known)
    vectors = network.inputs(words).astype(float)
    for text, score in enumerate(toxicity.score_block(model, data, offsets)):
        a, b = words.first[text], words.first[text + 1]
        starts = range(a, max(a, b - toxicity.WINDOW) + toxicity.STRIDE, toxicity.STRIDE) if b > a else ()
        best = max((plain_window(network, vectors[words.index[s : min(s + toxicity.WINDOW, b)]]) for s in starts), default=0.0)
        assert score == pytest.approx(best, abs=1e-4), texts[text][:30]


def LOWER_OF(data):
    from meterlake.llm.text import LOWER, span_hashes, spans

    low = LOWER[data]
    return span_hashes(low, *spans(low, np.array([0, len(low)]), toxicity.IS_WORD)[:2])


def test_a_passage_of_half_a_window_is_whole_in_some_window():
    assert toxicity.STRIDE <= toxicity.WINDOW // 2
    begin, length, _ = toxicity.windows_of(np.array([0, 500]))
    for start in range(500 - 17):
        assert any(b <= start and start + 17 <= b + n for b, n in zip(begin, length))


def test_toxicity_does_not_learn_from_the_held_out_fold(spark, documents, prose):
    rows = [(i, prose(20, seed=i) + (" vile" if i % 3 == 0 else "")) for i in range(90)]
    docs = documents(rows)
    scores = []
    for turn in (False, True):
        labels = [(i, 1, int(i % 3 == 0) ^ int(turn and folds(i, 4) == 2)) for i, _ in rows]
        model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS), held_out(4, 2, "key"))
        scores.append({r["doc_id"]: r["score"] for r in toxicity.classify(docs, model).collect()})
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 10


# Rules ------------------------------------------------------------------------------------------------
def test_ratio_of_one_text_by_hand():
    """Two words: one bucket each for the words and one for the pair, by the definition."""
    counts = lambda t: np.bincount(likelihood.hashed_ngrams(*toxicity.joined([t]))[0], minlength=1 << likelihood.BITS)
    target, raw = counts("good text good"), counts("good text good bad words bad")
    ratios = likelihood.log_ratios(target, raw)
    buckets = likelihood.hashed_ngrams(*toxicity.joined(["good words"]))[0]
    size = 1 << likelihood.BITS
    by_hand = [
        math.log((target[b] + 1) / (target.sum() + size)) - math.log((raw[b] + 1) / (raw.sum() + size)) for b in buckets
    ]
    found = likelihood.mean_ratio(ratios, *toxicity.joined(["good words"]))[0]
    assert found == pytest.approx(sum(by_hand) / len(by_hand)) and len(by_hand) >= 2


@pytest.mark.parametrize("most", [10_000, 40])
def test_order_statistics_are_exact(spark, most):
    values = [(float((i * 7919) % 5003 // 3),) for i in range(20_000)] + [(None,)] * 5 + [(7.0,)] * 9_000
    df = settle(spark.createDataFrame(values, "v double").repartition(5), "values")
    kept = sorted(v for (v,) in values if v is not None)
    for place in (1, 2, 290, 14_500, len(kept) - 1, len(kept)):
        assert likelihood.order_statistic(df, "v", place, most) == kept[place - 1]
    assert likelihood.order_statistic(df, "v", len(kept) + 1, most) is None
    assert likelihood.order_statistic(df.limit(0), "v", 1) is None


# Samples ----------------------------------------------------------------------------------------------
def test_samples_do_not_depend_on_the_layout(spark, prose):
    rows = [(i % 60, prose(5, seed=i)) for i in range(300)]  # each key with several texts
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)
    found = []
    for layout in (1, 13):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(layout, "text")
        sample = labelled_sample(docs, labels, "quality", per_class=10, max_chars=99, held_out=held_out(4, 2, "key"))
        found.append(sorted(map(tuple, sample.collect())))
    assert found[0] == found[1] and Counter(r[1] for r in found[0]) == {0: 10, 1: 10}


# Ring -------------------------------------------------------------------------------------------------
def test_each_row_lies_in_the_shard_of_its_place(spark, tmp_path, monkeypatch):
    """Whole result against walking the ring row by row; a hot key is ranked in many parts."""
    monkeypatch.setattr(ring, "ROWS_PER_DEAL", 16)
    spark.createDataFrame([(i if i < 300 else 7,) for i in range(700)], "doc_id bigint").repartition(4).write.parquet(str(tmp_path / "t"))
    docs = with_row_id(spark.read.parquet(str(tmp_path / "t")))
    placed = docs.withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(ring.POSITIONS)))
    for slack in (0.0, 0.25, 50.0):
        found = ring.shard(placed, 12, slack=slack, row_id=ROW_ID).collect()
        room, used = ring.capacities(700, 12, slack), Counter(r["shard"] for r in found)
        assert len(found) == 700 and all(used[s] <= room[s] for s in used)
        slots = Counter((r["shard"], r["slot"]) for r in found)
        assert set(slots.values()) == {1} and all(slot < used[shard] for shard, slot in slots)
        # Walk: places in order, keys wait for the next node with room, those that wait longest first.
        nodes, left = ring.nodes(12), {s: room[s] for s in range(12)}
        per_place = Counter(r["at"] for r in found)
        expected, waiting, turn = Counter(), [], 0
        while turn == 0 or waiting:
            for place in range(ring.POSITIONS):
                if turn == 0:
                    waiting += [place] * per_place[place]
                for shard in nodes.get(place, ()):
                    taken = waiting[: left[shard]]
                    del waiting[: left[shard]]
                    left[shard] -= len(taken)
                    expected.update((at, shard) for at in taken)
            turn += 1
        assert Counter((r["at"], r["shard"]) for r in found) == expected


# Candidates of the join -------------------------------------------------------------------------------
def raw_pairs(spark, prose, pages):
    """Pairs that meet among pages of one template, each with 10 to 13 % words of its own."""
    template = prose(203, seed=5, words=5000)
    rng = random.Random(1)
    rows = []
    for i in range(pages):
        own = [f"own{i}x{j}" for j in range(rng.randint(21, 26))]
        rows.append((i, template + " " + " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    limit = jaccard.Threshold(85, 100)
    members = jaccard.token_sets(docs, 4, limit, "doc_id", "text")
    chosen = jaccard.with_partners(members, jaccard._classes(members), limit)
    sets = jaccard.settle(jaccard.full_sets(docs, chosen, 4, "doc_id", "text"), "test-sets")
    entries = jaccard.settle(jaccard.postings(sets, limit), "test-entries")
    return jaccard.meeting(entries, limit).count(), entries.count()


def test_pages_of_one_template_do_not_meet_in_pairs(spark, prose):
    (few, entries), (many, more) = raw_pairs(spark, prose, 150), raw_pairs(spark, prose, 300)
    assert more > 1.8 * entries > 0
    assert many <= 2.2 * max(few, entries)


def test_one_of_two_that_may_link_is_light(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 60), rng.randint(1, 60), rng.random(), rng.random()) for _ in range(4000)]
    rows = [(a, b, int(a * x * x), int(b * y * y)) for a, b, x, y in rows]
    df = spark.createDataFrame(rows, "n_a int, n_b int, own_a int, own_b int").where("own_a < n_a AND own_b < n_b")
    for num, den in ((4, 5), (85, 100), (1, 2), (1, 1)):
        limit = jaccard.Threshold(num, den)
        may = df.where(limit.may_link("a", "b"))
        assert may.count() > 0 and may.where(~limit.light("_a") & ~limit.light("_b")).count() == 0


# Names and near copies --------------------------------------------------------------------------------
CLASH = ["_id", "_hash", "_text", "_kept", "_score", "_host", "_drop", "_place", "_rank", "id", "text_hash", "page", "row", "drop", "kept"]


def test_stages_keep_columns_of_any_name(spark, prose, tmp_path):
    rows = [(i, prose(60, seed=i) + "\nfooter", "en", "s", 1) for i in range(12)] + [(0, prose(60, seed=0) + "\nfooter", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASH])
    folder = str(tmp_path)
    spark.createDataFrame([], LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(60, seed=3))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = settle(stage(spark, docs, folder), f"clash-{name}")
        assert docs.columns[5:] == CLASH
        assert all(r[c] == f"{c}-{r['doc_id']}" for r in docs.collect() for c in CLASH)
    assert sorted(r["doc_id"] for r in docs.collect()) == [i for i in range(12) if i != 3]
    kept = lines.clean(docs, host="source").collect()
    assert all(r["_kept"] == f"_kept-{r['doc_id']}" and r["_drop"] == f"_drop-{r['doc_id']}" for r in kept)


def test_copies_keep_one_whole_text(spark, prose, tmp_path):
    """30 copies in 130 pages of a source; a footer is on every page."""
    shared = [prose(9, seed=i, words=3000) for i in range(20)]
    rows = [(i, "\n".join([*shared, "footer of the site"]), "s") for i in range(30)]
    rows += [(100 + i, "\n".join([prose(40, seed=500 + i, words=3000), "footer of the site"]), "s") for i in range(100)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    cleaned = settle(corpus_pipeline.line_dedup(spark, docs, str(tmp_path)), "copies-test")
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert not any("footer" in t for t in texts.values())
    assert all(texts[i] == "\n".join(shared) for i in range(30))
    left = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, cleaned, str(tmp_path)).collect()]
    assert sorted(left) == [0, *range(100, 200)]


def test_near_copies_keep_one_whole_text(spark, prose, tmp_path):
    """30 near copies of 20 shared lines, each with a line of its own or a line changed, in 130 pages of a
    source; a footer is on every page."""
    shared = [prose(9, seed=i, words=3000) for i in range(20)]
    near = [[*shared, prose(8, seed=900 + i, words=3000)] for i in range(30)]
    for i in range(15):
        near[i] = [prose(9, seed=950 + i, words=3000) if n == i else line for n, line in enumerate(shared)]
    rows = [(i, "\n".join([*parts, "footer of the site"]), "s") for i, parts in enumerate(near)]
    rows += [(100 + i, "\n".join([prose(40, seed=500 + i, words=3000), "footer of the site"]), "s") for i in range(100)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    cleaned = settle(corpus_pipeline.line_dedup(spark, docs, str(tmp_path)), "near-test")
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert all(texts[i] == "\n".join(parts) for i, parts in enumerate(near))
    assert not any("footer" in t for t in texts.values())
    left = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, cleaned, str(tmp_path)).collect()}
    assert 0 in left and set(range(100, 200)) <= left


def brute_near(rows, alike):
    """Near copies of rows (host, page, text), plainly: (host, page) and the key of the longest shared line."""
    pages = {(h, p): {x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")} - {""} for h, p, t in rows}
    on = Counter((h, line) for (h, _), lines_ in pages.items() for line in lines_)
    out = {}
    for (h, p), lines_ in pages.items():
        both = [x for x in lines_ if on[h, x] > 1]
        common, whole = sum(map(len, both)), sum(map(len, lines_))
        if both and common * (1 + alike) >= whole * 2 * alike:
            out[h, p] = {x for x in both if len(x) == max(map(len, both))}
    return out


def test_near_pages_agree_with_brute_force(spark, hard, prose):
    rng = random.Random(3)
    base = [[prose(rng.randint(1, 12), seed=100 * b + i, words=3000) for i in range(8)] for b in range(6)]
    rows = []
    for i in range(120):
        parts = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            parts[rng.randrange(8)] = prose(rng.randint(1, 9), seed=2000 + rng.randrange(150), words=3000)
        rows.append((rng.choice(["a", "b", None]), i, "\n".join(parts + ["Menu"] * rng.randint(0, 2))))
    rows += [("a", 200 + i, t) for i, t in enumerate(hard)] + rows[:3]
    docs = spark.createDataFrame(rows, "host string, page bigint, text string").repartition(3)
    found = lines.near_pages(lines.page_lines(docs, "host", "text", "page"), 0.8).collect()
    expected = brute_near(rows, 0.8)
    assert 10 < len(expected) < 120 and len(found) == len(expected)
    key = {x: k for x, k in spark.createDataFrame([(x,) for v in expected.values() for x in v], "x string").select("x", lines.line_key(F.col("x"))).collect()}
    assert all(r["copy_of"] in {key[x] for x in expected[r["host"], r["page"]]} for r in found)


def test_near_pages_of_no_rows_and_without_page(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, text string, page bigint")
    assert lines.clean(empty, host="source", page="page", alike=0.8).collect() == []
    with pytest.raises(ValueError, match="alike"):
        lines.clean(empty, host="source", alike=0.8)
