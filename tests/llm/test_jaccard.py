import random
import re

import numpy as np
import pytest

from meterlake.llm import jaccard


def shingles(text, k):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den):
    """Set sizes, links between different rows, and the smallest key of each row's component."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and den * both >= num * (len(a) + len(b) - both):
                links.add((j, i))
                parent[root(i)] = root(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(key)
    smallest = {r: min((k for k in keys if k is not None), default=None) for r, keys in groups.items()}
    return [len(s) for s in sets], links, [smallest[root(i)] for i in range(len(rows))]


def variants(prose, rng):
    """Families of near copies at many distances, chains, and passages that many texts share."""
    rows = []
    passage = prose(40, seed=99)
    for family in range(6):
        base = prose(rng.randint(20, 120), seed=family).split()
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"new{rng.randint(0, 3)}"
            rows.append(" ".join(words))
        base = list(base)
        for step in range(6):  # a chain: each changes one word more
            base[-1 - step * 5 % len(base)] = f"step{step}"
            rows.append(" ".join(base))
    for i in range(25):
        rows.append(prose(rng.randint(5, 60), seed=1000 + i) + " " + passage)
        rows.append(passage + " " + prose(rng.randint(0, 8), seed=2000 + i))
    rows += ["A b C", "a B c", "one", "one", "one two three four", "", None, "  "]
    return rows


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 4, 5), (3, 1, 2)])
def test_agrees_with_brute_force(documents, prose, k, num, den):
    rng = random.Random(k)
    texts = variants(prose, rng)
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(500, texts[0]), (0, texts[0]), (None, texts[1]), (501, texts[2])]
    sizes, _, smallest = brute(rows, k, num, den)
    found = jaccard.join(documents(rows), k=k, num=num, den=den).collect()
    expected = sorted(((i, n, c) for (i, _), n, c in zip(rows, sizes, smallest, strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == expected


def test_all_links_are_found(documents, prose):
    texts = list(dict.fromkeys(variants(prose, random.Random(5))))
    rows = [(i, t) for i, t in enumerate(texts)]
    unique = {}
    for i, t in rows:
        unique.setdefault(frozenset(shingles(t, 4)), i)
    _, links, _ = brute([(i, texts[i]) for i in unique.values()], 4, 85, 100)
    pairs, members = jaccard.similar_pairs(documents(rows), k=4, num=85, den=100)
    of = {}
    for r in members.collect():
        of.setdefault(r["c"], []).append(r["doc_id"])
    assert pairs.count() == pairs.distinct().count() == len(links)


def test_more_matches_are_asked_where_entries_are_frequent(spark):
    limit = jaccard.Threshold(4, 5)
    # Each set has tokens of its own in front, then tokens that all share.
    sets = [(c, 20, [c * 100 + i for i in range(2)] + list(range(-18, 0))) for c in range(1, 30)]
    rows = jaccard.postings(spark.createDataFrame(sets, "c bigint, n bigint, tokens array<bigint>"), limit)
    chosen = {r["l"] for r in rows.collect()}
    assert len(chosen) == 1 and rows.groupBy("c").count().agg({"count": "max"}).first()[0] >= 1
    pairs = jaccard.candidate_pairs(rows, limit)
    assert pairs.count() == 29 * 28 // 2


def test_large_group_of_near_copies_is_not_expanded(spark, documents, prose):
    base = prose(200, seed=1).split()
    rows = []
    for i in range(400):
        words = list(base)
        words[i % 200] = f"edit{i}"
        rows.append((i, " ".join(words)))
    limit = jaccard.Threshold(4, 5)
    members = jaccard.token_sets(documents(rows), 5, limit, "doc_id", "text")
    chosen = jaccard.with_partners(members, jaccard._classes(members), limit)
    sets = jaccard.settle(jaccard.full_sets(documents(rows), chosen, 5, "doc_id", "text"), "test-sets")
    entries = jaccard.settle(jaccard.postings(sets, limit), "test-postings")
    near = jaccard.components(jaccard.verified(jaccard.pivot_pairs(entries, limit), sets, limit))
    assert jaccard.candidate_pairs(entries, limit, near).count() < 4 * len(rows)
    ids = {r["component_id"] for r in jaccard.join(documents(rows)).collect()}
    assert ids == {0}


def test_overlap_of_prefixes_is_a_lower_bound():
    rng = random.Random(8)
    limit = jaccard.Threshold(85, 100)
    for _ in range(3000):
        base = rng.sample(range(60), rng.randint(5, 40))
        sets = [sorted({x if rng.random() > 0.06 else rng.randint(60, 90) for x in base}) for _ in range(2)]
        a, b = (set(x) for x in sets)
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        t = [limit.needed(len(x)) for x in sets]
        for l_a in range(1, t[0] + 1):
            l_b = rng.randint(1, t[1])
            first = [set(x[: len(x) - y + z]) for x, y, z in zip(sets, t, (l_a, l_b), strict=True)]
            need = -(-85 * (len(a) + len(b)) // 185) - max(t[0] - l_a, t[1] - l_b)
            assert len(first[0] & first[1]) >= need


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    found = {r["c"]: r["component"] for r in jaccard.components(chain).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_filter_keeps_sets_with_a_partner():
    limit = jaccard.Threshold(85, 100)
    for n in range(1, 400):
        t = limit.needed(n)
        assert 100 * t >= 85 * n > 100 * (t - 1)
        assert jaccard.matches(np.array(n)) >= jaccard.matches(np.array(t))


def test_empty_table_hard_texts_and_clashing_columns(spark, documents, hard):
    assert jaccard.join(documents([])).collect() == []
    rows = list(enumerate(hard))
    found = {r["doc_id"]: r["component_id"] for r in jaccard.join(documents(rows)).collect()}
    assert found == {i: i for i in range(len(hard))}
    clash = spark.createDataFrame([(1, "a b", 5), (2, "A b", 6)], "doc_id int, text string, n int")
    assert {r["component_id"] for r in jaccard.join(clash).collect()} == {1}
