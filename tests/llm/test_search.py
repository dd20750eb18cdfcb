"""Ranked search against plain Python, the bounds against full scoring, corner cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cardlens.llm import search as se

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item_id string, term int, block string"
ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    nd, nl = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc_id, bag in bags:
            m = 50 + 50 * sum(bag.values()) * nd // nl if nl else 50
            s = sum(math.floor(1000 * math.log((2 * nd + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                    for t in wanted if bag[t])
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k, block_docs=7):
    d = spark.createDataFrame([(i, t, "x", 0, "y") for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    return sorted(map(tuple, se.search(se.build_index(d, block_docs), q, k).select("item_id", "rank", "doc_id", "score").collect()),
                  key=repr)


@pytest.mark.parametrize("batch", [8, 10**5])
def test_corner_cases_against_plain_python(spark, monkeypatch, batch):
    monkeypatch.setattr(se, "BATCH_TERMS", batch)
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "ÉTÉ", "日本"]
    docs = [(i, " ".join(rnd.choices(vocabulary, [1 / (j + 1) for j in range(43)], k=rnd.randrange(1, 30)))) for i in range(120)]
    docs += [(200 + i, "same text w3 w7") for i in range(20)]  # ties beyond k
    docs += [(5, "w3 w4"), (5, "w3 w4"), (None, "w3 w3 w5"), (None, None), (300, ""), (301, " .-! "), (302, "W1,w1;W1 " * 20000)]
    items = [(i, " ".join(rnd.sample(vocabulary, rnd.randrange(1, 12)))) for i in range(9)]
    items += [(20, "same text"), (21, None), (22, ""), (23, "nowhere"), (24, "w1 w1 W1"), (24, "w2"), (None, "w3"), (25, "w3 w4 w5")]
    assert found(spark, docs, items, 6) == brute(docs, items, 6)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")], 5) == []
    assert found(spark, [(1, "a")], [], 5) == []
    assert found(spark, [(1, None), (2, "!")], [(1, "a")], 5) == []
    assert found(spark, [(1, "a")], [(1, "a"), (2, "b")], 5) == brute([(1, "a")], [(1, "a"), (2, "b")], 5)


def random_units(rnd, n, pairs, density):
    units, total = [], np.zeros(n, np.int64)
    for _ in range(pairs):
        lists = []
        for _ in range(rnd.randrange(1, 3)):
            docs = np.array(sorted(rnd.sample(range(n), max(1, int(n * density * rnd.random())))), np.int64)
            gains = np.array([rnd.randrange(0, 60) for _ in docs], np.int64)
            total[docs] += gains
            lists.append((docs, gains))
        unit = se.Unit(lists, max(int(g.max()) for _, g in lists))
        if len(lists) == 2:
            unit.common, unit.both = se.intersect(*lists)
        units.append(unit)
    return units, total


@pytest.mark.parametrize("joint", [True, False])
def test_bounds_lose_no_document(joint):
    rnd = random.Random(5)
    for _ in range(400):
        n, k = rnd.randrange(1, 80), rnd.randrange(1, 8)
        units, total = random_units(rnd, n, rnd.randrange(1, 7), rnd.random())
        least = rnd.choice([1, 1, int(np.quantile(total, 0.9)) + 1, int(total.max()), int(total.max()) + 1])
        places, scores = se.best_of_block(units, n, k, max(1, least), joint)
        got = dict(zip(places.tolist(), scores.tolist(), strict=True))
        assert all(total[p] == s for p, s in got.items())
        kth = np.sort(total)[::-1][:k].min()
        want = {p for p in range(n) if total[p] >= max(1, least, kth if n >= k else 0)}
        assert want <= set(got)


def test_joint_maxima_skip_more_than_single_maxima():
    """Terms that avoid each other: together they never reach the sum of their maxima."""
    n = 1000
    units = []
    for _ in range(6):
        a, b = np.arange(0, n, 2), np.arange(1, n, 2)
        unit = se.Unit([(a, np.full(500, 10)), (b, np.full(500, 10))], 10)
        unit.common, unit.both = se.intersect(*unit.lists)
        assert unit.bound == 10 and not len(unit.common)
        units.append(unit)
    rare = np.array([17])
    units.append(se.Unit([(rare, np.array([50]))], 50))
    pair, single = [], []
    for joint, walked in ((True, pair), (False, single)):
        places, scores = se.best_of_block(units, n, 1, 70, joint, walked)
        assert places.tolist() == [17] and scores.tolist() == [110]
    assert pair[0] < single[0] / 10
    # a pair that counts only where both terms meet: candidates come from the intersection list
    both = se.Unit([(np.arange(0, 600), np.full(600, 30)), (np.arange(590, 1000), np.full(410, 30))], 30)
    both.common, both.both = se.intersect(*both.lists)
    walked = []
    places, scores = se.best_of_block([both], n, 20, 40, True, walked)
    assert places.tolist() == list(range(590, 600)) and set(scores.tolist()) == {60}
    assert walked[0] == 10 + 2 * 10
