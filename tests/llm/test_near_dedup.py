import random
import re

import pytest

from cardlens.llm import near_dedup
from cardlens.llm.components import components
from cardlens.llm.queries import QUERIES

@pytest.fixture
def sf_small():
    return "/root/testdata/sf0.001"


UP = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(UP))
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingle_set(text, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            for x in sets[i]:
                for y in sets[j]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        a, b = find(i), find(j)
                        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def fixture_rows(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, " ".join(w) if rng.random() < .7 else "\n ".join(x.upper() for x in w)))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \t"), (i + 3, "one"), (i + 4, "ONE"), (i + 5, "one two")]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_match_brute_force(spark, k, percent):
    rows = fixture_rows()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k_words=k, percent=percent)
    got = {r.doc_id: r for r in got.collect()}
    want = brute(rows, k, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())
    texts = dict(rows)
    assert all(r.n_shingles == len(shingle_set(texts[i], k)) for i, r in got.items())


def test_open_lists_reach_the_blocks(spark):
    """Without star rounds every link is found by the blocks alone."""
    rows = fixture_rows(5)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k_words=3, percent=85,
                                     star_rounds=0, block=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows, 3, 85)


def test_repeated_rows_nulls_and_extra_columns(spark):
    rows = [(2, "a b c d", 1), (2, "a b c d", 2), (1, "a b c d", 3), (None, "a b c d", 4), (None, None, 5), (7, "x y z", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sig int").withColumnRenamed("sig", "digest")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [("1", "1", True), ("2", "1", False), ("2", "1", False), ("7", "7", True),
                   ("None", "1", False), ("None", "None", False)]


def test_one_document_with_several_texts_is_one_component(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(5, a), (9, a), (9, b), (20, b), (30, "one two"), (30, None), (31, ""), (31, "one two"), (40, "x y z"), (40, "k l m")]
    rows += fixture_rows(11)
    rng = random.Random(4)
    rows += [(rng.randrange(60), rows[rng.randrange(len(rows))][1]) for _ in range(15)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(df, k_words=3, percent=85).collect()
    want = brute(rows, 3, 85)
    assert len(got) == len(rows)
    assert all(r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id]) for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(df).count() == 0


def test_long_chain_of_links(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 3), (9, 8), (8, 9)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 8: 8, 9: 8}


def test_query_on_whole_documents(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: r.component_id for r in QUERIES["op6_near_dedup"](spark, sf_small).collect()}
    assert got == brute(rows, 3, 85)
