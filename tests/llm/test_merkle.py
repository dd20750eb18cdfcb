"""The manifest against a tree built in plain Python, octopus sets against a search, corner cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cardlens.llm import merkle as mk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx string, tree int, digest string, id string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(one, (doc_id, source, lang, n_chars, text)))


def levels(row):
    out = [row]
    while len(row) > 1:
        row = [h(*row[i:i + 2]) for i in range(0, len(row), 2)]
        out.append(row)
    return out


def brute(rows):
    """rows of (doc_id, text, lang, source, n_chars) -> sorted result rows."""
    groups = {}
    for r in rows:
        claim = r
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
            claim = (*r[:4], r[4] + 1)
        groups.setdefault(r[2], []).append((r[0], leaf(*r), leaf(*claim)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(levels([x[1] for x in groups[g]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for g, name in enumerate(names):
        for i, (doc_id, own, claim) in enumerate(groups[name]):
            proof, now = "", claim
            for at, row in [(i >> k, row) for k, row in enumerate(trees[g][:-1])] + [
                    (g >> k, row) for k, row in enumerate(top[:-1])]:
                other = row[at ^ 1] if at ^ 1 < len(row) else ""
                proof += other
                now = h(other, now) if at & 1 else h(now, other)
            root = top[-1][0]
            out.append((doc_id, own, trees[g][-1][0], root, h(proof), now, now == root))
    return sorted(out, key=repr)


def found(spark, rows, span):
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)
    got = mk.prove(mk.documents_manifest(docs, span), ["id"], "claim", span)
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.folded_root == r.root)
                   for r in got.collect()), key=repr)


@pytest.mark.parametrize("span", [1, 2, 5])
def test_corner_cases_against_plain_python(spark, span):
    rows = [(i, f"text {i}", "en", "web", i) for i in range(19)]
    rows += [(i, "é" * i, "dé", None, None) for i in range(40, 44)] + [(5, "alone", "zz", "s", 5)]
    rows += [(None, None, None, None, None), (None, "", None, "a", 0), (3, "x" * 200_000, None, "b", 200_000)]
    # repeated ids with other texts, repeated rows, an id of both
    rows += [(7, "other", "en", "web", 1), (8, "text 8", "en", "web", 8), (8, "text 8", "en", "web", 8)]
    assert found(spark, rows, span) == brute(rows)


def test_one_group_one_row_and_none(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [(0, "a", "en", "s", 1)], 2) == brute([(0, "a", "en", "s", 1)])
    rows = [(i, "a", None, "s", 1) for i in range(8)]
    assert found(spark, rows, 2) == brute(rows)


def test_missing_columns_count_as_null(spark):
    got = mk.prove(mk.documents_manifest(spark.range(3).toDF("doc_id")), ["id"], "claim").collect()
    assert {r.leaf for r in got} == {leaf(i, None, None, None, None) for i in range(3)}


def test_octopus_is_minimal():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randrange(1, 70)
        wanted = set(rnd.sample(range(n), rnd.randrange(1, n + 1)))
        need = mk.octopus(wanted, n)
        tree = levels([h(str(i)) for i in range(n)])
        known = {(0, i): bytes.fromhex(tree[0][i]) for i in wanted}
        fetched = {(k, i): bytes.fromhex(tree[k][i]) for k, i in need}
        assert mk.derive({**known, **fetched}, n).hex() == tree[-1][0]
        for gone in need:  # nothing is fetched that could be spared
            with pytest.raises(KeyError):
                mk.derive({**known, **{k: v for k, v in fetched.items() if k != gone}}, n)


def test_proofs_of_a_few_leaves_fetch_inside_their_partition(spark):
    rows = [(i, f"text {i}", "en", "web", i) for i in range(60)] + [(100, "t", "fr", "w", 1)]
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)
    manifest = mk.documents_manifest(docs, 4)
    wanted = spark.createDataFrame([("=en", 3), ("=en", 4), ("=en", 59)], "tree string, idx long")
    got = {r.id: r for r in mk.prove(manifest, ["id"], "digest", 4, wanted).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert sorted(got) == [3, 4, 59]
    for i, r in got.items():
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) == (*want[i][1:5], r.root)
    # 3 and 4: two leaves, two pairs and one node of level 3 beside the shared block root, then 2 above and the other group
    assert got[3].n_fetched == len(mk.octopus({3, 4}, 60)) + 1
    assert got[3].n_fetched < got[3].n_siblings + got[4].n_siblings


def test_tampering_is_seen_only_where_it_happened(spark):
    rows = [(i, f"text {i}", "en", "web", i if i % 3 else None) for i in range(40)]
    for r in found(spark, rows, 3):
        hit = zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[0] % 3 != 0
        assert r[6] == (not hit)


def test_whole_partitions_read_no_node_below_their_own(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    got = mk.prove(mk.documents_manifest(docs, 3), ["id"], "claim", 3).collect()
    assert {r.n_fetched for r in got} <= {1, 2, 3} and {r.n_siblings for r in got} <= {4, 5, 6}
