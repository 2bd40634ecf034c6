import random
import re

import numpy as np
import pytest
import xxhash

from heliograph.llm import components, simhash


def _fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(points, bits=2):
    """Component of each point by comparing all pairs."""
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def _crowd(rnd, n):
    """Points with dense balls, chains and loners."""
    points = [rnd.getrandbits(64) for _ in range(n // 4)]
    dense = rnd.getrandbits(64)
    points += [dense ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(5))) for _ in range(n // 2)]
    chain = rnd.getrandbits(64)
    for i in range(n // 4):
        chain ^= (1 << i % 64) | (1 << (i * 7 + 3) % 64)
        points.append(chain % (1 << 64))
    return np.unique(np.array([p % (1 << 64) for p in points], np.uint64))


def test_fingerprints_equal_brute_force():
    rnd = random.Random(1)
    texts = ["", " \n", "a", "A b", "É é x\x1cy\x85z", "a b c " * 2000]
    texts += [" ".join(rnd.choices(["The", "cat", "é", "x"], k=rnd.randrange(700))) for _ in range(60)]
    assert [simhash.fingerprint(t) for t in texts] == [_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t, 5) for t in texts] == [_fingerprint(t, 5) for t in texts]


@pytest.mark.parametrize("leaf", [4, 256])
def test_one_shard_finds_every_group(monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    points = _crowd(random.Random(leaf), 1600)
    groups = simhash._search(points)
    assert [groups.find(i) for i in range(len(points))] == _roots(points)


def test_linked_points_share_a_ball():
    rnd = random.Random(2)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for k in rnd.sample(range(64), rnd.randrange(5)):
            b ^= 1 << k
        balls = simhash._balls(np.array([a, b], np.uint64))
        assert bool(set(balls[0].tolist()) & set(balls[1].tolist())) == ((a ^ b).bit_count() <= 2)


@pytest.mark.parametrize("most", [200_000, 150])
def test_shards_together_find_every_group(spark, monkeypatch, most):
    """Many shards, some of them too large; with the small limit these are searched by neighbours."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 100)
    monkeypatch.setattr(simhash, "SHARD_MOST", most)
    points = _crowd(random.Random(5), 2000)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long")
    found = dict(components.components(simhash.links(table)).collect())
    named = {}
    for i, root in enumerate(_roots(points)):
        named.setdefault(root, set()).add(int(points.view(np.int64)[i]))
    want = {p: min(group) for group in named.values() if len(group) > 1 for p in group}
    assert found == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5), (2000, 1999)]
    random.Random(3).shuffle(edges)
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[i] for i in range(301)} == {0} and {found[1000 + i] for i in range(400)} == {1000}
    assert found[2000] == found[1999] == 1999
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _docs(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(400)]
    base = " ".join(words)
    near = base.replace(words[17], words[17] + "x")
    rows = [(5, base, 1), (3, near, 2), (9, base, 3), (7, None, 4), (2, "", 5), (2, "", 6), (None, " \t", 7), (4, "a b", 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, point int")


def test_groups_of_documents(spark):
    docs = _docs(spark)
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.simhash_groups(docs).collect()}
    rows = docs.collect()
    points = np.array([_fingerprint(r["text"]) for r in rows], np.uint64)
    roots = _roots(points)
    for i, row in enumerate(rows):
        own = [rows[j]["doc_id"] for j, r in enumerate(roots) if r == roots[i] and rows[j]["doc_id"] is not None]
        assert got[(row["doc_id"], f"{points[i]:016x}")] == min(own)
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = _docs(spark)
    kept = simhash.one_of_each(docs)
    groups = {r["component_id"] for r in simhash.simhash_groups(docs).collect()}
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(groups)
    assert [r["point"] for r in rows if r["doc_id"] == 2] in ([5], [6])
    assert simhash.one_of_each(docs.limit(0)).count() == 0
