import hashlib
import random
from collections import defaultdict

from heliograph.llm import sharding


def _bits(key):
    return bin(int(hashlib.md5(key.encode()).hexdigest()[:15], 16))[2:].zfill(60)


def _brute(rows, limit):
    """Shards of distinct keys, splitting one bucket at a time."""
    todo, done = [("", rows)], {}
    while todo:
        prefix, own = todo.pop()
        if sum(n for _, n in own) <= limit or len(own) <= 1:
            for key, _ in own:
                done[key] = (prefix, sum(n for _, n in own), len(own))
            continue
        for bit in "01":
            todo.append((prefix + bit, [r for r in own if _bits(r[0])[len(prefix)] == bit]))
    return done


def test_equal_to_splitting_one_bucket_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PASS_BITS", 3)
    rnd = random.Random(1)
    texts = {i: "é" * rnd.choice([0, 1, 5, 400]) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = sharding.assign(docs, 2000, columns=["doc_id"]).collect()
    want = _brute([(str(i), len(t.encode())) for i, t in texts.items()], 2000)
    got = {str(r["doc_id"]): (r["shard"], r["shard_bytes"], r["shard_rows"]) for r in found}
    assert got == want and len(found) == 300
    assert all(len(r["shard"]) == r["depth"] for r in found)


def test_rows_of_one_key_are_parted(spark):
    docs = spark.createDataFrame([(7, "z" * 300)] * 200 + [(8, "z"), (None, None), (None, "")], "doc_id long, text string")
    found = sharding.assign(docs, 5000, columns=["doc_id"]).collect()
    size = defaultdict(int)
    for r in found:
        size[r["shard"]] += r["n_bytes"]
    assert len(found) == 203 and max(size.values()) <= 5000 and len(size) > 10
    assert {r["shard_bytes"] for r in found} == set(size.values())


def test_a_row_above_the_limit_is_a_shard(spark):
    docs = spark.createDataFrame([(1, "z" * 9000), (2, "a"), (3, "b")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in sharding.assign(docs, 100).collect()}
    assert found[1]["shard_rows"] == 1 and found[1]["shard_bytes"] == 9000


def test_columns_stay(spark, tmp_path):
    rows = [(i, "t" * 50, "x", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, n_bytes int")
    found = sharding.assign(docs, 200)
    assert found.columns == ["doc_id", "text", "shard", "n_bytes", "n_bytes_", "shard_", "depth", "shard_bytes", "shard_rows"]
    sharding.write_shards(docs, str(tmp_path / "out"), 200)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in back.select(docs.columns).collect()) == sorted(rows)
    assert sharding.assign(docs.limit(0), 200).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = sharding.op8_sharding(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
