"""Phrase collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest

from heliograph.llm import collocations

FIELDS = "doc_id bigint, text string, lang string, n bigint, phrase string, k int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "x", 2) for i, (t, g) in enumerate(rows)], FIELDS)


def _brute(rows, longest, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    found = {}
    frequent = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    for (lang, p), a in frequent.items():
        inside = any(
            g == lang and len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (g, q), c in frequent.items()
        )
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            row = (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]])
            found.setdefault(lang, []).append(row)
    out = []
    for lang, own in found.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _texts(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "é", "ab", "a\x00", "a\x08b", "c-d", "\x1f", "ß1", "zz"]
    seps = [" ", "  ", "\t", " ", " ", ". ", "\n", ",", "!?"]
    made = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(60)))
        made.append((text, rng.choice(["en", "fr", None, "x\ty z", ""])))
    return [*made, (None, "en"), ("", None), ("a b " * 3000, "en"), ("a b " * 3000, "en"), (". , ;", "de")]


@pytest.mark.parametrize(("held", "ranges"), [(300_000, 1_000_000), (50, 400)])
def test_equals_plain_count(spark, monkeypatch, held, ranges):
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "RANGE_WINDOWS", ranges)
    rows = _texts(3, 300)
    found = collocations.collocations(_frame(spark, rows).repartition(5), longest=4, least=6, top=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == _brute(rows, 4, 6, 40)


def test_cuts_part_the_work(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_WINDOWS", 400)
    rows = _frame(spark, _texts(3, 300)).select("text", "lang").fillna("und", ["lang"])
    cuts = collocations._cuts(rows)
    assert len(cuts) > 5 and cuts == sorted(set(cuts))


def test_one_window_in_most_rows(spark):
    rows = [("same old story again today", "en")] * 5000 + [(f"w{i} same old", "en") for i in range(300)]
    found = collocations.collocations(_frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == _brute(rows, 5, 100, 2000)


def test_exact_beyond_64_bits(spark):
    counts = [("en", 0, 9 * 10**16), ("en\ta", 1, 7 * 10**16), ("en\tb", 1, 6 * 10**16 + 1), ("en\ta\tb", 2, 5 * 10**16 + 3)]
    frame = spark.createDataFrame(counts, "phrase string, size int, f bigint")
    row = collocations.from_counts(frame).collect()[0]
    assert row["score"] == 1000 * (5 * 10**16 + 3) * 9 * 10**16 // (7 * 10**16 * (6 * 10**16 + 1))


@pytest.mark.parametrize("rows", [[], [(None, None)], [("one two three", "en")]])
def test_nothing_frequent(spark, rows):
    assert collocations.collocations(_frame(spark, rows)).collect() == []


def test_query_equals_sql(spark, tmp_path):
    rng = random.Random(9)
    rows = [(" ".join(rng.choice("abcdef") for _ in range(80)) + ". One two, three", rng.choice(["en", None])) for _ in range(200)]
    _frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = collocations.op12_phrase_collocations(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, found)) == sorted(con.execute(collocations.SQL).fetchall()) != []
