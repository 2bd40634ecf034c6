import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from heliograph.llm import packing, segments, token_counts
from heliograph.llm.common import strings

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b \n c", "x ", "a\n b", "a<|endoftext|> b <|endoftext|>c", "don't  stop 's 've", " a  b",
    "é ü\x1c \x1cx ", "a" * 3000 + " " + "b" * 10, "日本 語　x", "\t\tx\t y", "😀😀 😀", "\r\n\r\n a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(text):
    return np.concatenate(list(segments.ids(PATH, text))).tolist()


def test_ids_are_the_library_s(library, monkeypatch):
    rnd = random.Random(3)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "1", ".", "'s", "é", " ", "\x1c", " ", "<|endoftext|>", "!"]
    texts = ODD + ["".join(rnd.choices(alphabet, k=rnd.randrange(16))) for _ in range(3000)]
    for most in (1 << 20, 3):
        monkeypatch.setattr(segments.pieces, "__defaults__", (most,))
        for text in texts:
            assert _ids(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_runs_of_white_space(library):
    text = " " * 1_000_000 + "x"
    assert _ids(text) == library.encode(text, add_special_tokens=False).ids


def test_pieces_put_together_are_the_text():
    text = "ab cd  ef\n gh " * 1000
    cut = segments.pieces(text, 50)
    assert "".join(cut) == text and len(cut) > 100
    assert segments.pieces("x" * 500, 50) == ["x" * 500]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(name):
    path = public_tokenizers.path(name)
    got = [np.concatenate(list(segments.ids(path, t))).tolist() for t in ODD]
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert got == [model.encode(t) for t in ODD]


def test_slices_are_cut_by_bytes(monkeypatch):
    """Each slice alone becomes Python strings, and is weighed in UTF-8."""
    made = []
    monkeypatch.setattr(token_counts, "strings", lambda batch, c: made.append(batch.column(c).to_pylist()) or strings(batch, c))
    texts = ["日本" * 100_000, "é" * 300_000, None, "", "ab" * 100_000, "日" * 500_000, "x"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": pa.array(texts, pa.string())})
    found = pa.Table.from_batches(list(token_counts._lengths(PATH)(iter([batch])))).to_pydict()
    assert made == [[texts[0]], texts[1:5], [texts[5]], [texts[6]]]
    assert found["id"] == list(range(7)) and found["n_bytes"] == [len((t or "").encode()) for t in texts]
    assert found["n_tokens"] == [len(_ids(t or "")) for t in texts]


def test_counts(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, None), (3, "x ", "x"), (3, "w " * 600, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts.count_tokens(docs, PATH).collect()
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def _least_bins(lengths, capacity):
    """Fewest bins by trying every placement."""
    best = [len(lengths)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for left in sorted(set(bins)):
            if left >= lengths[i]:
                rest = list(bins)
                rest.remove(left)
                put(i + 1, [*rest, left - lengths[i]])
        put(i + 1, [*bins, capacity - lengths[i]])

    put(0, [])
    return best[0]


def test_bound_and_packing_enclose_the_optimum():
    rnd = random.Random(7)
    for _ in range(150):
        capacity = rnd.choice([10, 17, 30])
        lengths = np.array([rnd.randrange(1, capacity) for _ in range(rnd.randrange(1, 9))])
        bins, offsets, made = packing.best_fit(lengths, capacity)
        least = _least_bins(sorted(lengths.tolist(), reverse=True), capacity)
        assert packing.lower_bound(lengths, capacity) <= least <= made
        for b in range(made):
            own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
            assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]
            assert sum(n for _, n in own) <= capacity
    assert packing.lower_bound(np.array([], int), 10) == 0
    assert packing.lower_bound(np.array([6, 6, 6, 4]), 10) == 3  # total length alone says 3 too
    assert packing.lower_bound(np.array([7, 7, 7, 4, 4, 4]), 10) == 5  # total length says 4


def _checked(packed, capacity):
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= capacity
    return packed.sequence_id.nunique()


def test_documents_come_back_whole(spark, library):
    rnd = random.Random(9)
    texts = ["the end " * rnd.randrange(0, 40) + "é" * rnd.randrange(5) for _ in range(200)] + ["a b " * 400, None, "", "x y"]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "x y", 5), (3, texts[3], 6), (3, texts[3], 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    packed = packing.pack_documents(docs, PATH, capacity=64).toPandas()
    _checked(packed, 64)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)] if len(ids) > 64 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((float("nan") if i is None else i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = packed[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)
    key = lambda r: tuple(-1 if pd.isna(x) else int(x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_partitions_with_a_gap_exchange_documents(spark):
    rnd = random.Random(4)
    rows = [(i, 0, 0, rnd.randrange(20, 70), i) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "id long, piece int, start long, length long, ids_crc32 long")
    once = packing.pack(pieces, 100, dealt=100, rounds=0).toPandas()
    more = packing.pack(pieces, 100, dealt=100, rounds=4).toPandas()
    assert len(once) == len(more) == 3000 and sorted(more["id"]) == list(range(3000))
    assert _checked(more, 100) <= _checked(once, 100)
    assert set(more.columns) == {"id", *packing.PIECE, "sequence_id", "offset", "gap"}


def test_a_lone_partition_with_a_gap_exchanges_with_certified_ones(spark):
    saved = 0
    for seed, n, low, high in ((1, 60, 15, 45), (14, 60, 15, 45), (17, 120, 5, 50)):
        rnd = random.Random(seed)
        assert (rnd.choice([60, 80, 120]), rnd.choice([(10, 60), (5, 50), (15, 45)])) == (n, (low, high))
        rows = [(i, 0, 0, rnd.randrange(low, high), i) for i in range(n)]
        pieces = spark.createDataFrame(rows, "id long, piece int, start long, length long, ids_crc32 long").coalesce(1)
        once = packing.pack(pieces, 100, dealt=20, rounds=0).toPandas()
        assert once[once.gap > 0].sequence_id.floordiv(1 << 25).nunique() == 1
        more = packing.pack(pieces, 100, dealt=20).toPandas()
        assert sorted(more["id"]) == list(range(n))
        saved += _checked(once, 100) - _checked(more, 100)
    assert saved > 0
