"""The pipeline on planted documents."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from heliograph import session

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int"


def _prose(seed, n=150):
    rnd = random.Random(seed)
    words = [rnd.choice(["the", "of", "and"]) if i % 4 == 0 else "".join(rnd.choices("abcdefghij", k=6)) for i in range(n)]
    return " ".join(words)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    item = _prose(999, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    copy = _prose(1)
    texts = {
        1: copy, 2: copy, 3: _prose(2), 4: None, 5: "", 6: "too short", 7: _prose(3).replace(" ", "### "), 8: "again " * 50,
        9: f"{_prose(4, 60)} {item}", 10: f"{_prose(5)} token = 0123456789abcdef {_prose(6)}", 11: f"{_prose(7, 3000)} {item[:20]}",
        12: _prose(8, 6000),
    }
    rows = [(i, t, "en", "s", len(t or ""), 1) for i, t in texts.items()] + [(3, texts[3], "en", "s", len(texts[3]), 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = session.materialise(stage(spark, docs, folder), name)
    return folder, texts, found


def _ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_decides(stages):
    _, texts, found = stages
    assert _ids(found["quality_rules"]) == [1, 2, 3, 3, 9, 10, 11, 12]
    assert _ids(found["simhash_near_dedup"]) == [1, 3, 9, 10, 11, 12]
    assert _ids(found["benchmark_decontamination"]) == [1, 3, 10, 11, 12]
    rows = {r["doc_id"]: r for r in found["secret_scans"].collect()}
    assert sorted(rows) == [1, 3, 10, 11, 12]
    assert rows[10]["text"] == f"{_prose(5)} [assign] {_prose(6)}"
    assert all(r["text"] == texts[i] for i, r in rows.items() if i != 10)
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())


def test_all_but_the_last_keep_the_columns(stages):
    _, _, found = stages
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    assert all(df.columns == names for name, df in found.items() if name != "best_fit_packing")


def test_packed_pieces_are_the_kept_documents(stages):
    _, _, found = stages
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = found["best_fit_packing"].toPandas()
    for row in found["secret_scans"].collect():
        own = packed[packed.doc_id == row["doc_id"]].sort_values("piece")
        assert own.length.sum() == len(tokenizer.encode(row["text"], add_special_tokens=False).ids) + 1
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert np.array_equal(own.offset, [0, *own.length.cumsum()[:-1]]) and own.length.sum() <= 2048


def test_run_is_the_stages(spark, stages):
    folder, _, found = stages
    assert _ids(corpus_pipeline.run(spark, folder)) == _ids(found["best_fit_packing"])
