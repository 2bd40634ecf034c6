import itertools
import random
from collections import Counter

import pytest

from heliograph.llm import license_scans as scans


def _scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, block string")
    return scans.scan(docs).orderBy("doc_id", "block").collect()


@pytest.mark.parametrize("n", range(len(scans.TEMPLATES)))
def test_every_template_knows_itself(n):
    primed = scans.Templates(scans.TEMPLATES)
    block = scans.words(scans.TEMPLATES[n][1])
    gain, best = primed.ranked(block)[0]
    assert best == n and gain > 0.2 and primed.differences(block, n) == (True, [], [])


def test_notices_in_texts(spark):
    rnd = random.Random(4)
    filler = " ".join("".join(rnd.choices("abcdefg", k=6)) for _ in range(100))
    named = [f"{filler}\n{text}\n{filler}" for _, text, _ in scans.TEMPLATES]
    rows = _scan(spark, named)
    assert {r["doc_id"]: r["license"] for r in rows if r["confirmed"]} == {i: t[0] for i, t in enumerate(scans.TEMPLATES)}


def test_wording_decides(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}."
    rows = _scan(spark, [gpl.format(2), gpl.format(3), gpl.format(9), "my driver's license was in Mit\nhand", None, "", "none"])
    assert [(r["doc_id"], r["license"], r["confirmed"]) for r in rows if r["confirmed"]] == [(0, "GPL-2.0", True), (1, "GPL-3.0", True)]
    assert {r["doc_id"] for r in rows} == {0, 1, 2, 3}
    assert "-2" in rows[2]["differences"] or "-3" in rows[2]["differences"]


def test_places_and_repeats(spark):
    text = "é😀\nReleased under the MIT License.\nx\n\n\n" + "y " * 400 + "\nAll rights reserved."
    rows = _scan(spark, [text, text])
    assert len(rows) == 4
    for r in rows:
        assert text[r["start"] : r["end"]] in ("Released under the MIT License.", "All rights reserved.")
    assert [r["block"] for r in rows] == [0, 1, 0, 1]


def test_very_long_text(spark):
    text = "license " * 100_000 + "\nReleased under the ISC License."
    rows = _scan(spark, [text])
    assert rows[-1]["license"] == "ISC" or not rows[-1]["confirmed"]
    assert all(r["end"] - r["start"] <= scans.BLOCK + scans.REACH for r in rows)
    covered = sum(r["end"] - r["start"] for r in rows)
    assert covered >= len(text) - len(rows) * 2


LEGAL = (
    "The parties agree that no warranty of any kind, express or implied, shall apply to the software or its documentation, "
    "and that permission to copy, modify, publish and distribute this work in source or binary form is subject to the "
    "following conditions, provided that the copyright holder keeps the notice in all copies of the program, "
)
PLAIN = "we walked along the river for an hour and then had a long lunch with old friends from the village near the lake, "


@pytest.mark.parametrize("n", range(len(scans.TEMPLATES)))
@pytest.mark.parametrize("prose", [PLAIN, LEGAL])
def test_every_template_in_long_prose_lines(n, prose):
    primed = scans.Templates(scans.TEMPLATES)
    text = prose * 4 + scans.TEMPLATES[n][1] + " " + prose * 4
    found = {primed.names[row[4]] for row in scans.notices(text, primed) if row[2]}
    assert scans.TEMPLATES[n][0] in found


@pytest.mark.parametrize("n", range(len(scans.TEMPLATES)))
def test_every_template_in_merged_blocks(n):
    primed = scans.Templates(scans.TEMPLATES)
    lines = ["no warranty of any kind is given", "the copyright notice in the source must stay", "the public license applies"]
    text = "\n".join(lines * 8 + [scans.TEMPLATES[n][1].replace("\n", " ")] + lines * 8)
    assert len(scans.blocks(text)) == 1
    found = {primed.names[row[4]] for row in scans.notices(text, primed) if row[2]}
    assert scans.TEMPLATES[n][0] in found


def test_matches_equal_brute_force():
    rnd = random.Random(6)
    primed = scans.Templates((("X", "a b c d a e f g", "c"), ("Y", "k a l", "k l")))

    def within(kept, part):
        rest = iter(part)
        return all(w in rest for w in kept)

    def fits(i, part):  # some choice of missing words leaves all key words and a rest that the part has in order
        own, most = primed.wording[i], primed.most[i]
        for n in range(most + 1):
            for kept in itertools.combinations(own, len(own) - n):
                if len(part) - len(kept) <= most and not Counter(primed.keys[i]) - Counter(kept) and within(kept, part):
                    return True
        return False

    seen = set()
    for _ in range(600):
        i = rnd.randrange(2)
        block = list(primed.wording[i])
        for _ in range(rnd.randrange(5)):
            at = rnd.randrange(len(block))
            block[at : at + rnd.randrange(2)] = rnd.choices("abcdefgkl", k=rnd.randrange(2))
        block = rnd.choices("abcdefgkl", k=rnd.randrange(6)) + block + rnd.choices("abcdefgkl", k=rnd.randrange(6))
        places = primed.matches(block, i)
        for start, end, missing, added in places:
            assert max(len(missing), len(added)) <= primed.most[i]
            assert end - start == len(primed.wording[i]) - len(missing) + len(added)
        spans = [(x, y) for x in range(len(block)) for y in range(x + 1, len(block) + 1) if fits(i, block[x:y])]
        assert bool(places) == bool(spans)
        # Every place that is left out overlaps one that is taken.
        assert all(any(x < end and start < y for start, end, _, _ in places) for x, y in spans)
        seen.add((i, bool(places)))
    assert len(seen) == 4


def _found(text):
    primed = scans.Templates(scans.TEMPLATES)
    return [(primed.names[row[4]] if row[2] else None, text[row[0] : row[1]]) for row in scans.notices(text, primed)]


def test_notices_on_adjacent_lines():
    lines = [
        "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.",
        "The other license is not known here.", "All rights reserved.",
    ]
    text = "\n".join(lines)
    assert len(scans.blocks(text)) == 1
    assert _found(text) == [
        ("Apache-2.0", lines[0]), ("MIT", lines[1]), ("reserved", lines[2]), (None, f"\n{lines[3]}\n"), ("reserved", lines[4])
    ]


def test_notices_in_one_line():
    text = "It is Released under the MIT License. Or Licensed under CC BY-SA 4.0, as you wish. " + PLAIN
    assert [x for x in _found(text) if x[0]] == [
        ("MIT", "Released under the MIT License."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0,")
    ]


@pytest.mark.parametrize("between", [1, 300, 600, 900])
def test_notices_near_each_other(between):
    wrapped = next(t for _, t, key in scans.TEMPLATES if key == "permission sublicense software")
    gap = "\n" + (PLAIN * 10)[:between] + "\n"
    text = wrapped + gap + "Released under the ISC License." + gap + "Licensed under CC BY 4.0."
    assert len(scans.blocks(wrapped)) > 1  # widened
    assert _found(text) == [("MIT", wrapped), ("ISC", "Released under the ISC License."), ("CC-BY-4.0", "Licensed under CC BY 4.0.")]


def test_every_pair_of_templates():
    primed = scans.Templates(scans.TEMPLATES)
    for (one, first, _), (two, second, _) in itertools.permutations(scans.TEMPLATES, 2):
        for gap in ("\n", "\n\n" + "word " * 20 + "\n"):
            rows = [row for row in scans.notices(first + gap + second, primed) if row[2]]
            assert [primed.names[row[4]] for row in rows] == [one, two], (first, second, gap)


def test_overlapping_places_give_the_best():
    text = "This work is licensed under the GNU Lesser General Public License, version 2.1"
    assert _found(text)[0][0] == "LGPL" and len(_found(text)) == 1
    assert [name for name, _ in _found("Licensed under CC BY-SA 4.0.")] == ["CC-BY-SA-4.0"]


def test_ranking_by_compression_decides(monkeypatch):
    templates = (
        ("short", "Released under the plain license.", "plain license"),
        ("long", "You may use it freely. Released under the plain license. No warranty is given.", "plain license"),
    )
    primed = scans.Templates(templates)
    text = "Hello there. " + templates[1][1]
    assert [primed.names[row[4]] for row in scans.notices(text, primed) if row[2]] == ["long"]
    ranked = scans.Templates.ranked
    monkeypatch.setattr(scans.Templates, "ranked", lambda self, *given: ranked(self, *given)[::-1])
    assert [primed.names[row[4]] for row in scans.notices(text, primed) if row[2]] == ["short"]


def test_reach_follows_the_templates():
    wording = "the owner of " + "many different things " * 60 + "gives a license to all"
    primed = scans.Templates((("X", wording, "owner license"),))
    text = "word " * 400 + wording + " and more" * 400
    assert [(row[0], row[2]) for row in scans.notices(text, primed) if row[2]] == [(2000, True)]


def test_empty_table_and_clashing_names(spark):
    fields = "doc_id long, text string, block int, license string, id string, confirmed int"
    assert scans.scan(spark.createDataFrame([], fields)).collect() == []
    rows = [(None, "All rights reserved.", 1, "x", "y", 2)] * 2
    found = scans.scan(spark.createDataFrame(rows, fields)).collect()
    assert [(r["doc_id"], r["license"], r["confirmed"]) for r in found] == [(None, "reserved", True)] * 2
