"""License scans by conditional compression: which template, given as a dictionary, makes a block the smallest.

Blocks of lines around license words are candidates. Each is compressed alone and with every template as a raw
dictionary; templates are ranked by how much smaller the block gets, and confirmed by comparing words. Every place that a
template has in a block is a notice, so several licenses side by side are all found.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm.common import slices, strings, table

CUE = (
    r"licen[sc]e|copyright|rights reserved|permission is hereby|permission to use|warrant(?:y|ies)|public domain|redistribut"
    r"|creative commons|\bcc0|\bcc by"
)
_CUE = re.compile(CUE, re.I | re.A)
_MARKS = re.compile(r"[^\w\s]*")  # what ends a sentence belongs to its last word

# The largest share of a template's words that may be missing, and that may be put between them.
DIFFERING = 0.15

LEVEL = 9

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at"""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at"""
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_CC = "This work is licensed under a Creative Commons {} International License."

# Fixed values: (license, wording, words that must be there exactly).
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit license"),
    ("MIT", _MIT, "permission sublicense software"),
    ("ISC", "Released under the ISC License.", "isc license"),
    ("ISC", _ISC, "permission fee"),
    ("BSD", "Released under the BSD License.", "bsd license"),
    ("BSD", _BSD, "redistribution binary"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache license 2 0"),
    ("Apache-2.0", _APACHE, "apache license 2 0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general public 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general public 3"),
    ("GPL-3.0", _GPL, "gnu general public 3"),
    ("LGPL", "This work is licensed under the GNU Lesser General Public License.", "gnu lesser general public"),
    ("AGPL", "This work is licensed under the GNU Affero General Public License.", "gnu affero general public"),
    ("MPL-2.0", _MPL, "mozilla public 2 0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4 0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa 4 0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc 4 0"),
    ("CC-BY-4.0", _CC.format("Attribution 4.0"), "creative commons attribution 4 0"),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike 4.0"), "creative commons attribution sharealike 4 0"),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial 4.0"), "creative commons attribution noncommercial 4 0"),
    ("CC0-1.0", "Released under CC0 1.0.", "cc0 1 0"),
    ("Unlicense", _UNLICENSE, "unencumbered public domain"),
    ("reserved", "All rights reserved.", "all rights reserved"),
)


# A longer line is a candidate only this far around its cues, and notices are looked for so far after a block, as they
# may run over lines without cues: twice the longest wording. Merged lines are cut into blocks of about BLOCK.
def _reach(templates: tuple[tuple[str, str, str], ...]) -> int:
    return 2 * max(len(text) for _, text, _ in templates)


REACH = _reach(TEMPLATES)
BLOCK = 8 * REACH

_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def blocks(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Start and end of the candidate blocks of a text."""
    spans: list[list[int]] = []
    for cue in _CUE.finditer(text):
        if spans and cue.end() <= spans[-1][1]:
            continue  # on a line that is taken already
        start = text.rfind("\n", max(0, cue.start() - reach), cue.start()) + 1 or max(0, cue.start() - reach)
        end = text.find("\n", cue.end(), cue.end() + reach)
        end = min(len(text), cue.end() + reach) if end < 0 else end
        if spans and start <= spans[-1][1] + 1 and end - spans[-1][0] <= 8 * reach:
            spans[-1][1] = end
        else:
            spans.append([max(start, spans[-1][1]) if spans else start, end])
    return [(a, b) for a, b in spans]


class Templates:
    """Compressors primed with each template."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...]):
        self.names = [name for name, _, _ in templates]
        self.reach = _reach(templates)
        self.wording = [words(text) for _, text, _ in templates]
        self.keys = [key.split() for _, _, key in templates]
        self.most = [int(DIFFERING * len(own) + (len(own) < 20)) for own in self.wording]
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(" ".join(own).encode(), dict_type=raw),
            )
            for own in self.wording
        ]

    def able(self, block: list[str]) -> list[int]:
        """The templates whose key words the block has; no other one can match."""
        there = Counter(block)
        return [i for i, own in enumerate(self.keys) if not Counter(own) - there]

    def ranked(self, block: list[str], among: list[int] | None = None) -> list[tuple[float, int]]:
        """Share of its compressed size that the block loses given each template, largest first; ties by order."""
        data = " ".join(block).encode()
        alone = len(self.alone.compress(data))
        chosen = range(len(self.given)) if among is None else among
        gains = [(1 - len(self.given[i].compress(data)) / alone, i) for i in chosen]
        return sorted(gains, key=lambda x: (-x[0], x[1]))

    def gain(self, block: list[str], i: int) -> float:
        """The share for one template."""
        data = " ".join(block).encode()
        return 1 - len(self.given[i].compress(data)) / len(self.alone.compress(data))

    def matches(self, block: list[str], i: int) -> list[tuple[int, int, list[str], list[str]]]:
        """(first word, end, missing words, words between) of the places where the block has the wording of template `i`.

        Places do not overlap and are in order; of those that would, the one with fewer differing words is taken. Every
        place holds all key words, so only stretches around the rarest of them are compared.
        """
        own, keys, most = self.wording[i], Counter(self.keys[i]), self.most[i]
        if any(block.count(key) < n for key, n in keys.items()):
            return []
        rare = min(keys, key=block.count)
        before = len(own) - 1 - own[::-1].index(rare) + most  # from its last place in the wording
        after = len(own) - own.index(rare) + most
        stretches: list[list[int]] = []
        for at in (j for j, w in enumerate(block) if w == rare):
            start, end = max(0, at - before), at + after
            if stretches and start <= stretches[-1][1]:
                stretches[-1][1] = end
            else:
                stretches.append([start, end])
        found = []
        for start, end in stretches:
            part = block[start:end]
            if sum((Counter(own) & Counter(part)).values()) >= len(own) - most:
                found += [(start + x, start + y, *rest) for x, y, *rest in self._aligned(part, i)]
        return found

    def _aligned(self, part: list[str], i: int) -> list[tuple[int, int, list[str], list[str]]]:
        """`matches` of a stretch: the fewest words between for every number of missing ones, over pairs of equal words."""
        own, keys, most = self.wording[i], Counter(self.keys[i]), self.most[i]
        at: dict[str, list[int]] = {}
        for j, word in enumerate(part):
            at.setdefault(word, []).append(j)
        must = [k for k, w in enumerate(own) if own.count(w) == keys[w]]
        skips = lambda a, b: any(a < k < b for k in must)
        best: dict[tuple[int, int], dict[int, tuple[int, tuple | None]]] = {}
        for k, word in enumerate(own):
            back = [q for q in range(max(0, k - 1 - most), k) if not skips(q, k)]
            for j in at.get(word, ()):
                here: dict[int, tuple[int, tuple | None]] = {} if k > most or skips(-1, k) else {k: (0, None)}
                for q in back:
                    places = at.get(own[q], [])
                    for x in places[bisect_left(places, j - 1 - most) : bisect_left(places, j)]:
                        for missing, (added, _) in best.get((q, x), {}).items():
                            less, more = missing + k - q - 1, added + j - x - 1
                            if less <= most and more <= most and (less not in here or more < here[less][0]):
                                here[less] = (more, (q, x, missing))
                if here:
                    best[k, j] = here
        ends = sorted(
            (missing + len(own) - 1 - k + added, j, k, missing)
            for (k, j), here in best.items()
            if not skips(k, len(own))
            for missing, (added, _) in here.items()
            if missing + len(own) - 1 - k <= most
        )
        found: list[tuple[int, int, list[str], list[str]]] = []
        for _, j, k, missing in ends:
            if any(x <= j < y for x, y, _, _ in found):
                continue
            met, step = {}, (k, j, missing)
            while step:
                met[step[0]] = step[1]
                step = best[step[0], step[1]][step[2]][1]
            start, kept = min(met.values()), Counter(own[x] for x in met)
            if any(x < j + 1 and start < y for x, y, _, _ in found) or keys - kept:
                continue
            between = [part[x] for x in range(start, j + 1) if x not in set(met.values())]
            found.append((start, j + 1, [w for x, w in enumerate(own) if x not in met], between))
        return sorted(found)

    def differences(self, block: list[str], i: int) -> tuple[bool, list[str], list[str]]:
        """Whether the block has the wording of template `i`; its words that are missing, and words put between them."""
        for _, _, missing, added in self.matches(block, i):
            return True, missing, added
        own = self.wording[i]
        runs = [m for m in SequenceMatcher(None, own, block, autojunk=False).get_matching_blocks() if m.size]
        met = {k for m in runs for k in range(m.a, m.a + m.size)}
        missing = [w for k, w in enumerate(own) if k not in met]
        added = [w for x, y in zip(runs, runs[1:], strict=False) for w in block[x.b + x.size : y.b]]
        return False, missing, added


def _places(primed: Templates, block: list[str]) -> list[tuple[int, int, int, list[str], list[str]]]:
    """(first word, end, template, missing words, words between) of all notices that words confirm, in order.

    Templates whose key words are there are ranked by the size that the block loses, and confirmed down that ranking: first
    those that some place has word for word, then those with differing words. A place that overlaps one taken before is
    left. What lies between the places taken is ranked and searched again for others.
    """
    ranking = [i for _, i in primed.ranked(block, able)] if (able := primed.able(block)) else []
    met = [(i, primed.matches(block, i)) for i in ranking]
    owned, taken = set(), []
    for exact in (True, False):
        for i, places in met:
            for first, end, missing, added in places:
                if (not missing and not added) == exact and owned.isdisjoint(range(first, end)):
                    owned.update(range(first, end))
                    taken.append((first, end, i, missing, added))
    if not taken:
        return []
    taken.sort()
    found = list(taken)
    for x, y in zip([0, *(p[1] for p in taken)], [*(p[0] for p in taken), len(block)], strict=True):
        found += [(x + first, x + end, *rest) for first, end, *rest in _places(primed, block[x:y])]
    return sorted(found)


def notices(text: str, primed: Templates) -> Iterator[tuple[int, int, bool, float, int, str]]:
    """(start, end, confirmed, gain, template, differences) of every confirmed notice of a text, and of what else of its
    candidate blocks has a license word."""
    done = 0
    spans = blocks(text, primed.reach)
    for (start, end), (following, _) in zip(spans, [*spans[1:], (len(text) + 1, 0)], strict=True):
        if end <= done:
            continue  # inside a notice that was confirmed
        at = max(start, done)
        said = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text, at, min(len(text), end + primed.reach))]
        block = [w for w, _, _ in said]
        # A notice that begins in the next block is left to it.
        met = [p for p in _places(primed, block) if said[p[0]][1] < following]
        for first, after, i, missing, added in met:
            begin, until = said[first][1], said[after - 1][2]
            until = _MARKS.match(text, until).end()
            yield from _others(text, at, min(begin, end), primed)
            data = block[first:after]
            yield begin, until, True, round(primed.gain(data, i), 6), i, _written(missing, added)
            at = done = until
        yield from _others(text, at, end, primed)


def _others(text: str, start: int, end: int, primed: Templates) -> Iterator[tuple[int, int, bool, float, int, str]]:
    """The unconfirmed candidate that a stretch without notices is, if it has a license word."""
    if start < end and _CUE.search(text, start, end):
        block = words(text[start:end])
        gain, i = primed.ranked(block)[0]
        _, missing, added = primed.differences(block, i)
        yield start, end, False, round(gain, 6), i, _written(missing, added)


def _written(missing: list[str], added: list[str]) -> str:
    return " ".join([f"-{w}" for w in missing] + [f"+{w}" for w in added])


def _scan(templates: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        primed = Templates(templates)
        for batch in (own for whole in batches for own in slices(whole, "text")):
            at, rows = [], []
            for i, text in enumerate(strings(batch, "text")):
                for n, (start, end, sure, gain, chosen, differing) in enumerate(notices(text, primed)):
                    at.append(i)
                    rows.append((n, start, end, primed.names[chosen], chosen, gain, sure, differing))
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.bool_(), pa.string()]
                names = ["id", "block", "start", "end", "license", "template", "gain", "confirmed", "differences"]
                made = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *made], names)

    return run


def scan(
    docs: DataFrame, templates: tuple = TEMPLATES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per notice, and per rest of a candidate block that has a license word: id, block (from 0, in order),
    start and end in code points, license, template, gain, confirmed, differences.

    Every place that the words of a template confirm is a row of its own, from its first met word to the marks after its
    last one; of places that overlap, that of the template ranked first by compression, word for word before others. In the other rows `confirmed` is false and `license` is that of the best
    template by `gain`, the share of the row's compressed size saved. `differences` lists the template's missing words
    with "-" and words between the met ones with "+". Texts without a license word, so NULL and empty ones, give no row.
    Repeated rows and NULL ids stay; other columns are not read; no rows give no rows. Whole texts are searched where they are read, without a
    shuffle; a text takes time in proportion to its length.
    """
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    found = chosen.filter(F.col("text").rlike(f"(?i){CUE}")).mapInArrow(
        _scan(templates),
        f"id {kind}, block int, start bigint, end bigint, license string, template int, gain double, "
        "confirmed boolean, differences string",
    )
    return found.withColumnRenamed("id", id_column)


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return scan(table(spark, sf_dir, "documents"))
