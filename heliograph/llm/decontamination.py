"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton recognises every run of words of every item. Documents stream through it word by word; the longest match
ending at each word tells which windows of the items occur. Items are cut into blocks of bounded size, one automaton
each, built by Spark's tasks and kept in a table. The driver takes one at a time and sends it to the workers, so neither
holds more of a benchmark, however large, than a block.
"""

from __future__ import annotations

import math
import pickle
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from heliograph import session
from heliograph.llm.common import LOWER, UPPER, fresh, slices, strings, table, told_apart

WINDOW, COVERAGE = 13, 20

# Words of benchmark items in one automaton, which has at most two states a word; a longer item is a block of its own.
BLOCK_WORDS = 100_000

# Bytes below 0x80 other than letters and digits part words; others belong to them, so cutting bytes cuts no character.
_FOLD = bytes(
    32 if b < 0x30 or 0x39 < b < 0x41 or 0x5A < b < 0x61 or 0x7A < b < 0x80 else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str) -> list[bytes]:
    """Lower-cased words of a whole text, as UTF-8."""
    return text.encode().translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, and for each state the items whose windows end there.

    A window is `window` consecutive words, or the whole of a shorter item. `spell` numbers the words; `pairs` has the
    pairs of words that stand together in some item. Once built, states are numbers in flat arrays: all moves in one
    sorted array of state and word, and the windows that end at a state as a stretch of two more.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.spell: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = []
        self.least = window
        pairs = set()
        for number, (_, item) in enumerate(items):
            numbers = [self.spell.setdefault(w, len(self.spell)) for w in item]
            pairs.update(zip(numbers, numbers[1:], strict=False))
            self.least = min(self.least, len(numbers))
            state, path = 0, []
            for word in numbers:
                state = self._extend(state, word)
                path.append(state)
            ends.append([(number, s) for s in path])
        self.names = [name for name, _ in items]
        self.pairs = np.array(sorted(a * len(self.spell) + b for a, b in pairs), np.int64)
        del pairs
        # The windows whose last words are those of a state, as (length, number of an item).
        windows: dict[int, set[tuple[int, int]]] = {}
        for path in ends:
            size = min(window, len(path))
            for number, state in path[size - 1 :]:
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                windows.setdefault(state, set()).add((size, number))
        # The nearest state with a window, along the links to ever shorter suffixes.
        ending = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            ending[state] = state if state in windows else ending[self.link[state]]
        self._flatten(windows, ending)

    def _flatten(self, windows: dict[int, set[tuple[int, int]]], ending: list[int]) -> None:
        moves = sorted((s * len(self.spell) + w, t) for s, own in enumerate(self.next) for w, t in own.items())
        self.next = []
        self.moves, self.targets = array("q", [m for m, _ in moves]), array("i", [t for _, t in moves])
        self.first, self.sizes, self.owners = array("i", [0]), array("i"), array("i")
        for state in range(len(ending)):
            for size, number in sorted(windows.get(state, ())):
                self.sizes.append(size)
                self.owners.append(number)
            self.first.append(len(self.sizes))
        self.link, self.length, self.ending = array("i", self.link), array("i", self.length), array("i", ending)

    def _move(self, state: int, word: int) -> int:
        """The state after a word, 0 if there is none: no move leads back to the start."""
        key = state * len(self.spell) + word
        place = bisect_left(self.moves, key)
        return self.targets[place] if place < len(self.moves) and self.moves[place] == key else 0

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(moves)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of `target` for the shorter suffixes that end at `state` with `word`."""
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # another item has these words already
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        made = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            same = self.length[target] == self.length[state] + 1
            self.link[made] = target if same else self._split(state, word, target)
        return made

    def _walk(self, numbers: list[int]) -> Iterator[tuple[int, int, int]]:
        """(last position, length, item) of every window that occurs."""
        state = size = 0
        for at, word in enumerate(numbers):
            after = self._move(state, word)
            while state > 0 and not after:
                state = self.link[state]
                size = self.length[state]
                after = self._move(state, word)
            state = after
            size = size + 1 if state else 0
            found = self.ending[state] if state else -1
            while found > 0:
                for place in range(self.first[found], self.first[found + 1]):
                    if self.sizes[place] <= size:
                        yield at, self.sizes[place], self.owners[place]
                found = self.ending[self.link[found]] if self.link[found] > 0 else -1

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words inside windows, merged, and the items whose windows occur.

        Only stretches in which every two neighbouring words are neighbours in some item can hold a window, and these
        are found by array look-ups.
        """
        get = self.spell.get
        numbers = np.array([get(w, -1) for w in found], np.int64)
        known = numbers >= 0
        beside = known[1:] & known[:-1]
        if len(self.pairs) and beside.any():
            at = np.flatnonzero(beside)
            key = numbers[at] * len(self.spell) + numbers[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            beside[at[self.pairs[place] != key]] = False
        else:
            beside[:] = False
        if self.least == 1:
            edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        else:
            edges = np.flatnonzero(np.diff(np.concatenate([[False], beside, [False]]).astype(np.int8)))
            edges[1::2] += 1
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a < self.least:
                continue
            for at, length, owner in self._walk(numbers[a:b].tolist()):
                items.add(owner)
                start, end = a + at + 1 - length, a + at + 1
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, end))
        return spans, items


FOUND = "n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def _scan(held: Broadcast, only_hits: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value
        for batch in (own for whole in batches for own in slices(whole, "text")):
            rows, hit = [], []
            for text in strings(batch, "text"):
                cut = words(text)
                spans, items = automaton.hits(cut)
                hit.append(not only_hits or bool(spans))
                rows.append((len(cut), [a for a, _ in spans], [b for _, b in spans], [automaton.names[i] for i in items]))
            if rows:
                numbers = pa.list_(pa.int64())
                kinds = [pa.int64(), numbers, numbers, pa.list_(pa.string())]
                made = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                own = [batch.column(i) for i in range(batch.num_columns - 1)]
                names = [*batch.schema.names[:-1], "n_words", "starts", "ends", "items"]
                yield pa.RecordBatch.from_arrays([*own, *made], names).filter(pa.array(hit, pa.bool_()))

    return run


def _build(window: int, block_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def block(items: list[tuple[str, list[bytes]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Automaton(items, window))], pa.binary())], ["automaton"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (own for whole in batches for own in slices(whole, "text")):
            for name, text in zip(strings(batch, "name"), strings(batch, "text"), strict=True):
                cut = words(text)
                if held and size + len(cut) > block_words:
                    yield block(held)
                    held, size = [], 0
                if cut:
                    held.append((name, cut))
                    size += len(cut)
        if held:
            yield block(held)

    return run


class Blocks:
    """The automata of a benchmark, in a table. One is held at a time."""

    def __init__(self, benchmark: DataFrame, window: int, block_words: int, id_column: str, text_column: str):
        """Tasks cut their items into blocks and build them. Equal texts count as one sequence each; items without words
        have no window; NULL ids are named by the empty string."""
        name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name")
        items = benchmark.select(name, F.col(text_column).alias("text"))
        size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, math.ceil(size / (8 * block_words)))  # about as many as there will be blocks
        made = items.repartition(parts).mapInArrow(_build(window, block_words), "automaton binary")
        self.window = window
        self.table = session.materialise(made.withColumn("block", F.monotonically_increasing_id()), "automata")
        self.numbers = sorted(row[0] for row in self.table.select("block").collect())

    def send(self, place: int) -> Broadcast:
        """The automaton at a place in the table, or an empty one where there are no items, sent to the workers."""
        if self.numbers:
            found = pickle.loads(self.table.where(F.col("block") == self.numbers[place]).first()["automaton"])
        else:
            found = Automaton([], self.window)
        return self.table.sparkSession.sparkContext.broadcast(found)


def _merged(spans: DataFrame) -> DataFrame:
    """Findings of several blocks as one per row: spans are united."""
    pairs = F.arrays_zip("starts", "ends")
    grouped = spans.groupBy("row").agg(
        F.first("id").alias("id"),
        F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list(pairs))).alias("pairs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    empty = "cast(array() AS array<struct<starts: bigint, ends: bigint>>)"
    united = F.expr(
        f"""aggregate(pairs, {empty}, (done, p) ->
        if(size(done) > 0 AND element_at(done, -1).ends >= p.starts,
           concat(slice(done, 1, size(done) - 1), array(named_struct('starts', element_at(done, -1).starts,
                  'ends', greatest(element_at(done, -1).ends, p.ends)))),
           concat(done, array(p))))"""
    )
    return grouped.withColumn("pairs", united).select(
        "row", "id", "n_words", F.col("pairs.starts").alias("starts"), F.col("pairs.ends").alias("ends"), "items"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    block_words: int = BLOCK_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, n_words, spans of hit words (starts, ends), items, n_hit, contaminated.

    A word is hit inside any occurrence of a window; a text is contaminated if at least one in `coverage` of its words
    is. `items` are the ids, as sorted distinct strings, of items with an occurring window. NULL and empty texts have no
    words and no hits; repeated rows and NULL ids stay; an empty benchmark hits nothing; no rows give no rows.
    """
    blocks = Blocks(benchmark, window, block_words, item_column, item_text_column)
    return _contamination(docs, blocks, coverage, id_column, text_column)


def _contamination(docs: DataFrame, blocks: Blocks, coverage: int, id_column: str, text_column: str) -> DataFrame:
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()  # may be a struct
    if len(blocks.numbers) <= 1:
        found = chosen.mapInArrow(_scan(blocks.send(0)), f"id {kind}, {FOUND}")
    else:
        numbered = session.materialise(chosen.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "numbered")
        parts = []
        for place in range(len(blocks.numbers)):
            held = blocks.send(place)
            scanned = numbered.mapInArrow(_scan(held, only_hits=place > 0), f"row bigint, id {kind}, {FOUND}")
            parts.append(session.materialise(scanned, "hits"))
            held.destroy()  # the next one takes its place
        found = _merged(reduce(DataFrame.unionByName, parts)).drop("row")
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    counted = found.withColumns({"n_hit": n_hit, "items": F.array_sort(F.array_distinct("items"))})
    dirty = (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))
    return counted.withColumn("contaminated", dirty).withColumnRenamed("id", id_column)


def _without(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    def cut(text: str, spans: list[tuple[int, int]]) -> str:
        found = [m.span() for m in _WORD.finditer(text)]
        done, at = [], 0
        for a, b in spans:
            done.append(text[at : found[a][0]])
            at = found[b - 1][1]
        return "".join([*done, text[at:]])

    made = [t if a is None or not len(a) else cut(t, list(zip(a, b))) for t, a, b in zip(texts, starts, ends)]
    return pd.Series(made, dtype=object)


def _kept(held: Broadcast, at: int, coverage: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def contaminated(text: str | None) -> bool:
        cut = words(text or "")
        n_hit = sum(b - a for a, b in held.value.hits(cut)[0])
        return n_hit > 0 and coverage * n_hit >= len(cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own for whole in batches for own in slices(whole, at)):
            yield batch.filter(pa.array([not contaminated(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return run


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    longest: int | None = None,
    window: int = WINDOW,
    coverage: int = COVERAGE,
    block_words: int = BLOCK_WORDS,
    text_column: str = "text",
    from_files: bool = False,
) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns, whatever their names.

    Of those that stay, hit spans of more than `longest` words are cut out of the text; None leaves every text as it is.
    NULL and empty texts stay. Where one automaton holds the whole benchmark and nothing is to be cut, rows are dropped
    where they are read. Otherwise findings are joined to the rows, which takes a second reading of `docs`; unless it is
    a table read `from_files`, it is written first.
    """
    blocks = Blocks(benchmark, window, block_words, "item_id", "text")
    if longest is None and len(blocks.numbers) <= 1:
        return docs.mapInArrow(_kept(blocks.send(0), docs.columns.index(text_column), coverage), docs.schema)
    row = fresh(docs, "row")
    numbered = told_apart(docs, row, from_files)
    found = _contamination(numbered, blocks, coverage, row, text_column)
    if longest is None:
        return numbered.join(found.filter("contaminated").select(row), row, "left_anti").drop(row)
    long = F.filter(F.arrays_zip("starts", "ends"), lambda s: s["ends"] - s["starts"] > longest)
    own = [fresh(numbered, n) for n in ("starts", "ends", "contaminated")]
    spans = found.filter("n_hit > 0").select(
        F.col(row), long["starts"].alias(own[0]), long["ends"].alias(own[1]), F.col("contaminated").alias(own[2])
    )
    joined = numbered.join(spans, row, "left").filter(~F.coalesce(F.col(own[2]), F.lit(False)))
    cut = F.pandas_udf(_without, StringType())(text_column, own[0], own[1])
    return joined.withColumn(text_column, cut).select(*docs.columns)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of every document with the benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT r, doc_id, regexp_extract_all(translate(t, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM docs
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_places AS (
  SELECT item_id, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i
  FROM items WHERE len(w) > 0
),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM item_places),
sizes AS (SELECT DISTINCT n FROM item_windows),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut, sizes WHERE len(w) >= n),
found AS (
  SELECT p.r, p.i, p.n, x.item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM places) p
  JOIN item_windows x ON x.n = p.n AND x.s = p.s
),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ks, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM cut LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
