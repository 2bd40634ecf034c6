"""Phrase collocations from sorted count streams.

Every word of the corpus opens a window: its language and up to five words, cut off where a piece ends. A stream of
windows in prefix order counts all phrases at once, as a phrase is as frequent as the windows that begin with it, and these
stand together. Windows are dealt by ranges of that order, sorted, and counted in one pass. Phrases that are frequent
enough make a second, small stream. In prefix order it is merged in lockstep with the first parts of every candidate and
with the phrases one word longer, in suffix order with the rest and with those one word longer to the left (sort-merge
joins, which hold no hash table).
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm.common import LOWER, UPPER, by_bytes, table

LONGEST, LEAST, TOP, UNKNOWN = 5, 100, 2000, "und"

# Windows aimed at in one range, ranges at most, and sampled windows per range that the cuts are placed by. Any cuts give
# the same result.
RANGE_WINDOWS, RANGES, SAMPLED = 1_000_000, 16_384, 24

# Distinct windows that a task gathers before it writes them out.
HELD = 300_000

# A window is its language and words with a tab after all but the last. No word has a tab, a space or a line end, so those
# serve as marks: a tab sorts before whatever a word may hold, as smaller bytes are written as a line end and a letter.
_TAB, _ESCAPE = b"\t", b"\n"
_SMALL = range(9)
_FOLD = bytes.maketrans(
    (UPPER + ".,;:!?\x0b\x0c\r\t").encode(), (LOWER + "\n" * 9 + " ").encode()
)


def _escaped(raw: bytes, codes: range = _SMALL) -> bytes:
    if raw.translate(None, bytes(codes)) != raw:
        for code in codes:
            raw = raw.replace(bytes([code]), _ESCAPE + bytes([65 + code]))
    return raw


def _plain(text: Column) -> Column:
    """Words or a language without the escapes."""
    for code in range(11):
        text = F.replace(text, F.lit("\n" + chr(65 + code)), F.lit(chr(code)))
    return text


def _opening(lang: str) -> bytes:
    raw = lang.encode()
    for code in (10, *range(10)):  # the escape itself first
        raw = raw.replace(bytes([code]), _ESCAPE + bytes([65 + code])) if code in raw else raw
    # A space parts windows on their way.
    return raw.replace(b" ", _ESCAPE + b"L") + _TAB


def windows(text: str, opening: bytes, longest: int = LONGEST) -> Iterator[list[bytes]]:
    """The windows of a whole text, some thousands at a time."""
    for piece in text.encode().translate(_FOLD).split(b"\n"):
        words = piece.split()
        if not words:
            continue
        if piece.translate(None, bytes(_SMALL)) != piece:
            words = [_escaped(w) for w in words]
        for start in range(0, len(words), 10_000):
            yield [
                opening + _TAB.join(words[i : i + longest]) for i in range(start, min(start + 10_000, len(words)))
            ]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column("text")), pa.int64()), 0).to_pylist()
        for part in by_bytes(sizes):
            own = batch.slice(part.start, part.stop - part.start)
            for text, lang in zip(own.column("text").to_pylist(), own.column("lang").to_pylist(), strict=True):
                if text:
                    yield text, _opening(lang)


def _streams(cuts: list[bytes], longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows with their counts, sorted and packed for the ranges that they belong to."""

    def packed(held: Counter) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=3)
        keys = sorted(held)
        counts = np.fromiter(map(held.__getitem__, keys), "<i8", len(keys))
        edges = [0, *(bisect_left(keys, cut) for cut in cuts), len(keys)]
        rows = [
            (part, press.compress(b" ".join(keys[a:b])), press.compress(counts[a:b].tobytes()))
            for part, (a, b) in enumerate(zip(edges, edges[1:]))
            if a < b
        ]
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["part", "windows", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for text, opening in _texts(batches):
            for some in windows(text, opening, longest):
                held.update(some)
                if len(held) >= HELD:
                    yield packed(held)
                    held.clear()
        if held:
            yield packed(held)

    return run


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        for raw, counts in zip(batch.column("windows").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            keys = pa.array(press.decompress(raw).split(b" "), pa.binary())
            counts = pa.array(np.frombuffer(press.decompress(counts), "<i8"))
            for start in range(0, len(keys), 10_000):
                own = [keys.slice(start, 10_000), counts.slice(start, 10_000)]
                yield pa.RecordBatch.from_arrays(own, ["window", "n"])


def _counted(longest: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of phrases in a sorted stream of windows.

    Windows that begin with a phrase stand together. Within a batch their sum is final unless they touch its ends; those
    sums go on whatever they are, to be added to the neighbour's. A language by itself counts as a phrase of no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, n = batch.column("window"), batch.column("n").to_numpy()
            cut = pc.split_pattern(keys, b"\t")
            begin, flat = cut.offsets.to_numpy(), cut.values
            depth = np.diff(begin)
            made: list[tuple[bytes, int, int]] = []
            same = np.ones(len(n) - 1, bool)
            for level in range(longest + 1):
                rows = np.flatnonzero(depth > level)
                if not len(rows):
                    break
                word = flat.take(pa.array(begin[:-1][rows] + level))
                # Only neighbours that share what came before can share this word; whatever stands between does too.
                apart = np.ones(len(rows), bool)
                equal = pc.equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
                apart[1:] = ~(equal & same[rows[:-1]])
                starts = np.flatnonzero(apart)
                sums = np.add.reduceat(n[rows], starts)
                wanted = sums >= least
                wanted[[0, -1]] = True
                for at in np.flatnonzero(wanted).tolist():
                    first = keys[int(rows[starts[at]])].as_py()
                    made.append((b"\t".join(first.split(_TAB)[: level + 1]), level, int(sums[at])))
                same = np.zeros(len(n) - 1, bool)
                same[rows[1:][~apart[1:]] - 1] = True
            phrase, size, total = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrase, pa.string()), pa.array(size, pa.int32()), pa.array(total, pa.int64())],
                ["phrase", "size", "f"],
            )

    return run


def _picked(each: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Some windows of each text, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, opening in _texts(batches):
            total, some = 0, []
            for own in windows(text, opening):
                some.append(own[total % len(own)])
                total += len(own)
                some = some[::2] if len(some) >= 64 * each else some
            if total:
                some = some[:: max(1, len(some) // each)]
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([some])], ["n", "windows"])

    return run


def _cuts(chosen: DataFrame) -> list[bytes]:
    """Where the ranges part, from some texts drawn at random; the driver gets a bounded number of windows."""
    documents, each = chosen.count(), 8
    drawn = min(documents, RANGES * SAMPLED // each)
    if not documents:
        return []
    # Few texts first, to learn how many windows there are.
    first = min(1.0, 512 / documents)
    n = chosen.sample(first, 7).mapInArrow(_picked(1), "n bigint, windows array<binary>").agg(F.sum("n")).first()[0]
    ranges = min(RANGES, int((n or 0) / first) // RANGE_WINDOWS + 1)
    if ranges == 1:
        return []
    drawn = min(drawn, ranges * SAMPLED // each + 512)
    rows = chosen.sample(min(1.0, drawn / documents), 11).mapInArrow(_picked(each), "n bigint, windows array<binary>")
    found = sorted(bytes(w) for r in rows.select("windows").toLocalIterator() for w in r["windows"])
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """(phrase, size, f): all phrases of up to `longest` words that occur `least` times in a language.

    `phrase` is the language and the words with tabs between, in the writing of the streams; a language by itself, of size
    0, has the number of all its words. One pass over the texts, one shuffle of packed windows.
    """
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN))
    chosen = docs.select(F.col(text_column).alias("text"), lang.alias("lang"))
    cuts = _cuts(chosen)
    sent = chosen.mapInArrow(_streams(cuts, longest), "part int, windows binary, counts binary")
    dealt = sent.repartitionById(len(cuts) + 1, F.col("part")).select("windows", "counts")
    stream = dealt.mapInArrow(_opened, "window binary, n bigint").sortWithinPartitions("window")
    found = stream.mapInArrow(_counted(longest, least), "phrase string, size int, f bigint")
    total = found.groupBy("phrase", "size").agg(F.sum("f").alias("f"))
    return total.filter((F.col("f") >= least) | (F.col("size") == 0))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    A candidate has 2 to `longest` words and occurs `least` times (a). Cut in two, its parts occur l and r times, and
    floor(1000 a n / (l r)) says how much more often they meet than by chance among n words; the cut with the least score
    counts, the first of equal ones. A candidate within a longer one that is as frequent is dropped; looking one word
    further to either side is enough for that, as no longer phrase is more frequent than what it holds. Ranks go by score,
    then a, both falling, then phrase in byte order.

    Products are exact for up to 10^17 words. NULL and empty texts have no words; a NULL language is `und`; repeated rows count each; other columns are not read;
    no rows give no rows. Texts are taken whole, some thousand words at a time.
    """
    counts = session.materialise(phrase_counts(docs, longest, least, text_column, lang_column), "phrases")
    return from_counts(counts, top)


def from_counts(counts: DataFrame, top: int = TOP) -> DataFrame:
    """`collocations` from a written table of `phrase_counts`."""
    candidates = counts.filter("size >= 2").withColumn("words", F.split("phrase", "\t"))
    lang, size = F.get("words", F.lit(0)), F.col("size")

    def part(first: Column | int, number: Column) -> Column:
        return F.array_join(F.slice("words", first, number), "\t")

    # Prefix order meets the first parts of the candidates, suffix order the rest.
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    parts = cut.select(
        lang.alias("lang"),
        "phrase",
        F.col("f").alias("a"),
        "k",
        part(1, F.col("k") + 1).alias("head"),
        F.concat_ws("\t", lang, part(F.col("k") + 2, size - F.col("k"))).alias("tail"),
    )
    heads = counts.select(F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select(F.col("phrase").alias("tail"), F.col("f").alias("r"))
    totals = counts.filter("size = 0").select(F.col("phrase").alias("lang"), F.col("f").alias("n"))
    met = parts.join(heads.hint("merge"), "head").join(tails.hint("merge"), "tail").join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    scored = met.withColumns(
        {"above": F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"], "below": exact["l"] * exact["r"]}
    ).withColumn("score", F.expr("cast(above AS decimal(38,0)) div cast(below AS decimal(38,0))"))
    best = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    # What is left of a phrase without its last word is one word shorter in prefix order, without its first in suffix order.
    longer = candidates.filter("size >= 3")
    inner = longer.select(part(1, size).alias("phrase"), "f").unionByName(
        longer.select(F.concat_ws("\t", lang, part(3, size - 1)).alias("phrase"), "f")
    )
    extended = inner.groupBy("phrase").agg(F.max("f").alias("more"))
    kept = best.join(extended.hint("merge"), "phrase", "left").filter("more IS NULL OR more < a")
    named = kept.select(
        _plain(F.replace("lang", F.lit("\nL"), F.lit(" "))).alias("lang"),
        _plain(F.replace(_words("phrase"), F.lit("\t"), F.lit(" "))).alias("phrase"),
        "a",
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").alias("score"),
    )
    return _ranked(session.materialise(named, "candidates"), top)


def _words(column: str) -> Column:
    """What follows the language."""
    return F.expr(f"substring({column}, position('\\t' IN {column}) + 1)")


def _ranked(named: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language. Every task first keeps its own best, so no task gets all of a language."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = named.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = first.filter(F.col("place") <= top).drop("salt", "place")
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return last.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language."""
    return collocations(table(spark, sf_dir, "documents"))


def _sql() -> str:
    sizes = ", ".join(f"({k})" for k in range(1, LONGEST + 1))
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '{UNKNOWN}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t
  FROM documents
),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM pieces, (VALUES {sizes}) AS z(s) WHERE len(w) >= s),
counts AS (
  SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS p, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= {LEAST}
),
cand AS (SELECT lang, s, p, f AS a, string_split(p, ' ') AS w FROM counts WHERE s >= 2),
cut AS (SELECT lang, p, a, w, s, unnest(range(1, s)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut c JOIN total USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.p = array_to_string(c.w[c.k + 1:c.s], ' ')
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (
  SELECT lang, q, max(a) AS more FROM (
    SELECT lang, a, unnest([array_to_string(w[1:s - 1], ' '), array_to_string(w[2:s], ' ')]) AS q FROM cand WHERE s >= 3
  ) GROUP BY ALL
),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, p) AS rank
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.q = b.p WHERE more IS NULL OR more < a
)
SELECT lang, rank, p AS phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}
"""


SQL = _sql()
