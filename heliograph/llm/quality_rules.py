"""Quality rules: a table of thresholds, compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm.common import fresh, let, table

# White space between words, in Java's and DuckDB's patterns.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with in is it for on as are was this by an or at "
    "der die das und ist nicht mit den von zu ein eine im auf für sich des dem "
    "le la les de et est en un une que qui pour dans sur pas du au "
    "el los las del y con para es se lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure that must lie between two limits; None leaves a side open."""

    measure: str
    least: float | None = None
    most: float | None = None

    def fails(self, value: Column) -> Column:
        low = F.lit(False) if self.least is None else value < self.least
        high = F.lit(False) if self.most is None else value > self.most
        return low | high


# A text that breaks any of these is rejected, besides those that fail the base rules.
RULES = (
    Rule("symbol_ratio", most=0.25),
    Rule("exclaim_ratio", most=0.5),
    Rule("stop_ratio", least=0.01),
    Rule("mean_word_chars", least=2.0, most=12.0),
    Rule("dup_line_ratio", most=0.6),
    Rule("stutter_ratio", most=0.3),
)


def _count_in(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _equals_neighbour(sorted_pairs: Column, name: str) -> Column:
    """The pairs of a sorted array whose field `name` also stands beside them."""

    def seen(pair: Column, at: Column) -> Column:
        same = [F.get(sorted_pairs, at + step)[name].eqNullSafe(pair[name]) for step in (-1, 1)]
        return same[0] | same[1]

    return F.filter(sorted_pairs, seen)


def _covered(places: Column) -> Column:
    """How many positions windows at the ascending `places` cover together."""
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        places,
        zero,
        lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")),
        lambda a: a["total"],
    )


def _window(values: Column, start: Column) -> list[Column]:
    # Not `slice`, which copies the whole array at every call.
    return [F.get(values, start + k) for k in range(WINDOW)]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight that the text has twice or more.

    Windows are compared by hash first; those that seem to repeat are compared by their words.
    """

    def exact(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("at"))))
        likely = let(pairs, lambda p: _equals_neighbour(p, "key"))
        spelled = F.transform(
            likely,
            lambda x: F.struct(F.concat_ws(" ", *_window(words, x["at"])).alias("key"), x["at"].alias("at")),
        )
        repeated = let(F.sort_array(spelled), lambda p: _equals_neighbour(p, "key"))
        return _covered(F.sort_array(F.transform(repeated, lambda x: x["at"])))

    def of(numbers: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(numbers) - WINDOW)
        hashes = F.transform(starts, lambda i: F.xxhash64(*_window(numbers, i)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact(h)).otherwise(0))

    numbers = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(numbers, of)).otherwise(0)


def _measured(text: Column, words: Column, lines: Column) -> Column:
    """Counts and ratios of a text as one struct; ratios of nothing are NULL."""
    n_words, n_lines = F.size(words), F.size(lines)
    capital = [w[:1].upper() + w[1:] for w in STOP_WORDS]
    counts = {
        "n_words": n_words,
        "word_chars": F.char_length(F.translate(text, " \t\n\x0b\x0c\r", "")),
        "n_symbols": _count_in(text, SYMBOLS),
        "n_dup_lines": n_lines - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
        "n_lines": n_lines,
        "n_exclaims": _count_in(text, "!"),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS, *capital))),
        "n_stutters": F.size(F.filter(words, lambda w, i: w.eqNullSafe(F.get(words, i - 1)))),
    }
    return F.struct(*[value.cast("bigint").alias(name) for name, value in counts.items()])


RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words"),
    "exclaim_ratio": ("n_exclaims", "n_words"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "stutter_ratio": ("n_stutters", "n_words"),
}
BASE = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def measures(text: Column) -> Column:
    """Struct of counts and ratios of a text, in one expression without user functions."""
    full = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(full, SPACE), lambda w: w != "")
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words, lambda w: let(lines, lambda x: _measured(full, w, x)))


def verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES, text_column: str = "text") -> DataFrame:
    """`docs` with a struct column "quality" of counts, ratios, `base_failed` and `kept`, whatever other columns it has.

    If `docs` has a column of that name, the new one has underscores after its name; it is always the last. The base
    rules reject texts of fewer than 20 words, so NULL and empty ones, and those of which over 30 % are repeats of eight
    words. Every row is judged alone: repeated rows, NULL ids and ties stay, and no rows give no rows.
    """
    name = fresh(docs, "quality")
    measured = docs.withColumn(name, measures(F.col(text_column)))
    count = lambda c: F.col(f"{name}.{c}")
    ratios = {r: count(a) / F.nullif(count(b), F.lit(0)) for r, (a, b) in RATIOS.items()}
    base = (count("n_words") < 20) | (100 * count("n_repeat_words") > 30 * count("n_words"))
    broken = reduce(lambda a, b: a | b, [F.coalesce(r.fails(ratios[r.measure]), F.lit(False)) for r in rules], F.lit(False))
    return measured.withColumn(
        name,
        F.struct(
            F.col(f"{name}.*"), *[v.alias(r) for r, v in ratios.items()], base.alias("base_failed"),
            (~(base | broken)).alias("kept"),
        ),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[f"quality.{c}" for c in [*counts, "base_failed", "kept"]])


def _failing_sql(rule: Rule) -> str:
    a, b = RATIOS[rule.measure]
    sides = [(rule.least, "<"), (rule.most, ">")]
    return " OR ".join(f"coalesce({a} / nullif({b}, 0) {sign} {limit}, false)" for limit, sign in sides if limit is not None)


_QUOTED = ", ".join(f"'{w}', '{w[:1].upper() + w[1:]}'" for w in STOP_WORDS)
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT *, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM docs
),
places AS (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM cut WHERE len(w) >= {WINDOW}),
windows AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s FROM places),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r
),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
    len(list_filter(w, lambda x: x IN ({_QUOTED}))) AS n_stop_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM cut LEFT JOIN covered USING (r)
),
based AS (SELECT *, {BASE} AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(map(_failing_sql, RULES))}) AS kept
FROM based
"""
