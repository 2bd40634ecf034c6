"""Secret scans: sure findings by pattern, weak ones only where the parts of a credential stand together.

Each text is scanned once for spans. An access identifier, an assigned value and a long hex run are sure. A bare random
token, a named account and an address are weak: each is common in clean text. The weak ones go, as intervals, through a
join with what would complete them, and only those that meet it within their scope are reported.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm.common import fresh, slices, strings, table, told_apart

# Parts complete each other if they begin at most this many code points apart. A part that is longer than that reaches
# as far beyond its end.
SCOPE = 200

# Kinds in the order in which spans of one start are listed; those after `hex` are weak.
KINDS = ["assign", "access", "hex", "secret", "identifier", "endpoint"]
BASE = KINDS[:3]

# What a weak kind needs beside it: one kind out of every list.
SURE_SECRETS = ["assign", "hex", "secret"]
NEEDS = {
    "secret": [["access", "identifier", "endpoint"]],
    "identifier": [SURE_SECRETS],
    "endpoint": [["access", "identifier"], SURE_SECRETS],
}

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WEAK = {
    "secret": re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=])"),
    "identifier": re.compile(
        r"(?ai:access_?key_?id|client_?id|account_?id|username|login)[\"']?\x20*[:=]\x20*[\"']?[\w.@-]{3,}"
    ),
    "endpoint": re.compile(r"\b(?:[a-z][a-z0-9+.-]{1,19}://[^\s\"'<>]{4,}|[a-z0-9.-]{1,253}\.amazonaws\.com)"),
}

SPAN = "struct<start: bigint, kind: int, end: bigint>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Sure spans as (start, number of the kind, end), in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is found at its own start, so this equals dropping shorter whole runs.
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak spans that no sure span overlaps."""
    found = []
    for kind, pattern in _WEAK.items():
        for m in pattern.finditer(text):
            if kind != "secret" or _mixed(m[0]):
                found.append((m.start(), KINDS.index(kind), m.end()))
    found.sort()
    clear, at = [], 0
    reach = -1  # the furthest end of the sure spans that begin before the weak one
    for span in found:
        while at < len(base) and base[at][0] < span[2]:
            if base[at][0] >= span[0]:
                break
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= span[0] and not (at < len(base) and base[at][0] < span[2]):
            clear.append(span)
    return clear


def _scan() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    names = ("start", "kind", "end")

    def column(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[dict(zip(names, s, strict=True)) for s in row] for row in rows], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own for whole in batches for own in slices(whole, "text")):
            texts = strings(batch, "text")
            base = [base_spans(t) for t in texts]
            weak = [weak_spans(t, b) for t, b in zip(texts, base, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), column(base), column(weak)], ["id", "base", "weak"])

    return run


def _near(parts: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The parts that have one of `others` of the same row within the scope.

    Both sides are dealt by row and the stretches of text that they reach, so neither a long text nor a row with very many
    parts meets in one task, and spans that do not overlap bound the pairs of a stretch.
    """
    long = F.col("end") - F.col("start") > scope
    first = F.floor(F.col("start") / scope)
    last = F.floor((F.col("end") + scope) / scope)
    keyed = parts.withColumn("stretch", F.explode(F.sequence(first, F.when(long, last).otherwise(first))))
    reached = others.select(
        "row",
        F.col("start").alias("other"),
        F.when(long, F.col("end")).alias("other_end"),
        F.explode(F.sequence(first - 1, F.when(long, last).otherwise(first + 1))).alias("stretch"),
    )
    start, end, other, other_end = keyed["start"], keyed["end"], reached["other"], reached["other_end"]
    after = (other >= start) & (end - start > scope) & (other - end <= scope)
    before = (start >= other) & other_end.isNotNull() & (start - other_end <= scope)
    near = (F.abs(start - other) <= scope) | after | before
    same = (keyed["row"] == reached["row"]) & (keyed["stretch"] == reached["stretch"])
    met = keyed.join(reached, same & near, "left_semi").drop("stretch")
    return met.dropDuplicates(["row", "start", "kind", "end"])  # a long part is dealt to several stretches


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, linked): the weak spans of each row of `scanned` (row, base, weak) that have what they need beside them."""
    weak = scanned.filter(F.size("weak") > 0)
    parts = session.materialise(
        weak.select("row", F.inline(F.concat("base", "weak"))), "parts"
    )
    of = lambda kinds: parts.filter(F.col("kind").isin([KINDS.index(k) for k in kinds]))
    found = None
    for kind, lists in NEEDS.items():
        own = of([kind])
        for kinds in lists:
            own = _near(own, of(kinds), scope)
        found = own if found is None else found.unionByName(own)
    return found.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `base` and `spans`, arrays of (start, kind, end) in code points, end exclusive.

    `kind` is the place in KINDS. `spans` holds all of `base` and the weak spans that are completed. Texts are scanned
    once, whole; findings go to a written table. NULL and empty texts have no spans; repeated rows and NULL ids stay;
    other columns are not read; no rows give no rows.
    """
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    found = chosen.mapInArrow(_scan(), f"id {kind}, base array<{SPAN}>, weak array<{SPAN}>")
    scanned = session.materialise(found.withColumn("row", F.monotonically_increasing_id()), "scanned")
    linked = link(scanned.select("row", "base", "weak"), scope)
    spans = F.array_sort(F.concat("base", F.coalesce("linked", F.expr(f"cast(array() AS array<{SPAN}>)"))))
    return scanned.join(linked, "row", "left").select(F.col("id").alias(id_column), "base", spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))

    def one(span: Column) -> Column:
        return F.concat_ws(":", F.get(names, span["kind"]), span["start"].cast("string"), span["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    done, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            done += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*done, text[at:]])


def _masked(at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows without their last column, which has the spans that are masked in the text, column number `at`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (own for whole in batches for own in slices(whole, at)):
            texts, found = batch.column(at), batch.column(batch.num_columns - 1)
            if found.null_count < len(found):
                spans = [s and [(x["start"], x["kind"], x["end"]) for x in s] for s in found.to_pylist()]
                done = [mask(t, s) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)]
                texts = pa.array(done, texts.type)
            columns = [texts if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run


def redact(docs: DataFrame, scope: int = SCOPE, text_column: str = "text", from_files: bool = False) -> DataFrame:
    """`docs` with every reported span replaced by its kind in brackets; overlapping spans by the first one's.

    All columns and rows are kept, whatever their names; a text without spans, or NULL, is not touched; very long texts
    are taken whole; no rows give no rows. Texts are scanned once, and the spans written; then they are joined to the rows,
    which is a second reading of `docs`. For that rows are told apart, and unless `docs` is a table read `from_files`, they
    are written first. No task runs more than one Python function, so none holds more than one worker.
    """
    row = fresh(docs, "row")
    numbered = told_apart(docs, row, from_files)
    spans = fresh(numbered, "spans")
    found = scan(numbered, scope, row, text_column).filter(F.size("spans") > 0)
    marks = session.materialise(found.select(F.col(row), F.col("spans").alias(spans)), "marks")
    joined = numbered.join(marks, row, "left").select(*docs.columns, spans)
    return joined.mapInArrow(_masked(docs.columns.index(text_column)), docs.schema)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return found.select(
        "doc_id",
        *[n(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
