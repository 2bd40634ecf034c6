"""URL filters: allow and block rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm.common import LOWER, UPPER, let, table

GRAMS, BUCKETS = (3, 4, 5), 1 << 16

# Labelled rows that a model is fitted on, at most; a larger table is refused, not sampled.
LABELLED_MOST = 100_000

# Rules in the form host/path, with what they decide.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# A small labelled table of URLs. 1 is to be blocked. The names of GIVEN are hosts of the given pages, others
# are invented, some of them after those.
BLOCKED = """
casino-win casino-royal online-casino big-casino casino-slots free-bets free-spins best-bets sports-bets bet-win
cheap-pills cheap-meds buy-pills diet-pills online-pills spam-farm link-farm content-farm seo-farm spam-links
ads-track ads-click track-pixel click-track ad-server adult-x adult-video adult-chat xxx-adult hot-adult
lottery-win prize-win payday-loans fast-loans fake-watches replica-watches best-pills pills-shop pills-24
spam-list spam-center spam-mails lottery-club prize-club big-lottery casino-club
""".split()
ALLOWED = """
library museum university research weather gardening recipes history science travel cycling railway
theatre orchestra hospital school council parliament archive journal review daily morning evening
harbour mountain river forest village market bakery workshop software hardware network database
tutorial reference manual encyclopedia dictionary translation poetry novel chapter lecture seminar
thersh ononth ththat anrely ionthe rentin storer hatbly enther liaoin schver ungheit eauxen ciondo
""".split()
GIVEN = ("casino-win", "free-bets", "cheap-pills", "ads-track", "spam-farm", "adult-x", "thersh", "ththat")
FRONTS, ENDS = ("", "www.", "m.", "blog."), ("example.org", "example.net", "example.com")
PATHS = ("/en/825", "/de/64.html", "/fr/12/", "/es/900", "/index.html", "")


def labelled_urls(spark: SparkSession, without: Sequence[str] = ()) -> DataFrame:
    """The built-in labelled table: every name, but those `without`, with a few fronts, ends and paths."""
    rows = []
    for label, names in ((1.0, BLOCKED), (0.0, ALLOWED)):
        for i, name in enumerate(n for n in names if n not in without):
            for k in range(6):
                front, end = FRONTS[(i + k) % len(FRONTS)], ENDS[(i + 2 * k) % len(ENDS)]
                rows.append((f"https://{front}{name}.{end}{PATHS[(i + k) % len(PATHS)]}", label))
    return spark.createDataFrame(rows, "url string, label double")


def host(url: Column) -> Column:
    """What stands between the first "://" and the next "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def matching_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, NULL where none fits; of equally long ones the first listed."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    chosen, verdict = F, F
    for action, rule in ordered:
        fits = _fits(rule, host, path)
        chosen, verdict = chosen.when(fits, rule), verdict.when(fits, action)
    none = F.lit(None).cast("string")
    return (chosen.otherwise(none), verdict.otherwise(none)) if rules else (none, none)


def _grams(text: Column, name: str) -> Column:
    """Character n-grams with a mark of their part, in time linear in the text."""
    marked = F.regexp_extract_all(F.concat(F.lit("^"), text, F.lit("$")), F.lit("(?s)(.)"), F.lit(1))

    def of_size(letters: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(letters) - n, F.lit(0)))
        # Not `slice`, which copies the whole array at every call. Letters beyond the end are left out.
        return F.transform(starts, lambda i: F.concat_ws("", F.lit(name + ":"), *[F.get(letters, i + k) for k in range(n)]))

    def of(letters: Column) -> Column:
        return F.array_distinct(F.concat(*[of_size(letters, n) for n in GRAMS]))

    return let(marked, of)


def features(urls: DataFrame, url_column: str) -> DataFrame:
    """`urls` with the column "features": hashed n-grams of host and path, each counted once."""
    address = F.col(url_column)
    grams = F.concat(_grams(host(address), "h"), _grams(path(address), "p"))
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)
    return hashing.transform(urls.withColumn("grams", grams)).drop("grams")


def fit(labelled: DataFrame, most: int = LABELLED_MOST) -> LogisticRegressionModel:
    """Fit on a labelled table (url, label) of at most `most` rows; rows without a label are left out."""
    usable = labelled.filter("label IS NOT NULL").select("url", "label")
    if usable.limit(most + 1).count() > most:
        raise ValueError(f"the labelled table has more than {most} rows")
    model = LogisticRegression(regParam=0.003, maxIter=40, standardization=False)
    return model.fit(features(usable, "url").select("features", "label"))


def judge(
    pages: DataFrame,
    model: LogisticRegressionModel,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule, verdict, and the model's probability of "block" as `score`.

    The rule's verdict holds where one fits, else the model blocks from a score of 0.5 on. A NULL url, or one without
    "://", has empty host and path, which no rule fits, and its verdict is the model's of empty parts. Repeated rows
    and NULL ids stay, other columns are not read, no rows give no rows. No shuffle and no Python.
    """
    chosen = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    scored = model.transform(features(chosen, "url"))
    address_host, address_path = host(F.col("url")), path(F.col("url"))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    score = vector_to_array("probability")[1]
    named = scored.select("id", address_host.alias("host"), address_path.alias("path"), score.alias("score"))
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return named.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        "score",
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page."""
    return judge(table(spark, sf_dir, "pages"), fit(labelled_urls(spark)))
