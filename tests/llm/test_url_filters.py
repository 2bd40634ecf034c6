import random

import pytest

from heliograph.llm import url_filters as u


@pytest.fixture(scope="module")
def model(spark):
    return u.fit(u.labelled_urls(spark))


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def _rule(host, path):
    fitting = []
    for action, rule in u.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(rule), rule, action))
    return max(fitting)[1:] if fitting else (None, None)


def test_parts_and_rules_equal_brute_force(spark, model):
    rnd = random.Random(2)
    bits = ["http", "://", "WWW.", "example", ".com", "com", ".net", "net", "/", "/en/", "/es/", "?", "#", "é", "x", "\n", "É"]
    urls = [None, "", "://", "a://com/", "a://com", "h://xcom/", *("".join(rnd.choices(bits, k=9)) for _ in range(400))]
    urls += [f"http://{h}{p}" for h in ("www.example.com", "example.com", "a.net", "net") for p in ("/en/a", "/es/", "/fr/?x", "")]
    pages = spark.createDataFrame([(i, t, 1) for i, t in enumerate(urls)], "page_id long, url string, rule int")
    for row in u.judge(pages, model).collect():
        host, path = _parts(urls[row["page_id"]])
        rule, action = _rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (action or ("block" if row["score"] >= 0.5 else "allow"))


def test_held_out_names(spark, model):
    """Names that are not in the labelled table, made of its kinds of words."""
    bad = ["super-casino", "casino-online", "win-bets", "pills-online", "mega-spam", "adult-cams", "lottery-prize"]
    good = ["observatory", "bookshop", "fishing", "ththest", "onrely", "mathematics", "lexikon", "ciudad"]
    rows = [(i, f"http://{n}.example.org/en/{i}") for i, n in enumerate(bad + good)]
    judged = u.judge(spark.createDataFrame(rows, "page_id long, url string"), model).orderBy("page_id").collect()
    right = sum((r["verdict"] == "block") == (r["page_id"] < len(bad)) for r in judged)
    assert right >= 0.9 * len(rows)


def test_given_hosts_left_out_of_the_table(spark):
    """Hosts of the given pages, judged by a model that has not seen their names."""
    left = u.labelled_urls(spark, without=u.GIVEN)
    assert u.labelled_urls(spark).count() - left.count() == 6 * len(u.GIVEN)
    assert not left.filter(u.F.col("url").rlike("|".join(rf"[/.]{n}[.]" for n in u.GIVEN))).count()
    rows = [(i, f"http://{n}.example.org/en/{i}") for i, n in enumerate(u.GIVEN)]
    judged = u.judge(spark.createDataFrame(rows, "page_id long, url string"), u.fit(left)).collect()
    assert all((r["score"] >= 0.5) == ("-" in u.GIVEN[r["page_id"]]) for r in judged)


def test_long_repeated_and_missing(spark, model):
    rows = [(1, "http://h.org/" + "ab" * 100_000), (2, "x"), (2, "x"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    assert u.judge(pages, model).count() == 4
    assert u.judge(pages.limit(0), model).count() == 0
    assert u.matching_rule([], *[u.F.lit("")] * 2)


def test_labelled_table_is_bounded(spark):
    with pytest.raises(ValueError):
        u.fit(u.labelled_urls(spark), most=10)
