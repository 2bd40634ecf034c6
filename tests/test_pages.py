import re

import pytest
from helpers import rows

from heliograph import session
from heliograph.operators import fleet
from heliograph.sources import pages, tables


def _numbers(spark, count):
    return spark.range(count).selectExpr("concat('p', lpad(id * 7919 % 1000, 4, '0')) AS panel_id", "id AS n")


@pytest.fixture(scope="module")
def numbers(spark):
    table = session.materialise(_numbers(spark, 1000), "numbers")
    path = session.run_dir(spark, "pages")
    pages.write_pages(table, path, ["panel_id"], range_rows=60)
    return table, path


@pytest.mark.parametrize("skip, limit", [(0, 10), (0, 1000), (59, 3), (480, 200), (990, 50), (1000, 5), (5000, 5), (3, 0)])
def test_a_page_is_the_slice_of_the_whole_order(spark, numbers, skip, limit):
    table, path = numbers
    whole = sorted(tuple(r) for r in table.collect())
    found = pages.read_page(spark, path, table.schema, ["panel_id"], skip, limit)
    assert [tuple(r) for r in found.collect()] == whole[skip : skip + limit]
    assert found.columns == table.columns


def test_a_deep_page_reads_its_own_ranges(spark, numbers):
    table, path = numbers
    assert pages.count_rows(spark, path) == 1000
    read = pages.read_page(spark, path, table.schema, ["panel_id"], 700, 20).inputFiles()
    ranges = {int(re.search(r"page_range=(\d+)", f)[1]) for f in read}
    directory = spark.read.parquet(f"{path}/directory").collect()
    assert len(directory) > 10 and 1 <= len(ranges) <= 3
    assert ranges == {r.page_range for r in directory if r.before + r.rows > 700 and r.before < 720}


def test_repeated_and_missing_keys(spark):
    """A key with a third of all rows, and rows without one, which come first: nothing is lost or doubled."""
    made = _numbers(spark, 300).selectExpr("IF(n % 3 = 0, 'hot', IF(n % 7 = 0, NULL, panel_id)) AS panel_id", "n")
    table, path = session.materialise(made, "numbers"), session.run_dir(spark, "pages")
    pages.write_pages(table, path, ["panel_id", "n"], range_rows=20)
    found = [pages.read_page(spark, path, table.schema, ["panel_id", "n"], s, 70).collect() for s in range(0, 300, 70)]
    whole = sorted((tuple(r) for r in table.collect()), key=lambda r: (r[0] is not None, r))
    assert [tuple(r) for page in found for r in page] == whole


def test_folders_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(pages, "MOST_RANGES", 8)
    table, path = session.materialise(_numbers(spark, 1000), "numbers"), session.run_dir(spark, "pages")
    pages.write_pages(table, path, ["panel_id"], range_rows=10)
    assert spark.read.parquet(f"{path}/directory").count() <= 8 and pages.count_rows(spark, path) == 1000
    whole = sorted(tuple(r) for r in table.collect())
    assert [tuple(r) for r in pages.read_page(spark, path, table.schema, ["panel_id"], 700, 40).collect()] == whole[700:740]


def test_an_empty_table_has_no_pages(spark):
    path, empty = session.run_dir(spark, "pages"), tables.empty_status(spark)
    pages.write_pages(empty, path, ["panel_id"])
    assert pages.count_rows(spark, path) == 0
    assert rows(fleet.status_response(pages.read_page(spark, path, empty.schema, ["panel_id"]))) == []


def test_places_are_not_negative(spark, numbers):
    table, path = numbers
    with pytest.raises(ValueError):
        pages.read_page(spark, path, table.schema, ["panel_id"], -1, 5)
