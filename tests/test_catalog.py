import pytest
from conftest import DATA
from oracle import connect, rows

import __spark_entry__ as entry
from palimpsest.plans import catalog, catalog_sql, quality

CORE = {**quality.QUERIES, **catalog.QUERIES}
SQL = {**quality.ORACLE, **catalog_sql.ORACLE}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_sql(spark, con, name):
    got = CORE[name](spark, DATA).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["NamespaceName", "PageName", "RevisionCount"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_histogram_bucket_is_disjoint():
    ranges = [(lo, hi if hi is not None else 10**9) for lo, hi in catalog.BOUNDS]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_first_title_with_prefix(spark):
    names = spark.createDataFrame([("Abc",), ("50%_x",), ("Z",), ("",)], "PageName string")
    titles = spark.createDataFrame([("Talk/abcd",), ("Talk/Abc",), ("talk/abc 2",), ("Talk/50%_x y",), ("Talk/50 x",), ("Abc",), ("Other/Z",)], "title string")
    got = {r.PageName: r.DiscussionPage for r in catalog.first_with_prefix(names, titles, "Talk/").collect()}
    assert got == {"Abc": "Talk/Abc", "50%_x": "Talk/50%_x y", "": "Talk/50 x"}
    assert catalog.first_with_prefix(names.limit(0), titles, "").count() == 0
