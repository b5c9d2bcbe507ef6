"""Every bound query against its SQL, over whole small tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from assayer.operators import validation
from assayer.plans import bound, bound_files  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(bound.QUERIES))
def test_query_is_its_sql(spark, tables, name):
    got = bound.QUERIES[name](spark, SF)
    want = tables.execute(bound.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = want.fetchall()
    assert comparable(got.columns, got.collect()) == comparable(names, rows) and rows


def test_set_difference_is_two_anti_joins(spark):
    rows = lambda *k: spark.createDataFrame([(a, b) for a, b in k], "a int, b string")
    left, right = rows((1, "x"), (1, "x"), (2, "y"), (3, None), (None, None), (5, "z"), (6, "w")), rows((2, "y"), (2, "y"), (3, None), (4, "q"), (4, "q"), (6, "w"))
    keys = ["a", "b"]
    of = lambda df: sorted(map(repr, df.collect()))
    joins = validation.together(validation.missing(left, right, keys, "r: missing"), validation.missing(right, left, keys, "r: unexpected"))
    assert of(validation.set_difference(left, right, keys, "r")) == of(validation.set_difference(left, right, keys, "r", parts=3)) == of(joins)
    once = validation.together(validation.missing(left.distinct(), right.distinct(), keys, "r: missing"), validation.missing(right.distinct(), left.distinct(), keys, "r: unexpected"))
    assert of(validation.set_difference(left, right, keys, "r", once=True)) == of(once)


def test_partitions_of_compared_keys_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(bound, "PART_ROWS", 100)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    got = bound.QUERIES["u2_attachment_sets"](spark, SF)
    sizes = got.rdd.glom().map(len).collect()
    assert n > 1000 and len(sizes) == n // 100 + 1 and max(sizes) < 300
