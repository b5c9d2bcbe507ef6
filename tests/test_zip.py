import duckdb

from assayer.plans import bound

SF = "/root/testdata/sf0.001"


def test_zip_of_a_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF}/lineitem.parquet'")
    want = sorted(con.execute(bound.SQL["j3_strict_zip_lines"]).fetchall())
    got = sorted(map(tuple, bound.QUERIES["j3_strict_zip_lines"](spark, SF).select("task", "ordinal", "line", "part").collect()))
    assert got == want and len(got) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
