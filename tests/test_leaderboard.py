from assayer.operators import leaderboard


def test_a_half_is_a_half_in_any_order_of_rows(spark):
    """The scores add up to 8.9825; as doubles to 8.982500000000001 in the second order."""
    orders = [(2.477175, 2.247455, 3.257965, 0.999905), (3.257965, 0.999905, 2.247455, 2.477175)]
    rows = [(k, "graded", x, None, None, None) for k, own in enumerate(orders) for x in own]
    df = spark.createDataFrame(rows, "product int, status string, rubric_score double, pairwise_score double, elapsed_seconds double, tokens long").coalesce(1)
    got = leaderboard.product_totals(df, ("rubric",))
    assert dict(got.dtypes)["rubric_total"] == "double"
    assert {r["rubric_total"] for r in got.collect()} == {8.982}
