from warraq.plans.materialize import cut, few, sweep


def test_tables_are_cut_and_swept(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s")
    one, none = cut(df, "a"), cut(df.where("id > 9"), "b")
    assert one.dtypes == df.dtypes and one.count() == 5 and none.count() == 0
    assert "Range" not in one._jdf.queryExecution().toString()
    assert sweep(spark) >= 2 and sweep(spark) == 0


def test_few(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(few(spark.range(3), 3)) and not hinted(few(spark.range(4), 3))
