import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "unit_id" in df.columns and "value_ewm_5" in df.columns


def test_every_query_has_a_callable_and_oracle_keys_are_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_rounding_is_half_away_from_zero(spark):
    from pyspark.sql import functions as F

    from fleetlens.plans.queries import round_half_away

    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370497.5, 1e300, -0.0, 3.0, float("inf"), float("nan"), None, 0.0000005, 1.0000015, 123.4567885]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 6):
        scale = F.lit(float(10**digits))
        old = F.round(F.col("x") * scale) / scale + F.lit(0.0)
        for r in df.select("x", old.alias("old"), round_half_away(F.col("x"), digits).alias("new")).collect():
            assert str(r.old) == str(r.new), r
