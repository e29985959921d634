from pyspark.sql import functions as F

from dossier.functions.rows import explode_rows, fence


def test_explode_rows_drops_placeholders(spark):
    df = spark.createDataFrame([(1, [("a", 1)]), (2, []), (3, None)],
                               "id int, xs array<struct<k:string,v:int>>")
    got = [(r.id, r.k, r.v) for r in explode_rows(df, ["id"], "xs", "k").collect()]
    assert got == [(1, "a", 1)]


def test_fence_keeps_filters_above(spark):
    df = spark.range(10).withColumn("x", F.expr("aggregate(sequence(0, id), 0L, (a, b) -> a + b)"))
    plan = fence(df).filter(F.col("x") > 3)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    filt = next(i for i, l in enumerate(lines) if "Filter" in l)
    gen = next(i for i, l in enumerate(lines) if "Generate" in l)
    assert filt < gen  # the filter is above (printed before) the generator
    assert sorted(r.id for r in fence(df).filter(F.col("x") > 3).collect()) == list(range(3, 10))
