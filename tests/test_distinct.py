"""Distinct categories from bitmaps against exact counts, under every filter on loads and days."""

from itertools import combinations

from pyspark.sql import functions as F

from ouvidoria.operators import classify, distinct, taxonomy


def test_every_filter(spark):
    labels = [*taxonomy.MACROS, "Outra coisa", "mais uma", None]
    rows = [(f"2024010{1 + i % 3}", f"0{1 + i % 4}/01/2024", labels[(i * i + i // 5) % len(labels)]) for i in range(90)]
    rows += [("20240109", None, "Outra coisa"), ("20240108", "09/01/2024", None)]
    df = spark.createDataFrame(rows, "datrefcarga string, dataocorrido string, macro_categoria string")
    state = distinct.category_state(df).cache()
    loads, days = sorted({r[0] for r in rows}), sorted({r[1] for r in rows if r[1]})
    for some in [(), *[(x,) for x in loads], *combinations(loads, 2)]:
        for ds in [(), *[(x,) for x in days[:3]]]:
            test = (F.col("datrefcarga").isin(*some) if some else F.lit(True)) & (F.col("dataocorrido").isin(*ds) if ds else F.lit(True))
            want = {r[2] for r in rows if (not some or r[0] in some) and (not ds or r[1] in ds)} - {None}
            assert distinct.distinct_categories(state.where(test)).first()[0] == len(want)


def test_states_of_loads_are_put_side_by_side(spark):
    df = spark.createDataFrame([("1", "a", "Outros"), ("2", "a", "Outros"), ("2", "b", "x")], "datrefcarga string, dataocorrido string, macro_categoria string")
    parts = [distinct.category_state(df.where(F.col("datrefcarga") == r)) for r in ("1", "2")]
    assert distinct.distinct_categories(parts[0].unionAll(parts[1])).first()[0] == 2
    assert distinct.distinct_categories(parts[0].where("false")).first()[0] == 0


def test_state_makes_each_label_once(spark, plan):
    """No filter classifies texts a second time."""
    text = F.when(F.col("id") < 2, F.concat(F.lit("conta invadida "), F.col("id").cast("string")))
    feed = spark.range(3).select(F.lit("20240101").alias("datrefcarga"), F.col("id").cast("string").alias("dataocorrido"), text.alias("relato"))
    counted = classify.classify(feed).groupBy("datrefcarga", "dataocorrido", "macro_categoria").agg(F.count("*").alias("qtd"))
    state = distinct.category_state(counted)
    assert plan(state).count("split(") == 1
    assert sorted(r.dataocorrido for r in state.collect()) == ["0", "1"]
