"""Categories with very many levels are joined from a table, never gathered."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.preprocess import fit_preprocessor


def test_wide_and_narrow_encodings_agree(spark):
    rows = [(float(i), f"v{i % 5}", f"w{i % 7}") for i in range(70)] + [(1.0, None, None)]
    df = spark.createDataFrame(rows, "x double, a string, b string")
    narrow, wide = (fit_preprocessor(df, ["x"], ["a", "b"], max_levels=n) for n in (10, 5))
    assert wide.wide == {"b": 7} and wide.levels == {"a": [f"v{i}" for i in range(5)], "b": []}
    assert narrow.modes == wide.modes == {"a": "v0", "b": "w0"}
    unseen = spark.createDataFrame([(2.0, "new", "new"), (3.0, "v1", None)], df.schema)
    slots = {r.name: r.slot for r in wide.wide_names().collect()}
    order = {**{n: i for i, n in enumerate(wide.names)}, **slots}
    assert sorted(order) == sorted(narrow.names) and sorted(order.values()) == list(range(13))
    for data in (df, unseen):
        a = {(r.x, r.a, r.b): r.features.toArray() for r in narrow.vectors(data).collect()}
        b = {(r.x, r.a, r.b): r.features.toArray() for r in wide.vectors(data).collect()}
        assert a.keys() == b.keys()
        for row, values in a.items():
            assert [b[row][order[n]] for n in narrow.names] == pytest.approx(list(values))
    assert wide.vectors(df).columns == [*df.columns, "features"]


def test_three_hundred_thousand_levels(spark):
    df = spark.range(300_000).select(F.concat(F.lit("level"), F.col("id").cast("string")).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    fit = fit_preprocessor(df, [], ["c"])
    assert fit.wide == {"c": 300_000} and fit.names == [] and fit.modes == {"c": "level0"}
    vectors = fit.vectors(df)
    sizes = vectors.select(F.expr("y"), "features").limit(3).collect()
    assert all(r.features.size == 300_000 and r.features.numNonzeros() == 1 for r in sizes)
    places = fit.level_table.agg(F.countDistinct("index").alias("n"), F.max("index").alias("top")).first()
    assert (places.n, places.top) == (300_000, 299_999)
    assert fit.vectors(spark.createDataFrame([("unseen", 0)], "c string, y int")).first().features.numNonzeros() == 0
