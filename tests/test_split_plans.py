"""Splits do not send a stratum to one task."""

from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import sampling as S


def join_kinds(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_rows_are_not_shuffled_by_stratum(spark, monkeypatch):
    rows = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the table were large
    try:
        for split in (S.split_two, S.split_three):
            broadcast = split(rows, "row_id")
            assert not join_kinds(broadcast)
            with monkeypatch.context() as patch:
                patch.setattr(session, "MAX_BROADCAST_ROWS", 1)
                joined = split(rows, "row_id")
                assert join_kinds(joined)
            key = lambda df: sorted(map(tuple, df.collect()))
            assert key(broadcast) == key(joined)
        assert not join_kinds(S.split_two(rows, "row_id", strata=()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
