"""Top-k and response reconciliation on hand-made rows."""

from pyspark.sql import functions as F

from nestmart.operators.selection import (reconcile_keep, reconcile_strict, split_responses,
                                          top_ids)


def test_top_ids_ties_and_nulls(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 9.0), (None, 99.0), (4, None)],
                               "id bigint, popularity double")
    assert [r.id for r in top_ids(df, k=3).collect()] == [2, 1, 3]
    assert [r.id for r in top_ids(df, k=10).collect()] == [2, 1, 3, 4]


def test_reconcile_strict_and_keep(spark):
    first = spark.createDataFrame([(1, 1.0), (2, None), (3, None)], "id int, v double")
    retry = spark.createDataFrame([(2, 2.0), (3, None)], "id int, v double")
    failed = F.col("v").isNull()
    ok, bad = split_responses(first, failed)
    assert sorted(r.id for r in ok.collect()) == [1] and sorted(r.id for r in bad.collect()) == [2, 3]
    assert sorted((r.id, r.v) for r in reconcile_strict(first, retry, failed).collect()) == \
        [(1, 1.0), (2, 2.0)]
    keep = sorted((r.id, r.v if r.v is not None else -1) for r in
                  reconcile_keep(first, retry, failed).collect())
    assert keep == [(1, 1.0), (2, 2.0), (3, -1)]
