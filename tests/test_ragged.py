import pytest

from sparkprep.operators.gram import gram_matrix
from sparkprep.operators.linear import linregr


@pytest.mark.parametrize("rows", [[[1.0, 2.0], [2.0, 1.0, 9.0]], [[1.0, 2.0], [3.0]]])
def test_vectors_of_another_length_raise(spark, rows):
    df = spark.createDataFrame([(x, 1.0) for x in rows], "x array<double>, y double").coalesce(1)
    with pytest.raises(Exception, match="must all have 2 elements"):
        gram_matrix(df, "x", p=2).collect()
    with pytest.raises(Exception, match="must all have 2 elements"):
        linregr(df, "y", "x", p=2).collect()


def test_null_vectors_are_incomplete_rows(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1.0), (None, 2.0), ([None, 1.0], 3.0)], "x array<double>, y double")
    assert {r["n"] for r in gram_matrix(df, "x", p=2).collect()} == {1}
