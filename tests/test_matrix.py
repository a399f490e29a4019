import numpy as np
import pytest
from pyspark.sql import functions as F

from scanforge.operators import matrix

rng = np.random.default_rng(0)
A, B = rng.normal(size=24), rng.normal(size=24).astype("f4")


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame([(A.tolist(), B.tolist())], "a array<double>, b array<float>")


def value(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_elementwise(pair):
    a, b = F.col("a"), F.col("b")
    wide = B.astype("f8")
    assert np.array_equal(value(pair, matrix.hadamard(a, b)), A * wide)
    assert np.array_equal(value(pair, matrix.add(a, b)), A + wide)
    assert np.array_equal(value(pair, matrix.subtract(a, b)), A - wide)
    assert np.array_equal(np.float32(value(pair, matrix.add_narrow(a, b))), (A + wide).astype("f4"))
    assert np.array_equal(np.float32(value(pair, matrix.to_float(a))), A.astype("f4"))


def test_shapes(pair):
    a, b = F.col("a"), F.col("b")
    assert np.array_equal(value(pair, matrix.reshape_2d(a, 4, 6)), A.reshape(4, 6))
    assert np.array_equal(np.float32(value(pair, matrix.reshape_2d(b, 6, 4))), B.reshape(6, 4))
    assert np.array_equal(value(pair, matrix.reshape_3d(a, 2, 3, 4)), A.reshape(2, 3, 4))
    assert np.array_equal(value(pair, matrix.flatten_2d(matrix.reshape_2d(a, 4, 6))), A)
    assert np.array_equal(value(pair, matrix.flatten_3d(matrix.reshape_3d(a, 2, 3, 4))), A)
    with pytest.raises(Exception, match="must have 25 elements"):
        value(pair, matrix.reshape_2d(a, 5, 5))


def test_arange_and_largest(spark):
    one = spark.range(1)
    assert value(one, matrix.arange(-205, 215)) == [-205.0 + 10 * i for i in range(43)]
    assert value(one, matrix.arange(0, 25)) == [0.0, 10.0, 20.0]
    rows = [([1.0, 5.0, 5.0],), ([],), (None,)]
    df = spark.createDataFrame(rows, "a array<double>")
    assert [r[0] for r in df.select(matrix.largest_index(F.col("a"))).collect()] == [1, -1, -1]
