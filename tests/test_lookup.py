import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sheafworks.operators import lookup as L


def test_local_tables_are_checked_and_local(spark):
    small = spark.range(5).select("id", F.array(F.col("id") / 2).alias("v"))
    local = L.as_local(small, 5)
    assert sorted(map(tuple, local.collect())) == sorted(map(tuple, small.collect()))
    assert "LocalTableScan" in plan_of(local) and local.schema.simpleString() == small.schema.simpleString()
    with pytest.raises(ValueError, match="exceeds 4 rows"):
        L.as_local(small, 4)


def test_scalar_maps_are_checked(spark):
    small = spark.range(5).select("id", (F.col("id") * 2).alias("v"))
    one = spark.range(1)
    assert one.select(L.scalar_map(small, F.col("id"), F.col("v"))[3]).first()[0] == 6
    with pytest.raises(Exception, match="exceeds 4 rows"):
        one.select(L.scalar_map(small, F.col("id"), F.col("v"), max_rows=4)).collect()


def test_single_row(spark):
    one = spark.range(1).select(F.lit("x").alias("a"))
    assert spark.range(2).select(L.single_row(one, "none")["a"]).first()[0] == "x"
    with pytest.raises(Exception, match="none at all"):
        spark.range(2).select(L.single_row(one.limit(0), "none at all")["a"]).collect()
