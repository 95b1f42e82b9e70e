"""Delimited text, prediction and matrix tables."""

import pytest
from pyspark.sql import functions as F

from tabwright.sources import delimited
from tabwright.sources.tables import listing, table


def test_listing_schema():
    names = delimited.listing_schema().fieldNames()
    assert len(names) == 31 and "price" in names
    assert "price" not in delimited.listing_schema(labelled=False).fieldNames()


def test_empty_fields_are_missing(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("SaleID name regDate\n1  20160001\n2 7 20160102\n")
    schema = delimited.listing_schema().fieldNames()[:3]
    kind = delimited.T.StructType([delimited.listing_schema()[n] for n in schema])
    got = delimited.read_delimited(spark, str(path), kind).collect()
    assert [tuple(r) for r in got] == [(1, None, 20160001), (2, 7, 20160102)]


def test_projection_reaches_the_text_scan(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10).select(F.col("id").alias("a"), F.lit("x y").alias("b"), F.lit(1.5).alias("c"))
    delimited.write_delimited(df, path)
    got = delimited.read_delimited(spark, path, df.schema, columns=["c"])
    assert "ReadSchema: struct<c:string>" in got._jdf.queryExecution().executedPlan().toString()
    assert delimited.read_delimited(spark, path, df.schema).filter("b = 'x y'").count() == 10


def test_predictions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2.5), (2, None)], "SaleID long, pred double")
    delimited.write_predictions(df, path, "SaleID", "pred")
    got = spark.read.csv(path, header=True).orderBy("SaleID").collect()
    assert [r.asDict() for r in got] == [{"SaleID": "1", "price": "2.5"}, {"SaleID": "2", "price": None}]


def test_listing_leaves_out_joins_nobody_asked_for(spark, sf_dir):
    plan = listing(spark, sf_dir, ["sale_id", "brand"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lineitem" not in plan
    assert listing(spark, sf_dir, ["sale_id", "power", "body_type", "v_0"]).count() == table(spark, sf_dir, "orders").count()


def test_fields_as_other_tools_write_them(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('b,a,c,extra\n30.0,1,"say ""hi, you"" now",x\n,2.,plain,y\n-7,3,"",z\n')
    T = delimited.T
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    got = delimited.read_delimited(spark, str(path), schema, sep=",").collect()
    assert [tuple(r) for r in got] == [(1, 30, 'say "hi, you" now'), (2, None, "plain"), (3, -7, None)]
    out = str(tmp_path / "again")
    delimited.write_delimited(spark.createDataFrame(got, schema), out, sep=",")
    again = delimited.read_delimited(spark, out, schema, sep=",")
    assert sorted(again.collect(), key=str) == sorted(got, key=str)


def test_malformed_fields_raise_or_are_counted(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a b\n1 x\n2.5 7\n")
    T = delimited.T
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    with pytest.raises(Exception):
        delimited.read_delimited(spark, str(path), schema).collect()
    assert [tuple(r) for r in delimited.read_delimited(spark, str(path), schema, strict=False).collect()] == [(1, None), (None, 7.0)]
    assert {r["column"]: r["n"] for r in delimited.malformed_fields(spark, str(path), schema).collect()} == {"a": 1, "b": 1}
    with pytest.raises(delimited.MalformedFields):
        delimited.read_delimited(spark, str(path), T.StructType([T.StructField("z", T.StringType())]))
