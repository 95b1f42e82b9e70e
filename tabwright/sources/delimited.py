"""Delimited text and matrix tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the raw listing files.
LISTING_FIELDS = (
    ("SaleID", T.LongType()),
    ("name", T.LongType()),
    ("regDate", T.IntegerType()),
    ("model", T.IntegerType()),
    ("brand", T.IntegerType()),
    ("bodyType", T.IntegerType()),
    ("fuelType", T.IntegerType()),
    ("gearbox", T.IntegerType()),
    ("power", T.DoubleType()),
    ("kilometer", T.DoubleType()),
    ("notRepairedDamage", T.StringType()),
    ("regionCode", T.IntegerType()),
    ("seller", T.IntegerType()),
    ("offerType", T.IntegerType()),
    ("creatDate", T.IntegerType()),
)


def listing_schema(labelled: bool = True, n_vector: int = 15) -> T.StructType:
    """Schema of a raw listing file; unlabelled files carry no price."""
    fields = [T.StructField(name, kind) for name, kind in LISTING_FIELDS]
    if labelled:
        fields.append(T.StructField("price", T.DoubleType()))
    fields += [T.StructField(f"v_{i}", T.DoubleType()) for i in range(n_vector)]
    return T.StructType(fields)


class MalformedFields(ValueError):
    """A delimited file holds fields that are no values of their columns."""


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = " ",
    columns: Sequence[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Scan headed delimited text with a declared schema (no inference pass).

    Columns are matched by the header's names, in any order. An empty field is missing;
    quotes inside quoted fields are doubled. Whole numbers may be written as ``30.0``, as other
    tools write a column of integers with gaps. A field that is no value of its
    column, as well as a missing column, raises; with ``strict=False`` it is missing, and
    ``malformed_fields`` counts such fields. ``columns`` prunes the parse to those fields.
    """
    kept = schema if columns is None else T.StructType([schema[c] for c in columns])
    text = _as_text(spark, path, sep)
    lost = [f.name for f in kept if f.name not in text.columns]
    if lost:
        raise MalformedFields(f"{path} has no columns {lost}")
    return text.select(*[_parsed(f, strict).alias(f.name) for f in kept])


def malformed_fields(spark: SparkSession, path: str, schema: T.StructType, sep: str = " ") -> DataFrame:
    """``(column, n)``: fields per column that hold text but no value of the declared type."""
    text = _as_text(spark, path, sep)
    known = [f for f in schema if f.name in text.columns]
    counts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count(F.when(F.col(f"`{f.name}`").isNotNull() & _parsed(f, strict=False).isNull(), 1)).alias("n"),
        )
        for f in known
    ]
    return text.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def _as_text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.csv(path, sep=sep, header=True, escape='"', inferSchema=False, mode="FAILFAST")


def _parsed(field: T.StructField, strict: bool) -> Column:
    raw = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return raw
    if not isinstance(field.dataType, T.IntegralType):
        return raw.cast(field.dataType) if strict else raw.try_cast(field.dataType)
    whole = F.regexp_replace(F.trim(raw), r"\.0*$", "")
    return whole.cast(field.dataType) if strict else whole.try_cast(field.dataType)


def write_delimited(df: DataFrame, path: str, sep: str = " ") -> None:
    """Write headed delimited text, one file per partition, without an index column."""
    df.write.csv(path, sep=sep, header=True, escape='"')


def write_predictions(df: DataFrame, path: str, id_col: str, pred: str | Column) -> None:
    """Write the two-column ``(id, price)`` table as comma-separated text."""
    pred = F.col(pred) if isinstance(pred, str) else pred
    write_delimited(df.select(id_col, pred.alias("price")), path, sep=",")


def write_matrix(df: DataFrame, path: str, id_col: str, features: str) -> None:
    """Store a dense matrix as Parquet rows ``(id, array<double>)``."""
    values = F.col(features)
    if isinstance(df.schema[features].dataType, VectorUDT):
        values = vector_to_array(values)
    df.select(id_col, values.cast("array<double>").alias(features)).write.parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
