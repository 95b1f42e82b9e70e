"""The given Parquet tables and the listing view built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import materialize

VECTOR_SIZE = 15
# Vectors that are broadcast to the sales; more are joined by a shuffle.
BROADCAST_VECTORS = 20_000

CUSTOMER_COLUMNS = {"body_type", "region_code", "acctbal"}
LINE_COLUMNS = {"creat_date", "gearbox", "kilometer", "power"}
VECTOR_COLUMNS = {f"v_{i}" for i in range(VECTOR_SIZE)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_yyyymmdd(date: Column, month: Column) -> Column:
    return (F.year(date) * 10000 + month + F.dayofmonth(date)).cast("int")


def listing(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """One row per sale, holding only ``columns``; joins nobody asked for are left out."""
    wanted = set(columns)
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders")

    if wanted & LINE_COLUMNS:
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.max("l_shipdate").alias("ship"),
                F.count(F.lit(1)).alias("n_lines"),
                F.sum("l_quantity").alias("qty"),
            )
        )
        df = df.join(lines, "o_orderkey", "left")

    if wanted & CUSTOMER_COLUMNS:
        customers = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal"
        )
        df = df.join(customers, "o_custkey", "left")

    if wanted & VECTOR_COLUMNS:
        # Sales share all vectors in turn.
        vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
        n = max(1, vectors.count())
        side = F.broadcast(vectors) if n <= BROADCAST_VECTORS else vectors
        df = df.withColumn("vec_id", key % n).join(side, "vec_id", "left")

    labelled = key % 4 != 0
    exprs = {
        "sale_id": lambda: key,
        "is_train": lambda: labelled,
        "price": lambda: F.when(labelled, F.col("o_totalprice")),
        "reg_date": lambda: _as_yyyymmdd(
            F.col("o_orderdate"),
            F.when(key % 50 == 0, 0).otherwise(F.month("o_orderdate") * 100),
        ),
        "creat_date": lambda: _as_yyyymmdd(F.col("ship"), F.month("ship") * 100),
        "name": lambda: F.col("o_custkey"),
        "model": lambda: F.nullif(F.col("o_custkey") % 40, F.lit(7)),
        "brand": lambda: F.col("o_orderpriority"),
        "body_type": lambda: F.col("c_mktsegment"),
        "fuel_type": lambda: F.nullif(F.col("o_orderstatus"), F.lit("P")),
        "gearbox": lambda: F.col("n_lines") % 2,
        "region_code": lambda: F.col("c_nationkey") * 10 + F.col("o_custkey") % 7,
        "kilometer": lambda: F.col("n_lines"),
        "power": lambda: F.col("qty") * 3,
        "damaged": lambda: F.when(key % 9 == 0, "-").otherwise((key % 2).cast("string")),
        "acctbal": lambda: F.col("c_acctbal"),
    }
    for i in range(VECTOR_SIZE):
        exprs[f"v_{i}"] = lambda i=i: F.element_at("embedding", i + 1).cast("double")
    return df.select(*[exprs[c]().alias(c) for c in columns])


def stored_listing(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """The view written once to the shared folder, for work that reads it more than once."""
    return materialize(listing(spark, sf_dir, columns), "listing")


# The same view for an ANSI-SQL engine, used by the comparison queries.
LISTING_SQL = f"""
select o.o_orderkey as sale_id,
       o.o_orderkey % 4 <> 0 as is_train,
       case when o.o_orderkey % 4 <> 0 then o.o_totalprice end as price,
       cast(year(o.o_orderdate)*10000 + day(o.o_orderdate)
            + case when o.o_orderkey % 50 = 0 then 0 else month(o.o_orderdate)*100 end as int) as reg_date,
       cast(year(l.ship)*10000 + month(l.ship)*100 + day(l.ship) as int) as creat_date,
       o.o_custkey as name,
       nullif(o.o_custkey % 40, 7) as model,
       o.o_orderpriority as brand,
       c.c_mktsegment as body_type,
       nullif(o.o_orderstatus, 'P') as fuel_type,
       l.n_lines % 2 as gearbox,
       c.c_nationkey * 10 + o.o_custkey % 7 as region_code,
       l.n_lines as kilometer,
       l.qty * 3 as power,
       case when o.o_orderkey % 9 = 0 then '-' else cast(o.o_orderkey % 2 as varchar) end as damaged,
       c.c_acctbal as acctbal,
       {', '.join(f'cast(list_extract(e.embedding, {i + 1}) as double) as v_{i}' for i in range(VECTOR_SIZE))}
from orders o
left join customer c on c.c_custkey = o.o_custkey
left join (select l_orderkey, max(l_shipdate) as ship, count(*) as n_lines, sum(l_quantity) as qty
           from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey
left join embeddings e on e.vec_id = o.o_orderkey % (select count(*) from embeddings)
"""
