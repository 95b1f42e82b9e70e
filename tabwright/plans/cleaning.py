"""Queries: sources, sinks, selection, missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import scalars as S
from tabwright.operators import clean
from tabwright.plans.registry import on_listing, query, rounded, sql_rounded
from tabwright.session import scratch_path
from tabwright.sources import delimited
from tabwright.sources.tables import listing, stored_listing, table


@query(
    "scan_delimited",
    "select p_partkey, p_name, p_brand, p_type, nullif(p_size, 1) as p_size, p_retailprice from part",
)
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("p_size", F.nullif("p_size", F.lit(1)))
    path = scratch_path(spark, "scan_delimited")
    delimited.write_delimited(part, path)
    return delimited.read_delimited(spark, path, part.schema)


@query("scan_projected", "select o_orderkey, o_totalprice from orders")
def scan_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "scan_projected")
    delimited.write_delimited(orders, path, sep=",")
    return delimited.read_delimited(spark, path, orders.schema, ",", ["o_orderkey", "o_totalprice"])


@query("sink_delimited", on_listing("select sale_id, price, model, brand, power, fuel_type from listing"))
def sink_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "price", "model", "brand", "power", "fuel_type"])
    path = scratch_path(spark, "sink_delimited")
    delimited.write_delimited(rows, path)
    return delimited.read_delimited(spark, path, rows.schema)


@query(
    "sink_predictions",
    "select c_custkey as sale_id, case when c_acctbal < 0 then 0 else c_acctbal end as price from customer",
)
def sink_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sale_id"), "c_acctbal")
    path = scratch_path(spark, "sink_predictions")
    delimited.write_predictions(rows, path, "sale_id", S.floor_at_zero(F.col("c_acctbal")))
    schema = T.StructType([T.StructField("sale_id", T.LongType()), T.StructField("price", T.DoubleType())])
    return delimited.read_delimited(spark, path, schema, ",")


@query(
    "sink_matrix",
    """select vec_id, cast(pos as int) as pos, cast(list_extract(embedding, pos) as double) as value
       from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as pos from embeddings)""",
)
def sink_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sink_matrix")
    delimited.write_matrix(table(spark, sf_dir, "embeddings"), path, "vec_id", "embedding")
    matrix = delimited.read_matrix(spark, path)
    return matrix.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", (F.col("pos") + 1).alias("pos"), "value"
    )


@query("union_labelled", on_listing("select sale_id, brand, price, is_train from listing"))
def union_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "brand", "price", "is_train"])
    labelled = rows.filter("is_train").select("sale_id", "brand", "price")
    unlabelled = rows.filter("not is_train").select("brand", "sale_id")
    return clean.union_labelled(labelled, unlabelled)


@query(
    "split_labelled",
    on_listing(
        """select sale_id, price, 'labelled' as part from listing where is_train
           union all select sale_id, price, 'unlabelled' as part from listing where not is_train"""
    ),
)
def split_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, unlabelled = clean.split_labelled(listing(spark, sf_dir, ["sale_id", "price", "is_train"]))
    return labelled.withColumn("part", F.lit("labelled")).unionByName(
        unlabelled.withColumn("part", F.lit("unlabelled"))
    )


@query("select_features", on_listing("select sale_id, brand, body_type, power from listing"))
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "price", "name", "model", "brand", "body_type", "power"])
    wanted = ["power", "sale_id", "brand", "body_type", "name", "power", "never_built"]
    return clean.select_features(rows, wanted, exclude=["name", "not_there"])


@query("select_by_type", "select p_partkey, p_size, p_retailprice from part")
def select_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.select_by_type(table(spark, sf_dir, "part"))


def _sql_integer_type(c: str) -> str:
    return f"""(select case when min({c}) > -128 and max({c}) < 127 then 'tinyint'
                            when min({c}) > -32768 and max({c}) < 32767 then 'smallint'
                            when min({c}) > -2147483648 and max({c}) < 2147483647 then 'int'
                            else 'bigint' end from lineitem)"""


_LINE_INTEGERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query(
    "narrow_types",
    f"""select {', '.join(f'{c}, {_sql_integer_type(c)} as {c}_type' for c in _LINE_INTEGERS)},
               l_quantity, 'float' as l_quantity_type, l_returnflag
        from lineitem""",
)
def narrow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*_LINE_INTEGERS, "l_quantity", "l_returnflag")
    narrowed, report = clean.narrow_types(lines)
    kinds = [F.typeof(c).alias(f"{c}_type") for c, _, _ in report]
    # The chosen type depends on the data; values go back to a fixed type for comparison.
    values = [F.col(c).cast(lines.schema[c].dataType).alias(c) for c in narrowed.columns]
    return narrowed.select(*values, *kinds)


@query(
    "narrow_report",
    "\nunion all\n".join(
        f"""select '{c}' as column_name, '{old}' as old_type, {_sql_integer_type(c)} as new_type,
                   cast((select count(*) from lineitem) as bigint) * {size} as old_bytes"""
        for c, old, size in (
            ("l_orderkey", "bigint", 8),
            ("l_partkey", "bigint", 8),
            ("l_suppkey", "bigint", 8),
            ("l_linenumber", "int", 4),
        )
    ),
)
def narrow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*_LINE_INTEGERS)
    _, report = clean.narrow_types(lines)
    rows = lines.agg(F.count(F.lit(1)).alias("n"))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(old).alias("old_type"),
            F.lit(new).alias("new_type"),
            (F.col("n") * clean.TYPE_BYTES[old]).alias("old_bytes"),
        )
        for c, old, new in report
    ]
    return rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


@query(
    "cast_float",
    on_listing(
        """select cast(sale_id as float) as sale_id, brand, cast(price as float) as price,
                  cast(power as float) as power, cast(acctbal as float) as acctbal from listing"""
    ),
)
def cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.cast_numeric(listing(spark, sf_dir, ["sale_id", "brand", "price", "power", "acctbal"]))


@query("filter_rows", on_listing("select sale_id, model from listing where model is null or model <> 1"))
def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_rows(listing(spark, sf_dir, ["sale_id", "model"]), F.col("model") == 1)


@query("preview", on_listing("select sale_id, brand, price from listing order by sale_id limit 5"))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.preview(listing(spark, sf_dir, ["sale_id", "brand", "price"]), ["sale_id"])


@query(
    "sentinel_to_value",
    on_listing(
        """select sale_id, case when damaged = '-' then 0.0::double else cast(damaged as double) end as damaged
           from listing"""
    ),
)
def sentinel_to_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "damaged"])
    return rows.select("sale_id", S.sentinel_to_value(F.col("damaged"), "-", 0).alias("damaged"))


@query("sentinel_to_null", on_listing("select sale_id, cast(nullif(damaged, '-') as float) as damaged from listing"))
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "damaged"])
    return rows.select("sale_id", S.sentinel_to_null(F.col("damaged"), "-").alias("damaged"))


_IMPUTED = ("model", "fuel_type", "gearbox", "kilometer", "power", "creat_date", "body_type", "region_code")


def sql_mode(c: str, source: str = "listing") -> str:
    return f"(select {c} from {source} where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"


@query(
    "impute_mode",
    on_listing(
        f"select sale_id, price, {', '.join(f'coalesce({c}, {sql_mode(c)}) as {c}' for c in _IMPUTED)} from listing"
    ),
)
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_listing(spark, sf_dir, ["sale_id", "price", *_IMPUTED])
    return clean.impute_mode(rows, exclude=["sale_id", "price"])


@query(
    "impute_constant",
    on_listing(
        """select sale_id, coalesce(model, 0) as model, coalesce(gearbox, 0) as gearbox,
                  coalesce(fuel_type, '0') as fuel_type from listing"""
    ),
)
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "model", "gearbox", "fuel_type"])
    return clean.impute_constant(rows, {"model": 0, "gearbox": 0, "fuel_type": "0"})


@query(
    "clip_bounds",
    on_listing(
        """select sale_id, case when power > 600 then 600 when power < 1 then 1 else power end as power,
                  case when acctbal < 0 then 0 else acctbal end as acctbal,
                  case when v_13 > 0.1 then 0.1 else v_13 end as v_13 from listing"""
    ),
)
def clip_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "power", "acctbal", "v_13"])
    return rows.select(
        "sale_id",
        S.clip(F.col("power"), 1, 600).alias("power"),
        S.clip(F.col("acctbal"), lower=0).alias("acctbal"),
        S.clip(F.col("v_13"), upper=0.1).alias("v_13"),
    )


@query(
    "floor_predictions",
    f"""select c_custkey, {sql_rounded('case when c_acctbal - 500 < 0 then 0 else c_acctbal - 500 end', 4)} as pred
        from customer""",
)
def floor_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", rounded(S.floor_at_zero(F.col("c_acctbal") - 500), 4).alias("pred"))
