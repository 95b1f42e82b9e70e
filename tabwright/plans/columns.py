"""Queries: dates, logs, weights, crosses and bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import bins, crosses
from tabwright.functions import scalars as S
from tabwright.plans.registry import on_listing, query, rounded, sql_rounded
from tabwright.sources.tables import VECTOR_SIZE, listing, stored_listing, table

AS_OF = "2002-01-01"
VECTOR = [f"v_{i}" for i in range(VECTOR_SIZE)]


def sql_date(c: str) -> str:
    text = f"cast({c} as varchar)"
    month = f"case when substr({text}, 5, 2) = '00' then '01' else substr({text}, 5, 2) end"
    return f"cast(try_strptime(substr({text}, 1, 4) || {month} || substr({text}, 7, 2), '%Y%m%d') as date)"


REG, CREAT = sql_date("reg_date"), sql_date("creat_date")
SQL_DAYS = f"cast({CREAT} - {REG} as int)"


def dated(spark: SparkSession, sf_dir: str, *more: str, stored: bool = False) -> DataFrame:
    """The listing with parsed dates and the days between them."""
    read = stored_listing if stored else listing
    rows = read(spark, sf_dir, ["sale_id", "reg_date", "creat_date", *more])
    return rows.withColumns(
        {"reg": S.repaired_date(F.col("reg_date")), "creat": S.repaired_date(F.col("creat_date"))}
    ).withColumn("days", S.day_gap(F.col("creat"), F.col("reg")))


@query(
    "date_repair_parse",
    on_listing(
        f"""select sale_id, reg_date, cast({REG} as varchar) as reg, cast({CREAT} as varchar) as creat from listing"""
    ),
)
def date_repair_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select(
        "sale_id", "reg_date", F.col("reg").cast("string").alias("reg"), F.col("creat").cast("string").alias("creat")
    )


def sql_parts(date: str, prefix: str) -> str:
    parts = {"year": "year", "month": "month", "day": "day"}
    out = [f"cast({fn}({date}) as int) as {prefix}_{name}" for name, fn in parts.items()]
    return ", ".join([*out, f"cast(isodow({date}) - 1 as int) as {prefix}_dayofweek"])


@query("date_parts", on_listing(f"select sale_id, {sql_parts(REG, 'reg')}, {sql_parts(CREAT, 'creat')} from listing"))
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dated(spark, sf_dir)
    return rows.select(
        "sale_id", *S.date_parts(F.col("reg"), "reg"), *S.date_parts(F.col("creat"), "creat")
    )


@query("date_diff_days", on_listing(f"select sale_id, {SQL_DAYS} as days from listing"))
def date_diff_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("sale_id", "days")


@query("age_years", on_listing(f"select sale_id, round({SQL_DAYS} / 365.0::double, 1) as years from listing"))
def age_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("sale_id", S.years_of(F.col("days")).alias("years"))


@query(
    "days_since",
    on_listing(
        f"""select sale_id, cast(date '{AS_OF}' - {REG} as int) as since_reg,
                   cast(date '{AS_OF}' - {CREAT} as int) as since_creat from listing"""
    ),
)
def days_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select(
        "sale_id",
        S.days_since(F.col("reg"), AS_OF).alias("since_reg"),
        S.days_since(F.col("creat"), AS_OF).alias("since_creat"),
    )


@query("string_prefix", on_listing("select sale_id, substr(cast(region_code as varchar), 1, 2) as city from listing"))
def string_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir, ["sale_id", "region_code"]).select(
        "sale_id", S.text_prefix(F.col("region_code"), 2).alias("city")
    )


@query(
    "log_target",
    f"""select o_orderkey, {sql_rounded('ln(1 + o_totalprice)', 6)} as log_price,
               {sql_rounded('exp(ln(1 + o_totalprice)) - 1', 3)} as price from orders""",
)
def log_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_price = S.to_log(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", rounded(log_price, 6).alias("log_price"), rounded(S.from_log(log_price), 3).alias("price")
    )


@query(
    "smoothing_weight",
    f"""select o_custkey, n, {sql_rounded('1 / (1 + exp((n - 2) / 1.0::double))', 6)} as weight,
               {sql_rounded('1 / (1 + exp((n - 9) / 3.5::double))', 6)} as gentle,
               {sql_rounded('10 / (10.0::double + n)', 6)} as own
        from (select o_custkey, count(*) as n from orders group by o_custkey)""",
)
def smoothing_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    hook = S.weight_hook(lambda c: F.lit(10.0) / (F.lit(10.0) + c))
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "o_custkey",
            "n",
            rounded(S.weight_hook(None)(n), 6).alias("weight"),
            rounded(S.weight_hook({"k": 9, "f": 3.5})(n), 6).alias("gentle"),
            rounded(hook(n), 6).alias("own"),
        )
    )


def _sql_self_cross(op: str, sign: str) -> str:
    grid = f"list_transform(embedding, lambda a: list_transform(embedding, lambda b: cast(a as double) {sign} cast(b as double)))"
    cells = "list_transform(flatten(grid), lambda x: cast(cast(floor(x * 1e9) as bigint) as varchar))"
    return f"""select vec_id, len(flatten(grid)) as crosses, list_sum(flatten(grid)[1:2]) as first_two,
                      md5(array_to_string({cells}, ',')) as all_crosses
               from (select vec_id, {grid} as grid from embeddings)"""


def _register_self_cross(name: str, op: str, sign: str) -> None:
    @query(name, _sql_self_cross(op, sign))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Crosses of whole vectors; thousands of them per row, so a digest tells that all are right."""
        values = F.col("embedding").cast("array<double>")
        rows = table(spark, sf_dir, "embeddings").select("vec_id", crosses.cross_array(values, op).alias("grid"))
        cells = F.transform("grid", lambda x: F.floor(x * 1e9).cast("string"))
        return rows.select(
            "vec_id",
            F.size("grid").cast("long").alias("crosses"),
            (F.element_at("grid", 1) + F.element_at("grid", 2)).alias("first_two"),
            F.md5(F.array_join(cells, ",").cast("binary")).alias("all_crosses"),
        )


for _name, _op, _sign in (
    ("pairwise_sum", "plus", "+"),
    ("pairwise_product", "times", "*"),
    ("pairwise_diff", "minus", "-"),
):
    _register_self_cross(_name, _op, _sign)


CODES = ("model", "brand_code", "gearbox", "power", "kilometer", "damage", "region_code")


@query(
    "cross_product_cols",
    on_listing(
        f"""select sale_id, {', '.join(f'{c} * {v} as {crosses.cross_name(c, "times", v)}' for c in CODES for v in VECTOR[:14])}
            from (select *, cast(substr(brand, 1, 1) as int) as brand_code,
                         case when damaged = '-' then 0.0::double else cast(damaged as double) end as damage from listing)"""
    ),
)
def cross_product_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["sale_id", "model", "brand", "gearbox", "power", "kilometer", "damaged", "region_code"]
    rows = listing(spark, sf_dir, [*columns, *VECTOR[:14]]).withColumns(
        {
            "brand_code": F.substring("brand", 1, 1).cast("int"),
            "damage": S.sentinel_to_value(F.col("damaged"), "-", 0),
        }
    )
    return rows.select("sale_id", *crosses.cross_columns(CODES, VECTOR[:14], "times"))


@query(
    "vector_scale",
    on_listing(
        f"""select sale_id, {', '.join(f'{v} * {s} as {crosses.cross_name(v, "times", s)}' for s in ('power', 'days', 'years') for v in VECTOR)}
            from (select *, {SQL_DAYS} as days, round({SQL_DAYS} / 365.0::double, 1) as years from listing)"""
    ),
)
def vector_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dated(spark, sf_dir, "power", *VECTOR).withColumn("years", S.years_of(F.col("days")))
    by_factor = [c for s in ("power", "days", "years") for c in crosses.cross_columns(VECTOR, [s], "times")]
    return rows.select("sale_id", *by_factor)


def sql_fixed_bin(c: str, count: int, width: int = 10) -> str:
    return f"""case when {c} > 0 and {c} <= {count * width}
               then cast((select count(*) from range(0, {count + 1}) e(i) where i * {width} < {c}) - 1 as int) end"""


@query(
    "bin_fixed",
    on_listing(
        f"""select sale_id, power, {sql_fixed_bin('power', 30)} as power_bin,
                   {sql_fixed_bin('model', 23)} as model_bin,
                   cast(case when power > 5 and power <= 20 then 0 when power > 20 and power <= 150 then 1
                             when power > 150 and power <= 400 then 2 end as int) as power_band
            from listing"""
    ),
)
def bin_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir, ["sale_id", "power", "model"])
    return rows.select(
        "sale_id",
        "power",
        bins.fixed_bins(F.col("power"), 0, 10, 30).alias("power_bin"),
        bins.fixed_bins(F.col("model"), 0, 10, 23).alias("model_bin"),
        bins.edge_bins(F.col("power"), [5, 20, 150, 400]).alias("power_band"),
    )


_RANGED = {
    "power": "case when power > 600 then 600.0 when power < 1 then 1.0 else power end",
    "acctbal": "acctbal",
    "days": SQL_DAYS,
}


def sql_range_bin(c: str, name: str) -> str:
    """Bin of ``c`` by the range column ``<name>_r`` of table ``r``."""
    edge = f"(i * r.{name}_r) / 50.0::double"
    return f"""case when {c} > 0 and {c} <= ((r.{name}_r - 1) * r.{name}_r) / 50.0::double
               then cast((select count(*) from range(0, r.{name}_r) e(i) where {edge} < {c}) - 1 as int) end"""


@query(
    "bin_range",
    on_listing(
        f"""select sale_id, {', '.join(f'{sql_range_bin(c, c)} as {c}_bin' for c in _RANGED)} from vals, r""",
        f"""vals as (select sale_id, {', '.join(f'{e} as {c}' for c, e in _RANGED.items())} from listing),
            r as (select {', '.join(f'cast(trunc(max({c}) - min({c})) as bigint) as {c}_r' for c in _RANGED)} from vals)""",
    ),
)
def bin_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dated(spark, sf_dir, "power", "acctbal", stored=True).withColumn("power", S.clip(F.col("power"), 1, 600))
    return attach_range_bins(rows, list(_RANGED)).select("sale_id", *[f"{c}_bin" for c in _RANGED])


def attach_range_bins(rows: DataFrame, columns: list[str], n_bins: int = 50) -> DataFrame:
    """Add ``<column>_bin``; one pass finds every column's range."""
    spread = rows.agg(*[(F.max(c) - F.min(c)).cast("double").alias(c) for c in columns]).first()
    return rows.withColumns(
        {f"{c}_bin": bins.range_bins(F.col(c), spread[c], n_bins) for c in columns}
    )
