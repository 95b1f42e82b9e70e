"""Queries: folds and cross-fitted encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators import folds
from tabwright.operators.target import FoldTargetEncoder, SmoothedMeanEncoder
from tabwright.plans.registry import on_listing, query, round_columns, sql_rounded
from tabwright.sources.tables import stored_listing, table


def sql_digest(c: str, seed: int) -> str:
    return f"cast('0x' || substr(md5(cast({c} as varchar) || ':{seed}'), 1, 15) as bigint)"


@query("kfold_contiguous", "select o_orderkey, cast(ntile(10) over (order by o_orderkey) - 1 as int) as fold from orders")
def kfold_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.contiguous_folds(orders, 10, F.col("o_orderkey"))


@query(
    "kfold_stratified",
    "select vec_id, label, cast(ntile(4) over (partition by label order by vec_id) - 1 as int) as fold from embeddings",
)
def kfold_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return folds.stratified_folds(vectors, 4, F.col("vec_id"), "label")


@query(
    "kfold_shuffled",
    f"select o_orderkey, cast(ntile(10) over (order by {sql_digest('o_orderkey', 42)}) - 1 as int) as fold from orders",
)
def kfold_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.shuffled_folds(orders, 10, "o_orderkey", 42, key=folds.digest_key)


@query("kfold_hashed")
def kfold_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default, faster shuffle order; only Spark computes this hash."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.shuffled_folds(orders, 5, "o_orderkey", 2018)


@query(
    "kfold_hashed_sizes",
    "select fold, count(*) as n from (select cast(ntile(5) over (order by o_orderkey) - 1 as int) as fold from orders) group by fold",
)
def kfold_hashed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folds of the hashed order are as large as any k folds."""
    return kfold_hashed(spark, sf_dir).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("kfold_modulo", "select o_orderkey, cast(o_orderkey % 7 as int) as fold from orders")
def kfold_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.modulo_folds(table(spark, sf_dir, "orders").select("o_orderkey"), 7, "o_orderkey")


@query(
    "kfold_repeated",
    f"""select o_orderkey, cast(ntile(10) over (order by {sql_digest('o_orderkey', 2018)}) - 1 as int) as fold_0,
               cast(ntile(10) over (order by {sql_digest('o_orderkey', 2019)}) - 1 as int) as fold_1 from orders""",
)
def kfold_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return folds.repeated_folds(orders, 10, "o_orderkey", 2, 2018, key=folds.digest_key)


CATEGORIES = ("region_code", "brand", "model", "name", "fuel_type", "body_type", "reg_date", "creat_date")


def _fold_listing(spark: SparkSession, sf_dir: str, features: Sequence[str], k: int) -> DataFrame:
    rows = stored_listing(spark, sf_dir, ["sale_id", "is_train", "price", *features])
    return folds.contiguous_folds(rows, k, F.col("sale_id"), where=F.col("is_train"))


def _sql_labelled(k: int) -> str:
    return f"""lab as (select *, ntile({k}) over (order by sale_id) - 1 as fold from listing where is_train),
               folds as (select distinct fold from lab)"""


def _sql_mean_tables(features: Sequence[str]) -> str:
    """Brute force: for every fold re-aggregate all rows of the other folds."""
    tables = ["prior as (select f.fold, avg(l.price) as p from folds f join lab l on l.fold <> f.fold group by f.fold)"]
    for c in features:
        tables.append(
            f"""s_{c} as (select s.fold, s.{c}, w * p + (1 - w) * m as enc from (
                    select f.fold, l.{c}, avg(l.price) as m, 1 / (1 + exp(cast(count(*) as double) - 2)) as w
                    from folds f join lab l on l.fold <> f.fold where l.{c} is not null group by f.fold, l.{c}) s
                  join prior on prior.fold = s.fold)"""
        )
    return ", ".join(tables)


def _sql_mean_encode(features: Sequence[str], k: int) -> str:
    cells = ", ".join(f"{sql_rounded(f'coalesce(s_{c}.enc, prior.p)', 4)} as {c}_pred" for c in features)
    joins = " ".join(f"left join s_{c} on s_{c}.fold = lab.fold and s_{c}.{c} = lab.{c}" for c in features)
    return on_listing(
        f"select lab.sale_id, {cells} from lab join prior on prior.fold = lab.fold {joins}",
        f"{_sql_labelled(k)}, {_sql_mean_tables(features)}",
    )


def _sql_mean_apply(features: Sequence[str], k: int) -> str:
    cells = ", ".join(f"{sql_rounded(f'avg(coalesce(s_{c}.enc, prior.p))', 4)} as {c}_pred" for c in features)
    joins = " ".join(f"left join s_{c} on s_{c}.fold = prior.fold and s_{c}.{c} = l.{c}" for c in features)
    return on_listing(
        f"select l.sale_id, {cells} from listing l join prior on true {joins} where not l.is_train group by l.sale_id",
        f"{_sql_labelled(k)}, {_sql_mean_tables(features)}",
    )


def _mean_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fold_listing(spark, sf_dir, CATEGORIES, 10)
    return SmoothedMeanEncoder(CATEGORIES, "price", 10).fit(rows).transform(rows)


@query("mean_encode_regression", _sql_mean_encode(CATEGORIES, 10))
def mean_encode_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _mean_encoded(spark, sf_dir).filter("is_train")
    return round_columns(out.select("sale_id", *[f"{c}_pred" for c in CATEGORIES]), 4)


@query("mean_encode_apply", _sql_mean_apply(CATEGORIES, 10))
def mean_encode_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _mean_encoded(spark, sf_dir).filter("not is_train")
    return round_columns(out.select("sale_id", *[f"{c}_pred" for c in CATEGORIES]), 4)


TEXT_CATEGORIES = ("lang", "source")


def _sql_classification(k: int, classes: Sequence[int] = (0, 1), apply: bool = False) -> str:
    cells, joins, tables = [], [], []
    # Applied, every document meets every fold, and the folds are averaged.
    row, mean = ("d", "avg") if apply else ("lab", "")
    fold = "folds" if apply else "lab"
    for v in classes:
        y = f"case when l.quality = {v} then 1.0::double else 0.0::double end"
        tables.append(f"prior_{v} as (select f.fold, avg({y}) as p from folds f join lab l on l.fold <> f.fold group by f.fold)")
        joins.append(f"join prior_{v} on prior_{v}.fold = {fold}.fold")
        for c in TEXT_CATEGORIES:
            name = f"s_{c}_{v}"
            tables.append(
                f"""{name} as (select s.fold, s.{c}, w * p + (1 - w) * m as enc from (
                        select f.fold, l.{c}, avg({y}) as m, 1 / (1 + exp(cast(count(*) as double) - 2)) as w
                        from folds f join lab l on l.fold <> f.fold group by f.fold, l.{c}) s
                      join prior_{v} on prior_{v}.fold = s.fold)"""
            )
            joins.append(f"left join {name} on {name}.fold = {fold}.fold and {name}.{c} = {row}.{c}")
            cells.append(f"{sql_rounded(f'{mean}(coalesce({name}.enc, prior_{v}.p))', 6)} as {c}_pred_{v}")
    return f"""with lab as (select l.doc_id, l.quality, d.lang, d.source,
                        ntile({k}) over (partition by l.quality order by l.doc_id) - 1 as fold
                 from labels l join documents d on d.doc_id = l.doc_id),
               folds as (select distinct fold from lab), {', '.join(tables)}
               select {row}.doc_id, {', '.join(cells)}
               from {'documents d join folds on true' if apply else 'lab'} {' '.join(joins)}
               {'where d.doc_id not in (select doc_id from lab) group by d.doc_id' if apply else ''}"""


# Most classes of a classification target; an encoder makes a column for each.
MOST_CLASSES = 100


def _fit_quality(spark: SparkSession, sf_dir: str):
    """The fitted encoder, the labelled rows, all documents, and the output columns."""
    documents = table(spark, sf_dir, "documents").select("doc_id", *TEXT_CATEGORIES)
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality").join(documents, "doc_id")
    rows = folds.stratified_folds(rows, 5, F.col("doc_id"), "quality")
    classes = [r[0] for r in rows.select("quality").distinct().orderBy("quality").limit(MOST_CLASSES + 1).collect()]
    if len(classes) > MOST_CLASSES:
        raise ValueError(f"the target has more than {MOST_CLASSES} classes")
    encoder = SmoothedMeanEncoder(TEXT_CATEGORIES, "quality", 5, classes=classes).fit(rows)
    return encoder, rows, documents, [f"{c}_pred_{v}" for c in TEXT_CATEGORIES for v in classes]


@query("mean_encode_classification", _sql_classification(5))
def mean_encode_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder, rows, _, names = _fit_quality(spark, sf_dir)
    return round_columns(encoder.transform(rows).select("doc_id", *names), 6)


@query("mean_encode_classification_apply", _sql_classification(5, apply=True))
def mean_encode_classification_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label have no fold, nor a fold column: the mean over folds."""
    encoder, rows, documents, names = _fit_quality(spark, sf_dir)
    unlabelled = documents.join(rows.select("doc_id"), "doc_id", "left_anti")
    return round_columns(encoder.transform(unlabelled).select("doc_id", *names), 6)


TARGET_CATEGORIES = ("region_code", "brand", "model", "body_type", "fuel_type", "kilometer", "name")
_SQL_STATS: Mapping[str, str] = {
    "max": "max", "min": "min", "mean": "avg", "std": "stddev_samp", "median": "median", "sum": "sum",
}
_SUM_PLACES = {"sum": 2}


def _sql_target_tables(features: Sequence[str], stats: Sequence[str]) -> str:
    defaults = ", ".join(f"{_SQL_STATS[s]}(price) as d_{s}" for s in stats)
    tables = [f"defaults as (select {defaults} from lab)"]
    for c in features:
        cells = ", ".join(f"{_SQL_STATS[s]}(l.price) as t_{s}" for s in stats)
        tables.append(
            f"s_{c} as (select f.fold, l.{c}, {cells} from folds f join lab l on l.fold <> f.fold where l.{c} is not null group by f.fold, l.{c})"
        )
    return ", ".join(tables)


def _sql_target_encode(features: Sequence[str], stats: Sequence[str], k: int) -> str:
    cells = ", ".join(
        f"{sql_rounded(f'coalesce(s_{c}.t_{s}, d_{s})', _SUM_PLACES.get(s, 4))} as {c}_target_{s}" for c in features for s in stats
    )
    joins = " ".join(f"left join s_{c} on s_{c}.fold = lab.fold and s_{c}.{c} = lab.{c}" for c in features)
    return on_listing(
        f"select lab.sale_id, {cells} from lab join defaults on true {joins}",
        f"{_sql_labelled(k)}, {_sql_target_tables(features, stats)}",
    )


def _sql_target_apply(features: Sequence[str], stats: Sequence[str], k: int) -> str:
    cells = ", ".join(
        f"{sql_rounded(f'avg(coalesce(s_{c}.t_{s}, d_{s}))', 4)} as {c}_target_{s}" for c in features for s in stats
    )
    joins = " ".join(f"left join s_{c} on s_{c}.fold = folds.fold and s_{c}.{c} = l.{c}" for c in features)
    return on_listing(
        f"""select l.sale_id, {cells} from listing l join folds on true join defaults on true {joins}
            where not l.is_train group by l.sale_id""",
        f"{_sql_labelled(k)}, {_sql_target_tables(features, stats)}",
    )


def _target_encoded(spark, sf_dir, features, stats, labelled: bool) -> DataFrame:
    rows = _fold_listing(spark, sf_dir, features, 10)
    out = FoldTargetEncoder(features, "price", 10, stats=stats).fit(rows).transform(rows)
    names = [f"{c}_target_{s}" for c in features for s in stats]
    out = out.filter("is_train" if labelled else "not is_train").select("sale_id", *names)
    return round_columns(out, {n: _SUM_PLACES.get(n.rsplit("_", 1)[-1], 4) for n in names})


@query("target_encode_oof", _sql_target_encode(TARGET_CATEGORIES, ("max", "min", "mean"), 10))
def target_encode_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_encoded(spark, sf_dir, TARGET_CATEGORIES, ("max", "min", "mean"), True)


@query("target_encode_apply", _sql_target_apply(TARGET_CATEGORIES, ("max", "min", "mean"), 10))
def target_encode_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_encoded(spark, sf_dir, TARGET_CATEGORIES, ("max", "min", "mean"), False)


@query("target_encode_std", _sql_target_encode(("region_code", "model", "name"), ("std", "sum"), 10))
def target_encode_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_encoded(spark, sf_dir, ("region_code", "model", "name"), ("std", "sum"), True)


@query("target_encode_median", _sql_target_encode(("region_code", "brand"), ("median",), 10))
def target_encode_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _target_encoded(spark, sf_dir, ("region_code", "brand"), ("median",), True)
