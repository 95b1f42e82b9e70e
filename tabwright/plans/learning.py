"""Queries: scaling, projection, cross-fitted learners, stacking and scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import scalars as S
from tabwright.operators import folds, learn, matrix, screening, stack
from tabwright.operators.target import FoldTargetEncoder
from tabwright.plans.columns import VECTOR, dated
from tabwright.plans.encoders import sql_digest
from tabwright.plans.registry import on_listing, query, round_columns, rounded, sql_rounded
from tabwright.session import materialize
from tabwright.sources.tables import stored_listing, table

@query(
    "minmax_scale",
    f"""select vec_id, label, pos, {sql_rounded('case when high = low then 0 else (value - low) / (high - low) end', 6)} as scaled
        from (select *, min(value) over (partition by pos) as low, max(value) over (partition by pos) as high
              from (select vec_id, label, cast(pos as int) as pos, cast(list_extract(embedding, pos + 1) as double) as value
                    from (select *, unnest(range(0, len(embedding))) as pos from embeddings) a) b) c""",
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole vectors, an element a row."""
    rows = matrix.minmax_scale_array(table(spark, sf_dir, "embeddings"), "embedding")
    cells = rows.select("vec_id", "label", F.posexplode("embedding").alias("pos", "scaled"))
    return cells.withColumn("scaled", rounded(F.col("scaled"), 6))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.array_as_vector(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "features")


@query("pca_project")
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    projection = matrix.fit_projection(rows, "features", 10)
    return projection.transform(rows).select("vec_id", vector_to_array("components").alias("components"))


@query(
    "pca_row_norms",
    f"""select vec_id, {sql_rounded('sum(power(value - mean, 2))', 6)} as norm from (
          select vec_id, value, avg(value) over (partition by pos) as mean from (
            select vec_id, pos, cast(list_extract(embedding, pos) as double) as value
            from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as pos from embeddings) a) b) c
        group by vec_id""",
)
def pca_row_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With every component kept, the projection preserves each row's distance to the centre."""
    rows = _vectors(spark, sf_dir)
    size = table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    projected = matrix.fit_projection(rows, "features", size).transform(rows)
    squares = F.aggregate(
        vector_to_array("components"), F.lit(0.0), lambda acc, x: acc + x * x
    )
    return projected.select("vec_id", rounded(squares, 6).alias("norm"))


# Base learners on the listing.

NUMERIC_FEATURES = ["power", "kilometer", "acctbal", "days", "brand_code", "model", "gearbox"]
LEARN_FOLDS = 5


def learner_rows(spark: SparkSession, sf_dir: str, gap: float) -> DataFrame:
    """Features, log price and shuffled folds; unlabelled rows have neither label nor fold.

    ``gap`` stands for missing features.
    """
    rows = dated(spark, sf_dir, "is_train", "price", "power", "kilometer", "acctbal", "brand", "model", "gearbox", *VECTOR)
    rows = rows.withColumns(
        {"brand_code": F.substring("brand", 1, 1).cast("int"), "label": S.to_log(F.col("price"))}
    )
    rows = matrix.as_vector(rows, [*NUMERIC_FEATURES, *VECTOR], keep=["sale_id", "is_train", "label"])
    rows = materialize(matrix.fill_gaps(rows, value=gap), "learner")
    return folds.shuffled_folds(rows, LEARN_FOLDS, "sale_id", 2018, where=F.col("is_train"))


def _cross_fitted(spark: SparkSession, sf_dir: str, make, gap: float = learn.MISSING) -> DataFrame:
    rows = learner_rows(spark, sf_dir, gap)
    return learn.cross_fit(rows, make, LEARN_FOLDS).transform(rows)


def _boosted(spark: SparkSession, sf_dir: str, make) -> DataFrame:
    out = _cross_fitted(spark, sf_dir, make)
    return out.select("sale_id", "is_train", S.floor_at_zero(F.col("prediction")).alias("price"))


@query("oof_gbt")
def oof_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boosted(spark, sf_dir, lambda: learn.boosted_trees(metric=stack.log_scale_mae))


@query("oof_gbt_b")
def oof_gbt_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boosted(spark, sf_dir, lambda: learn.boosted_trees_b(metric=stack.log_scale_mae))


# Absolute-loss boosting that SQL can state: two rounds of stumps on features with few values.

STUMP_FEATURES = ["kilometer", "model", "gearbox"]
STUMP_FOLDS = 3
STUMP_ROUNDS = 2
STUMP_STEP = 0.5
STUMP_LEAST = 20


def _sql_stumps() -> str:
    """Median base, best split of the signs, median leaves; the round with the least held-out error is kept."""
    xs = [f"coalesce(cast({c} as double), {learn.MISSING}) as x{i}" for i, c in enumerate(STUMP_FEATURES)]
    places = range(len(STUMP_FEATURES))
    pick = "case f " + " ".join(f"when {i} then x{i}" for i in places) + " end"
    tables = [
        f"""rows_ as (select sale_id, is_train, ln(1 + price) as y, case when is_train then ntile({STUMP_FOLDS}) over (partition by is_train order by sale_id) - 1 end as fold,
                   {', '.join(xs)} from listing)""",
        f"models as (select unnest(range({STUMP_FOLDS})) as m)",
        "base as (select m, median(y) as b from models join rows_ on fold <> m group by m)",
        "z0 as (select r.*, base.m, b as score, coalesce(fold <> base.m, false) as learns from rows_ r, base)",
        "edges as (" + " union all ".join(f"select distinct {i} as f, x{i} as edge from rows_ where is_train and x{i} < (select max(x{i}) from rows_ where is_train)" for i in places) + ")",
    ]
    for r in range(STUMP_ROUNDS):
        tables += [
            f"c{r} as (select m, f, edge, count(*) as n, sum(sign(y - score)) as s, count(*) filter ({pick} <= edge) as nl, coalesce(sum(sign(y - score)) filter ({pick} <= edge), 0) as sl from z{r}, edges where learns group by m, f, edge)",
            f"g{r} as (select *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n as gain from c{r} where nl >= {STUMP_LEAST} and n - nl >= {STUMP_LEAST})",
            f"s{r} as (select m, f, edge from g{r} where gain > 1e-9 qualify row_number() over (partition by m order by gain desc, f, edge) = 1)",
            f"d{r} as (select z.*, {pick} <= edge as side from z{r} z left join s{r} s on s.m = z.m)",
            f"v{r} as (select m, side, median(y - score) as v from d{r} where learns group by m, side)",
            f"z{r + 1} as (select d.sale_id, d.is_train, d.y, d.fold, {', '.join(f'x{i}' for i in places)}, d.m, d.score + {STUMP_STEP} * v.v as score, d.learns from d{r} d join v{r} v on v.m = d.m and v.side is not distinct from d.side)",
        ]
    scores = " union all ".join(f"select {r} as r, m, avg(abs(y - score)) as mae from z{r} where fold = m group by m" for r in range(1, STUMP_ROUNDS + 1))
    every = " union all ".join(f"select {r} as r, sale_id, is_train, fold, m, score from z{r}" for r in range(1, STUMP_ROUNDS + 1))
    tables.append(f"kept as (select m, r from ({scores}) s qualify row_number() over (partition by m order by mae, r) = 1)")
    body = f"""select sale_id, is_train, {sql_rounded('avg(score)', 6)} as prediction
               from ({every}) a join kept on kept.m = a.m and kept.r = a.r where fold is null or fold = a.m group by sale_id, is_train"""
    return on_listing(body, ", ".join(tables))


@query("oof_stumps", _sql_stumps())
def oof_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute-loss boosting whose every number SQL can give: bases, splits, leaf medians, kept rounds."""
    rows = stored_listing(spark, sf_dir, ["sale_id", "is_train", "price", *STUMP_FEATURES])
    rows = matrix.as_vector(rows.withColumn("label", S.to_log(F.col("price"))), STUMP_FEATURES, keep=["sale_id", "is_train", "label"])
    rows = materialize(matrix.fill_gaps(rows, value=learn.MISSING), "stumps")
    rows = folds.contiguous_folds(rows, STUMP_FOLDS, F.col("sale_id"), where=F.col("is_train"))
    make = lambda: learn.boosted_trees(
        depth=1, rounds=STUMP_ROUNDS, patience=STUMP_ROUNDS, step=STUMP_STEP, rows_share=1.0, feature_share=1.0, min_rows=STUMP_LEAST, median_points=1 << 20
    )
    out = learn.cross_fit(rows, make, STUMP_FOLDS).transform(rows)
    return out.select("sale_id", "is_train", rounded(F.col("prediction"), 6).alias("prediction"))


@query(
    "oof_gbt_checks",
    on_listing("select is_train, count(*) as n, count(distinct sale_id) as sales, 0::bigint as negative, count(*) as finite from listing group by is_train"),
)
def oof_gbt_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any booster: one finite prediction per sale, none of them negative."""
    price = F.col("price")
    return (
        oof_gbt(spark, sf_dir)
        .groupBy("is_train")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("sale_id").alias("sales"),
            F.count(F.when(price < 0, 1)).alias("negative"),
            F.count(F.when(price.isNotNull() & ~F.isnan(price) & (price < float("inf")), 1)).alias("finite"),
        )
    )


@query("cross_fit_linear")
def cross_fit_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _cross_fitted(spark, sf_dir, learn.absolute_linear, gap=0.0)
    return out.select("sale_id", "is_train", F.col("prediction").alias("price"))


LEVEL_FEATURES = ["kilometer", "gearbox"]


@query(
    "absolute_by_level",
    on_listing(
        f"""select m as fold, {sql_rounded('avg(abs(y - middle))', 3)} as objective
            from (select m, y, median(y) over (partition by m, kilometer, gearbox) as middle
                  from (select unnest(range({STUMP_FOLDS})) as m) f,
                       (select ln(1 + price) as y, kilometer, gearbox, ntile({STUMP_FOLDS}) over (order by sale_id) - 1 as fold
                        from listing where is_train) l
                  where fold <> m) x group by m"""
    ),
)
def absolute_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least absolute error per fold on indicators of all combinations of two features.

    With an indicator per combination the best line goes through their medians, so SQL can say what
    the fit must reach.
    """
    rows = stored_listing(spark, sf_dir, ["sale_id", "is_train", "price", *LEVEL_FEATURES])
    rows = rows.filter("is_train").withColumn("label", S.to_log(F.col("price")))
    level = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in LEVEL_FEATURES])
    rows = materialize(rows.select("sale_id", "label", level.alias("level")), "levels")
    # A dozen levels of a feature with few values.
    levels = sorted(r[0] for r in rows.select("level").distinct().collect())
    flags = {f"level_{i}": F.when(F.col("level") == name, 1.0).otherwise(0.0) for i, name in enumerate(levels)}
    rows = matrix.as_vector(rows.withColumns(flags), list(flags), keep=["sale_id", "label"])
    rows = folds.contiguous_folds(rows, STUMP_FOLDS, F.col("sale_id"))
    fitted = learn.cross_fit(rows, learn.absolute_linear, STUMP_FOLDS)
    found = [(i, model.objective) for i, model in enumerate(fitted.models)]
    return spark.createDataFrame(found, "fold long, objective double").select("fold", rounded(F.col("objective"), 3).alias("objective"))


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances averaged over the fold models, each stopped on its held-out fold."""
    rows = learner_rows(spark, sf_dir, learn.MISSING)
    models = learn.cross_fit(rows, learn.boosted_trees, LEARN_FOLDS)
    return learn.feature_importance(models, [*NUMERIC_FEATURES, *VECTOR], rows)


@query(
    "feature_importance_checks",
    f"select {len(NUMERIC_FEATURES) + len(VECTOR)}::bigint as features, 1.0::double as total, 1 as first, {len(NUMERIC_FEATURES) + len(VECTOR)} as last, true as falling",
)
def feature_importance_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances add up to 1 and fall with the rank."""
    out = feature_importance(spark, sf_dir)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "importance")))["importance"]
    return out.agg(
        F.count(F.lit(1)).alias("features"),
        rounded(F.sum("importance"), 6).alias("total"),
        F.min("rank").alias("first"),
        F.max("rank").alias("last"),
        (F.sort_array(ranked, asc=False) == ranked).alias("falling"),
    )


SCREENED = ["kilometer", "power", "model", "gearbox", "acctbal", *VECTOR[:4]]


@query(
    "feature_screening",
    on_listing(
        "with x as (select ln(1 + power) + 0.5 * gearbox as label, * from listing where is_train) "
        + "\nunion all\n".join(
            f"select '{c}' as feature, coalesce(power(corr(label, cast({c} as double)), 2) > 0.01, false) as kept from x" for c in SCREENED
        )
    ).replace("\nwith x as", ", x as", 1),
)
def feature_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which features stay for a label made of two of them and what goes with them; SQL judges by correlation."""
    rows = dated(spark, sf_dir, "is_train", *SCREENED)
    label = F.log(F.lit(1.0) + F.col("power")) + 0.5 * F.col("gearbox")
    rows = matrix.as_vector(rows.withColumn("label", label), SCREENED, keep=["sale_id", "is_train", "label"])
    rows = materialize(matrix.fill_gaps(rows.filter("is_train and label is not null"), value=learn.MISSING), "screening")
    rows = folds.contiguous_folds(rows, STUMP_FOLDS, F.col("sale_id"))
    make = lambda: learn.boosted_trees(depth=3, step=0.5, rounds=8, feature_share=1.0)
    kept = screening.screen(rows, make, STUMP_FOLDS, SCREENED).names
    return spark.createDataFrame([(c, c in kept) for c in SCREENED], "feature string, kept boolean")


# Stacking. The base predictions are out-of-fold means, which SQL can state exactly.

STACK_KEYS = {"pred_a": "region_code", "pred_b": "model"}
STACK_FOLDS = 5
PENALTY = 3.0


def base_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sale_id, is_train, label, fold, pred_a, pred_b)`` in log scale."""
    rows = stored_listing(spark, sf_dir, ["sale_id", "is_train", "price", *STACK_KEYS.values()])
    rows = rows.withColumn("label", S.to_log(F.col("price")))
    rows = folds.contiguous_folds(rows, STACK_FOLDS, F.col("sale_id"), where=F.col("is_train"))
    encoder = FoldTargetEncoder(list(STACK_KEYS.values()), "label", STACK_FOLDS, stats=["mean"])
    out = encoder.fit(rows).transform(rows)
    predictions = [F.col(f"{key}_target_mean").alias(name) for name, key in STACK_KEYS.items()]
    # Cut points, repeats and the final projection all read these.
    return materialize(out.select("sale_id", "is_train", "price", "label", "fold", *predictions), "base_predictions")


def _sql_base() -> str:
    tables = [
        f"lab as (select *, ln(1 + price) as label, ntile({STACK_FOLDS}) over (order by sale_id) - 1 as fold from listing where is_train)",
        "folds as (select distinct fold from lab)",
        "whole as (select avg(label) as d from lab)",
    ]
    joins, oof, mean = [], [], []
    for name, key in STACK_KEYS.items():
        tables.append(
            f"t_{key} as (select f.fold, l.{key}, avg(l.label) as m from folds f join lab l on l.fold <> f.fold where l.{key} is not null group by f.fold, l.{key})"
        )
        oof.append(f"coalesce(t_{key}.m, whole.d) as {name}")
        mean.append(f"avg(coalesce(t_{key}.m, whole.d)) as {name}")
    joins = {
        side: " ".join(f"left join t_{k} on t_{k}.fold = {side}.fold and t_{k}.{k} = {row}.{k}" for k in STACK_KEYS.values())
        for side, row in (("lab", "lab"), ("folds", "l"))
    }
    tables.append(
        f"""base as (
            select lab.sale_id, true as is_train, lab.price, lab.label, lab.fold, {', '.join(oof)}
            from lab join whole on true {joins['lab']}
            union all
            select l.sale_id, false, null, null, null, {', '.join(mean)}
            from listing l join folds on true join whole on true {joins['folds']} where not l.is_train group by l.sale_id)"""
    )
    return ", ".join(tables)


@query(
    "stack_inputs",
    on_listing(f"select sale_id, {sql_rounded('pred_a', 6)} as pred_a, {sql_rounded('pred_b', 6)} as pred_b from base", _sql_base()),
)
def stack_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_predictions(spark, sf_dir)
    sides = {name: rows.select("sale_id", F.col(name).alias("price")) for name in STACK_KEYS}
    return round_columns(stack.stack_inputs("sale_id", sides), 6)


STACK_REPEATS = 2
STACK_SEED = 2018


def _sql_bayesian() -> str:
    """The evidence iteration in SQL: closed 2 x 2 forms, one recursion over all fits."""
    folded = ", ".join(
        f"case when is_train then ntile(10) over (partition by is_train order by {sql_digest('sale_id', STACK_SEED + r)}) - 1 end as fold_{r}"
        for r in range(STACK_REPEATS)
    )
    fits = " union all ".join(
        f"""select {r} as r, f.fold, count(*) as n, avg(pred_a) as ma, avg(pred_b) as mb, avg(label) as my,
                   covar_pop(pred_a, pred_a) * count(*) as aa, covar_pop(pred_a, pred_b) * count(*) as ab,
                   covar_pop(pred_b, pred_b) * count(*) as bb, covar_pop(pred_a, label) * count(*) as ay,
                   covar_pop(pred_b, label) * count(*) as by_, covar_pop(label, label) * count(*) as yy
            from range(10) f(fold) join folded d on d.fold_{r} <> f.fold where d.is_train group by f.fold"""
        for r in range(STACK_REPEATS)
    )

    def weight(b1: str, s22: str, b2: str) -> str:
        ratio = "(weight / noise)"
        return f"(({b1} * ({s22} + {ratio}) - ab * {b2}) / ((aa + {ratio}) * (bb + {ratio}) - ab * ab))"

    prior = stack.GAMMA_PRIOR
    # effective = 2 - weight * trace of the inverse of (noise * S + weight * I)
    trace = """((noise * aa + weight + noise * bb + weight)
                / ((noise * aa + weight) * (noise * bb + weight) - noise * ab * noise * ab))"""
    extra = f"""
        {_sql_base()},
        folded as (select *, {folded} from base),
        grams as ({fits}),
        steps as (
          select *, 0 as step, 1 / (yy / n + 2.220446049250313e-16) as noise, 1.0::double as weight,
                 null::double as wa, null::double as wb, false as done from grams
          union all
          select r, fold, n, ma, mb, my, aa, ab, bb, ay, by_, yy, step + 1,
                 (n - effective + {2 * prior}) / (greatest(yy - 2 * (na * ay + nb * by_) + na * na * aa + 2 * na * nb * ab + nb * nb * bb, 0) + {2 * prior}),
                 (effective + {2 * prior}) / (na * na + nb * nb + {2 * prior}),
                 na, nb, coalesce(abs(na - wa) + abs(nb - wb) < {stack.TOLERANCE}, false)
          from (select *, 2 - weight * {trace} as effective,
                       {weight('ay', 'bb', 'by_')} as na, {weight('by_', 'aa', 'ay')} as nb from steps) s
          where not done and step < {stack.MOST_ROUNDS}),
        settled as (
          select r, fold, ma, mb, my, {weight('ay', 'bb', 'by_')} as wa, {weight('by_', 'aa', 'ay')} as wb
          from (select *, row_number() over (partition by r, fold order by step desc) as place from steps) s where place = 1)"""
    predicted = "my + wa * (pred_a - ma) + wb * (pred_b - mb)"
    last = STACK_REPEATS - 1
    body = f"""select sale_id, is_train, {sql_rounded(predicted, 6)} as stacked
               from folded d join settled s on s.r = {last} and s.fold = d.fold_{last} where is_train
               union all
               select sale_id, is_train, {sql_rounded(f'avg({predicted})', 6)} as stacked
               from folded d join settled s on true where not is_train group by sale_id, is_train"""
    return on_listing(body, extra).replace("with listing", "with recursive listing", 1)


@query("stack_ridge", _sql_bayesian())
def stack_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bayesian ridge over ten folds drawn twice."""
    rows = base_predictions(spark, sf_dir).drop("fold")
    rows = folds.repeated_folds(
        rows, 10, "sale_id", STACK_REPEATS, STACK_SEED, F.col("is_train"), key=folds.digest_key
    )
    fitted = stack.fit_stack(rows, list(STACK_KEYS), "label", [f"fold_{r}" for r in range(STACK_REPEATS)])
    return fitted.transform(rows).select("sale_id", "is_train", rounded(F.col("stacked"), 6).alias("stacked"))


def _sql_fixed_ridge() -> str:
    """Two-input ridge written out: solve (S + penalty I) w = b per held-out fold."""
    moments = """grams as (select f.fold, avg(pred_a) as ma, avg(pred_b) as mb, avg(label) as my,
                   covar_pop(pred_a, pred_a) * count(*) as aa, covar_pop(pred_a, pred_b) * count(*) as ab,
                   covar_pop(pred_b, pred_b) * count(*) as bb, covar_pop(pred_a, label) * count(*) as ay,
                   covar_pop(pred_b, label) * count(*) as by_
                   from folds f join base b on b.fold <> f.fold where b.is_train group by f.fold)"""
    det = f"((aa + {PENALTY}) * (bb + {PENALTY}) - ab * ab)"
    solved = f"""fits as (select fold, wa, wb, my - wa * ma - wb * mb as w0 from (
                   select *, ((bb + {PENALTY}) * ay - ab * by_) / {det} as wa,
                          ((aa + {PENALTY}) * by_ - ab * ay) / {det} as wb from grams) g)"""
    predicted = "w0 + wa * pred_a + wb * pred_b"
    body = f"""select sale_id, {sql_rounded(predicted, 6)} as stacked from base join fits on fits.fold = base.fold where is_train
               union all
               select sale_id, {sql_rounded(f'avg({predicted})', 6)} as stacked from base join fits on true where not is_train group by sale_id"""
    return on_listing(body, f"{_sql_base()}, {moments}, {solved}")


@query("stack_ridge_fixed", _sql_fixed_ridge())
def stack_ridge_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_predictions(spark, sf_dir)
    fitted = stack.fit_stack(rows, list(STACK_KEYS), "label", ["fold"], stack.fixed_ridge(PENALTY))
    return fitted.transform(rows).select("sale_id", rounded(F.col("stacked"), 6).alias("stacked"))


@query(
    "blend_mean",
    on_listing(
        f"""select sale_id, {sql_rounded('((exp(pred_a) - 1) + (exp(pred_b) - 1)) / 2', 3)} as even,
                   {sql_rounded('(3 * (exp(pred_a) - 1) + (exp(pred_b) - 1)) / 4', 3)} as weighted from base""",
        _sql_base(),
    ),
)
def blend_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = S.from_log(F.col("pred_a")), S.from_log(F.col("pred_b"))
    return base_predictions(spark, sf_dir).select(
        "sale_id",
        rounded(stack.blend([a, b]), 3).alias("even"),
        rounded(stack.blend([a, b], [3, 1]), 3).alias("weighted"),
    )


@query(
    "mae_original_scale",
    on_listing(
        f"""select {sql_rounded('avg(abs((exp(label) - 1) - (exp(pred_a) - 1)))', 3)} as mae_a,
                   {sql_rounded('avg(abs((exp(label) - 1) - (exp(pred_b) - 1)))', 3)} as mae_b from base where is_train""",
        _sql_base(),
    ),
)
def mae_original_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base_predictions(spark, sf_dir).filter("is_train")
    label = F.col("label")
    return rows.agg(
        rounded(stack.log_scale_mae(label, F.col("pred_a")), 3).alias("mae_a"),
        rounded(stack.log_scale_mae(label, F.col("pred_b")), 3).alias("mae_b"),
    )


@query(
    "stage_scores",
    on_listing(
        "\nunion all\n".join(
            f"select '{stage}' as stage, {sql_rounded(f'avg(abs(price - ({e})))', 3)} as mae from base where is_train"
            for stage, e in (
                ("a", "exp(pred_a) - 1"),
                ("b", "exp(pred_b) - 1"),
                ("blend", "((exp(pred_a) - 1) + (exp(pred_b) - 1)) / 2"),
            )
        ),
        _sql_base(),
    ),
)
def stage_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = S.from_log(F.col("pred_a")), S.from_log(F.col("pred_b"))
    rows = base_predictions(spark, sf_dir)
    scores = stack.stage_scores(rows, F.col("price"), {"a": a, "b": b, "blend": stack.blend([a, b])})
    return round_columns(scores, 3)


@query(
    "stage_scores_own_metric",
    on_listing(
        "\nunion all\n".join(
            f"select '{stage}' as stage, {sql_rounded(f'sqrt(avg(power(price - ({e}), 2)))', 3)} as mae from base where is_train"
            for stage, e in (("a", "exp(pred_a) - 1"), ("b", "exp(pred_b) - 1"))
        ),
        _sql_base(),
    ),
)
def stage_scores_own_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric of the caller's own: the root of the mean squared error in the price's scale."""
    rows = base_predictions(spark, sf_dir)
    stages = {"a": S.from_log(F.col("pred_a")), "b": S.from_log(F.col("pred_b"))}
    return round_columns(stack.stage_scores(rows, F.col("price"), stages, lambda y, p: F.sqrt(F.avg(F.pow(y - p, F.lit(2.0))))), 3)
