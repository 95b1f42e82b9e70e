"""Cross-fitted encodings of categories by a target.

Both encoders learn one table ``(feature, level, ...)``. A single pass leaves, per
level, one partial per fold; everything a held-out fold may see is then a fold over
the other k - 1 partials, so rows are read once, not once per fold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.scalars import WeightHook, weight_hook
from tabwright.operators import sketches
from tabwright.operators.complement import medians_outside
from tabwright.operators.folds import fold_of
from tabwright.operators.levels import KeyFacts, facts_of, unpivot_levels, unused
from tabwright.operators.lookup import lookup_level
from tabwright.operators.profile import global_profile
from tabwright.session import materialize

def _partials(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``rows`` grouped by ``keys`` and fold, then one array of fold partials per group.

    The second grouping only sees k small rows per group, however large the group.
    """
    per_fold = rows.groupBy(*keys, "fold").agg(*aggs)
    part = F.struct(*[c for c in per_fold.columns if c not in keys])
    return per_fold.groupBy(*keys).agg(F.collect_list(part).alias("parts"))


def _others(fold: Column) -> Column:
    return F.filter("parts", lambda p: p["fold"] != fold)


def _sum_of(parts: Column, value) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + F.coalesce(value(p).cast("double"), F.lit(0.0)))


def _per_fold(k: int, value) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), value)


class SmoothedMeanEncoder(Estimator):
    """Mean of the target per level, shrunk to the fold prior, cross-fitted over ``k`` folds.

    ``classes`` switches to classification: one column per feature and class, the
    target being the class indicator. ``weight`` is ``{"k": .., "f": ..}`` or a
    function of the count column.
    """

    def __init__(
        self,
        features: Sequence[str],
        target: str,
        k: int,
        fold: str = "fold",
        classes: Sequence | None = None,
        weight: dict | WeightHook | None = None,
    ):
        super().__init__()
        self.features = list(features)
        self.target = target
        self.k = k
        self.fold = fold
        self.classes = None if classes is None else list(classes)
        self.weight = weight_hook(weight)

    def _outputs(self) -> dict[str, Column]:
        y = F.col(self.target)
        if self.classes is None:
            return {"pred": y.cast("double")}
        return {f"pred_{c}": F.when(y == F.lit(c), 1.0).otherwise(0.0) for c in self.classes}

    def _fit(self, dataset: DataFrame) -> "MeanEncoding":
        outputs = self._outputs()
        places = {name: f"y{i}" for i, name in enumerate(outputs)}
        ys = list(places.values())
        # Features may have these names themselves.
        own = {c: unused(self.features, f"_{c}") for c in ("fold", *ys)}
        labelled = dataset.filter(F.col(self.fold).isNotNull()).select(
            *self.features,
            F.col(self.fold).cast("int").alias(own["fold"]),
            *[y.alias(own[places[name]]) for name, y in outputs.items()],
        )
        aggs = [F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(y) for y in ys]]

        bare = labelled.select(*[F.col(c).alias(name) for name, c in own.items()])
        fold_sums = {r["fold"]: r for r in bare.groupBy("fold").agg(*aggs).collect()}
        priors = {
            name: [_prior(fold_sums, y, f) for f in range(self.k)] for name, y in places.items()
        }

        long = unpivot_levels(labelled, self.features, carry=list(own.values()))
        long = long.withColumnsRenamed({c: name for name, c in own.items()})
        parts = _partials(long, ["feature", "level"], aggs)
        encoded = parts.select(
            "feature",
            "level",
            _sum_of(F.col("parts"), lambda p: p["n"]).cast("long").alias("n"),
            *[
                _per_fold(self.k, self._encode(y, priors[name])).alias(name)
                for name, y in places.items()
            ],
        )
        return MeanEncoding(self.features, self.fold, self.k, priors, materialize(encoded, "means"))

    def _encode(self, y: str, priors: Sequence[float]):
        prior_of = F.array(*[F.lit(p).cast("double") for p in priors])

        def encode(f: Column) -> Column:
            n = _sum_of(_others(f), lambda p: p["n"])
            s = _sum_of(_others(f), lambda p: p[y])
            prior = F.element_at(prior_of, f + 1)
            w = self.weight(n)
            return F.when(n > 0, w * prior + (F.lit(1.0) - w) * (s / n)).otherwise(prior)

        return encode


def _prior(fold_sums: Mapping, y: str, held_out: int) -> float | None:
    n = sum(r["n"] for f, r in fold_sums.items() if f != held_out)
    return sum(r[y] for f, r in fold_sums.items() if f != held_out) / n if n else None


class MeanEncoding(Model):
    """Learned table ``(feature, level, n, <output> array over folds)`` with the fold priors."""

    def __init__(self, features, fold, k, priors, table: DataFrame):
        super().__init__()
        self.features, self.fold, self.k, self.priors, self.table = features, fold, k, priors, table

    @cached_property
    def facts(self) -> dict[str, KeyFacts]:
        return facts_of(self.table)

    def save(self, path: str) -> None:
        self.table.write.parquet(f"{path}/table")
        rows = [(name, self.fold, self.features, [None if p is None else float(p) for p in ps]) for name, ps in self.priors.items()]
        schema = "output string, fold string, features array<string>, priors array<double>"
        self.table.sparkSession.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/priors")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "MeanEncoding":
        rows = spark.read.parquet(f"{path}/priors").collect()
        priors = {r["output"]: r["priors"] for r in rows}
        k = len(rows[0]["priors"])
        return cls(rows[0]["features"], rows[0]["fold"], k, priors, spark.read.parquet(f"{path}/table"))

    def level_table(self, feature: str) -> DataFrame:
        """``(level, <feature>_<output> ...)`` with one array over folds per output."""
        own = self.table.filter(F.col("feature") == feature)
        return own.select("level", *self.level_columns(feature))

    def level_columns(self, feature: str) -> list[Column]:
        return [F.col(n).alias(f"{feature}_{n}") for n in self.priors]

    def finish(self, joined: DataFrame, feature: str) -> DataFrame:
        """Replace the looked-up arrays: rows with a fold get that fold's encoding, all
        others the mean over folds, and unseen levels the priors."""
        return joined.withColumns(self.values(feature, F.col, fold_of(joined, self.fold)))

    def values(self, feature: str, at: Callable[[str], Column], fold: Column) -> dict[str, Column]:
        """What ``finish`` puts in the place of the arrays that ``at`` finds by name."""
        return {f"{feature}_{n}": self._value(at(f"{feature}_{n}"), p, fold + 1) for n, p in self.priors.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for feature in self.features:
            facts = self.facts.get(feature, KeyFacts(0, 0))
            out = lookup_level(out, self.level_table(feature), feature, facts, dataset.columns)
            out = self.finish(out, feature)
        return out

    def _value(self, per_fold: Column, priors: Sequence[float], f: Column) -> Column:
        prior_of = F.array(*[F.lit(p).cast("double") for p in priors])
        known = F.coalesce(per_fold, prior_of)
        mean = F.aggregate(known, F.lit(0.0), lambda acc, v: acc + v) / F.lit(float(self.k))
        return F.when(f.isNotNull(), F.element_at(known, f)).otherwise(mean)


TARGET_STATS = ("max", "min", "mean")


def _target_stat(stat: str, parts: Column) -> Column:
    """One statistic of a group from the partials of some of its folds."""
    n = _sum_of(parts, lambda p: p["n"])
    mean = F.try_divide(_sum_of(parts, lambda p: p["s"]), n)
    if stat == "max":
        return F.array_max(F.transform(parts, lambda p: p["high"]))
    if stat == "min":
        return F.array_min(F.transform(parts, lambda p: p["low"]))
    if stat == "sum":
        return F.when(n > 0, _sum_of(parts, lambda p: p["s"]))
    if stat == "mean":
        return mean
    if stat == "std":
        # Spread inside the folds plus spread of the fold means around the joint mean.
        squares = _sum_of(
            parts, lambda p: p["m2"] + p["n"] * F.pow(F.try_divide(p["s"], p["n"]) - mean, F.lit(2.0))
        )
        return F.when(n > 1, F.sqrt(F.try_divide(squares, n - 1)))
    raise ValueError(f"no partial form of {stat!r}")


class FoldTargetEncoder(Estimator):
    """Out-of-fold statistics of the target per level, global statistic where unseen.

    ``median`` has no partial form. It is found by counts per slice of the values and fold, all
    less own, so the medians of all folds come from one reading (``complement``). With
    ``approx`` it comes from sketches per level and fold (``sketches``, which state their error).
    """

    def __init__(
        self,
        features: Sequence[str],
        target: str,
        k: int,
        fold: str = "fold",
        stats: Sequence[str] = TARGET_STATS,
        approx: bool = False,
    ):
        super().__init__()
        self.features, self.target, self.k, self.approx = list(features), target, k, approx
        self.fold, self.stats = fold, list(stats)

    def _fit(self, dataset: DataFrame) -> "TargetEncoding":
        # Features may have these names themselves.
        own = {c: unused(self.features, f"_{c}") for c in ("fold", "y")}
        labelled = dataset.filter(F.col(self.fold).isNotNull()).select(
            *self.features,
            F.col(self.fold).cast("int").alias(own["fold"]),
            F.col(self.target).cast("double").alias(own["y"]),
        )
        defaults = self._defaults(labelled.select(F.col(own["y"]).alias("y")))
        long = unpivot_levels(labelled, self.features, carry=list(own.values()))
        long = long.withColumnsRenamed({c: name for name, c in own.items()})
        aggs = [
            F.count("y").alias("n"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("y").alias("s"),
            (F.var_pop("y") * F.count("y")).alias("m2"),
            F.max("y").alias("high"),
            F.min("y").alias("low"),
        ]
        parts = _partials(long, ["feature", "level"], aggs)
        partial_stats = [s for s in self.stats if s != "median"]
        table = parts.select(
            "feature",
            "level",
            _sum_of(F.col("parts"), lambda p: p["rows"]).cast("long").alias("n"),
            *[
                _per_fold(self.k, self._statistic(s, defaults[s])).alias(s)
                for s in partial_stats
            ],
        )
        if "median" in self.stats:
            table = table.join(self._medians(long, defaults["median"]), ["feature", "level"], "left")
        return TargetEncoding(
            self.features, self.fold, self.k, self.stats, defaults, materialize(table, "targets")
        )

    @staticmethod
    def _statistic(stat: str, default: float):
        return lambda f: F.coalesce(_target_stat(stat, _others(f)), F.lit(default))

    def _defaults(self, labelled: DataFrame) -> dict[str, float]:
        row = global_profile(labelled, "y", self.stats).first()
        return {s: float(row[f"y_{s}"]) for s in self.stats}

    def _medians(self, long: DataFrame, default: float) -> DataFrame:
        outside = sketches.medians_outside if self.approx else medians_outside
        found = outside(long, ["feature", "level"], "y", "fold", self.k)
        return found.select("feature", "level", F.transform("medians", lambda m: F.coalesce(m, F.lit(default))).alias("median"))


class TargetEncoding(Model):
    """Learned table ``(feature, level, n, <stat> array over folds)`` with global defaults."""

    def __init__(self, features, fold, k, stats, defaults, table: DataFrame):
        super().__init__()
        self.features, self.fold, self.k = features, fold, k
        self.stats, self.defaults, self.table = list(stats), defaults, table

    @cached_property
    def facts(self) -> dict[str, KeyFacts]:
        return facts_of(self.table)

    def save(self, path: str) -> None:
        self.table.write.parquet(f"{path}/table")
        rows = [(s, self.fold, self.k, self.features, float(self.defaults[s])) for s in self.stats]
        schema = "stat string, fold string, k int, features array<string>, value double"
        self.table.sparkSession.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/defaults")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TargetEncoding":
        rows = spark.read.parquet(f"{path}/defaults").collect()
        defaults = {r["stat"]: r["value"] for r in rows}
        first = rows[0]
        table = spark.read.parquet(f"{path}/table")
        return cls(first["features"], first["fold"], first["k"], list(defaults), defaults, table)

    def level_table(self, feature: str) -> DataFrame:
        """``(level, <feature>_target_<stat> ...)`` with one array over folds per statistic."""
        own = self.table.filter(F.col("feature") == feature)
        return own.select("level", *self.level_columns(feature))

    def level_columns(self, feature: str) -> list[Column]:
        return [F.col(s).alias(f"{feature}_target_{s}") for s in self.stats]

    def finish(self, joined: DataFrame, feature: str) -> DataFrame:
        """Replace the looked-up arrays as the mean encoding does; unseen levels get the default."""
        return joined.withColumns(self.values(feature, F.col, fold_of(joined, self.fold)))

    def values(self, feature: str, at: Callable[[str], Column], fold: Column) -> dict[str, Column]:
        """What ``finish`` puts in the place of the arrays that ``at`` finds by name."""
        names = {s: f"{feature}_target_{s}" for s in self.stats}
        return {v: self._value(at(v), self.defaults[s], fold + 1) for s, v in names.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for feature in self.features:
            facts = self.facts.get(feature, KeyFacts(0, 0))
            out = lookup_level(out, self.level_table(feature), feature, facts, dataset.columns)
            out = self.finish(out, feature)
        return out

    def _value(self, per_fold: Column, default: float, f: Column) -> Column:
        mean = F.aggregate(per_fold, F.lit(0.0), lambda acc, v: acc + v) / F.lit(float(self.k))
        return F.coalesce(F.when(f.isNotNull(), F.element_at(per_fold, f)).otherwise(mean), F.lit(default))
