"""Models on the panel: AR(1), trees, ridge, selection and roll-forward forecasts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, shared_dir
from .aggregates import class_balance, impute_mean, time_split
from .calendar import next_sessions
from .forests import _binomial_tail, random_blocks, shadow_gains
from .windows import price_path, shrink_clip, weekday_cycle

# Calendar columns and suffixes of the exogenous choice.
CALENDAR_FEATURES = ("sin_dow", "cos_dow", "sin_mp", "cos_mp")
EXOG_SUFFIXES = ("_lag1", "_chg_21d", "_chg_63d")


def ar1_fit(df: DataFrame, r: str = "r", key: str = "company_id", order: str = "date") -> DataFrame:
    """Least-squares AR(1) of each key: phi, intercept, residual sd, row count."""
    lagged = df.withColumn("_x", F.lag(r).over(Window.partitionBy(key).orderBy(order)))
    pairs = lagged.where(F.col(r).isNotNull() & F.col("_x").isNotNull())
    y, x = F.col(r), F.col("_x")
    fit = pairs.groupBy(key).agg(
        F.regr_slope(y, x).alias("phi"), F.regr_intercept(y, x).alias("intercept"),
        F.count(F.lit(1)).alias("n"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"))
    rss = F.greatest(F.col("_syy") - F.col("phi") * F.col("_sxy"), F.lit(0.0))
    return fit.select(key, "phi", "intercept", "n",
                      F.sqrt(rss / F.nullif(F.col("n") - 2, F.lit(0))).alias("sigma"))


def ar1_steps(df: DataFrame, n: int, r: str = "r", close: str = "close", key: str = "company_id",
              order: str = "date") -> DataFrame:
    """Step-by-step AR(1) return forecast of each key in closed form.

    r_k = mu + phi^k (r_last - mu), so every step is a column expression.
    """
    fit = ar1_fit(df, r, key, order)
    last = df.groupBy(key).agg(F.max_by(F.struct(r, close, order), order).alias("_l"))
    base = fit.join(last, key).select(
        key, "phi", "intercept", "sigma", F.col(f"_l.{r}").alias("_r"),
        F.col(f"_l.{close}").alias("last_price"), F.col(f"_l.{order}").alias("last_date"))
    mu = F.col("intercept") / F.nullif(1.0 - F.col("phi"), F.lit(0.0))
    steps = base.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    k, phi = F.col("step").cast("double"), F.col("phi")
    var = (1.0 - F.pow(phi, 2 * k)) / F.nullif(1.0 - phi * phi, F.lit(0.0))
    return steps.select(key, "last_price", "last_date", "step",
                        (mu + F.pow(phi, k) * (F.col("_r") - mu)).alias("r_pred"),
                        (F.col("sigma") * F.sqrt(var)).alias("r_sd"))


def with_price(steps: DataFrame, key: str = "company_id", bias: float = 0.0, shrink: float = 1.0,
               clip: tuple | None = None) -> DataFrame:
    """Correct the predicted returns and compound them to a price path."""
    w = Window.partitionBy(key).orderBy("step")
    out = steps.withColumn("r_pred", shrink_clip(F.col("r_pred"), bias, shrink, clip))
    return out.withColumn("forecast", price_path(F.col("last_price"), F.col("r_pred"), w))


def ar1_forecast(df: DataFrame, n: int = 30, calendar: DataFrame | None = None, bias: float = 0.0,
                 shrink: float = 1.0, clip: tuple | None = None, key: str = "company_id") -> DataFrame:
    """Price forecast for the next n sessions of each key."""
    steps = with_price(ar1_steps(df, n, key=key), key, bias, shrink, clip)
    last = df.groupBy(key).agg(F.max("date").alias("last_date"))
    dates = next_sessions(last, n, calendar).select(key, "step", "date")
    return steps.join(dates, [key, "step"]).select(key, "step", "date", "r_pred", "forecast")


def ar1_interval(df: DataFrame, companies: DataFrame, n: int = 14, z: float = 1.96) -> DataFrame:
    """Return forecast with a symmetric 95 % interval, labelled by ticker and step."""
    steps = ar1_steps(df, n)
    names = companies.select(F.col("id").alias("company_id"), F.col("ticker").alias("company_ticker"))
    return steps.join(names, "company_id").select(
        "company_ticker", F.date_add("last_date", 1).alias("forecast_start_date"),
        F.col("step").alias("forecast_step"), F.col("r_pred").alias("predicted"),
        (F.col("r_pred") - z * F.col("r_sd")).alias("lower"),
        (F.col("r_pred") + z * F.col("r_sd")).alias("upper"))


def exog_columns(columns: Sequence[str]) -> list[str]:
    """Calendar columns and lagged or changed measures, in input order."""
    return [c for c in columns if c in CALENDAR_FEATURES or c.endswith(EXOG_SUFFIXES)]


def exog_future(df: DataFrame, n: int, calendar: DataFrame | None = None, key: str = "company_id",
                order: str = "date", phase: DataFrame | None = None) -> DataFrame:
    """Exogenous columns for the next n sessions: last values frozen, calendar refreshed."""
    cols = [c for c in exog_columns(df.columns) if c not in CALENDAR_FEATURES]
    last = df.groupBy(key).agg(F.max(order).alias("last_date"), *[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols])
    out = next_sessions(last, n, calendar)
    s, c = weekday_cycle("date")
    out = out.select(key, "step", "date", *cols, s.alias("sin_dow"), c.alias("cos_dow"))
    if phase is not None:
        angle = F.lit(2 * math.pi) * F.col("phase")
        out = (out.join(F.broadcast(phase), "date", "left")
               .withColumn("sin_mp", F.sin(angle)).withColumn("cos_mp", F.cos(angle)).drop("phase"))
    return out


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(features))


def _grown(df: DataFrame, assembler: VectorAssembler, gbt: GBTRegressor | GBTClassifier) -> PipelineModel:
    """Trees on rows assembled and stored once: MLlib goes through them for its counts, its cuts, training and validation."""
    named = [gbt.getLabelCol(), *(gbt.getOrDefault(p) for p in ("weightCol", "validationIndicatorCol") if gbt.isDefined(p))]
    rows = assembler.transform(df).select(assembler.getOutputCol(), *dict.fromkeys(named))
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # without it the lineage grows with the trees
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return PipelineModel([assembler, gbt.fit(reliable_checkpoint(rows, "vectors"))])


def fit_gbt(df: DataFrame, features: Sequence[str], label: str, *, max_iter: int = 600, depth: int = 6,
            step: float = 0.05, subsample: float = 0.8, seed: int = 42, weight: str | None = None,
            valid: str | None = None, feature_subset: str = "auto") -> PipelineModel:
    """Boosted regression trees on the whole panel.

    ``valid`` names a boolean column; with it the boosting stops when the
    validation error stops falling, however slowly it falls. ``weight`` names a sample-weight column.
    """
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=depth,
                       stepSize=step, subsamplingRate=subsample, seed=seed,
                       featureSubsetStrategy=feature_subset, validationTol=0.0)
    if weight:
        gbt = gbt.setWeightCol(weight)
    if valid:
        gbt = gbt.setValidationIndicatorCol(valid)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return _grown(_assembled(df, [*features, label]), assembler, gbt)


def purged_parts(df: DataFrame, valid_size: float = 0.2, min_train: int = 200, gap: int = 42, stop_share: float = 0.1,
                 by: str = "date") -> DataFrame:
    """Add ``part``: train, stop, gap or valid.

    The newest share is kept for validation, behind a gap. The newest rows before the gap decide when boosting stops, so
    the part that is reported has no say in it.
    """
    out = time_split(df, valid_size, min_train, gap, by=by)
    cut = F.greatest(F.floor(F.count(F.lit(1)) * (1.0 - valid_size)), F.lit(min_train)) - gap
    first = out.agg(F.floor(cut * (1.0 - stop_share)).alias("c")).select("c").scalar()
    stop = (F.col("part") == "train") & (F.col("position") >= first)
    return out.withColumn("part", F.when(stop, "stop").otherwise(F.col("part")))


def class_weights(df: DataFrame, label: str, part: str = "part", balance: bool = True) -> DataFrame:
    """Add ``weight`` from the training rows alone: positives count as often as negatives, companies alike.

    Rows of other parts have weight 1; a company without training rows has no weight to share.
    """
    train = df.where(F.col(part) == "train")
    pos = class_balance(train, label).select("scale_pos_weight").scalar()
    weight = F.when(F.col(label) == 1, pos).otherwise(F.lit(1.0))
    if balance:
        n = train.groupBy("company_id").agg((1.0 / F.count(F.lit(1))).alias("_inv"))
        df = df.join(n, "company_id", "left")
        weight = weight * F.coalesce("_inv", F.lit(1.0))
    return df.withColumn("weight", F.when(F.col(part) == "train", weight).otherwise(F.lit(1.0))).drop("_inv")


def fit_gbt_classifier(df: DataFrame, features: Sequence[str], label: str, *, max_iter: int = 600, depth: int = 6,
                       step: float = 0.05, subsample: float = 0.8, seed: int = 42, weight: str = "weight",
                       part: str = "part") -> PipelineModel:
    """Boosted trees with logistic loss on the rows of part train; those of part stop end the boosting."""
    rows = df.where(F.col(part).isin("train", "stop")).withColumn("_stop", F.col(part) == "stop")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=depth, stepSize=step,
                        subsamplingRate=subsample, seed=seed, weightCol=weight, validationIndicatorCol="_stop")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return _grown(rows, assembler, gbt)


def predict_class(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1; rows with a missing feature have none (NULL)."""
    tried = PipelineModel([s.copy() for s in model.stages])
    tried.stages[0].setHandleInvalid("keep")  # NaN goes with the smaller values
    out = tried.transform(df)
    missing = F.lit(False)
    for f in model.stages[0].getInputCols():
        missing |= F.col(f).isNull()
    return (out.withColumn(name, F.when(~missing, vector_to_array("probability")[1]))
            .drop("features", "rawPrediction", "probability", "prediction"))


@dataclass(frozen=True)
class Ridge:
    """A fitted linear model: coefficients of the standardised features, means and deviations of the plain ones."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    intercept: float

    def column(self) -> Column:
        """The prediction; NULL where a feature is."""
        plain = self.coefficients / np.where(self.deviations > 0, self.deviations, 1)
        out = F.lit(self.intercept - float(plain @ self.means))
        for f, b in zip(self.features, plain.tolist()):
            out = out + F.lit(b) * F.col(f).cast("double")
        return out


def _moments(df: DataFrame, columns: Sequence[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means, and sums of products of deviations of numeric columns, in one pass; one row a task reaches the driver."""
    def joined(a: tuple, b: tuple) -> tuple:
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                mean = x.mean(axis=0)
                x = x - mean
                part = (float(len(x)), mean, x.T @ x)
                total = part if total is None else joined(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total[0]]), pa.array([total[1].tolist()]), pa.array([total[2].ravel().tolist()])],
                                             ["n", "mean", "products"])

    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = [(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(len(columns), -1))
             for r in rows.mapInArrow(add_up, "n double, mean array<double>, products array<double>").collect()]
    if not parts:
        raise ValueError("no complete row to fit on")
    return reduce(joined, parts)


def fit_ridge(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.1) -> Ridge:
    """Standardised features and an L2-penalised linear model on the panel, from its normal equations in one pass.

    The penalty is in units of the target's deviation. A constant feature has the coefficient 0.
    """
    n, mean, products = _moments(_assembled(df, [*features, label]), [*features, label])
    sd = np.sqrt(np.diag(products)[:-1] / max(n - 1, 1))
    spread, used = math.sqrt(products[-1, -1] / n), np.flatnonzero(sd > 0)
    coefficients = np.zeros(len(features))
    if spread > 0 and len(used):
        scale = sd[used]
        left = products[np.ix_(used, used)] / n / np.outer(scale, scale) + np.eye(len(used)) * (penalty / spread)
        coefficients[used] = np.linalg.lstsq(left, products[used, -1] / n / scale, rcond=None)[0]
    return Ridge(tuple(features), coefficients, mean[:-1], sd, float(mean[-1]))


def predict(model: PipelineModel | Ridge, df: DataFrame, features: Sequence[str], name: str = "pred") -> DataFrame:
    """Add the prediction; rows with a missing feature stay and have none (NULL)."""
    if isinstance(model, Ridge):
        return df.withColumn(name, model.column())
    missing = F.lit(False)
    for f in features:
        missing |= F.col(f).isNull()
    filled = df.select("*", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_x_{f}") for f in features])
    tried = PipelineModel([s.copy() for s in model.stages])
    tried.stages[0].setInputCols([f"_x_{f}" for f in features])
    out = tried.transform(filled).withColumn(name, F.when(~missing, F.col("prediction")))
    return out.select(*df.columns, name)


def gain_ranking(df: DataFrame, model: PipelineModel, features: Sequence[str], n: int = 20) -> DataFrame:
    """Top n features by importance; unused features count 0."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(g)) for f, g in zip(features, gains, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature string, gain double")
    return table.orderBy(F.col("gain").desc(), "feature").limit(n)


def gbt_forecast(model: PipelineModel, df: DataFrame, features: Sequence[str], n: int = 30,
                 calendar: DataFrame | None = None, phase: DataFrame | None = None, n_lags: int = 10,
                 key: str = "company_id", cut_every: int = 10) -> DataFrame:
    """Roll a return model forward n sessions for every key.

    The state is one row per key: the last returns as an array, the frozen
    exogenous values and the price. Each step is one model transform; the
    lineage is cut through the shared folder every ``cut_every`` steps.
    """
    keep = max(n_lags, 10)
    w = Window.partitionBy(key).orderBy(F.col("date").desc())
    tail = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep)
    window = tail.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_n", "r"))), lambda s: s["r"]).alias("_w"))
    rolled = {*(f"r_lag_{i}" for i in range(1, n_lags + 1)), "r_ma_5", "r_ma_10", "r_std_5", "r_std_10",
              *CALENDAR_FEATURES}
    frozen = [f for f in features if f not in rolled]
    last = df.groupBy(key).agg(F.max_by(F.struct("date", "close", *frozen), "date").alias("_l"))
    state = (last.join(window, key).where(F.size("_w") >= keep)
             .select(key, F.col("_l.date").alias("last_date"), F.col("_l.close").alias("price"), "_w",
                     *[F.col(f"_l.{f}").alias(f) for f in frozen]))
    days = next_sessions(state.select(key, "last_date"), n, calendar)
    if phase is not None:
        days = days.join(F.broadcast(phase), "date", "left")
    else:
        days = days.withColumn("phase", F.lit(None).cast("double"))
    plan = days.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("step", "date", "phase"))).alias("_days"))
    state = state.join(plan, key).withColumn("_out", F.array().cast("array<struct<date:date,forecast:double>>"))

    def mean(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)

    def sd(a: Column) -> Column:
        m = mean(a)
        return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / (F.size(a) - 1))

    for step in range(1, n + 1):
        day = F.col("_days")[step - 1]
        s, c = weekday_cycle(day["date"])
        angle = F.lit(2 * math.pi) * day["phase"]
        cols = {f"r_lag_{i}": F.col("_w")[i - 1] for i in range(1, n_lags + 1)}
        for k in (5, 10):
            cols[f"r_ma_{k}"] = mean(F.slice("_w", 1, k))
            cols[f"r_std_{k}"] = sd(F.slice("_w", 1, k))
        cols |= {"sin_dow": s, "cos_dow": c, "sin_mp": F.coalesce(F.sin(angle), F.lit(0.0)),
                 "cos_mp": F.coalesce(F.cos(angle), F.lit(1.0))}
        fed = state.withColumns({f: x for f, x in cols.items() if f in features})
        fed = model.transform(fed)
        price = F.col("price") * F.exp("prediction")
        state = fed.select(
            key, "last_date", price.alias("price"),
            F.slice(F.concat(F.array("prediction"), "_w"), 1, keep).alias("_w"), *frozen, "_days",
            F.concat("_out", F.array(F.struct(day["date"].alias("date"), price.alias("forecast")))).alias("_out"))
        if step % cut_every == 0 and step < n:
            state = reliable_checkpoint(state, "forecast")
    return state.select(key, F.posexplode("_out").alias("_p", "_f")).select(
        key, (F.col("_p") + 1).alias("step"), "_f.date", "_f.forecast")


def shadow_selection(df: DataFrame, features: Sequence[str], target: str, ids: Sequence[str], *,
                     rounds: int = 20, trees: int = 200, depth: int = 7, alpha: float = 0.05,
                     seed: int = 42) -> DataFrame:
    """All-relevant selection: features that beat their best shadow more often than chance.

    Each round shuffles the shadows anew, grows a forest on features and shadows,
    and counts the features above the best shadow. Counts decide by a binomial
    test, corrected for the number of features. Forests of as many rounds as a
    task can hold sums of grow together, one pass over the rows a level; only
    splits reach the driver.
    """
    data = df.where(F.col(target).isNotNull()).select(*ids, target, *features)
    data = reliable_checkpoint(impute_mean(data, features), "selection")
    gain = shadow_gains(random_blocks(data, features, target, ids), len(features), rounds, trees, depth, seed)
    best = gain[:, len(features):].max(axis=1)
    hits = {f: int((gain[:, i] > best).sum()) for i, f in enumerate(features)}
    level = alpha / len(features)
    chosen = {f for f in features if _binomial_tail(hits[f], rounds) < level}
    dropped = {f for f in features if _binomial_tail(rounds - hits[f], rounds) < level}
    order = sorted({hits[f] for f in dropped}, reverse=True)
    rows = [(f, hits[f], f in chosen, 1 if f in chosen else 3 + order.index(hits[f]) if f in dropped else 2)
            for f in features]
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, selected boolean, rank int")


def selection_record(ranks: DataFrame, sector_id: int | None = None, company_id: int | None = None,
                     model_type: str = "shadow") -> DataFrame:
    """One selection row with the chosen names, the ranks and the run date."""
    return ranks.agg(
        F.array_sort(F.collect_list(F.when(F.col("selected"), F.col("feature")))).alias("selected_features"),
        F.count(F.lit(1)).cast("int").alias("total_features"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "rank")))).alias("feature_importances"),
    ).select(F.lit(company_id).cast("int").alias("company_id"), F.lit(sector_id).cast("int").alias("sector_id"),
             F.current_date().alias("run_date"), F.lit(model_type).alias("model_type"),
             "selected_features", "total_features", "feature_importances")
