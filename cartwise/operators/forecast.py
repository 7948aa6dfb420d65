"""Monthly series and linear-trend forecasts.

Two fitting paths, both one distributed pass over the (already aggregated)
monthly series:

* ``fit_trend`` -- one feature (the month number). The 12-candidate grid
  (regParam x fitIntercept x elasticNetParam) of the reference is solved in
  closed form from sufficient statistics gathered by a single aggregation, the
  same statistics Spark's normal-equation solver gathers. The candidate is
  chosen on a key-based split (every fourth month number is validation), then
  refitted on all rows. Everything stays a DataFrame expression, so the result
  is reproducible and has an exact SQL oracle.
* ``fit_keyed`` -- month, year and a key index as features, fitted with
  ``pyspark.ml`` ``LinearRegression`` for every candidate on the same key-based
  split, then refitted on all rows.

Closed form (population moments, labels standardized as Spark does), one
feature x, label y, reg = lambda, enet = alpha, lambda_eff = lambda / sd(y):
  with intercept:    w = sign(c) * max(|c| - lambda_eff*alpha, 0) / (1 + lambda_eff*(1-alpha)),
                     c = cov(x, y) / (sd(x) sd(y))
  without intercept: c = mean(xy) / (sd(x) sd(y)), the 1 becomes mean(x^2) / var(x)
  slope = w * sd(y) / sd(x); intercept = mean(y) - slope*mean(x) (or 0).
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.calendar import first_of_month, horizon_months, whole_months_before
from cartwise.functions.holding import hold
from cartwise.functions.indexing import dense_index, rank_on

# The reference's model grid and horizon.
REG_PARAMS = [0.1, 0.01]
FIT_INTERCEPT = [True, False]
ELASTIC_NET = [0.0, 0.5, 1.0]
HORIZON = 12
VALIDATION_EVERY = 4   # month numbers t with t % 4 == 3 are the validation rows
KEYED_FIT_PARALLELISM = 4   # candidate fits submitted at once


def grid() -> list[tuple[float, bool, float]]:
    """Candidate order; the first candidate wins a tie on validation RMSE."""
    return [(r, fi, a) for r in REG_PARAMS for fi in FIT_INTERCEPT for a in ELASTIC_NET]


# ---------------------------------------------------------------------------
# series
# ---------------------------------------------------------------------------

def monthly_series(df: DataFrame, date_col: str, value: Column, as_of: dt.date | str,
                   history: int, keys: list[str] | None = None,
                   value_type: str = "bigint") -> DataFrame:
    """Sum ``value`` per (year, month[, keys]) over the whole months before as_of.

    Output columns: year, month, *keys, label (``value_type``). Money is summed
    as decimal so the total does not depend on summation order.
    """
    keys = keys or []
    d = F.col(date_col)
    summed_type = "decimal(28,2)" if value_type.startswith("decimal") else "bigint"
    cast_in = "decimal(18,2)" if value_type.startswith("decimal") else "bigint"
    return (df.filter(whole_months_before(d, as_of, history))
            .groupBy(F.year(d).cast("int").alias("year"), F.month(d).cast("int").alias("month"),
                     *keys)
            .agg(F.sum(value.cast(cast_in)).cast(summed_type).alias("label")))


def number_months(series: DataFrame) -> DataFrame:
    """Add t = 0-based position of (year, month) among the months present.

    Months without sales get no number, so gaps close up (as in the reference).
    ``series`` has one row per month of the history.
    """
    return rank_on(series, ["year", "month"], "t")


# ---------------------------------------------------------------------------
# closed-form one-feature trend
# ---------------------------------------------------------------------------

def _stats(x: Column, y: Column, cond: Column, prefix: str) -> list[Column]:
    """Moments of the rows where ``cond`` holds: n, sums of x, x^2, y, xy, y^2.

    Sums run on exact decimals (labels carry at most 2 decimals), so they do not
    depend on the order in which partitions are combined; only the final
    values become doubles.
    """
    yd = y.cast("decimal(18,2)")
    xd = x.cast("decimal(18,0)")
    xl = x.cast("bigint")
    w = F.when(cond, F.lit(1)).otherwise(F.lit(None))
    return [
        F.count(w).cast("double").alias(f"{prefix}_n"),
        F.sum(F.when(cond, xl)).cast("double").alias(f"{prefix}_sx"),
        F.sum(F.when(cond, xl * xl)).cast("double").alias(f"{prefix}_sxx"),
        F.sum(F.when(cond, yd)).cast("double").alias(f"{prefix}_sy"),
        F.sum(F.when(cond, xd * yd)).cast("double").alias(f"{prefix}_sxy"),
        F.sum(F.when(cond, yd * yd)).cast("double").alias(f"{prefix}_syy"),
    ]


def _solve(p: str, reg: Column, enet: Column, fit_intercept: Column) -> tuple[Column, Column]:
    """(slope, intercept) of the elastic-net line from the ``p`` statistics.

    Divisions use ``try_divide``: with ANSI mode a zero divisor would raise, and
    a constant series or a single month has zero variance. Those cases take the
    ``degenerate`` branch (flat line through the mean with an intercept, plain
    least squares through the origin without one).
    """
    div = F.try_divide
    n = F.col(f"{p}_n")
    mx, my = div(F.col(f"{p}_sx"), n), div(F.col(f"{p}_sy"), n)
    mxx, mxy, myy = div(F.col(f"{p}_sxx"), n), div(F.col(f"{p}_sxy"), n), div(F.col(f"{p}_syy"), n)
    var_x = mxx - mx * mx
    var_y = myy - my * my
    sd_x, sd_y = F.sqrt(var_x), F.sqrt(var_y)
    lam = div(reg, sd_y)
    c = F.when(fit_intercept, div(mxy - mx * my, sd_x * sd_y)).otherwise(div(mxy, sd_x * sd_y))
    denom = F.when(fit_intercept, F.lit(1.0)).otherwise(div(mxx, var_x)) + lam * (F.lit(1.0) - enet)
    w = div(F.signum(c) * F.greatest(F.abs(c) - lam * enet, F.lit(0.0)), denom)
    degenerate = (var_x <= 0) | (var_y <= 0)
    slope = F.when(degenerate, F.when(fit_intercept, F.lit(0.0)).otherwise(div(mxy, mxx))) \
        .otherwise(div(w * sd_y, sd_x))
    intercept = F.when(fit_intercept, my - slope * mx).otherwise(F.lit(0.0))
    return slope, intercept


def fit_trend(series: DataFrame, x: str = "t", y: str = "label") -> DataFrame:
    """One-row model: reg, enet, fit_intercept, rmse, slope, intercept, max_t.

    One aggregation gathers the moments of the training rows, the validation
    rows and all rows; the 12 candidates are then rows of a tiny exploded grid
    (so each expression stays small), and the best one is refitted on all rows.
    """
    xc, yc = F.col(x), F.col(y)
    is_val = (xc % VALIDATION_EVERY) == (VALIDATION_EVERY - 1)
    stats = series.agg(*_stats(xc, yc, ~is_val, "tr"), *_stats(xc, yc, is_val, "va"),
                       *_stats(xc, yc, F.lit(True), "al"), F.max(xc).alias("max_t"))
    cands = F.array(*[F.struct(F.lit(pos).alias("pos"), F.lit(reg).alias("reg"),
                               F.lit(enet).alias("enet"), F.lit(fi).alias("fit_intercept"))
                      for pos, (reg, fi, enet) in enumerate(grid())])
    per = stats.select("*", F.explode(cands).alias("c"))
    slope, icpt = _solve("tr", F.col("c.reg"), F.col("c.enet"), F.col("c.fit_intercept"))
    per = per.select("*", slope.alias("_s"), icpt.alias("_i"))
    s_, i_, nv = F.col("_s"), F.col("_i"), F.col("va_n")
    sse = (F.col("va_syy") - F.lit(2.0) * i_ * F.col("va_sy") - F.lit(2.0) * s_ * F.col("va_sxy")
           + nv * i_ * i_ + F.lit(2.0) * i_ * s_ * F.col("va_sx") + s_ * s_ * F.col("va_sxx"))
    rmse = F.when(nv > 0, F.sqrt(F.try_divide(F.greatest(sse, F.lit(0.0)), nv))).otherwise(F.lit(0.0))
    # a candidate without a defined line (no fit possible) ranks last
    ranked = per.select("*", F.coalesce(rmse, F.lit(float("inf"))).alias("_rmse"))
    # min over (rmse, grid position): the first candidate wins a tie
    best = ranked.agg(
        F.min(F.struct("_rmse", F.col("c.pos"), F.col("c.reg"), F.col("c.enet"),
                       F.col("c.fit_intercept"))).alias("best"),
        *[F.first(c).alias(c) for c in stats.columns])
    slope, icpt = _solve("al", F.col("best.reg"), F.col("best.enet"), F.col("best.fit_intercept"))
    return best.select(F.col("best.reg").alias("reg"), F.col("best.enet").alias("enet"),
                       F.col("best.fit_intercept").alias("fit_intercept"),
                       F.col("best._rmse").alias("rmse"), slope.alias("slope"),
                       icpt.alias("intercept"), F.col("max_t"))


def trend_forecast(model: DataFrame, as_of: dt.date | str, horizon: int = HORIZON) -> DataFrame:
    """Rows (month, year, prediction) for the ``horizon`` months from as_of's month.

    The month numbers continue after the last training month (max_t + 1 ...).
    """
    first = first_of_month(as_of)
    steps = model.select("*", F.posexplode(horizon_months(first, horizon)).alias("h", "d"))
    return steps.select(F.month("d").cast("int").alias("month"), F.year("d").cast("int").alias("year"),
                        (F.col("intercept") + F.col("slope") * (F.col("max_t") + F.col("h") + 1))
                        .alias("prediction"))


# ---------------------------------------------------------------------------
# keyed model: month, year, key index -> label (pyspark.ml)
# ---------------------------------------------------------------------------

def fit_keyed(train: DataFrame, feature_cols: list[str], label: str = "label"):
    """Choose among the 12 LinearRegression candidates and refit; return a
    ``PipelineModel`` (assembler + regression) that scores ``feature_cols``.

    The split is key-based like the trend's: months whose position among the
    series' months is 3 modulo 4 are validation. A random split (the
    reference's choice) depends on row order after a shuffle; this one does
    not, so the chosen candidate is the same on every run. The lowest
    validation RMSE wins, the first candidate on a tie (also when there is no
    validation month); the winner is refitted on all rows. Each fit is a
    distributed ``pyspark.ml`` job, and one aggregation over the validation
    rows scores the 12 fitted lines; only the 12 RMSE values reach the driver.
    Rows with a null label or feature teach nothing.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    months = dense_index(train.select("year", "month").distinct(), ["year", "month"], "_t", bounded=True)
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features")
    data = assembler.transform(
        train.dropna(subset=[*feature_cols, label]).join(months, ["year", "month"])
        .select(*feature_cols, F.col(label).cast("double").alias(label),
                ((F.col("_t") % VALIDATION_EVERY) == (VALIDATION_EVERY - 1)).alias("_val")))
    data = hold(data)
    fit_rows, val_rows = data.filter(~F.col("_val")), data.filter(F.col("_val"))
    lr = LinearRegression(featuresCol="features", labelCol=label)
    candidates = [{lr.regParam: reg, lr.fitIntercept: fi, lr.elasticNetParam: enet} for reg, fi, enet in grid()]
    best = 0
    if val_rows.take(1):
        # candidates are independent jobs: submit a few at once, as TrainValidationSplit does
        with ThreadPoolExecutor(max_workers=KEYED_FIT_PARALLELISM) as pool:
            lines = list(pool.map(lambda params: lr.copy(params).fit(fit_rows), candidates))
        errors = []
        for i, line in enumerate(lines):
            predicted = F.lit(float(line.intercept))
            for c, w in zip(feature_cols, line.coefficients, strict=True):
                predicted = predicted + F.col(c) * F.lit(float(w))
            errors.append(F.sqrt(F.avg((predicted - F.col(label)) * (predicted - F.col(label)))).alias(f"e{i}"))
        scores = list(val_rows.agg(*errors).first())
        best = min(range(len(scores)), key=lambda i: (scores[i], i))
    final = lr.copy(candidates[best]).fit(data)
    return PipelineModel(stages=[assembler, final])


def keyed_horizon(keys: DataFrame, as_of: dt.date | str, horizon: int = HORIZON) -> DataFrame:
    """One row per (key, future month): keys x the next ``horizon`` months.

    Generated by exploding a 12-element date array on every key row, so the
    work is split like the key table and no cross join is planned.
    """
    first = first_of_month(as_of)
    return (keys.select("*", F.explode(horizon_months(first, horizon)).alias("_d"))
            .withColumn("month", F.month("_d").cast("int"))
            .withColumn("year", F.year("_d").cast("int")).drop("_d"))


def nearest_int(c: Column) -> Column:
    """Round half up to an integer (``floor(x + 0.5)``)."""
    return F.floor(c + F.lit(0.5)).cast("int")


def cents(c: Column) -> Column:
    """Two decimals, HALF_UP on the decimal form of the double."""
    return F.round(c, 2)
