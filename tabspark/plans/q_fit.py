"""Queries: closed-form fits and unrolled gradient steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row, cap_upper, round6
from tabspark.operators import fit, split, transform
from tabspark.operators.evaluate import mse_expr
from tabspark.plans.q_core import FEATURES, U_SQL, ex
from tabspark.plans.registry import query, sqlf
from tabspark.plans.sql_views import with_views

GD_FEATURES = list(FEATURES)
GD_STEPS = 10
LR_LINEAR = 20.0
LR_LOGISTIC = 2.0
CAP = 5000.0


def _r6(e: str) -> str:
    return f"round(({e}) * 1e6) / 1e6"


@query("linreg_1d", "I1", with_views("ex", body=f"""
select {_r6('regr_slope(net_k, gross / 1000.0)')} as slope, {_r6('regr_intercept(net_k, gross / 1000.0)')} as intercept,
       {_r6('regr_r2(net_k, gross / 1000.0)')} as r2, cast(regr_count(net_k, gross / 1000.0) as bigint) as n from ex"""))
def linreg_1d(spark, d):
    e = ex(spark, d).select((F.col("gross") / 1000.0).alias("x"), "net_k")
    r = fit.linreg_1d(e, "x", "net_k")
    return r.select(round6("slope").alias("slope"), round6("intercept").alias("intercept"),
                    round6("r2").alias("r2"), F.col("n").cast("bigint").alias("n"))


@query("linreg_2d", "I2", with_views("ex", ctes="""
s as (select var_samp(x1) s11, var_samp(x2) s22, covar_samp(x1, x2) s12, covar_samp(x1, y) s1y, covar_samp(x2, y) s2y,
             avg(x1) m1, avg(x2) m2, avg(y) my, count(*) n
      from (select gross / 1000.0 as x1, total_quantity as x2, net_k as y from ex)),
c as (select (s22 * s1y - s12 * s2y) / nullif(s11 * s22 - s12 * s12, 0) b1,
             (s11 * s2y - s12 * s1y) / nullif(s11 * s22 - s12 * s12, 0) b2, m1, m2, my, n from s)""", body=f"""
select {_r6('b1')} as b1, {_r6('b2')} as b2, {_r6('my - b1 * m1 - b2 * m2')} as intercept, n from c"""))
def linreg_2d(spark, d):
    e = ex(spark, d).select((F.col("gross") / 1000.0).alias("x1"), F.col("total_quantity").alias("x2"),
                            F.col("net_k").alias("y"))
    r = fit.linreg_2d(e, "x1", "x2", "y")
    return r.select(round6("b1").alias("b1"), round6("b2").alias("b2"), round6("intercept").alias("intercept"), "n")


@query("linprob_baseline", "I4", with_views("ex", ctes="""
f as (select regr_slope(is_high, gross / 1000.0) a, regr_intercept(is_high, gross / 1000.0) b from ex),
p as (select is_high, f.a * (gross / 1000.0) + f.b as pr from ex, f)""", body=f"""
select {_r6('(select a from f)')} as slope, {_r6('(select b from f)')} as intercept,
       {_r6('avg(cast(pr < 0 or pr > 1 as double))')} as out_of_range, {_r6('sqrt(avg(power(pr - is_high, 2)))')} as rmse
from p"""))
def linprob_baseline(spark, d):
    e = ex(spark, d).select((F.col("gross") / 1000.0).alias("x"), "is_high")
    f = fit.linreg_1d(e, "x", "is_high")
    p = fit.predict_line(f, e, "x", "pr")
    m = attach_row(p, f, ["slope", "intercept"]).agg(
        F.first("slope").alias("slope"), F.first("intercept").alias("intercept"),
        F.avg(((F.col("pr") < 0) | (F.col("pr") > 1)).cast("double")).alias("out_of_range"),
        F.sqrt(mse_expr("pr", "is_high")).alias("rmse"))
    return m.select(*[round6(c).alias(c) for c in ["slope", "intercept", "out_of_range", "rmse"]])


# ------------------------------------------------------------ learning curve

def _gd_input(spark, d, label: str):
    e = split.fraction_split(ex(spark, d), split.TRAIN_VALID)
    return transform.linear_scale(e, GD_FEATURES, fit_on=e.where(F.col("split") == "train"), keep=("id", label, "split"))


def _gd_sql(label: str, lr: float, loss: str) -> str:
    mm = ", ".join(f"min({c}) as {c}__min, max({c}) as {c}__max" for c in GD_FEATURES)
    lin = ", ".join(f"({c} - s.{c}__min) / nullif((s.{c}__max - s.{c}__min) / 2.0, 0) - 1.0 as {c}" for c in GD_FEATURES)
    n = len(GD_FEATURES)
    is_train = f"{U_SQL} < {sqlf(split.TRAIN_VALID['train'])}"
    ctes = [f"s as (select {mm} from ex where {is_train})",
            f"sc as materialized (select {lin}, {label} as y, case when {is_train} "
            f"then 'train' else 'valid' end as split from ex, s)",
            "w0 as (select " + ", ".join(f"0.0::double as w{i}" for i in range(n)) + ", 0.0::double as b)"]

    def z(wt: str) -> str:
        return f"({wt}.b + " + " + ".join(f"{wt}.w{i} * {c}" for i, c in enumerate(GD_FEATURES)) + ")"

    def err(wt: str) -> str:
        if loss == "squared":
            return f"(2.0 * ({z(wt)} - y))"
        return f"(1.0 / (1.0 + exp(-{z(wt)})) - y)"

    for k in range(GD_STEPS):
        w = f"w{k}"
        ctes.append(f"g{k} as materialized (select "
                    + ", ".join(f"avg({err(w)} * {c}) g{i}" for i, c in enumerate(GD_FEATURES))
                    + f", avg({err(w)}) gb from sc, {w} where split = 'train')")
        norm = "sqrt(" + " + ".join(f"g{i}*g{i}" for i in range(n)) + " + gb*gb)"
        ctes.append(f"c{k} as (select case when {norm} > 0 then least(1.0, 5.0 / {norm}) else 1.0 end as k, * from g{k})")
        ctes.append(f"w{k + 1} as materialized (select "
                    + ", ".join(f"{w}.w{i} - {sqlf(lr)} * c.g{i} * c.k as w{i}" for i in range(n))
                    + f", {w}.b - {sqlf(lr)} * c.gb * c.k as b from {w}, c{k} c)")
    rows = []
    for k in range(GD_STEPS + 1):
        w = f"w{k}"
        if loss == "squared":
            m = f"sqrt(avg(power({z(w)} - y, 2)))"
        else:
            pz = f"greatest(least(1.0 / (1.0 + exp(-{z(w)})), 1 - 1e-15), 1e-15)"
            m = f"-avg(y * ln({pz}) + (1.0 - y) * ln(1.0 - {pz}))"
        rows.append(f"select cast({k} as bigint) as step, split, {_r6(m)} as loss from sc, {w} group by split")
    return with_views("ex", ctes=",\n".join(ctes), body=" union all ".join(rows))


def _curve(spark, d, label, lr, loss):
    r = fit.gradient_descent(_gd_input(spark, d, label), GD_FEATURES, label, lr, GD_STEPS, loss=loss)
    return r.curve.select("step", "split", round6("loss").alias("loss"))


@query("learning_curve_linear", "I13,I14,I15,K2", _gd_sql("net_k", LR_LINEAR, "squared"))
def learning_curve_linear(spark, d):
    return _curve(spark, d, "net_k", LR_LINEAR, "squared")


@query("learning_curve_logistic", "I13,I14,I5", _gd_sql("is_high", LR_LOGISTIC, "logistic"))
def learning_curve_logistic(spark, d):
    return _curve(spark, d, "is_high", LR_LOGISTIC, "logistic")


# --------------------------------------------------------- line and refits

@query("line_endpoints", "I18", with_views("ex", ctes="""
f as (select regr_slope(net_k, gross / 1000.0) a, regr_intercept(net_k, gross / 1000.0) b from ex),
smp as (select gross / 1000.0 as x, net_k as y from ex order by md5('7-' || id), id limit 300)""", body=f"""
select min(x) as x0, {_r6('greatest(least((select a from f) * min(x) + (select b from f), max(y)), min(y))')} as y0,
       max(x) as x1, {_r6('greatest(least((select a from f) * max(x) + (select b from f), max(y)), min(y))')} as y1
from smp"""))
def line_endpoints(spark, d):
    e = ex(spark, d).select("id", (F.col("gross") / 1000.0).alias("x"), F.col("net_k").alias("y"))
    f = fit.linreg_1d(e, "x", "y").select("slope", "intercept")
    smp = split.sample_n(e, 300, "id", seed=7)
    r = smp.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("ylo"), F.max("y").alias("yhi"))
    r = attach_row(r, f)

    def y_at(x):
        return F.greatest(F.least(F.col("slope") * F.col(x) + F.col("intercept"), F.col("yhi")), F.col("ylo"))

    return r.select("x0", round6(y_at("x0")).alias("y0"), "x1", round6(y_at("x1")).alias("y1"))


@query("refit_after_cap", "I25,C6", with_views("ex", ctes=f"""
v as (select 'raw' as variant, price_per_unit as x, net_k as y from ex
      union all select 'capped', least(price_per_unit, {sqlf(CAP)}), net_k from ex),
f as (select variant, regr_slope(y, x) a, regr_intercept(y, x) b from v group by variant)""", body=f"""
select v.variant, {_r6('max(f.a)')} as slope, {_r6('max(f.b)')} as intercept,
       {_r6('sqrt(avg(power(f.a * v.x + f.b - v.y, 2)))')} as rmse
from v join f on v.variant = f.variant group by v.variant"""))
def refit_after_cap(spark, d):
    e = ex(spark, d)
    out = None
    for variant, x in (("raw", F.col("price_per_unit")), ("capped", cap_upper("price_per_unit", CAP))):
        t = e.select(x.alias("x"), F.col("net_k").alias("y"))
        f = fit.linreg_1d(t, "x", "y")
        p = fit.predict_line(f, t, "x")
        m = attach_row(p, f, ["slope", "intercept"]).agg(
            F.first("slope").alias("slope"), F.first("intercept").alias("intercept"),
            F.sqrt(mse_expr("prediction", "y")).alias("rmse"))
        m = m.select(F.lit(variant).alias("variant"), *[round6(c).alias(c) for c in ["slope", "intercept", "rmse"]])
        out = m if out is None else out.unionByName(m)
    return out


# ------------------------------------------------- fits on held-out rows

_IS_TRAIN = f"{U_SQL} < {sqlf(split.TRAIN_VALID['train'])}"


@query("holdout_fitted", "I24,I2,B12,F6", with_views("ex", ctes=f"""
e as (select gross / 1000.0 as x1, total_quantity as x2, net_k as y,
             case when {_IS_TRAIN} then 'train' else 'valid' end as split from ex),
s as (select var_samp(x1) s11, var_samp(x2) s22, covar_samp(x1, x2) s12, covar_samp(x1, y) s1y, covar_samp(x2, y) s2y,
             avg(x1) m1, avg(x2) m2, avg(y) my from e where split = 'train'),
c as (select (s22 * s1y - s12 * s2y) / nullif(s11 * s22 - s12 * s12, 0) b1,
             (s11 * s2y - s12 * s1y) / nullif(s11 * s22 - s12 * s12, 0) b2, m1, m2, my from s)""", body=f"""
select split, {_r6('sqrt(avg(power(my + b1 * (x1 - m1) + b2 * (x2 - m2) - y, 2)))')} as rmse, count(*) as n
from e, c group by split"""))
def holdout_fitted(spark, d):
    """A two-feature fit on training rows, judged on the rows it has not seen."""
    e = split.fraction_split(ex(spark, d).select(
        "id", (F.col("gross") / 1000.0).alias("x1"), F.col("total_quantity").alias("x2"), F.col("net_k").alias("y")),
        split.TRAIN_VALID)
    m = fit.linreg_2d(e.where(F.col("split") == "train"), "x1", "x2", "y")
    p = attach_row(e, m, ["b1", "b2", "intercept"]).withColumn(
        "p", F.col("intercept") + F.col("b1") * F.col("x1") + F.col("b2") * F.col("x2"))
    return p.groupBy("split").agg(round6(F.sqrt(mse_expr("p", "y"))).alias("rmse"), F.count(F.lit(1)).alias("n"))


def normal_equation_ctes(features, label: str, train_sql: str) -> str:
    """CTEs ending in ``sol(x0..xp)``: least squares on min-max scaled training rows by unrolled elimination.

    ``x0`` is the bias. ``sc`` has the scaled features, ``y`` and ``split``.
    """
    mm = ", ".join(f"min({c}) as {c}__min, max({c}) as {c}__max" for c in features)
    lin = ", ".join(f"({c} - s.{c}__min) / nullif((s.{c}__max - s.{c}__min) / 2.0, 0) - 1.0 as {c}" for c in features)
    xs = ["1.0", *features, "y"]
    n = len(features) + 1
    ctes = [f"s as (select {mm} from ex where {train_sql})",
            f"sc as materialized (select id, {lin}, {label} as y, case when {train_sql} then 'train' else 'valid' end as split "
            f"from ex, s)",
            "m0 as materialized (select " + ", ".join(f"sum({xs[i]} * {xs[j]}) as a{i}_{j}" for i in range(n) for j in range(n + 1))
            + " from sc where split = 'train')"]
    for k in range(n):
        cells = [f"a{i}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j}" for i in range(n) for j in range(n + 1)]
        ctes.append(f"m{k + 1} as materialized (select " + ", ".join(
            f"{c} as a{i}_{j}" for c, (i, j) in zip(cells, [(i, j) for i in range(n) for j in range(n + 1)], strict=True))
            + f" from m{k})")
    ctes.append("sol as materialized (select " + ", ".join(f"a{i}_{n} / a{i}_{i} as x{i}" for i in range(n)) + f" from m{n})")
    return ",\n".join(ctes)
