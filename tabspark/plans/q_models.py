"""Queries: MLlib fits and comparisons (I2, I3, I5-I12, I17, I20-I23). Rows-only checks.

Fits are distributed MLlib jobs; only coefficients (bounded by the
feature count) and a bounded vocabulary (top-k) ever reach the driver.
Every metric is computed by the ``evaluate`` aggregates on the scored
DataFrame, split by the seeded fraction split.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import (
    FMClassifier, LogisticRegression, MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, HashingTF, MinMaxScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators import code_logistic, encode, evaluate, fit, gram, one_vs_rest, scoring, split, term_blocks, term_factors, transform
from tabspark.operators.profile import nonzero_count
from tabspark.plans.q_core import FEATURES, TRAIN_FRAC, U_SQL, ex
from tabspark.plans.q_encode import bucket_bounds_ctes, vocab_and_reviews
from tabspark.plans.q_fit import normal_equation_ctes
from tabspark.plans.registry import REGISTRY, query, sqlf
from tabspark.plans.sql_views import with_views
from tabspark.functions.columns import argmax, attach_row, hex8_unit, round6, seeded_key
from tabspark.session import ensure_checkpoint_dir, materialize
from tabspark.sources import views

def catalog_sql(name: str) -> str:
    """The oracle of an already registered query (same output columns)."""
    return REGISTRY[name].sql


SCALED = list(FEATURES)
CROSS_COLS = list(FEATURES)
# The reference's bucket counts, fine for the position-like columns, coarse for the others.
N_BUCKETS = 10
BUCKETS = {c: 50 if c in ("gross", "acctbal") else N_BUCKETS for c in CROSS_COLS}
L1_GRID = [0.0001, 0.001, 0.01, 0.1]
# The reference's model-size and log-loss goals for the L1 pick.
MAX_SIZE = 600
MAX_LOG_LOSS = 0.35


MODEL_COLS = ["id", *FEATURES, "net_k", "is_high"]


def _split_ex(spark, d) -> DataFrame:
    """The split example table, materialized once as the fits' input."""
    return fit.fit_input(split.fraction_split(ex(spark, d).select(*MODEL_COLS), split.TRAIN_VALID))


def _scaled(spark, d, label: str, e: DataFrame | None = None) -> DataFrame:
    """``e``: the split example table, if it is at hand."""
    e = _split_ex(spark, d) if e is None else e
    sc = transform.linear_scale(e, SCALED, fit_on=e.where(F.col("split") == "train"), keep=("id", label, "split"))
    return VectorAssembler(inputCols=SCALED, outputCol="features").transform(sc)


def _reg_metrics(pred: DataFrame, label: str, model: str) -> DataFrame:
    r = evaluate.rmse(pred, "prediction", label, groups=["split"])
    return evaluate.metrics_long(r, ["rmse", "n"], keep=["split"]).select(F.lit(model).alias("model"), "split",
                                                                          "metric", "value")


def _cls_metrics(pred: DataFrame, label: str, model: str) -> DataFrame:
    """Log loss, accuracy (one grouped pass) and exact AUC (one grouped
    pass) per split, over a materialized 4-column scored table."""
    p = materialize(pred.select("split", F.col(label).cast("double").alias("y"),
                                vector_to_array("probability")[1].alias("p1"), "prediction"))
    pc = evaluate.clipped("p1")
    la = p.groupBy("split").agg(
        (-F.avg(F.col("y") * F.ln(pc) + (F.lit(1.0) - F.col("y")) * F.ln(F.lit(1.0) - pc))).alias("log_loss"),
        F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("accuracy"))
    au = evaluate.auc(p, "p1", "y", groups=["split"], groups_bounded=True).select("split", "auc")
    row = la.join(au, "split")
    m = evaluate.metrics_long(row, ["log_loss", "accuracy", "auc"], keep=["split"])
    return m.select(F.lit(model).alias("model"), "split", "metric", "value")


def _crossed_codes(spark, d, label: str, e: DataFrame | None = None) -> DataFrame:
    """D5 buckets from training rows + D11 exact cross, as codes."""
    e = _split_ex(spark, d) if e is None else e
    b = encode.bucketize_by_quantiles(e, CROSS_COLS, BUCKETS, fit_on=e.where(F.col("split") == "train"),
                                      keep=("id", label, "split"), stored=True)
    return b.withColumn("cross", encode.cross_exact("total_quantity", "gross", BUCKETS["gross"]))


def _crossed(spark, d, label: str, e: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """The crossed codes, one-hot encoded."""
    b = _crossed_codes(spark, d, label, e)
    sizes = BUCKETS | {"cross": BUCKETS["total_quantity"] * BUCKETS["gross"]}
    cats = list(sizes)
    b = b.select("id", label, "split", *[F.col(c).cast("double").alias(c) for c in cats])
    # The category counts are parameters: one row with the largest categories fits the encoder.
    largest = spark.createDataFrame([tuple(float(sizes[c] - 1) for c in cats)], ", ".join(f"{c} double" for c in cats))
    model = OneHotEncoder(inputCols=cats, outputCols=[f"{c}_oh" for c in cats], dropLast=False,
                          handleInvalid="keep").fit(largest)
    oh = model.transform(b)
    names = [f"{c}={i}" for c, n in zip(cats, model.categorySizes) for i in range(n + 1)]
    # The codes stay beside their vector: a fit that reads them needs no vectors.
    return VectorAssembler(inputCols=[f"{c}_oh" for c in cats], outputCol="features").transform(oh), names


# ---------------------------------------------------------------- regression

_NORMAL = normal_equation_ctes(SCALED, "net_k", f"{U_SQL} < {sqlf(TRAIN_FRAC)}")
_FITTED = "sol.x0 + " + " + ".join(f"sol.x{i + 1} * sc.{c}" for i, c in enumerate(SCALED))


@query("linreg_multi", "I2,D13,I17", with_views("ex", ctes=_NORMAL + f""",
r as (select split, sqrt(avg(power({_FITTED} - y, 2))) as rmse, count(*) as n from sc, sol group by split)""", body="""
select 'linear_normal' as model, split, 'rmse' as metric, round(rmse * 1e6) / 1e6 as value from r
union all select 'linear_normal', split, 'n', cast(n as double) from r"""))
def linreg_multi(spark, d):
    data = _scaled(spark, d, "net_k")
    m = LinearRegression(featuresCol="features", labelCol="net_k", solver="normal").fit(
        data.where(F.col("split") == "train"))
    return _reg_metrics(m.transform(data), "net_k", "linear_normal").withColumn("value", round6("value"))


@query("linreg_kept", "I17,I24,I2", catalog_sql("linreg_multi"))
def linreg_kept(spark, d):
    """The fit of ``linreg_multi`` kept as a pipeline, reloaded, its input columns checked, and scored."""
    e = _split_ex(spark, d)
    path = f"{ensure_checkpoint_dir(spark)}/linreg_kept-{uuid.uuid4().hex}"
    stages = [VectorAssembler(inputCols=SCALED, outputCol="raw"), MinMaxScaler(inputCol="raw", outputCol="features", min=-1.0, max=1.0),
              LinearRegression(featuresCol="features", labelCol="net_k", solver="normal")]
    scoring.fit_and_keep(e.where(F.col("split") == "train"), stages, [*SCALED, "net_k"], path)
    return _reg_metrics(scoring.score(spark, path, e), "net_k", "linear_normal").withColumn("value", round6("value"))


@query("linreg_mllib_2d", "I2,I17", catalog_sql("linreg_2d"))
def linreg_mllib_2d(spark, d):
    """MLlib's distributed normal-equation fit on two features, checked
    against the closed-form (Cramer's rule) SQL of ``linreg_2d``."""
    e = ex(spark, d).select((F.col("gross") / 1000.0).alias("x1"), F.col("total_quantity").alias("x2"),
                            F.col("net_k").alias("y"))
    data = VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(fit.fit_input(e))
    m = LinearRegression(featuresCol="features", labelCol="y", solver="normal", regParam=0.0).fit(data)
    w = fit.linear_weights(spark, m, ["b1", "b2"])
    row = w.groupBy().pivot("name", ["b1", "b2", "bias"]).agg(F.first("weight"))
    n = e.agg(F.count(F.lit(1)).alias("n"))
    return attach_row(row, n).select(round6("b1").alias("b1"), round6("b2").alias("b2"),
                                     round6("bias").alias("intercept"), "n")


@query("export_weights", "I17", with_views("ex", ctes=_NORMAL, body=" union all ".join(
    f"select 'weights' as layer, cast({i} as bigint) as row, cast(0 as bigint) as col, '{c}' as name, "
    f"round(x{i + 1} * 1e4) / 1e4 as weight from sol" for i, c in enumerate(SCALED))
    + " union all select 'bias', 0, 0, 'bias', round(x0 * 1e4) / 1e4 from sol"))
def export_weights(spark, d):
    data = _scaled(spark, d, "net_k")
    m = LinearRegression(featuresCol="features", labelCol="net_k", solver="normal").fit(
        data.where(F.col("split") == "train"))
    w = fit.linear_weights(spark, m, SCALED)
    return w.withColumn("weight", F.round(F.col("weight") * 1e4) / 1e4)


RIDGE = 0.01
CROSSED = {**BUCKETS, "cross": BUCKETS["total_quantity"] * BUCKETS["gross"]}
CG_STEPS = 250


def _crossed_ctes() -> str:
    """``codes(id, split, y, <codes>)``, ``oh(id, split, y, k)`` with a row per active one-hot column (0: the bias), and
    ``gram(i, j, v)``, ``rhs(k, b)`` of the training rows."""
    code = {c: f"cast(len(list_filter((select bounds from b where feature = '{c}'), lambda x: x <= {c})) as bigint)"
            for c in CROSS_COLS}
    first, at = {}, 1
    for c, n in CROSSED.items():
        first[c], at = at, at + n
    active = ["0", *[f'{first[c]} + "{c}"' for c in CROSSED]]
    return bucket_bounds_ctes(BUCKETS) + f""",
buckets as (select id, net_k as y, case when {U_SQL} < {sqlf(TRAIN_FRAC)} then 'train' else 'valid' end as split,
            {", ".join(f"{e} as {c}" for c, e in code.items())} from ex),
codes as materialized (select *, total_quantity * {BUCKETS["gross"]} + gross as "cross" from buckets),
oh as materialized (select id, split, y, unnest([{", ".join(active)}]) as k from codes),
gram as materialized (select p.k as i, q.k as j, cast(count(*) as double) as v from oh p join oh q on p.id = q.id
                      where p.split = 'train' group by all),
rhs as materialized (select k, sum(y) as b from oh where split = 'train' group by k)"""


@query("crossed_counts", "I3,D11", with_views("ex", ctes=_crossed_ctes(), body="""
select split, count(*) as cells, sum(n)::bigint as pairs, max(n)::bigint as largest from (
  select p.split, p.k, q.k, count(*) as n from oh p join oh q on p.id = q.id and p.k < q.k group by p.split, p.k, q.k)
group by split"""))
def crossed_counts(spark, d):
    """How many pairs of codes occur together, and how often: the cells of the crossed fit's matrix."""
    counts = gram.pair_counts(_crossed_codes(spark, d, "net_k"), CROSSED, "net_k", ["split"]).where("b <> ''")
    return counts.groupBy("split").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("pairs"), F.max("n").alias("largest"))


@query("linreg_crossed", "I3,D5,D10,D11", "with recursive " + with_views("ex", ctes=_crossed_ctes() + f""",
a as materialized (select i, j, case when i = j and i > 0 then v + {sqlf(RIDGE)} * (select v from gram where i = 0 and j = 0)
                                else v end as v from gram),
cg(it, k, x, r, p) as (
  select 0, k, 0.0::double, b, b from rhs
  union all
  select it + 1, k, x + alpha * p, r1, r1 + coalesce(sum(r1 * r1) over () / nullif(rr, 0), 0) * p from (
    select it, k, x, p, rr, alpha, r - alpha * ap as r1 from (
      select c.it, c.k, c.x, c.r, c.p, m.ap, sum(c.r * c.r) over () as rr,
             coalesce(sum(c.r * c.r) over () / nullif(sum(c.p * m.ap) over (), 0), 0) as alpha
      from cg c join (select a.i, sum(a.v * c2.p) as ap from a join cg c2 on a.j = c2.k group by a.i) m on m.i = c.k
      where c.it < {CG_STEPS}))),
w as materialized (select k, x from cg where it = {CG_STEPS}),
r as (select split, sqrt(avg(power(e, 2))) as rmse, count(*) as n
      from (select id, split, any_value(y) - sum(coalesce(w.x, 0)) as e from oh left join w using (k) group by id, split) group by split)""",
                                                                       body="""
select 'linear_crossed' as model, split, 'rmse' as metric, round(rmse * 1e6) / 1e6 as value from r
union all select 'linear_crossed', split, 'n', cast(n as double) from r""").removeprefix("with "))
def linreg_crossed(spark, d):
    """Ridge on all one-hot buckets and a cross, solved from the counts of code pairs; errors from the same sums."""
    own = gram.contingency(_crossed_codes(spark, d, "net_k"), CROSSED, "net_k", ["split"])
    w = gram.ridge(own[("train",)], RIDGE)
    rows = [("linear_crossed", s, metric, float(v)) for (s,), m in own.items() for metric, v in (("rmse", m.rmse(w)), ("n", m.n))]
    return spark.createDataFrame(rows, "model string, split string, metric string, value double").withColumn(
        "value", round6("value"))


@query("gbt_regress", "I9,I13")
def gbt_regress(spark, d):
    """A non-linear regressor (boosted trees) and its learning curve: RMSE per split after each of ten trees."""
    data = _scaled(spark, d, "net_k").select("split", "features", F.col("net_k").alias("label"))
    m = GBTRegressor(maxIter=10, maxDepth=4, stepSize=0.5, seed=42).fit(data.where(F.col("split") == "train"))
    rows = [(k + 1, s, float(e) ** 0.5) for s in ("train", "valid")
            for k, e in enumerate(m.evaluateEachIteration(data.where(F.col("split") == s), "squared"))]
    return spark.createDataFrame(rows, "period long, split string, rmse double")


@query("solver_compare", "I22,I14")
def solver_compare(spark, d):
    data = _scaled(spark, d, "net_k")
    train = data.where(F.col("split") == "train")
    out = None
    for solver in ("normal", "l-bfgs"):
        m = LinearRegression(featuresCol="features", labelCol="net_k", solver=solver, maxIter=100).fit(train)
        r = evaluate.rmse(m.transform(data), "prediction", "net_k", groups=["split"])
        r = r.select(F.lit(solver).alias("solver"), F.lit(0).cast("bigint").alias("step"), "split",
                     F.col("rmse").alias("loss"))
        out = r if out is None else out.unionByName(r)
    sc = data.drop("features")
    for name, clip in (("gd_clip5", fit.CLIP_NORM), ("gd_noclip", None)):
        g = fit.gradient_descent(sc, SCALED, "net_k", lr=0.1, steps=10, clip_norm=clip)
        out = out.unionByName(g.curve.select(F.lit(name).alias("solver"), "step", "split", "loss"))
    return out


@query("recipe_compare", "I23,C9,C14,D5")
def recipe_compare(spark, d):
    """Ridge of three recipes over one split table, each from the sums of a single scan: the same minimum as that of
    up to 100 gradient scans (the columns are bounded by the recipes)."""
    out = None
    e = _split_ex(spark, d)
    base = _scaled(spark, d, "net_k", e)
    minimal = VectorAssembler(inputCols=["gross", "total_quantity"], outputCol="features").transform(
        base.drop("features"))
    crossed, _ = _crossed(spark, d, "net_k", e)
    for name, data in (("all_scaled", base), ("minimal", minimal), ("binned_crossed", crossed)):
        m = LinearRegression(featuresCol="features", labelCol="net_k", solver="normal", regParam=0.01,
                             maxIter=100).fit(data.where(F.col("split") == "train"))
        r = evaluate.rmse(m.transform(data), "prediction", "net_k", groups=["split"])
        r = r.select(F.lit(name).alias("recipe"), "split", "rmse", "n")
        out = r if out is None else out.unionByName(r)
    return out


STRENGTHS = [0.0, 0.001, 0.01, 0.1, 1.0]
FOLDS = 4
ELASTIC = [(s, share) for s in (0.01, 0.1, 1.0) for share in (0.0, 0.5, 1.0)]


def _fold_sql(seed: int = 7) -> str:
    return f"cast(floor(cast(('0x' || substr(md5('{seed}-' || id), 1, 8)) as bigint) / 4294967296.0 * {FOLDS}) as bigint)"


def _ridge_ctes() -> str:
    """``sol(left_out, s, x0..xp)``: the fit of every strength on the training rows outside a fold (-1: on all)."""
    xs = ["1.0", *SCALED, "y"]
    n = len(SCALED) + 1
    pairs = [(i, j) for i in range(n) for j in range(n + 1)]
    ctes = [_NORMAL.split("m0 as materialized")[0].rstrip().rstrip(","),
            f"f as materialized (select *, {_fold_sql()} as fold from sc)",
            "lo as (select unnest(range(-1, " + str(FOLDS) + ")) as left_out)",
            "st as (select unnest([" + ", ".join(sqlf(s) for s in STRENGTHS) + "]) as s)",
            "g as materialized (select left_out, count(*) as n, " + ", ".join(f"sum({xs[i]} * {xs[j]}) as a{i}_{j}" for i, j in pairs)
            + " from lo, f where split = 'train' and fold <> left_out group by left_out)",
            "m0 as materialized (select left_out, s, " + ", ".join(
                f"a{i}_{j}" + (" + s * n" if i == j and i else "") + f" as a{i}_{j}" for i, j in pairs) + " from g, st)"]
    for k in range(n):
        ctes.append(f"m{k + 1} as materialized (select left_out, s, " + ", ".join(
            (f"a{i}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j}") + f" as a{i}_{j}" for i, j in pairs)
            + f" from m{k})")
    ctes.append("sol as materialized (select left_out, s, " + ", ".join(f"a{i}_{n} / a{i}_{i} as x{i}" for i in range(n))
                + f" from m{n})")
    return ",\n".join(ctes)


_PREDICTED = "sol.x0 + " + " + ".join(f"sol.x{i + 1} * f.{c}" for i, c in enumerate(SCALED))


def _fold_moments(spark, d) -> tuple[dict, gram.Moments]:
    """Sums of the training rows by fold, and of the validation rows: one scan of the scaled table."""
    data = _scaled(spark, d, "net_k").withColumn(
        "fold", F.floor(hex8_unit(seeded_key(7, "id")) * FOLDS).cast("bigint"))
    own = gram.moments(data, SCALED, "net_k", ["split", "fold"])
    folds = {f: m for (s, f), m in own.items() if s == "train"}
    return folds, gram.total([m for (s, _), m in own.items() if s == "valid"] or [gram.Moments.zero(len(SCALED))])


@query("grid_search", "I20", with_views("ex", ctes=_ridge_ctes() + f""",
cv as (select sol.s, sqrt(avg(power({_PREDICTED} - y, 2))) as rmse from f join sol on sol.left_out = f.fold
       where split = 'train' group by sol.s),
va as (select sol.s, sqrt(avg(power({_PREDICTED} - y, 2))) as rmse from f join sol on sol.left_out = -1
       where split = 'valid' group by sol.s)""", body="""
select cv.s as reg_param, round(cv.rmse * 1e6) / 1e6 as cv_rmse, round(va.rmse * 1e6) / 1e6 as rmse from cv join va on cv.s = va.s"""))
def grid_search(spark, d):
    """Cross-validated and validation RMSE of every ridge strength, from the sums of each fold."""
    folds, valid = _fold_moments(spark, d)
    every = gram.total(folds.values())
    rows = [(s, float(cv), valid.rmse(gram.ridge(every, s))) for s, cv in gram.ridge_path(folds, STRENGTHS)]
    return spark.createDataFrame(rows, "reg_param double, cv_rmse double, rmse double").select(
        "reg_param", round6("cv_rmse").alias("cv_rmse"), round6("rmse").alias("rmse"))


@query("grid_search_elastic", "I20,I6")
def grid_search_elastic(spark, d):
    """The same sums, with an L1 share: sizes and validation RMSE by coordinate descent without further scans."""
    folds, valid = _fold_moments(spark, d)
    every = gram.total(folds.values())
    rows = []
    for s, share in ELASTIC:
        w = gram.elastic_net(every, s, share)
        rows.append((s, share, int((w[1:] != 0).sum()), valid.rmse(w)))
    return spark.createDataFrame(rows, "reg_param double, elastic_net_param double, size long, rmse double")


# ------------------------------------------------------------ classification

@query("logreg", "I5,F8,F10,F11")
def logreg(spark, d):
    data = _scaled(spark, d, "is_high")
    m = LogisticRegression(featuresCol="features", labelCol="is_high", maxIter=50).fit(
        data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "is_high", "logistic")


def _l1_train(data: DataFrame) -> DataFrame:
    """The training rows' codes in Spark's compact cache, two bytes each and no vectors."""
    return data.where(F.col("split") == "train").select(*[F.col(c).cast("smallint").alias(c) for c in CROSSED],
                                                        F.col("is_high").cast("smallint").alias("is_high")).persist()


def _l1_fit(train: DataFrame, lam: float) -> code_logistic.L1Fit:
    return code_logistic.L1Fit(train, lam)


def _l1_models(spark, data: DataFrame, strengths) -> list:
    """A model for each strength; the fits share their scans."""
    train = _l1_train(data)
    try:
        fits = code_logistic.solve([_l1_fit(train, lam) for lam in strengths], CROSSED, "is_high")
    finally:
        train.unpersist()
    return [f.model(spark) for f in fits]


@query("logreg_l1", "I6,F5")
def logreg_l1(spark, d):
    data, names = _crossed(spark, d, "is_high")
    m, = _l1_models(spark, data, [0.001])
    w = fit.linear_weights(spark, m, names).where(F.col("layer") == "weights")
    size = nonzero_count(w).select(F.lit("logistic_l1").alias("model"), F.lit("model").alias("split"),
                                   F.lit("size").alias("metric"), F.col("size").cast("double").alias("value"))
    return _cls_metrics(m.transform(data), "is_high", "logistic_l1").unionByName(size)


@query("l1_constrained_pick", "I21,I6,F5")
def l1_constrained_pick(spark, d):
    """One L1 fit per strength, run together (one scan of the training rows answers all of them), then the
    constrained pick."""
    data, _ = _crossed(spark, d, "is_high")
    models = _l1_models(spark, data, L1_GRID)
    scored, p1 = data.where(F.col("split") == "valid").select("features", "is_high"), []
    for i, m in enumerate(models):
        own = m.setProbabilityCol(f"probability{i}").setRawPredictionCol("").setPredictionCol("")
        scored, p1 = own.transform(scored), [*p1, vector_to_array(f"probability{i}")[1].alias(f"p{i}")]
    scored = materialize(scored.select("is_high", *p1))  # one pass scores the rows with every model
    rows = []
    for i, (lam, m) in enumerate(zip(L1_GRID, models)):
        size = int(sum(1 for v in m.coefficients.toArray() if v != 0))
        rows.append((lam, size, float(evaluate.log_loss(scored, f"p{i}", "is_high").first()["log_loss"])))
    grid = spark.createDataFrame(rows, "lambda double, size long, log_loss double")
    ok = (F.col("size") <= MAX_SIZE) & (F.col("log_loss") < MAX_LOG_LOSS)
    best = grid.where(ok).orderBy("log_loss", "size").limit(1).select("lambda", F.lit(True).alias("picked"))
    return grid.join(best, "lambda", "left").select("lambda", "size", "log_loss",
                                                    F.coalesce("picked", F.lit(False)).alias("picked"))


def _digits(spark, d) -> DataFrame:
    dg = split.fraction_split(views.digits(spark, d), split.TRAIN_VALID)
    return fit.fit_input(dg.select("id", F.col("label").cast("double").alias("label"), "split",
                                   array_to_vector(F.col("v")).alias("features")))


def _multi_metrics(pred: DataFrame, model: str) -> DataFrame:
    """Accuracy and soft log loss per split in one grouped pass."""
    p = pred.select("split", "label", "prediction", vector_to_array("probability").alias("probs"))
    p_y = F.element_at(F.col("probs"), F.col("label").cast("int") + 1)
    row = p.groupBy("split").agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        (-F.avg(F.ln(evaluate.clipped(p_y)))).alias("log_loss"))
    m = evaluate.metrics_long(row, ["accuracy", "log_loss"], keep=["split"])
    return m.select(F.lit(model).alias("model"), "split", "metric", "value")


@query("softmax_linear", "I7,F9,F10")
def softmax_linear(spark, d):
    data = _digits(spark, d)
    m = LogisticRegression(family="multinomial", maxIter=50).fit(data.where(F.col("split") == "train"))
    return _multi_metrics(m.transform(data), "softmax_linear")


@query("one_vs_rest", "I7,F10")
def one_vs_rest_q(spark, d):
    """Ten binary fits from the same scans: accuracy over all, and each class's share of found rows."""
    dg = fit.fit_input(split.fraction_split(views.digits(spark, d), split.TRAIN_VALID).select(
        "id", F.col("label").cast("bigint").alias("label"), "split", "v"))
    m = one_vs_rest.fit(dg.where(F.col("split") == "train"), "v", "label", 10)
    hit = dg.select("split", "label", (argmax(m.scores("v")) == F.col("label")).cast("double").alias("hit"))
    per = hit.groupBy("split", F.concat(F.lit("accuracy_class_"), F.col("label")).alias("metric")).agg(F.avg("hit").alias("value"))
    every = hit.groupBy("split").agg(F.avg("hit").alias("value")).select("split", F.lit("accuracy").alias("metric"), "value")
    return every.unionByName(per).select(F.lit("one_vs_rest").alias("model"), "split", "metric", "value")


@query("confusion_fitted", "I24,I7,F13,F14")
def confusion_fitted(spark, d):
    """Held-out confusion shares of a fitted multinomial model."""
    data = _digits(spark, d)
    m = LogisticRegression(family="multinomial", maxIter=50).fit(data.where(F.col("split") == "train"))
    p = m.transform(data.where(F.col("split") == "valid")).select(
        F.col("label").cast("bigint").alias("label"), F.col("prediction").cast("bigint").alias("predicted"))
    return evaluate.confusion_normalised(evaluate.confusion_matrix(p, "label", "predicted", 10))


@query("mlp_classify", "I8,F10")
def mlp_classify(spark, d):
    data = _digits(spark, d)
    m = MultilayerPerceptronClassifier(layers=[64, 100, 100, 10], maxIter=100, seed=42).fit(
        data.where(F.col("split") == "train"))
    return _multi_metrics(m.transform(data), "mlp_100_100")


@query("mlp_weights", "I17,I8")
def mlp_weights_q(spark, d):
    data = _digits(spark, d)
    m = MultilayerPerceptronClassifier(layers=[64, 100, 100, 10], maxIter=100, seed=42).fit(
        data.where(F.col("split") == "train"))
    return fit.mlp_weights(spark, m)


# --------------------------------------------------------------------- text

def _text(spark, d):
    """Reviews as binary multi-hot vectors over the top-k vocabulary."""
    voc, reviews = vocab_and_reviews(spark, d)
    terms = [r["term"] for r in voc.orderBy("pos").collect()]  # k rows, a parameter
    rv = fit.fit_input(split.fraction_split(reviews, split.TRAIN_VALID))
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="features", binary=True)
    return cv.transform(rv), terms


@query("text_logreg", "I10,D9")
def text_logreg(spark, d):
    data, _ = _text(spark, d)
    m = LogisticRegression(maxIter=50).fit(data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "label", "text_logistic")


# Fixed value: the ridge of the fit over all terms, of which there are more than rows in small tables.
FULL_RIDGE = 0.01


def _text_full(spark, d):
    """Reviews as sparse binary vectors over every term of the training rows.

    The vocabulary's size is counted, not set; it and the coefficients, one
    number per term, are what the driver holds.
    """
    rv = fit.fit_input(split.fraction_split(views.reviews(spark, d), split.TRAIN_VALID))
    train = rv.where(F.col("split") == "train")
    n_terms = train.select(F.explode("terms").alias("term")).distinct().count()
    cv = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=max(1, n_terms)).fit(train)
    return cv.transform(rv), cv.vocabulary


@query("text_logreg_full", "I10,D9")
def text_logreg_full(spark, d):
    """As ``text_logreg``, over the whole vocabulary; the 54-term fits are the inline-vocabulary form."""
    data, _ = _text_full(spark, d)
    m = LogisticRegression(maxIter=50, regParam=FULL_RIDGE).fit(data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "label", "text_logistic_full")


@query("text_mlp", "I11,D9")
def text_mlp(spark, d):
    data, terms = _text(spark, d)
    m = MultilayerPerceptronClassifier(layers=[len(terms), 20, 20, 2], maxIter=100, seed=42).fit(
        data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "label", "text_mlp")


#: Columns that all terms are hashed into, for the linear fit and for the network (whose weights grow with them).
HASHED, HASHED_NET = 1 << 14, 1 << 9


def _text_hashed(spark, d, width: int) -> DataFrame:
    """Reviews as vectors of ``width`` columns that every term of a text falls into by a hash: no vocabulary at all."""
    rv = fit.fit_input(split.fraction_split(views.reviews(spark, d), split.TRAIN_VALID))
    whole = rv.withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    return HashingTF(numFeatures=width, binary=True, inputCol="terms", outputCol="features").transform(whole)


@query("text_mlp_hashed", "I11,D12")
def text_mlp_hashed(spark, d):
    """The text network over all terms, by hashed columns."""
    data = _text_hashed(spark, d, HASHED_NET)
    m = MultilayerPerceptronClassifier(layers=[HASHED_NET, 20, 20, 2], maxIter=60, seed=42).fit(
        data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "label", "text_mlp_hashed")


@query("evaluate_text_hashed", "F16,I24,D12")
def evaluate_text_hashed(spark, d):
    """A linear text fit over all terms, by hashed columns, judged on both splits."""
    data = _text_hashed(spark, d, HASHED)
    m = LogisticRegression(maxIter=50, regParam=FULL_RIDGE).fit(data.where(F.col("split") == "train"))
    p = m.transform(data).withColumn("p1", vector_to_array("probability")[1])
    return evaluate.evaluate_binary(p, "p1", "label", groups=["split"])


@query("text_factor_model", "I12,D14")
def text_factor_model(spark, d):
    data, terms = _text(spark, d)
    m = FMClassifier(factorSize=2, maxIter=100, seed=42).fit(data.where(F.col("split") == "train"))
    f = m.factors.toArray()
    rows = [(t, i, float(f[i, 0]), float(f[i, 1]), float(m.linear[i])) for i, t in enumerate(terms)]
    return spark.createDataFrame(rows, "term string, pos long, x double, y double, linear double")


FACTOR_RANK = 8


def _review_blocks(spark, d) -> DataFrame:
    """The labelled documents' terms of both splits, in blocks."""
    return term_blocks.build(split.fraction_split(views.reviews(spark, d), split.TRAIN_VALID), keep=("id", "split", "label"))


def _factors(spark, d):
    rv = _review_blocks(spark, d)
    return rv, term_factors.fit_blocks(rv, FACTOR_RANK, use=F.transform("split", lambda s: s == "train"))


@query("text_factors", "I12,D14", with_views("reviews", body=f"""
select count(distinct term) as n_terms from (select unnest(terms) as term from reviews where {U_SQL} < {sqlf(TRAIN_FRAC)})"""))
def text_factors(spark, d):
    """How many terms have a learned vector: all of the training documents'."""
    _, factors = _factors(spark, d)
    return factors.terms.where(F.size("vector") == FACTOR_RANK).agg(F.count(F.lit(1)).alias("n_terms"))


@query("text_embedded", "I11,I12,D15")
def text_embedded(spark, d):
    """A small network on the documents' mean term vectors; the vectors are learned over the whole vocabulary."""
    rv, factors = _factors(spark, d)
    data = fit.fit_input(term_factors.as_features(factors.embed_blocks(rv, keep=("split", "label"))).select(
        "id", "split", "label", "features"))
    m = MultilayerPerceptronClassifier(layers=[FACTOR_RANK, 16, 2], maxIter=100, seed=42).fit(data.where(F.col("split") == "train"))
    return _cls_metrics(m.transform(data), "label", "text_embedded")


@query("evaluate_text", "F16,I24")
def evaluate_text(spark, d):
    data, _ = _text(spark, d)
    m = LogisticRegression(maxIter=50).fit(data.where(F.col("split") == "train"))
    p = m.transform(data).withColumn("p1", vector_to_array("probability")[1])
    # both splits in one grouped pass
    return evaluate.evaluate_binary(p, "p1", "label", groups=["split"])

