"""Queries: profiles and evaluation metrics on fixed closed-form scores (F, H3, A7, I16, I24, K1).

Metrics are checked apart from any fit: the scores below are fixed
formulas both engines evaluate bit for bit (division, not ``exp``, for
anything that is grouped or ranked).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tabspark.functions.columns import argmax, linear_scores, round6, sigmoid
from tabspark.operators import evaluate, profile, profile_state, quantile, split, transform
from tabspark.plans.q_core import FEATURES, U_SQL, ex
from tabspark.plans.q_encode import FIXED_PRED_SQL, _quantile_ctes, fixed_pred_k
from tabspark.plans.registry import query, sqlf
from tabspark.plans.sql_views import with_views
from tabspark.session import materialize
from tabspark.sources import views

# The closed-form scores the metric checks use.
PROB_SCALE = 280000.0          # gross at which the fixed probability is 0.5
CALIB_BOUNDS = [i / 10 for i in range(1, 10)]
PROFILE_COLS = FEATURES + ["net_k"]
CORR_COLS = PROFILE_COLS


def fixed_prob(gross="gross"):
    return F.col(gross) / (F.col(gross) + F.lit(PROB_SCALE))


PROB_SQL = f"gross / (gross + {PROB_SCALE})"


def scored_binary(spark, d):
    return ex(spark, d).select("id", fixed_prob().alias("probability"), F.col("is_high").alias("label"))


SCORED_BIN = f"sb as (select id, {PROB_SQL} as probability, is_high as label from ex)"


def scored_reg(spark, d):
    return ex(spark, d).select("id", fixed_pred_k().alias("prediction"), F.col("net_k").alias("label"))


SCORED_REG = f"sr as (select id, {FIXED_PRED_SQL} as prediction, net_k as label from ex)"


# A fixed class score over the whole vector: weight of position j for class c by rule, to three decimals.
N_POS, N_CLASSES = 64, 10
DIGIT_W = [[round(math.cos((j + 1) * (c + 1)), 3) for j in range(N_POS)] for c in range(N_CLASSES)]


def digit_scores(spark, d):
    """Class scores of a fixed linear model over all vector entries; predicted = arg-max."""
    dg = views.digits(spark, d)
    s = linear_scores("v", DIGIT_W)
    return dg.select("id", F.col("label").cast("bigint").alias("label"), s.alias("scores")).withColumn(
        "predicted", argmax("scores"))


_SCORES_SQL = ", ".join("(" + " + ".join(f"v[{j + 1}] * {sqlf(w)}" for j, w in enumerate(ws)) + ")" for ws in DIGIT_W)
DIGIT_SC = f"""dv as (select id, cast(label as bigint) as label, [{_SCORES_SQL}] as scores from digits),
ds as (select *, cast(list_position(scores, list_max(scores)) - 1 as bigint) as predicted from dv)"""


# ----------------------------------------------------------------- profiles

def _describe_sql() -> str:
    stats = " union all ".join(
        f"select '{c}' as feature, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std,"
        f" cast(min({c}) as double) as min, cast(max({c}) as double) as max from ex" for c in PROFILE_COLS)
    body = f"""select s.feature, s.count, round(s.mean * 1e6) / 1e6 as mean, round(s.std * 1e6) / 1e6 as std, s.min,
       max(case when q.idx = 0 then q.value end) as p25, max(case when q.idx = 1 then q.value end) as p50,
       max(case when q.idx = 2 then q.value end) as p75, s.max
from ({stats}) s left join qd q on q.feature = s.feature
group by s.feature, s.count, s.mean, s.std, s.min, s.max"""
    return with_views("ex", ctes=_quantile_ctes("ex", PROFILE_COLS, [0.25, 0.5, 0.75]), body=body)


@query("describe_table", "F1", _describe_sql())
def describe_table(spark, d):
    dsc = profile.describe(ex(spark, d), PROFILE_COLS)
    return dsc.select("feature", "count", round6("mean").alias("mean"), round6("std").alias("std"),
                      "min", "p25", "p50", "p75", "max")


@query("min_max_range", "F2", with_views("ex", body=" union all ".join(
    f"select '{c}' as feature, cast(min({c}) as double) as min, cast(max({c}) as double) as max,"
    f" cast(max({c}) as double) - cast(min({c}) as double) as range from ex" for c in PROFILE_COLS)))
def min_max_range(spark, d):
    return profile.min_max_range(ex(spark, d), PROFILE_COLS)


def _corr_sql() -> str:
    rows = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            if i == j:
                rows.append(f"select '{a}' as col_a, '{b}' as col_b, 1.0::double as r")
            else:
                x, y = (a, b) if i < j else (b, a)
                rows.append(f"select '{a}' as col_a, '{b}' as col_b, round(corr({x}, {y}) * 1e6) / 1e6 as r from ex")
    return with_views("ex", body=" union all ".join(rows))


@query("corr_matrix", "F3", _corr_sql())
def corr_matrix(spark, d):
    c = profile.corr_matrix(ex(spark, d), CORR_COLS)
    return c.select("col_a", "col_b", round6("r").alias("r"))


def _merged_state(spark, d):
    """The profile state of eight parts of the examples, each computed apart, kept and merged."""
    parts = profile_state.states(ex(spark, d), PROFILE_COLS, F.pmod(F.col("id"), F.lit(8)))
    return profile_state.merge(materialize(parts))


@query("describe_merged", "F1,F2", with_views("ex", body=" union all ".join(
    f"select '{c}' as feature, count({c}) as count, round(avg({c}) * 1e6) / 1e6 as mean, round(stddev_samp({c}) * 1e6) / 1e6 as std,"
    f" cast(min({c}) as double) as min, cast(max({c}) as double) as max, cast(max({c}) as double) - cast(min({c}) as double) as range"
    f" from ex" for c in PROFILE_COLS)))
def describe_merged(spark, d):
    return profile_state.describe(_merged_state(spark, d)).select(
        "feature", "count", round6("mean").alias("mean"), round6("std").alias("std"), "min", "max", "range")


@query("corr_merged", "F3", _corr_sql())
def corr_merged(spark, d):
    return profile_state.corr(_merged_state(spark, d)).select("col_a", "col_b", round6("r").alias("r"))


@query("histogram", "F4", with_views("skewed", ctes="""
s as (select min(value) lo, max(value) hi, (max(value) - min(value)) / 10.0 as w from skewed),
c as (select coalesce(cast(least(floor((value - s.lo) / nullif(s.w, 0)), 9) as bigint), 0) as bin, count(*) as n
      from skewed, s where value is not null group by 1)""", body="""
select g.range as bin, s.lo + g.range * s.w as lo, s.lo + (g.range + 1) * s.w as hi, coalesce(c.n, 0) as n
from range(10) g cross join s left join c on c.bin = g.range"""))
def histogram(spark, d):
    return profile.histogram(views.skewed(spark, d), "value", 10)


@query("nonzero_profile", "F5", with_views("digits", body="""
select pos, cast(sum(case when x <> 0 then 1 else 0 end) as bigint) as nonzero, count(*) as n
from (select cast(generate_subscripts(v, 1) - 1 as bigint) as pos, unnest(v) as x from digits) group by pos"""))
def nonzero_profile(spark, d):
    return profile.nonzero_by_position(views.digits(spark, d), "v")


# ---------------------------------------------------------------- regression

@query("rmse", "F6", with_views("ex", ctes=SCORED_REG, body="""
select round(sqrt(avg(power(prediction - label, 2))) * 1e6) / 1e6 as rmse, count(*) as n from sr"""))
def rmse_q(spark, d):
    r = evaluate.rmse(scored_reg(spark, d))
    return r.select(round6("rmse").alias("rmse"), "n")


@query("rmse_vs_range", "F7", with_views("ex", ctes=SCORED_REG, body="""
select min(label) as min, max(label) as max, max(label) - min(label) as range,
       round(sqrt(avg(power(prediction - label, 2))) * 1e6) / 1e6 as rmse,
       round(sqrt(avg(power(prediction - label, 2))) / nullif(max(label) - min(label), 0) * 1e6) / 1e6 as rmse_over_range
from sr"""))
def rmse_vs_range(spark, d):
    r = evaluate.rmse_vs_range(scored_reg(spark, d))
    return r.select("min", "max", "range", round6("rmse").alias("rmse"), round6("rmse_over_range").alias("rmse_over_range"))


@query("generalisation_gap", "F17", with_views("ex", ctes=SCORED_REG + f""",
m as (select case when {U_SQL} < {sqlf(split.TRAIN_VALID['train'])} then 'train' else 'valid' end as split,
             sqrt(avg(power(prediction - label, 2))) as rmse from sr group by 1)""", body="""
select round(t.rmse * 1e6) / 1e6 as rmse_train, round(v.rmse * 1e6) / 1e6 as rmse_valid,
       round((v.rmse - t.rmse) * 1e6) / 1e6 as gap
from m t, m v where t.split = 'train' and v.split = 'valid'"""))
def generalisation_gap(spark, d):
    s = split.fraction_split(scored_reg(spark, d), split.TRAIN_VALID)
    g = evaluate.generalisation_gap(evaluate.rmse(s, groups=["split"]))
    return g.select(round6("rmse_train").alias("rmse_train"), round6("rmse_valid").alias("rmse_valid"),
                    round6("gap").alias("gap"))


@query("metrics_long", "A6,A7,S2", with_views("ex", ctes=SCORED_REG + f""",
sp as (select *, case when {U_SQL} < {sqlf(split.TRAIN_VALID['train'])} then 'train' else 'valid' end as split from sr)""",
                                              body="""
select split, metric, value from (
  select split, 'rmse' as metric, round(sqrt(avg(power(prediction - label, 2))) * 1e6) / 1e6 as value from sp group by split
  union all select split, 'n', cast(count(*) as double) from sp group by split
  union all select split, 'mean_label', round(avg(label) * 1e6) / 1e6 from sp group by split)"""))
def metrics_long(spark, d):
    # every split's metrics row in one grouped pass, then wide -> long
    s = split.fraction_split(scored_reg(spark, d), split.TRAIN_VALID)
    wide = s.groupBy("split").agg(round6(F.sqrt(evaluate.mse_expr("prediction", "label"))).alias("rmse"),
                                  F.count(F.lit(1)).cast("double").alias("n"),
                                  round6(F.avg("label")).alias("mean_label"))
    return evaluate.metrics_long(wide, ["rmse", "n", "mean_label"], keep=["split"])


# ------------------------------------------------------------------ binary

@query("log_loss", "F8", with_views("ex", ctes=SCORED_BIN, body="""
select round(-avg(label * ln(greatest(least(probability, 1 - 1e-15), 1e-15))
              + (1.0 - label) * ln(1.0 - greatest(least(probability, 1 - 1e-15), 1e-15))) * 1e6) / 1e6 as log_loss,
       count(*) as n from sb"""))
def log_loss_q(spark, d):
    r = evaluate.log_loss(scored_binary(spark, d))
    return r.select(round6("log_loss").alias("log_loss"), "n")


@query("auc_exact", "F11", with_views("ex", ctes=SCORED_BIN + """,
c as (select probability as score, sum(case when label > 0 then 1 else 0 end) as pos,
             sum(case when label > 0 then 0 else 1 end) as neg from sb group by probability),
cu as (select *, sum(neg) over (order by score rows between unbounded preceding and current row) as cum_neg from c)""",
                                        body="""
select sum(cast(pos as double) * (cast(cum_neg as double) - cast(neg as double) / 2.0))
         / (cast(sum(pos) as double) * cast(sum(neg) as double)) as auc,
       cast(sum(pos) as bigint) as positives, cast(sum(neg) as bigint) as negatives from cu"""))
def auc_exact(spark, d):
    return evaluate.auc(scored_binary(spark, d))


@query("roc_curve", "F12", with_views("ex", ctes=SCORED_BIN + """,
c as (select probability as score, sum(case when label > 0 then 1 else 0 end) as pos,
             sum(case when label > 0 then 0 else 1 end) as neg from sb group by probability),
t as (select sum(pos) as tp, sum(neg) as tn from c)""", body="""
select 'inf'::double as threshold, 0.0::double as fpr, 0.0::double as tpr
union all
select score, cast(sum(neg) over (order by score desc rows between unbounded preceding and current row) as double) / t.tn,
       cast(sum(pos) over (order by score desc rows between unbounded preceding and current row) as double) / t.tp
from c, t"""))
def roc_curve(spark, d):
    return evaluate.roc_curve(scored_binary(spark, d))


@query("evaluate_binary", "F16,F10", with_views("ex", ctes=SCORED_BIN + """,
p as (select *, cast(probability >= 0.5 as double) as yhat,
             greatest(least(probability, 1 - 1e-15), 1e-15) as pc from sb)""", body="""
select count(*) as n, round(avg(cast(yhat = label as double)) * 1e6) / 1e6 as accuracy,
       round(greatest(avg(label), 1.0 - avg(label)) * 1e6) / 1e6 as baseline_accuracy,
       round(cast(sum(case when yhat = 1 and label = 1 then 1 else 0 end) as double)
             / nullif(cast(sum(case when yhat = 1 then 1 else 0 end) as double), 0) * 1e6) / 1e6 as precision,
       round(cast(sum(case when yhat = 1 and label = 1 then 1 else 0 end) as double)
             / nullif(cast(sum(case when label = 1 then 1 else 0 end) as double), 0) * 1e6) / 1e6 as recall,
       round(avg(label) * 1e6) / 1e6 as label_mean, round(avg(probability) * 1e6) / 1e6 as prediction_mean,
       round(-avg(label * ln(pc) + (1.0 - label) * ln(1.0 - pc)) * 1e6) / 1e6 as log_loss
from p"""))
def evaluate_binary(spark, d):
    r = evaluate.evaluate_binary(scored_binary(spark, d))
    return r.select("n", *[round6(c).alias(c) for c in
                           ["accuracy", "baseline_accuracy", "precision", "recall", "label_mean",
                            "prediction_mean", "log_loss"]])


DECILES = [i / 10 for i in range(1, 10)]


@query("calibration_bins", "F18", with_views("ex", ctes=SCORED_BIN + """,
sp as materialized (select probability from sb),
""" + _quantile_ctes("sp", ["probability"], DECILES) + """,
b as materialized (select list(value order by idx) as bounds from qd)""", body="""
select cast(len(list_filter((select bounds from b), lambda x: x <= probability)) as bigint) as bin,
       count(*) as n, round(avg(probability) * 1e6) / 1e6 as mean_score, round(avg(label) * 1e6) / 1e6 as mean_label
from sb group by 1"""))
def calibration_bins(spark, d):
    """Predicted against observed rate in each decile of the score."""
    scored = materialize(scored_binary(spark, d))
    bounds = quantile.quantiles(scored, {"probability": DECILES}, stored=True).orderBy("idx").collect()  # nine rows
    c = evaluate.calibration_bins(scored, "probability", "label", [r["value"] for r in bounds])
    return c.select("bin", "n", round6("mean_score").alias("mean_score"), round6("mean_label").alias("mean_label"))


@query("calibration_fixed", "F18", with_views("ex", ctes=SCORED_BIN, body=f"""
select cast(len(list_filter([{', '.join(sqlf(b) for b in CALIB_BOUNDS)}], lambda x: x <= probability)) as bigint) as bin,
       count(*) as n, round(avg(probability) * 1e6) / 1e6 as mean_score, round(avg(label) * 1e6) / 1e6 as mean_label
from sb group by 1"""))
def calibration_fixed(spark, d):
    c = evaluate.calibration_bins(scored_binary(spark, d), "probability", "label", CALIB_BOUNDS)
    return c.select("bin", "n", round6("mean_score").alias("mean_score"), round6("mean_label").alias("mean_label"))


# ------------------------------------------------------------- multi-class

@query("argmax_class", "H3", with_views("digits", ctes=DIGIT_SC, body="select id, predicted as class_id from ds"))
def argmax_class(spark, d):
    return evaluate.argmax_class(digit_scores(spark, d).select("id", F.col("scores").alias("s")), "s")


CM_SQL = DIGIT_SC + """,
cnt as (select label, predicted, count(*) as n from ds group by 1, 2),
cm as (select l.range as label, p.range as predicted, coalesce(cnt.n, 0) as n
       from range(10) l cross join range(10) p left join cnt on cnt.label = l.range and cnt.predicted = p.range)"""


def _cm(spark, d):
    return evaluate.confusion_matrix(digit_scores(spark, d), "label", "predicted", 10)


@query("confusion_matrix", "F13", with_views("digits", ctes=CM_SQL, body="select label, predicted, n from cm"))
def confusion_matrix(spark, d):
    return _cm(spark, d)


@query("confusion_normalised", "F14,K3", with_views("digits", ctes=CM_SQL, body="""
select label, predicted, n, cast(n as double) / nullif(cast(sum(n) over (partition by label) as double), 0) as share from cm"""))
def confusion_normalised(spark, d):
    return evaluate.confusion_normalised(_cm(spark, d))


@query("confused_pairs", "F15", with_views("digits", ctes=CM_SQL, body="""
select label, predicted, n from cm where label <> predicted and n > 0 order by n desc, label, predicted limit 5"""))
def confused_pairs(spark, d):
    return evaluate.confused_pairs(_cm(spark, d), 5)


@query("log_loss_multi", "F9", with_views("digits", ctes=DIGIT_SC + """,
sm as (select id, label, predicted, list_transform(scores, lambda x: exp(x)) as e from ds),
py as (select label, predicted, e[label + 1] / list_sum(e) as p_soft from sm)""", body="""
select 'soft' as mode, round(-avg(ln(greatest(least(p_soft, 1 - 1e-15), 1e-15))) * 1e6) / 1e6 as log_loss, count(*) as n from py
union all
select 'hard', round(-avg(ln(greatest(least(case when predicted = label then 1.0 else 0.0 end, 1 - 1e-15), 1e-15))) * 1e6) / 1e6,
       count(*) from py"""))
def log_loss_multi(spark, d):
    ds = digit_scores(spark, d)
    e = F.transform("scores", lambda x: F.exp(x.cast("double")))
    soft = F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
    probs = ds.select("label", soft.alias("p"))
    out = None
    for mode in ("soft", "hard"):
        r = evaluate.log_loss_multi(probs, "p", "label", mode).select(
            F.lit(mode).alias("mode"), round6("log_loss").alias("log_loss"), "n")
        out = r if out is None else out.unionByName(r)
    return out


@query("accuracy", "F10", with_views("ex", "digits", ctes=SCORED_BIN + ",\n" + DIGIT_SC, body="""
select 'binary' as task, round(avg(cast(cast(probability >= 0.5 as double) = label as double)) * 1e6) / 1e6 as accuracy,
       count(*) as n from sb
union all
select 'multiclass', round(avg(cast(predicted = label as double)) * 1e6) / 1e6, count(*) from ds"""))
def accuracy(spark, d):
    b = scored_binary(spark, d).select(evaluate.threshold("probability").alias("prediction"), "label")
    m = digit_scores(spark, d).select(F.col("predicted").alias("prediction"), "label")
    rb = evaluate.accuracy(b).select(F.lit("binary").alias("task"), round6("accuracy").alias("accuracy"), "n")
    rm = evaluate.accuracy(m).select(F.lit("multiclass").alias("task"), round6("accuracy").alias("accuracy"), "n")
    return rb.unionByName(rm)


# ------------------------------------------------------- scoring / holdout

# Fixed weights on the linearly scaled features (I16).
FIXED_W = {"total_quantity": 40.0, "gross": 300.0, "acctbal": 2.0}
FIXED_B = 320.0


def _scaled_sql():
    mm = ", ".join(f"min({c}) as {c}__min, max({c}) as {c}__max" for c in FIXED_W)
    lin = ", ".join(f"({c} - s.{c}__min) / nullif((s.{c}__max - s.{c}__min) / 2.0, 0) - 1.0 as {c}" for c in FIXED_W)
    z = " + ".join(f"{sqlf(w)} * {c}" for c, w in FIXED_W.items()) + f" + {sqlf(FIXED_B)}"
    return f"s as (select {mm} from ex), sc as (select id, {lin} from ex, s), z as (select id, {z} as z from sc)"


def _z(spark, d):
    sc = transform.linear_scale(ex(spark, d), list(FIXED_W))
    z = None
    for c, w in FIXED_W.items():
        t = F.lit(w) * F.col(c)
        z = t if z is None else z + t
    return sc.select("id", (z + F.lit(FIXED_B)).alias("z"))


@query("score_linear", "I16", with_views("ex", ctes=_scaled_sql(), body="select id, z as prediction from z"))
def score_linear(spark, d):
    return _z(spark, d).select("id", F.col("z").alias("prediction"))


@query("score_logistic", "I16", with_views("ex", ctes=_scaled_sql(), body="""
select id, round(1.0 / (1.0 + exp(-((z - 320.0) / 100.0))) * 1e6) / 1e6 as probability from z"""))
def score_logistic(spark, d):
    z = _z(spark, d)
    return z.select("id", round6(sigmoid((F.col("z") - 320.0) / 100.0)).alias("probability"))


def _split3_sql():
    a = split.TRAIN_VALID_TEST["train"]
    b = a + split.TRAIN_VALID_TEST["valid"]
    return (f"case when {U_SQL} < {sqlf(a)} then 'train' when {U_SQL} < {sqlf(b)} then 'valid' else 'test' end")


@query("holdout_eval", "I24,B12", with_views("ex", body=f"""
select count(*) as n, round(sqrt(avg(power({FIXED_PRED_SQL} - net_k, 2))) * 1e6) / 1e6 as rmse,
       round(avg(cast(cast({PROB_SQL} >= 0.5 as double) = is_high as double)) * 1e6) / 1e6 as accuracy
from ex where {_split3_sql()} = 'test'"""))
def holdout_eval(spark, d):
    e = ex(spark, d)
    test = split.split_of(e, "test", split.TRAIN_VALID_TEST)
    s = test.select(fixed_pred_k().alias("prediction"), F.col("net_k").alias("label"),
                    evaluate.threshold(fixed_prob()).alias("yhat"), "is_high")
    return s.agg(F.count(F.lit(1)).alias("n"), round6(F.sqrt(evaluate.mse_expr("prediction", "label"))).alias("rmse"),
                 round6(F.avg((F.col("yhat") == F.col("is_high")).cast("double"))).alias("accuracy"))


@query("scatter_sample", "K1,C18", with_views("ex", ctes="""
smp as (select id, gross, net_k from ex order by md5('7-' || id), id limit 300)""", body="""
select id, gross as x, net_k as y, net_k / nullif((select max(net_k) from smp), 0) as colour from smp"""))
def scatter_sample(spark, d):
    smp = split.sample_n(ex(spark, d).select("id", "gross", "net_k"), 300, "id", seed=7)
    c = transform.max_ratio(smp, "net_k", keep=("id", "gross", "net_k"), out="colour")
    return c.select("id", F.col("gross").alias("x"), F.col("net_k").alias("y"), "colour")
