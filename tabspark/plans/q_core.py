"""Queries: scans, splits and row-wise transforms (A, B, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.functions.columns import (
    as_flag, binary_threshold, cap_upper, clip, log_normalize, round6, safe_ratio, vector_scale,
)
from tabspark.operators import split, transform
from tabspark.operators.transform import Step
from tabspark.plans.registry import query, sqlf
from tabspark.plans.sql_views import with_views
from tabspark.session import materialize
from tabspark.sources import views
from tabspark.sources.tables import pack_label_vector, read_table

FEATURES = list(views.EX_FEATURES)
FEAT_SQL = ", ".join(FEATURES)
SEED = split.DEFAULT_SEED
HASH = f"md5('{SEED}-' || id)"
U_SQL = f"cast(('0x' || substr(md5('{SEED}-' || id), 1, 8)) as bigint) / 4294967296.0"
TRAIN_FRAC = split.TRAIN_VALID["train"]


def ex(spark, d):
    return views.ex(spark, d)


def ex_once(spark, d, *cols):
    """Some columns of ``ex``, written once for queries that read them several times."""
    return materialize(ex(spark, d).select(*cols))


def train_rows(spark, d):
    return split.split_of(ex(spark, d), "train", split.TRAIN_VALID)


def is_train():
    return split.split_label(split.TRAIN_VALID) == "train"


TRAIN_SQL = f"select * from ex where {U_SQL} < {sqlf(TRAIN_FRAC)}"


# ------------------------------------------------------------------ A scans

@query("scan_examples", "A1", with_views("ex", body=f"select id, {FEAT_SQL}, net_k, is_high from ex"))
def scan_examples(spark, d):
    return ex(spark, d)


@query("scan_vectors", "A2,C17", with_views(body="""
select vec_id as id, label, cast(generate_subscripts(embedding, 1) - 1 as bigint) as pos,
       cast(unnest(embedding) as double) as x
from embeddings"""))
def scan_vectors(spark, d):
    # Positional columns _c0 (label) .. _c64 (vector), packed back by position.
    emb = read_table(spark, d, "embeddings")
    wide = emb.select(F.col("vec_id"), F.col("label").alias("_c0"),
                      *[F.col("embedding")[i].alias(f"_c{i + 1}") for i in range(64)])
    packed = pack_label_vector(wide, "_c0", [f"_c{i}" for i in range(1, 65)], id_col="vec_id")
    return transform.vector_long(packed, "v", keep=("id", "label"))


@query("terms_table", "A3", with_views("reviews", body="""
select id, cast(len(terms) as bigint) as n_terms, md5(array_to_string(terms, ' ')) as terms_md5, label
from reviews"""))
def terms_table(spark, d):
    r = views.reviews(spark, d)
    return r.select("id", F.size("terms").cast("bigint").alias("n_terms"),
                    F.md5(F.array_join("terms", " ")).alias("terms_md5"), "label")


# ------------------------------------------------------------ B order/split

@query("permute_seeded", "B1", with_views("ex", body=f"""
select id, row_number() over (order by {HASH}, id) as rank from ex"""))
def permute_seeded(spark, d):
    return split.permute(ex(spark, d).select("id"), "id", SEED)


@query("split_train_head", "B2,H2", with_views("ex", body=f"""
select id, {FEAT_SQL}, net_k from ex order by {HASH}, id limit {split.TRAIN_ROWS}"""))
def split_train_head(spark, d):
    return split.head(ex_once(spark, d, "id", *FEATURES, "net_k"), split.TRAIN_ROWS, "id", SEED)


@query("split_valid_tail", "B3", with_views("ex", body=f"""
select id, {FEAT_SQL}, net_k from ex order by {HASH} desc, id desc limit {split.VALID_ROWS}"""))
def split_valid_tail(spark, d):
    return split.tail(ex_once(spark, d, "id", *FEATURES, "net_k"), split.VALID_ROWS, "id", SEED)


@query("split_head_tail", "B2,B3", with_views("ex", ctes=f"""
r as (select id, row_number() over (order by {HASH}, id) as rank, count(*) over () as n from ex)""", body=f"""
select id, 'train' as split from r where rank <= {split.TRAIN_ROWS}
union all select id, 'valid' from r where rank > n - {split.VALID_ROWS}"""))
def split_head_tail(spark, d):
    # The reference's sizes; on fewer than 17000 rows the ends overlap.
    return split.head_tail_split(ex_once(spark, d, "id"), split.TRAIN_ROWS, split.VALID_ROWS, "id", SEED,
                                 allow_overlap=True)


@query("split_slice", "B4", with_views("ex", body=f"""
select id, rank from (select id, row_number() over (order by {HASH}, id) as rank from ex)
where rank > 7500 and rank <= 10000"""))
def split_slice(spark, d):
    return split.slice_rows(ex(spark, d).select("id"), 7500, 10000, "id", SEED)


@query("prefix_cap", "B5,H1", with_views("ex", body=f"select id, {FEAT_SQL} from ex order by id limit 10000"))
def prefix_cap(spark, d):
    return split.prefix(ex_once(spark, d, "id", *FEATURES), 10000)


@query("split_fraction", "B6", with_views("ex", body=f"""
select id, case when {U_SQL} < {sqlf(TRAIN_FRAC)} then 'train' else 'valid' end as split from ex"""))
def split_fraction(spark, d):
    return split.fraction_split(ex(spark, d).select("id"), split.TRAIN_VALID, "id", SEED)


@query("sample_n", "B7,K1", with_views("ex", body="""
select id, gross, net_k from ex order by md5('7-' || id), id limit 300"""))
def sample_n(spark, d):
    return split.sample_n(ex(spark, d).select("id", "gross", "net_k"), 300, "id", seed=7)


# ------------------------------------------------------- C row-wise columns

@query("select_features", "C1", with_views("ex", body=f"select id, total_quantity, gross from ex"))
def select_features(spark, d):
    return transform.select_features(ex(spark, d), ["total_quantity", "gross"])


@query("ratio_feature", "C2", with_views("ex", body="""
select id, total_quantity / nullif(avg_discount, 0) as ratio from ex"""))
def ratio_feature(spark, d):
    return ex(spark, d).select("id", safe_ratio("total_quantity", "avg_discount").alias("ratio"))


@query("scale_target", "C3", with_views("ex", body="select id, gross / 1000.0 as gross_k from ex"))
def scale_target(spark, d):
    return ex(spark, d).select("id", (F.col("gross") / 1000.0).alias("gross_k"))


@query("binary_target", "C4", with_views("ex", body="""
select id, cast(net_k > 265.0 as double) as is_high from ex"""))
def binary_target(spark, d):
    return ex(spark, d).select("id", as_flag(F.col("net_k") > 265.0).alias("is_high"))


@query("cast_float32", "C5", with_views("ex", body="""
select id, cast(price_per_unit as float) as ppu_f32 from ex"""))
def cast_float32(spark, d):
    return ex(spark, d).select("id", F.col("price_per_unit").cast("float").alias("ppu_f32"))


@query("cap_upper", "C6", with_views("ex", body="""
select id, case when price_per_unit is null then null else least(price_per_unit, 5000.0) end as ppu_capped
from ex"""))
def cap_upper_q(spark, d):
    return ex(spark, d).select("id", cap_upper("price_per_unit", 5000.0).alias("ppu_capped"))


@query("clip_range", "C7", with_views("skewed", body="""
select id, case when value is null then null else greatest(least(value, 200.0), 10.0) end as clipped
from skewed"""))
def clip_range(spark, d):
    return views.skewed(spark, d).select("id", clip("value", 10.0, 200.0).alias("clipped"))


def _lin_sql(c: str, src: str = "s") -> str:
    return f"({c} - {src}.{c}__min) / nullif(({src}.{c}__max - {src}.{c}__min) / 2.0, 0) - 1.0 as {c}"


def _minmax_sql(cols) -> str:
    return ", ".join(f"min({c}) as {c}__min, max({c}) as {c}__max" for c in cols)


@query("linear_scale", "C8,E4", with_views("ex", ctes=f"s as (select {_minmax_sql(['price_per_unit'])} from ex)",
                                           body=f"select id, {_lin_sql('price_per_unit')} from ex, s"))
def linear_scale(spark, d):
    return transform.linear_scale(ex(spark, d), ["price_per_unit"])


@query("linear_scale_all", "C9", with_views(
    "ex", ctes=f"tr as ({TRAIN_SQL}), s as (select {_minmax_sql(FEATURES)} from tr)",
    body=f"select id, {', '.join(_lin_sql(c) for c in FEATURES)} from ex, s"))
def linear_scale_all(spark, d):
    # Statistics from the training split only, applied to every row.
    return transform.linear_scale(ex(spark, d), FEATURES, fit_on=is_train())


@query("linear_scale_subset", "C10", with_views(
    "ex", ctes=f"s as (select {_minmax_sql(['total_quantity', 'gross'])} from ex)",
    body=f"select id, {_lin_sql('total_quantity')}, {_lin_sql('gross')} from ex, s"))
def linear_scale_subset(spark, d):
    return transform.linear_scale(ex(spark, d), ["total_quantity", "gross"])


@query("log_normalize", "C11", with_views("skewed", body="""
select id, round(ln(value + 1.0) * 1e6) / 1e6 as log_value from skewed"""))
def log_normalize_q(spark, d):
    return views.skewed(spark, d).select("id", round6(log_normalize("value")).alias("log_value"))


@query("z_score", "C12", with_views("skewed", ctes="s as (select avg(value) m, stddev_samp(value) sd from skewed)",
                                    body="""
select id, round(((value - s.m) / nullif(s.sd, 0)) * 1e6) / 1e6 as z from skewed, s"""))
def z_score(spark, d):
    z = transform.z_score(views.skewed(spark, d), ["value"])
    return z.select("id", round6("value").alias("z"))


@query("binary_threshold", "C13", with_views("skewed", body="""
select id, case when value is null then null when value > 100.0 then 1 else 0 end as above from skewed"""))
def binary_threshold_q(spark, d):
    return views.skewed(spark, d).select("id", binary_threshold("value", 100.0).alias("above"))


# Recipe of C14: log for the skewed money columns, linear for the
# coordinates-like pair, clip-then-linear for the outlier-heavy ratio.
RECIPE = {
    "gross": Step("log"),
    "acctbal": Step("linear"),
    "total_quantity": Step("linear"),
    "n_lines": Step("linear"),
    "price_per_unit": Step("clip_linear", lo=0.0, hi=5000.0),
    "avg_discount": Step("zscore"),
}


def _recipe_sql() -> str:
    stats, out = [], []
    for c, s in RECIPE.items():
        if s.kind == "linear":
            stats.append(f"min({c}) as {c}__min, max({c}) as {c}__max")
            out.append(_lin_sql(c))
        elif s.kind == "clip_linear":
            x = f"greatest(least({c}, {sqlf(s.hi)}), {sqlf(s.lo)})"
            stats.append(f"min({x}) as {c}__min, max({x}) as {c}__max")
            out.append(f"({x} - s.{c}__min) / nullif((s.{c}__max - s.{c}__min) / 2.0, 0) - 1.0 as {c}")
        elif s.kind == "zscore":
            stats.append(f"avg({c}) as {c}__mean, stddev_samp({c}) as {c}__std")
            out.append(f"round((({c} - s.{c}__mean) / nullif(s.{c}__std, 0)) * 1e6) / 1e6 as {c}")
        elif s.kind == "log":
            out.append(f"round(ln({c} + 1.0) * 1e6) / 1e6 as {c}")
    return with_views("ex", ctes=f"tr as ({TRAIN_SQL}), s as (select {', '.join(stats)} from tr)",
                      body=f"select id, {', '.join(out)} from ex, s")


@query("normalize_recipe", "C14", _recipe_sql())
def normalize_recipe(spark, d):
    n = transform.normalize(ex(spark, d), RECIPE, fit_on=is_train())
    return n.select("id", *[round6(c).alias(c) if RECIPE[c].kind in ("log", "zscore") else F.col(c)
                            for c in RECIPE])


@query("abs_distance", "C15", with_views("ex", body="select id, abs(total_quantity - 100.0) as dist_100 from ex"))
def abs_distance(spark, d):
    return ex(spark, d).select("id", F.abs(F.col("total_quantity") - 100.0).alias("dist_100"))


@query("vector_scale", "C16", with_views("digits", body="""
select id, cast(generate_subscripts(v, 1) - 1 as bigint) as pos, cast(unnest(v) as double) / 255.0 as x
from digits"""))
def vector_scale_q(spark, d):
    dg = views.digits(spark, d).select("id", vector_scale("v", 255.0).alias("v"))
    return transform.vector_long(dg, "v")


@query("label_vector_split", "C17", with_views("digits", body="""
select id, label, cast(len(v) as bigint) as dims, cast(v[1] as double) as first, cast(v[len(v)] as double) as last
from digits"""))
def label_vector_split(spark, d):
    emb = read_table(spark, d, "embeddings")
    wide = emb.select(F.col("vec_id"), F.col("label").alias("_c0"),
                      *[F.col("embedding")[i].alias(f"_c{i + 1}") for i in range(64)])
    p = pack_label_vector(wide, "_c0", [f"_c{i}" for i in range(1, 65)], id_col="vec_id")
    return p.select("id", "label", F.size("v").cast("bigint").alias("dims"),
                    F.element_at("v", 1).alias("first"), F.element_at("v", -1).alias("last"))


@query("max_ratio", "C18", with_views("ex", ctes="s as (select max(gross) mx from ex)",
                                      body="select id, gross / nullif(s.mx, 0) as gross_share from ex, s"))
def max_ratio(spark, d):
    return transform.max_ratio(ex(spark, d), "gross", out="gross_share")


@query("vector_grid", "C19", with_views("digits", body="""
select id, cast((generate_subscripts(v, 1) - 1) // 8 as bigint) as row,
       cast((generate_subscripts(v, 1) - 1) % 8 as bigint) as col, cast(unnest(v) as double) as value
from digits"""))
def vector_grid(spark, d):
    return transform.vector_grid(views.digits(spark, d), "v", 8)
