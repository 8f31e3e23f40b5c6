"""Document quality by co-training on two views.

View one is the text (shares of kinds of characters, word lengths,
repetition), view two the page's metadata (language, source, length as
recorded). Each view has a logistic model (MLlib) fitted on labelled rows.
In every round each model scores all documents; the ones it is surest of
become pseudo-labelled training rows of the other model, at most
``per_round`` of a class, by falling confidence; documents with equal views
are one such row, however many copies there are. Afterwards each view is
calibrated on labelled rows that no fit has seen (a line through the
logits), and the views are combined as independent evidence: calibrated
logits add up, the prior counts once.

Labelled rows are taken up to ``max_labelled`` (see bounded_labels), pseudo
labels are bounded by rounds x per_round; features, scores and the choice of
pseudo labels cover all documents. Features are written once, and every
later step reads them instead of the texts.

Defined cases
* null or empty text: all text features are 0; null metadata add nothing to the second view.
* a label that is null or not 0/1, or whose id is null, is ignored; without labels of both
  classes every score is the share of label 1 (0.5 without labels).
* ids that repeat: every row is scored by its own columns; a label counts for each of its id's rows.
* ties in confidence are broken by a hash of the views; an empty table gives an empty table.
* other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import bounded_labels, output_type, record_batch, stored
from tabspark.llm.text import Words, utf8
from tabspark.llm.toxicity import logistic

_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" \t\r", "line": b"\n",
            "shout": b"!?", "mark": b"#$%&*@^~+=<>", "bar": b"|", "stop": b".,;:", "other": range(128, 256)}


def text_features(column: pa.Array) -> np.ndarray:
    """(rows, features); square roots of shares, so that small shares count."""
    data, offsets = utf8(column)
    n = np.maximum(np.diff(offsets), 1).astype(np.float64)
    histogram = np.array([np.bincount(data[a:b], minlength=256) for a, b in zip(offsets[:-1], offsets[1:], strict=True)],
                         np.float64).reshape(-1, 256)
    count = {k: histogram[:, list(v)].sum(axis=1) for k, v in _CLASSES.items()}
    letters = np.maximum(count["upper"] + count["lower"] + count["other"], 1)
    words = Words(column)
    n_words = np.diff(words.first)
    per_word = np.maximum(n_words, 1)
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    repeats = np.bincount(words.row[again], minlength=len(n))
    distinct = np.array([len(np.unique(words.hash[a:b])) for a, b in zip(words.first[:-1], words.first[1:], strict=True)])
    length = np.bincount(words.row, weights=words.end - words.start, minlength=len(n))
    return np.stack([
        np.log1p(n_words) / 5, length / per_word / 5, np.sqrt(count["upper"] / letters), np.sqrt(count["digit"] / n),
        count["space"] / n, np.sqrt(count["line"] / n), np.sqrt(count["shout"] / n), np.sqrt(count["mark"] / n),
        np.sqrt(count["bar"] / n), np.sqrt(count["stop"] / n), count["other"] / n, distinct / per_word,
        np.sqrt(repeats / per_word), (n_words < 8) * 1.0], 1)


def _features(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                            pa.array(x.ravel()))
            yield record_batch(schema, batch.column(0), flat, *batch.columns[2:])

    return run


def features(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, size_col: str) -> DataFrame:
    """``id, kind, text_view, meta_view`` of every document, written once; rows of one kind have equal views."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("size", T.StringType())])
    size = F.floor(F.log2(F.col(size_col) + 1)).cast("string")
    own = docs.select(F.col(id_col), F.col(text_col).cast("string"), F.col(lang_col).cast("string"),
                      F.col(source_col).cast("string"), size)
    rows = stored(own.mapInArrow(_features(output_type(schema)), schema))
    hasher = FeatureHasher(inputCols=["lang", "source", "size"], outputCol="meta_view", numFeatures=256)
    kind = F.xxhash64("x", "lang", "source", "size")
    return hasher.transform(rows).select("id", kind.alias("kind"), array_to_vector("x").alias("text_view"), "meta_view")


VIEWS = ("text_view", "meta_view")


def fit_view(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol=view, labelCol="label", regParam=1e-3, maxIter=25,
                              probabilityCol=f"{view}_p", rawPredictionCol=f"{view}_raw",
                              predictionCol=f"{view}_y").fit(rows)


def logit_of(model: LogisticRegressionModel, rows: DataFrame, view: str) -> DataFrame:
    """``rows`` with ``<view>_z``, the model's logit of label 1."""
    drop = [f"{view}_p", f"{view}_raw", f"{view}_y"]
    return model.transform(rows).withColumn(f"{view}_z", vector_to_array(f"{view}_raw")[1]).drop(*drop)


def surest(scored: DataFrame, view: str, label: int, threshold: float, n: int) -> DataFrame:
    """The n rows a view is surest of to have the label, if its logit reaches the threshold."""
    z = F.col(f"{view}_z")
    sure = z >= threshold if label else z <= -threshold
    return (scored.where(sure).orderBy(z.desc() if label else z.asc(), "kind").limit(n)
            .select(*VIEWS, F.lit(float(label)).alias("label")))


def co_train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source", size_col: str = "n_chars", label_col: str = "quality",
             calibrate: Column | None = None, max_labelled: int = 30_000, rounds: int = 2, per_round: int = 1000,
             confidence: float = 0.95) -> DataFrame:
    """``id, score, text_score, meta_score`` of every row of ``docs``.

    ``labels`` has ``id_col`` and ``label_col``. ``calibrate`` is a condition
    on ``labels`` for the rows kept for calibration (default: a fifth by hash).
    """
    rows = features(docs, id_col, text_col, lang_col, source_col, size_col)
    if calibrate is None:
        calibrate = F.pmod(F.xxhash64(id_col), F.lit(5)) == 0
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"), calibrate.alias("calibrate"))
    own = bounded_labels(own, "id", max_labelled)
    known = stored(rows.join(F.broadcast(own), "id"))
    counts = {(r["calibrate"], r["label"]): r["n"] for r in known.groupBy("calibrate", "label").agg(
        F.count("*").alias("n")).collect()}
    ones, all_rows = sum(n for (_, y), n in counts.items() if y), sum(counts.values())
    prior = ones / all_rows if all_rows else 0.5
    if any(not counts.get((c, y)) for c in (False, True) for y in (0.0, 1.0)):
        return rows.select("id", *[F.lit(prior).alias(c) for c in ("score", "text_score", "meta_score")])
    base = math.log(prior / (1 - prior))
    train = {v: known.where("not calibrate").select(*VIEWS, "label") for v in VIEWS}
    models = {v: fit_view(train[v], v) for v in VIEWS}
    # Labelled rows keep their labels: pseudo labels go to the others, one for each kind, so that no group of copies fills a round.
    others = stored(rows.join(F.broadcast(own.select("id")), "id", "left_anti").groupBy("kind")
                    .agg(*[F.first(v).alias(v) for v in VIEWS]))
    threshold = math.log(confidence / (1 - confidence))
    for _ in range(rounds):
        scored = others
        for v in VIEWS:
            scored = logit_of(models[v], scored, v)
        new = {v: stored(surest(scored, v, 1, threshold + max(base, 0), per_round)
                         .unionByName(surest(scored, v, 0, threshold + max(-base, 0), per_round))) for v in VIEWS}
        for v, other in (VIEWS, VIEWS[::-1]):
            train[v] = train[v].unionByName(new[other])
        models = {v: fit_view(train[v], v) for v in VIEWS}
    held = known.where("calibrate")
    for v in VIEWS:
        held, rows = logit_of(models[v], held, v), logit_of(models[v], rows, v)
    # The line through a view's logits: binned, so the driver gets a few hundred rows.
    score = {}
    for v in VIEWS:
        z = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.col(f"{v}_z")))
        points = held.groupBy(F.round(z * 4).alias("bin"), "label").agg(F.count("*").alias("n")).collect()
        slope, offset = logistic([(r["bin"] / 4, int(r["label"]), r["n"]) for r in sorted(points)], ridge=1.0)
        score[v] = z * slope + offset
    p = lambda z: 1 / (1 + F.exp(-z))
    return rows.select("id", p(score[VIEWS[0]] + score[VIEWS[1]] - base).alias("score"),
                       p(score[VIEWS[0]]).alias("text_score"), p(score[VIEWS[1]]).alias("meta_score"))
