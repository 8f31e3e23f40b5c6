"""Near-duplicate vectors: an epsilon grid order join on cosine similarity.

Unit vectors whose cosine is at least c are at most eps = sqrt(2 - 2c)
apart. Vectors are turned to their principal axes, sorted by the cells of a
grid of width eps on the leading axes, and cut into blocks of consecutive
vectors. Intervals of the sequence are joined recursively, level by level:
a pair of intervals goes on to its parts' pairs only if the boxes around
them (leading axes, and the norm of the rest) are at most eps apart. What
is left are pairs of blocks; parts of them whose caps on the sphere are too far
apart are skipped, the others' vectors are compared by matrix products in
double precision.

Equal vectors are one node with a weight, so a group of copies costs its
distinct vectors only; a block pair returns a degree and a local
representative per vector, never its links one by one.

Defined cases
* null or empty vectors, zero vectors, and those with null or non-finite components link with nothing.
* vectors of different lengths don't link; a null id links with nothing and is not kept.
* repeated rows count as vectors of their own; the component is the smallest id.
* an id that repeats with other vectors: each row has its own vector's links and component.
* an empty table gives an empty table; columns besides id and vector are dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.graph import components
from tabspark.llm.tasks import output_type, record_batch, stored

#: Leading axes of the grid and the boxes; vectors in a block; how many parts an interval has (a power of two).
AXES, BLOCK, PARTS_LOG2 = 8, 2048, 3
#: Vectors in a part of a block.
PART = 256
#: Box distances come from turned coordinates; this much is allowed for their rounding.
SLACK = 1e-6


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision, without overflow."""
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def usable(vector: np.ndarray) -> bool:
    return len(vector) > 0 and bool(np.isfinite(vector).all()) and bool(vector.any())


_ROWS = [("node", T.BinaryType()), ("dim", T.IntegerType()), ("vec", T.BinaryType())]


def _read(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # null: not a number; -0: 0
            size = np.nan_to_num(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.float64)).astype(int)
            ends = np.cumsum(size)
            out: list[list] = [[], [], []]
            for i, (n, e) in enumerate(zip(size, ends, strict=True)):
                v = flat[e - n:e]
                ok = usable(v) and batch.column(0)[i].is_valid
                raw = v.tobytes() if ok else None
                out[0].append(hashlib.blake2b(raw, digest_size=16).digest() if ok else None)
                out[1].append(int(n))
                out[2].append(raw)
            yield record_batch(schema, batch.column(0), *out)

    return run


def _moments(schema: pa.Schema):
    """Sums of products of the unit vectors' components, of one length each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims):
                own = batch.column(1).filter(pa.array(dims == d))
                x = unit(np.frombuffer(b"".join(own.to_pylist())).reshape(-1, d))
                x = np.concatenate([x, np.ones((len(x), 1))], 1)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            i, j = np.triu_indices(d + 1)
            yield record_batch(schema, [int(d)] * len(i), i.tolist(), j.tolist(), s[i, j].tolist())

    return run


def principal_axes(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length: (mean, axes by falling variance). The driver gets length**2 sums."""
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("dim", "i", "j")]
                          + [T.StructField("s", T.DoubleType())])
    sums = rows.select("dim", "vec").mapInArrow(_moments(output_type(schema)), schema).groupBy("dim", "i", "j").agg(
        F.sum("s").alias("s")).collect()
    out = {}
    for d in {r["dim"] for r in sums}:
        m = np.zeros((d + 1, d + 1))
        for r in sums:
            if r["dim"] == d:
                m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
        mean = m[d, :d] / m[d, d]
        values, axes = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))
        out[d] = (mean, axes[:, np.argsort(-values, kind="stable")])
    return out


def _turned(axes: dict[int, tuple[np.ndarray, np.ndarray]], eps: float, n_axes: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for d in np.unique(dims):
                own = batch.filter(pa.array(dims == d))
                mean, basis = axes[int(d)]
                y = (unit(np.frombuffer(b"".join(own.column(3).to_pylist())).reshape(-1, d)) - mean) @ basis
                lead = np.zeros((len(y), n_axes))
                lead[:, :min(n_axes, d)] = y[:, :n_axes]
                rest = np.sqrt((y[:, n_axes:] ** 2).sum(axis=1))
                cells = np.floor(lead / eps).astype(np.int64)
                yield record_batch(schema, *own.columns, *(pa.array(c) for c in cells.T),
                                   *(pa.array(c) for c in lead.T), pa.array(rest))

    return run


def _blocks(size: int, n_axes: int, schema: pa.Schema):
    """Consecutive rows of a task's sorted interval, ``size`` at a time, with the box around them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def cut(table: pa.Table) -> pa.RecordBatch:
            box = np.stack([table.column(5 + n_axes + k).to_numpy() for k in range(n_axes + 1)], 1)
            vec = b"".join(table.column("vec").to_pylist())
            return record_batch(schema, [task], [seq], [table.column("dim")[0].as_py()],
                                *([x] for x in box.min(axis=0)), *([x] for x in box.max(axis=0)),
                                [table.column("id").to_pylist()], [table.column("no").to_pylist()], [table.column("w").to_pylist()],
                                [vec])

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal seq, held, rows
            table = pa.Table.from_batches(held)
            dims = table.column("dim").to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(dims[1:] != dims[:-1]) + 1, [len(dims)]])
            left = 0
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                for a in range(lo, hi, size):
                    b = min(a + size, hi)
                    if b == len(dims) and not last and b - a < size:
                        left = b - a
                        break
                    yield cut(table.slice(a, b - a))
                    seq += 1
            held = table.slice(len(dims) - left).combine_chunks().to_batches() if left else []
            rows = left

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
                if rows >= 4 * size:
                    yield from whole(False)
        if held:
            yield from whole(True)

    return run


def caps(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(centre, widest angle to it) of each run of ``size`` unit vectors."""
    edge = np.arange(0, len(x), size)
    centre = np.add.reduceat(x, edge, axis=0)
    norm = np.sqrt((centre * centre).sum(axis=1, keepdims=True))
    centre = np.divide(centre, norm, out=np.zeros_like(centre), where=norm > 0)
    own = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(x))))
    return centre, np.arccos(np.clip(np.minimum.reduceat((x * centre[own]).sum(axis=1), edge), -1, 1))


def near_parts(a: np.ndarray, b: np.ndarray, cosine: float, size: int) -> np.ndarray:
    """Which pairs of runs of a and b can hold vectors with that cosine: their caps on the sphere come close enough."""
    (ca, ra), (cb, rb) = caps(a, size), caps(b, size)
    angle = np.arccos(np.clip(ca @ cb.T, -1, 1))
    return angle - ra[:, None] - rb[None, :] <= math.acos(max(-1.0, min(1.0, cosine))) + 10 * SLACK


def links(a: np.ndarray, b: np.ndarray, cosine: float, size: int = PART) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of all pairs of unit vectors with at least that cosine; distant parts are skipped."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for i, near in enumerate(near_parts(a, b, cosine, size)):
        cols = np.flatnonzero(np.repeat(near, size)[:len(b)])
        if len(cols):
            x, y = np.nonzero(a[i * size:(i + 1) * size] @ b[cols].T >= cosine)
            out.append((x + i * size, cols[y]))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([o[k] for o in out]) if out else empty for k in (0, 1))


def _compare(cosine: float, schema: pa.Schema):
    """For a pair of blocks: each linked vector's degree (weights count) and its component in the pair."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same, d, ia, na, wa, va, ib, nb, wb, vb = (batch.column(k)[r] for k in range(10))
                same, d = same.as_py(), d.as_py()
                ia, na, wa, ib, nb, wb = (np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in (ia, na, wa, ib, nb, wb))
                a = unit(np.frombuffer(va.as_py()).reshape(-1, d))
                b = a if same else unit(np.frombuffer(vb.as_py()).reshape(-1, d))
                i, j = links(a, b, cosine)
                if same:
                    i, j = i[i != j], j[i != j]
                if not len(i):
                    continue
                if same:
                    ids, nodes, weight = ia, na, wa
                else:
                    j = j + len(ia)
                    i, j = np.concatenate([i, j]), np.concatenate([j, i])
                    ids, nodes, weight = np.concatenate([ia, ib]), np.concatenate([na, nb]), np.concatenate([wa, wb])
                degree = np.bincount(i, weight[j], len(ids)).astype(np.int64)
                by = np.lexsort((nodes, ids))
                label = np.empty(len(ids), np.int64)
                label[by] = np.arange(len(ids))
                while True:  # smallest vector reachable inside the pair
                    new = label.copy()
                    np.minimum.at(new, i, label[j])
                    new = new[by[new]]  # and what that one has reached
                    if (new == label).all():
                        break
                    label = new
                keep = degree > 0
                top = by[label[keep]]
                yield record_batch(schema, pa.array(ids[keep]), pa.array(nodes[keep]), pa.array(degree[keep]),
                                   pa.array(ids[top]), pa.array(nodes[top]))

    return run


def _near(eps: float, n_axes: int) -> Column:
    """Whether the boxes a and b are at most eps apart."""
    gaps = [F.greatest(F.lit(0.0), F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}"))
            for k in range(n_axes + 1)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= (eps + SLACK) ** 2


def block_pairs(boxes: DataFrame, eps: float, n_axes: int) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks whose boxes are near; intervals are joined from the widest down."""
    bounds = [f"{s}{k}" for s in ("lo", "hi") for k in range(n_axes + 1)]
    last = boxes.agg(F.max("pos").alias("m")).first()["m"] or 0
    levels = max(0, -(-max(0, last.bit_length() - 5) // PARTS_LOG2))  # the widest level has at most 32 intervals
    pairs = None
    for level in range(levels, -1, -1):
        shift = level * PARTS_LOG2
        nodes = (boxes.groupBy("dim", F.shiftright("pos", shift).alias("n"))
                 .agg(*[(F.min(c) if c.startswith("lo") else F.max(c)).alias(c) for c in bounds]))
        side = {s: nodes.select(F.col("dim").alias(f"{s}_dim"), F.col("n").alias(s),
                                *[F.col(c).alias(f"{s}_{c}") for c in bounds]) for s in "ab"}
        if pairs is None:
            ask = side["a"].withColumn("b", F.explode(F.sequence("a", F.lit(last >> shift))))
            pairs = ask.join(side["b"], (F.col("a_dim") == F.col("b_dim")) & (ask["b"] == side["b"]["b"])).drop(ask["b"])
        else:
            up = pairs.select(F.col("a_dim").alias("dim"), F.col("a").alias("pa"), F.col("b").alias("pb"))
            a = side["a"].withColumn("pa", F.shiftright("a", PARTS_LOG2))
            b = side["b"].withColumn("pb", F.shiftright("b", PARTS_LOG2))
            pairs = (up.join(a, (up["dim"] == a["a_dim"]) & (up["pa"] == a["pa"])).drop(a["pa"])
                     .join(b, (F.col("dim") == F.col("b_dim")) & (up["pb"] == b["pb"])).drop(b["pb"])
                     .where("a <= b"))
        pairs = pairs.where(_near(eps, n_axes))
    return pairs.select("a", "b", F.col("a_dim").alias("dim"))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9,
                 n_axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``id_col, n_links, component_id, kept``. Ids are integers."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    row = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(n, t) for n, t in _ROWS]])
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>"))
    rows = stored(own.mapInArrow(_read(output_type(row)), row))
    nodes = stored(rows.where(F.col("node").isNotNull()).groupBy("node", "dim", "vec")
                   .agg(F.min("id").alias("id"), F.count("*").alias("w")).withColumn("no", F.monotonically_increasing_id()))
    axes = principal_axes(nodes)
    cells, ys = [f"c{k}" for k in range(n_axes)], [f"y{k}" for k in range(n_axes + 1)]
    turned = T.StructType([T.StructField("id", T.LongType()), T.StructField("no", T.LongType()), T.StructField("dim", T.IntegerType()),
                           T.StructField("vec", T.BinaryType()), T.StructField("w", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in cells],
                           *[T.StructField(y, T.DoubleType()) for y in ys]])
    placed = nodes.select("id", "no", "dim", "vec", "w").mapInArrow(_turned(axes, eps, n_axes, output_type(turned)), turned)
    bounds = [f"{s}{k}" for s in ("lo", "hi") for k in range(n_axes + 1)]
    blocked = T.StructType([T.StructField("task", T.LongType()), T.StructField("seq", T.LongType()),
                            T.StructField("dim", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in bounds],
                            T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("nos", T.ArrayType(T.LongType())),
                            T.StructField("ws", T.ArrayType(T.LongType())), T.StructField("vecs", T.BinaryType())])
    n_tasks = max(1, math.ceil(nodes.count() / (8 * block)))
    order = ["dim", *cells, "id", "no"]
    # Sorted ranges next to each other go to one task, so that blocks are full however many ranges there are.
    sequence = stored(placed.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order).coalesce(n_tasks)
                      .mapInArrow(_blocks(block, n_axes, output_type(blocked)), blocked))
    longest = sequence.agg(F.max("seq").alias("m")).first()["m"] or 0
    pos = F.shiftleft("task", int(longest).bit_length()) + F.col("seq")
    sequence = sequence.withColumn("pos", pos)
    pairs = block_pairs(sequence.select("pos", "dim", *bounds), eps, n_axes)
    payload = {s: sequence.select(F.col("pos").alias(s), F.col("ids").alias(f"i{s}"), F.col("nos").alias(f"n{s}"),
                                  F.col("ws").alias(f"w{s}"), F.col("vecs").alias(f"v{s}")) for s in "ab"}
    # Each pair is a task's worth of work: they are dealt out before their blocks are fetched.
    todo = pairs.join(payload["a"], "a").join(payload["b"], "b").select(
        (F.col("a") == F.col("b")).alias("same"), "dim", "ia", "na", "wa", "va", "ib", "nb", "wb", "vb")
    part = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "no", "degree", "to_id", "to_no")])
    found = stored(todo.mapInArrow(_compare(cosine, output_type(part)), part))
    degree = found.groupBy("no").agg(F.sum("degree").alias("degree"))
    # A vector's number in the graph has its smallest id in front, so a component's smallest one has its id.
    point = {c: F.struct(F.col(i).alias("id"), F.col(n).alias("no")) for c, i, n in (("a", "id", "no"), ("b", "to_id", "to_no"))}
    labels = components(found.select(point["a"].alias("a"), point["b"].alias("b"))).select(
        F.col("node.no").alias("no"), F.col("component.id").alias("component_id"))
    known = (nodes.select("node", "no", "id", "w").join(degree, "no", "left").join(labels, "no", "left")
             .select("node", (F.coalesce("degree", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                     F.coalesce("component_id", "id").alias("component_id")))
    out = rows.select("id", "node").join(known, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
