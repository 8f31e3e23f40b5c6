"""Personal data: base rules and a skip-chain conditional random field.

Base rules find email addresses, IP addresses, card and phone numbers; their
spans always stay. The field adds spans that the rules miss: its nodes are
the base spans (their labels are given) and the other mentions of a
document that could be such data (runs of digits with marks between them,
spelled-out addresses). Consecutive mentions share a chain potential,
distant mentions with the same digits or the same address a skip potential;
loopy message passing over the whole document makes their labels agree.
Mentions whose belief in a kind reaches ``min_belief`` are added.

The field is trained by pseudo-likelihood on mentions of a bounded sample of
documents whose labels are the base rules' own (``max_train`` documents by a
hash of the text); free mentions that are linked to a base span are left out
there, since their labels are what the field is to find.

Defined cases
* null text counts as empty; a text without mentions has no spans.
* overlapping spans of different kinds all stay; redaction covers their union.
* null and repeated ids: every input row gives one row.
* an empty table gives an empty table, and the field keeps its prior weights.
* columns besides id and text are dropped by ``find``, kept by ``redact``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

# Possessive repeats and the test before an address only save steps: where they stop, the plain pattern fails too.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_NUMBER = re.compile(r"(?<![\w@.])\+?\(?[0-9]++(?:[ ().\-/\[\]]{1,3}+[0-9]++)*+(?![\w@])")
_SPELLED = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}(?: ?[\[({]at[\])}] ?| at )[A-Za-z0-9-]{1,63}"
                      r"(?:(?: ?[\[({]dot[\])}] ?| dot |\.)[A-Za-z0-9-]{1,63})+", re.IGNORECASE)
_AT = re.compile(r" ?[\[({]at[\])}] ?| at ", re.IGNORECASE)
_DOT = re.compile(r" ?[\[({]dot[\])}] ?| dot ", re.IGNORECASE)
_WORD_BEFORE = re.compile(r"([^\W\d_]{2,20})\W{0,3}\Z")
#: Digits that a free mention of a number has at least.
MIN_DIGITS = 7


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base rules by start, then kind as listed; code points, end exclusive."""
    out = []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            while at > done and text[at - 1] in _LOCAL:
                at -= 1
            if at < m.start():
                out.append((at, 0, m.end()))
                done = m.end()
    if _DIGIT.search(text):
        out.extend((m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m[0].split("."))))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out.extend((m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                       if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15)
    out.sort()
    return [(KINDS[k], s, e) for s, k, e in out]


def free_mentions(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans outside the base spans that could be personal data, by start."""
    out = []
    if _DIGIT.search(text):
        out += [m.span() for m in _NUMBER.finditer(text) if sum(c.isdigit() for c in m[0]) >= MIN_DIGITS]
    lowered = text.lower()
    if " at " in lowered or "at)" in lowered or "at]" in lowered or "at}" in lowered:
        out += [m.span() for m in _SPELLED.finditer(text)]
    if not out:
        return []
    taken: list[tuple[int, int]] = []  # base spans, merged where they overlap
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1] = taken[-1][0], max(e, taken[-1][1])
        else:
            taken.append((s, e))
    free, at = [], 0
    for s, e in sorted(out):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if (at == len(taken) or taken[at][0] >= e) and (not free or s >= free[-1][1]):
            free.append((s, e))
    return free


def identity(mention: str) -> str:
    """What two mentions of the same thing have in common: the address in lower case, or the last ten digits."""
    if _AT.search(mention) or "@" in mention:
        return _DOT.sub(".", _AT.sub("@", mention)).lower()
    return _NOT_DIGIT.sub("", mention)[-10:]


def node_features(text: str, start: int, end: int) -> list[str]:
    """Binary features of a mention; every string is hashed to a column of the weights."""
    mention = text[start:end]
    digits = _NOT_DIGIT.sub("", mention)
    before = _WORD_BEFORE.search(text[max(0, start - 24):start])
    parts = mention.strip("()[]").split(".")
    return ["bias", f"digits {min(len(digits), 20)}", f"marks {''.join(sorted(set(re.sub(r'[0-9A-Za-z]', '', mention))))[:8]}",
            f"plus {mention[:1] == '+'}", f"luhn {12 <= len(digits) <= 19 and luhn(digits)}",
            f"four {len(parts) == 4 and all(p.isdigit() and _byte(p) for p in parts)}",
            f"at {bool(_AT.search(mention)) or '@' in mention}",
            f"before {before[1].lower() if before else ''}"]


N_COLUMNS = 1 << 12


def columns(names: list[str]) -> list[int]:
    return [zlib.crc32(n.encode()) % N_COLUMNS for n in names]


@dataclass
class Graph:
    """A document's mentions: spans, feature columns, labels (-1: free) and edges by kind."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    label: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def graph(text: str, base: list[tuple[str, int, int]]) -> Graph | None:
    """The field's nodes and edges, or None where there is nothing to decide."""
    free = free_mentions(text, base)
    if not free:
        return None
    nodes = sorted([(s, e, LABELS.index(k)) for k, s, e in base] + [(s, e, -1) for s, e in free])
    last: dict[str, int] = {}
    given: dict[str, int] = {}
    names = [identity(text[s:e]) for s, e, _ in nodes]
    for i, (_, _, k) in enumerate(nodes):
        if k >= 0:
            given.setdefault(names[i], i)
    skip = []
    for i, same in enumerate(names):
        # Mentions of what a base span names are tied to it; other equal ones form a path. Either way there are
        # no more edges than mentions.
        if same in given:
            if given[same] != i:
                skip.append((given[same], i))
        elif same in last:
            skip.append((last[same], i))
        last[same] = i
    return Graph([(s, e) for s, e, _ in nodes], [columns(node_features(text, s, e)) for s, e, _ in nodes],
                 np.array([k for _, _, k in nodes]), [(i, i + 1) for i in range(len(nodes) - 1)], skip)


@dataclass
class Field:
    """Weights: node features by label, one chain potential matrix, one skip agreement."""

    node: np.ndarray = field(default_factory=lambda: np.zeros((N_COLUMNS, len(LABELS))))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((len(LABELS), len(LABELS))))
    skip: float = 10.0

    def beliefs(self, g: Graph, rounds: int = 30, damping: float = 0.3) -> np.ndarray:
        """Marginal beliefs of all nodes by loopy sum-product message passing; given labels are clamped."""
        n, k = len(g.spans), len(LABELS)
        unary = np.array([self.node[c].sum(axis=0) for c in g.features])
        given = g.label >= 0
        unary[given] = -50.0
        unary[given, g.label[given]] = 0.0
        edges = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
        agree = np.eye(k) * self.skip
        pair = np.concatenate([np.broadcast_to(self.chain, (len(g.chain), k, k)),
                               np.broadcast_to(agree, (len(g.skip), k, k))])
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        pot = np.concatenate([pair, pair.transpose(0, 2, 1)])  # [message, source label, target label]
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        msg = np.zeros((len(src), k))
        for _ in range(rounds):
            total = unary.copy()
            np.add.at(total, dst, msg)
            z = (total[src] - msg[back])[:, :, None] + pot
            top = z.max(axis=1, keepdims=True)
            new = np.log(np.exp(z - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            step = np.abs(new - msg).max(initial=0)
            msg = damping * msg + (1 - damping) * new
            if step < 1e-6:
                break
        total = unary.copy()
        np.add.at(total, dst, msg)
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True) if n else total

    def added(self, text: str, base: list[tuple[str, int, int]], min_belief: float = 0.9) -> list[tuple[str, int, int]]:
        g = graph(text, base)
        if g is None:
            return []
        b = self.beliefs(g)
        best = b.argmax(axis=1)
        return [(LABELS[best[i]], *g.spans[i]) for i in np.flatnonzero(g.label < 0)
                if best[i] and b[i, best[i]] >= min_belief]


def fit(examples: list[tuple[list[int], int, int, int, int]], steps: int = 200, rate: float = 0.5,
        ridge: float = 1e-3, times: list[int] | None = None) -> Field:
    """Pseudo-likelihood fit: each example is (columns, label, label before, label after, agreeing or not: -1 none).

    ``times``: how often each example stands for itself (once by default).
    """
    out = Field()
    # Prior: without evidence a mention is nothing.
    out.node[columns(["bias"])[0], 0] = 2.0
    if not examples:
        return out
    k = len(LABELS)
    width = max(len(e[0]) for e in examples)
    x = np.array([e[0] + [N_COLUMNS] * (width - len(e[0])) for e in examples])
    y = np.array([e[1] for e in examples])
    before, after = (np.array([e[j] for e in examples]) for j in (2, 3))
    linked = np.array([e[4] for e in examples])
    node = np.concatenate([out.node, np.zeros((1, k))])
    start = node.copy()
    chain, skip = np.zeros((k + 1, k + 1)), out.skip
    share = np.ones(len(y)) if times is None else np.array(times, float)
    share = (share / share.sum())[:, None]
    goal = np.eye(k)[y]
    for _ in range(steps):
        z = node[x].sum(axis=1) + chain[before, :k] + chain[:k, after].T
        has = linked >= 0
        z[has, linked[has]] += skip
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = (goal - p) * share
        grad = np.zeros_like(node)
        np.add.at(grad, x.ravel(), np.repeat(g, width, axis=0))
        grad[N_COLUMNS] = 0
        gc = np.zeros_like(chain)
        np.add.at(gc[:, :k], before, g)
        np.add.at(gc.T[:, :k], after, g)
        gc[k, :] = gc[:, k] = 0
        gs = (g[has, linked[has]]).sum()
        node += rate * (grad - ridge * (node - start) / k)
        chain += rate * (gc - ridge * chain)
        skip += rate * (gs - ridge * (skip - 10.0))
    out.node, out.chain, out.skip = node[:N_COLUMNS], chain[:k, :k], float(max(skip, 0.0))
    return out


# -------------------------------------------------------------- Spark jobs

_EXAMPLE = T.StructType([T.StructField("x", T.ArrayType(T.IntegerType()))]
                        + [T.StructField(c, T.IntegerType()) for c in ("y", "before", "after", "linked")])


def _examples(schema: pa.Schema):
    none = len(LABELS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text or "")
                free = free_mentions(text or "", base)
                nodes = sorted([(s, e, LABELS.index(k)) for k, s, e in base] + [(s, e, 0) for s, e in free])
                kinds: dict[str, set[int]] = {}
                names = [identity(text[s:e]) for s, e, _ in nodes]
                times = Counter(names)
                for name, (_, _, k) in zip(names, nodes, strict=True):
                    kinds.setdefault(name, set()).add(k)
                for i, (s, e, k) in enumerate(nodes):
                    if k == 0 and len(kinds[names[i]]) > 1:
                        continue
                    rows.append((columns(node_features(text, s, e)), k, nodes[i - 1][2] if i else none,
                                 nodes[i + 1][2] if i + 1 < len(nodes) else none, k if times[names[i]] > 1 else -1))
            if rows:
                yield record_batch(schema, *map(list, zip(*rows, strict=True)))

    return run


def train(docs: DataFrame, text_col: str = "text", max_train: int = 2000) -> Field:
    """Fit the field on the mentions of about ``max_train`` different texts, taken by a hash of the text.

    Equal texts count once, so a text that is copied often is one of them;
    the same texts are taken whatever task is run again. An example that
    repeats (same features and neighbours) counts by its number.
    """
    text = F.col(text_col).cast("string")
    own = docs.select(text.alias("text")).where(F.rlike("text", F.lit("[0-9@]")))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    # The smallest share of all hashes, among the powers of two, that has enough different texts.
    counts = own.agg(*[F.approx_count_distinct(F.when(draw < (1 << 30 - k), F.xxhash64("text"))).alias(f"n{k}") for k in range(31)]).first()
    k = max((k for k in range(31) if counts[f"n{k}"] >= max_train), default=0)
    own = own.where(draw < (1 << 30 - k)).distinct()
    # Different examples only: what a text repeats, or many texts have alike, is a number.
    rows = (own.mapInArrow(_examples(output_type(_EXAMPLE)), _EXAMPLE).groupBy(*_EXAMPLE.fieldNames())
            .agg(F.count(F.lit(1)).alias("times")).collect())
    examples = sorted((list(r["x"]), r["y"], r["before"], r["after"], r["linked"], r["times"]) for r in rows)
    return fit([e[:5] for e in examples], times=[e[5] for e in examples])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text",
         min_belief: float = 0.9) -> DataFrame:
    """``id_col, base, added, spans``: comma-joined kind:start:end of the rules, of the field, and of both."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *[T.StructField(c, T.StringType()) for c in ("base", "added", "spans")]])
    out = output_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added, spans = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                b = base_spans(text)
                a = model.added(text, b, min_belief)
                base.append(_joined(b))
                added.append(_joined(a))
                spans.append(_joined(sorted(b + a, key=lambda x: (x[1], KINDS.index(x[0])))) if a else base[-1])
            yield record_batch(out, batch.column(0), base, added, spans)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Field, text_col: str = "text", min_belief: float = 0.9) -> DataFrame:
    """The same rows and columns with personal data replaced in ``text_col``; null stays null."""
    schema = docs.schema
    out, at = output_type(schema), docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                if text:
                    b = base_spans(text)
                    spans = b + model.added(text, b, min_belief)
                    text = redact_text(text, spans) if spans else text
                texts.append(text)
            cols = list(batch.columns)
            cols[at] = pa.array(texts, out.field(at).type)
            yield record_batch(out, *cols)

    return docs.mapInArrow(run, schema)
