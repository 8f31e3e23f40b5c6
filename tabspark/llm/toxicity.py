"""Toxicity by a weighted lexicon.

Texts are folded (case, accents of look-alike letters from other scripts,
full-width forms, digits and signs that stand for letters, stretched
letters) and matched against a lexicon by an Aho-Corasick automaton. The
matches' weights, without those inside exception phrases, are normalised by
the text's length and mapped to 0..1 by a logistic curve.

The lexicon is learned from labelled texts in Spark: a term's weight is the
smoothed log-odds of toxic against clean texts that have it, where a text
counts only if it is the first with some context of the term (the words on
either side), so copies of one text count once. Words that share a stem of
four or five letters are taken together as the stem if all words with that
stem are as toxic. A phrase of a
term and a neighbour becomes an exception when the term is toxic in general
but the phrase only occurs in texts labelled clean. The curve is fitted on
all labelled rows. Lexicon, exceptions and curve are bounded by parameters
and go to the tasks as literals.

Defined cases
* null text counts as empty; a text without words scores as one without matches.
* a label that is null or not 0/1, or a null id, is not learned from.
* with no toxic (or no clean) labelled row the lexicon is empty and every
  score is the share of toxic labels (0 if there is none).
* a document labelled twice counts once for each label row; repeated and
  tied rows of documents each get a row.
* other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch, stored

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans({
    "а": "a", "ɑ": "a", "α": "a", "в": "b", "ь": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "є": "e", "ε": "e",
    "ɡ": "g", "һ": "h", "і": "i", "ı": "i", "ι": "i", "ї": "i", "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "ⅼ": "l",
    "м": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s",
    "т": "t", "τ": "t", "υ": "u", "ц": "u", "ν": "v", "ѵ": "v", "ԝ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y",
    "γ": "y", "ᴢ": "z",
})
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
                             "@": "a", "$": "s", "!": "i", "|": "l", "€": "e", "£": "l"})
# Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "sore loser")

_WIDE = str.maketrans({0xFF01 + i: 0x21 + i for i in range(94)} | {0x200B: None, 0x200C: None, 0x200D: None,
                                                                  0x2060: None, 0xFEFF: None, 0xAD: None})
_WORD = re.compile(r"[^\W_]+(?:[0-9@$!|€£*.'_-]+[^\W_]+)*")
_JOINT = re.compile(r"[*.'_-]+")
_SPELLED = re.compile(r"(?<![^\W_])[^\W_]([ .*_-])[^\W_](?:\1[^\W_]){2,}(?![^\W_])")
_LETTER = re.compile(r"[^\W\d_]")
_STRETCH = re.compile(r"([^\W\d_])\1{2,}")


def fold_word(word: str) -> str:
    """A word's folded form: substitutes become letters if it has any letter, marks inside it go."""
    word = word.translate(HOMOGLYPHS)
    if not word.isalpha() and _LETTER.search(word):
        word = _JOINT.sub("", word.translate(SUBSTITUTES))
    return word


class _Folded(dict):
    """What stands between white space -> its folded words, joined by spaces; kept for short ones."""

    limit = 400_000

    def __missing__(self, token: str) -> str:
        plain = token if token.isascii() else token.translate(_WIDE).lower()
        out = " ".join([fold_word(w) for w in _WORD.findall(_STRETCH.sub(r"\1\1", plain))])
        if len(token) <= 48:
            if len(self) >= self.limit:
                self.clear()
            self[token] = out
        return out


_FOLDED = _Folded()


def fold(text: str) -> str:
    """The folded words of a text, in order, with one space between them."""
    text = _SPELLED.sub(lambda m: m[0].replace(m[1], ""), text.lower())
    return " ".join(filter(None, map(_FOLDED.__getitem__, text.split())))


@dataclass
class Lexicon:
    """Terms with weights, exception phrases and the curve from normalised weight to score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 0.0
    offset: float = -20.0

    def automaton(self) -> ahocorasick.Automaton | None:
        """Words, stems (with a star) and phrases behind a space; the stored value is (length, weight), 0 for a phrase."""
        a = ahocorasick.Automaton()
        for w, x in self.weights.items():
            form = f" {w[:-1]}" if w.endswith("*") else f" {w} "
            a.add_word(form, (len(form), x))
        for p in self.exceptions:
            a.add_word(f" {p} ", (len(p) + 2, 0.0))
        a.make_automaton()
        return a if len(a) else None

    def score(self, x: float) -> float:
        z = self.offset + self.slope * x
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def matched(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[int, float]:
    """(number of matches, sum of their weights) outside exception phrases."""
    if automaton is None or not folded:
        return 0, 0.0
    hits, spared = [], []
    for end, (n, weight) in automaton.iter(f" {folded} "):
        (hits if weight else spared).append((end - n + 1, end, weight))
    if spared:
        hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in spared)]
    return len(hits), sum(h[2] for h in hits)


def normalised(weight: float, n_words: int) -> float:
    """A text's weight by its length: by the root of the logarithm, as insults are told in few words."""
    return weight / math.sqrt(math.log2(16 + n_words))


# ---------------------------------------------------------------- learning

#: Letters of a stem: words of the lexicon that share their first letters give way to a term for all such words.
STEMS, STEM_WORDS = (4, 5), 3


def _counted(schema: pa.Schema):
    """Rows (label, text) -> (term, toxic texts, clean texts), counted within the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            rows = record_batch(schema, terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms])
            counts[0].clear()
            counts[1].clear()
            return rows

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update(set(fold(text or "").split()))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield out()
        yield out()

    return run


def _contexts(wanted: set[str], schema: pa.Schema):
    """Rows (label, doc, text) -> each wanted term (a word, or a stem with a star) with the words around it."""
    stems = {t[:-1] for t in wanted if t.endswith("*")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for label, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = ["", *fold(text or "").split(), ""]
                for i in range(1, len(words) - 1):
                    w = words[i]
                    if w in wanted:
                        rows.append((label, doc, w, words[i - 1], words[i + 1]))
                    rows += [(label, doc, w[:k] + "*", words[i - 1], words[i + 1]) for k in STEMS if w[:k] in stems]
            if rows:
                yield record_batch(schema, *map(list, zip(*set(rows), strict=True)))

    return run


_COUNT = T.StructType([T.StructField("term", T.StringType()), T.StructField("toxic", T.LongType()),
                       T.StructField("clean", T.LongType())])
_CONTEXT = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("doc", T.LongType()),
                         *[T.StructField(c, T.StringType()) for c in ("term", "before", "after")]])


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", max_terms: int = 2000,
          min_texts: int = 6, min_log_odds: float = 2.5, max_exceptions: int = 200) -> Lexicon:
    """Learn lexicon, exceptions and curve from all rows of ``labelled`` (text, 0/1 label).

    ``max_terms`` and ``max_exceptions`` bound what the driver holds; terms
    are taken by the number of toxic texts that have them.
    """
    text = F.col(text_col).cast("string")
    own = labelled.select(F.col(label_col).cast("int").alias("label"), F.xxhash64(text).alias("doc"), text.alias("text"))
    own = own.where(F.col("label").isin(0, 1))
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    prior = toxic / (toxic + clean) if toxic + clean else 0.0
    flat = Lexicon(offset=math.log(prior / (1 - prior)) if 0 < prior < 1 else (20.0 if prior else -20.0))
    if not toxic or not clean:
        return flat

    def odds(n_toxic: int, n_clean: int) -> float:
        return math.log((n_toxic + 0.5) / toxic) - math.log((n_clean + 0.5) / clean)

    # Terms by the texts that have them; copies still count. exp(odds) is compared without logarithms.
    likely = (own.select("label", "text").mapInArrow(_counted(output_type(_COUNT)), _COUNT)
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .where((F.col("toxic") >= min_texts) & ((F.col("toxic") + 0.5) * clean
                                                      >= (F.col("clean") + 0.5) * toxic * math.exp(min_log_odds)))
              .orderBy(F.desc("toxic"), "term").limit(4 * max_terms))
    words = [r["term"] for r in likely.collect()]
    if not words:
        return flat
    stems = Counter(w[:k] + "*" for w in words for k in STEMS if len(w) > k)
    wanted = set(words) | {s for s, n in stems.items() if n >= STEM_WORDS}
    rows = stored(own.mapInArrow(_contexts(wanted, output_type(_CONTEXT)), _CONTEXT))
    # A text counts for a term if it is the first with some context of it.
    first = rows.groupBy("label", "term", "before", "after").agg(F.min("doc").alias("doc"))
    n_texts = {(r["term"], r["label"]): r["n"] for r in first.groupBy("label", "term").agg(
        F.countDistinct("doc").alias("n")).collect()}
    good = {t: odds(n, n_texts.get((t, 0), 0)) for t in wanted if (n := n_texts.get((t, 1), 0)) >= min_texts}
    weights: dict[str, float] = {}
    for t in sorted(good, key=lambda t: (not t.endswith("*"), len(t) if t.endswith("*") else 0, -n_texts[t, 1], t)):
        covered = any(t[:k] + "*" in weights for k in STEMS if len(t.rstrip("*")) >= k)
        if good[t] >= min_log_odds and not covered and len(weights) < max_terms:
            weights[t] = good[t]
    known = F.col("term").isin(*weights) if weights else F.lit(False)
    phrase = F.explode(F.array(F.concat_ws(" ", "before", "term"), F.concat_ws(" ", "term", "after")))
    spared = (rows.where(known).select(phrase.alias("phrase"), "label", "doc")
              .where(F.rlike("phrase", F.lit("^[^ ]+ [^ ]+$")))
              .groupBy("phrase").agg(F.max("label").alias("toxic"), F.countDistinct("doc").alias("n"))
              .where((F.col("toxic") == 0) & (F.col("n") >= min_texts))
              .orderBy(F.desc("n"), "phrase").limit(max_exceptions).collect())
    lexicon = Lexicon(weights, (*EXCEPTIONS, *(r["phrase"] for r in spared)))
    # The curve: labelled rows by their normalised weight, in bins of 1/8.
    scored = measure(own.withColumnRenamed("label", "id"), lexicon, "id").groupBy(
        "id", F.least(F.round(F.col("x") * 8), F.lit(4000.0)).alias("bin")).agg(F.count("*").alias("n")).collect()
    lexicon.slope, lexicon.offset = logistic([(r["bin"] / 8, r["id"], r["n"]) for r in scored])
    return lexicon


def logistic(points: list[tuple[float, int, int]], ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """(slope, offset) of a logistic curve through (x, label, count) points, by Newton steps."""
    a = b = 0.0
    for _ in range(steps):
        ga = gb = haa = hab = hbb = 0.0
        for x, y, n in points:
            x = min(x, 20.0)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            g, h = n * (y - p), n * max(p * (1 - p), 1e-9)
            ga, gb, haa, hab, hbb = ga + g * x, gb + g, haa + h * x * x, hab + h * x, hbb + h
        ga, haa, hbb = ga - ridge * a, haa + ridge, hbb + ridge
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        scale = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + scale * da, b + scale * db
        if max(abs(da), abs(db)) < 1e-9:
            break
    return a, b


# ----------------------------------------------------------------- scoring

def measure(docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_matches, x, score`` of every row; one scan, no shuffle."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_matches", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("score", T.DoubleType())])
    out = output_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text or "")
                n_words = folded.count(" ") + (folded != "")
                n, weight = matched(folded, automaton)
                x = normalised(weight, n_words)
                rows.append((key, n_words, n, x, lexicon.score(min(x, 20.0))))
            if rows:
                yield record_batch(out, *map(list, zip(*rows, strict=True)))

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below the threshold; decided where a row lies."""
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            keep = []
            for text in batch.column(at).to_pylist():
                folded = fold(text or "")
                x = normalised(matched(folded, automaton)[1], folded.count(" ") + (folded != ""))
                keep.append(lexicon.score(min(x, 20.0)) < threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
