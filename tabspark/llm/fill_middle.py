"""Fill-in-middle transformation by repeated-capture matching.

A text is matched once in full by ``(unit)*``; the regex library keeps the
end of every repetition, so one match gives the number of units and both
cut offsets. Four draws per document decide: two cuts between units, whether
the text stays plain, and the order of the parts. The markers stand for the
prefix, the suffix and the middle; texts that hold a marker's string stay
plain, so an output is always read back exactly (``restore``).

Defined cases
* null and empty texts are plain, with 0 units and an empty output.
* a null id draws as the empty id; repeated ids draw alike, each row has its own result.
* a text of any length is matched whole: about 70 bytes of a worker's memory for each of its units.
* an empty table gives an empty table; columns besides id and text are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch

#: A code point; any pattern that matches every text piece by piece will do, such as ``\\X`` for what is seen as one character.
CODE_POINT = r"(?s:.)"


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(id_col: Column, salt: str = "1:") -> list[Column]:
    """Four unsigned 32-bit draws of an id."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _transform(marks: Markers, unit: str, plain_from: int, suffix_first_below: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, h1, h2, h3, h4 in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                text = text or ""
                match = units.fullmatch(text)
                if match is None:
                    raise ValueError(f"{unit} does not match every part of a text")
                ends = match.ends(1)
                n = len(ends)
                if not text or h3 % 100 >= plain_from or any(m in text for m in marks.all()):
                    row = n, "plain", None, None, text
                else:
                    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = ends[first - 1] if first else 0, ends[last - 1] if last else 0
                    prefix, middle, suffix = marks.prefix + text[:a], marks.middle + text[a:b], marks.suffix + text[b:]
                    spm = h4 % 100 < suffix_first_below
                    row = (n, "spm" if spm else "psm", a, b - a,
                           suffix + prefix + middle if spm else prefix + suffix + middle)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield record_batch(schema, batch.column(0), *out)

    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: Markers | None = None,
              unit: str = CODE_POINT, plain_from: int = 90, suffix_first_below: int = 20, salt: str = "1:") -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` of every row.

    ``n`` counts units, the two lengths are in code points and null for plain
    texts. ``plain_from`` and ``suffix_first_below`` are the hundredths from
    which a text stays plain and below which its suffix comes first.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"),
                      *[h.alias(f"_h{i}") for i, h in enumerate(draws(F.col(id_col), salt))])
    return own.mapInArrow(_transform(marks or Markers(), unit, plain_from, suffix_first_below, output_type(schema)), schema)


def restore(output: Column | str, form: Column | str, marks: Markers | None = None) -> Column:
    """The text that an output of a given form was made of."""
    marks = marks or Markers()
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def between(first: str, second: str | None) -> Column:
        """What stands after the first marker, up to the second (None: to the end)."""
        begin = F.instr(output, first) + F.lit(len(first))
        if second is None:
            return F.substring(output, begin, F.length(output))
        return F.substring(output, begin, F.instr(output, second) - begin)

    psm = F.concat(between(marks.prefix, marks.suffix), between(marks.middle, None), between(marks.suffix, marks.middle))
    spm = F.concat(between(marks.prefix, marks.middle), between(marks.middle, None), between(marks.suffix, marks.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
