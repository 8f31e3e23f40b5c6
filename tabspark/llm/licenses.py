"""Licence recognition by sentence rules (DataFrame functions only).

A text becomes its words with marks where a sentence ends, and these are cut
into pieces. Runs of pieces are normalised sentences, looked up in a table of
known licence sentences (of the runs from one piece on, the longest known
one counts), and the resulting sequence of sentence ids is matched against
ordered rules: a licence is reported where its sentences stand in the order
its rule asks for. A table sentence with a stop inside is known by all its
parts, one after the other. A line break without a stop before it, with all
blank lines and comment marks of other characters than letters and digits,
may end a sentence or stand inside one: notices are published wrapped. A
sentence has at most as many pieces as words, which bounds the runs.

Defined cases
* null text: no sentences, status ``none``.
* empty text, text of separators only: the same.
* repeated sentences: the id occurs as often as the sentence does.
* known sentences whose sequence meets no rule: status ``unmatched``.
* several rules met: all are listed, in the order of ``RULES``.
* repeated rows, null ids: every input row gives one output row.
* other columns of the input are dropped; the id column keeps its name.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence id -> licence sentence, as published in the notices.
SENTENCES: dict[str, str] = {
    "APACHE_LINE": "Licensed under the Apache License, Version 2.0",
    "APACHE_GRANT": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "APACHE_COMPLY": "you may not use this file except in compliance with the License",
    "APACHE_OBTAIN": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT_LINE": "Released under the MIT License",
    "MIT_LICENSED": "Licensed under the MIT License",
    "MIT_NAME": "The MIT License (MIT)",
    "MIT_NOTICE": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software",
    "GPL3_LINE": "This work is licensed under the GNU General Public License, version 3",
    "GPL_REDIST": "This program is free software: you can redistribute it and/or modify it under the terms of "
                  "the GNU General Public License as published by the Free Software Foundation, either version 3 "
                  "of the License, or (at your option) any later version",
    "GPL_COPY": "You should have received a copy of the GNU General Public License along with this program",
    "CCBYNC_LINE": "Licensed under CC BY-NC 4.0",
    "CCBY_LINE": "Licensed under CC BY 4.0",
    "CCBYSA_LINE": "Licensed under CC BY-SA 4.0",
    "BSD_REDIST": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met",
    "BSD_SOURCE": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer",
    "BSD_BINARY": "Redistributions in binary form must reproduce the above copyright notice, this list of "
                  "conditions and the following disclaimer in the documentation and/or other materials provided "
                  "with the distribution",
    "BSD_NAMES": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission",
    "MPL_LINE": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "UNLICENSE": "This is free and unencumbered software released into the public domain under the Unlicense",
    "RESERVED": "All rights reserved",
}

# Licence -> sentence ids that must stand in this order
# (``a|b`` is a choice); other known sentences may stand between them.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("APACHE_GRANT", "APACHE_COMPLY", "APACHE_OBTAIN")),
    ("Apache-2.0", ("APACHE_LINE",)),
    ("MIT", ("MIT_LINE|MIT_LICENSED",)),
    ("MIT", ("MIT_NAME", "MIT_NOTICE")),
    ("GPL-3.0-only", ("GPL3_LINE",)),
    ("GPL-3.0-or-later", ("GPL_REDIST", "GPL_COPY")),
    ("CC-BY-NC-4.0", ("CCBYNC_LINE",)),
    ("CC-BY-4.0", ("CCBY_LINE",)),
    ("CC-BY-SA-4.0", ("CCBYSA_LINE",)),
    ("BSD-3-Clause", ("BSD_REDIST", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES")),
    ("BSD-2-Clause", ("BSD_REDIST", "BSD_SOURCE", "BSD_BINARY")),
    ("MPL-2.0", ("MPL_LINE",)),
    ("Unlicense", ("UNLICENSE",)),
    ("LicenseRef-reserved", ("RESERVED",)),
]

#: A sentence ends at a line break, or at a stop with any marks after it and white space.
SENTENCE_END = r"\n+|[.?;][^\p{L}\p{N}\s]*\s+"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Every known sentence has one of these; texts without them need no cutting.
KEYWORDS = ("licen", "rights reserved", "redistribut", "permission notice", "copyright", "unencumbered")


def normalised_pieces(sentence: str) -> list[str]:
    """The parts that ``SENTENCE_END`` cuts a table sentence into, normalised like a text's."""
    parts = re.split(r"\n+|[.?;][^\w\s]*\s+", sentence)
    return [p for p in (re.sub(r"[\W_]+", " ", s.lower()).strip() for s in parts) if p]


#: Marks in a lower-cased text: a stop (as in ``SENTENCE_END``, with all up to the next word), a line break without one.
STOP, BREAK = "S", "B"
STOP_RUN = r"[.?;][^\p{L}\p{N}\s]*\s[^\p{L}\p{N}]*"
BREAK_RUN = rf"\n[[^\p{{L}}\p{{N}}]{STOP}]*"


def marked(text: Column) -> Column:
    """The normalised words of a text with a mark at every sentence end, a space at either end."""
    stops = F.regexp_replace(F.lower(text), STOP_RUN, f" {STOP} ")
    words = F.regexp_replace(F.regexp_replace(stops, BREAK_RUN, f" {BREAK} "), NOT_WORD, " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def known_sentences(pieces: Column, table: Mapping[str, str]) -> Column:
    """Ids of the table's sentences among the pieces of a ``marked`` text, from left to right, none overlapping.

    ``table``: normalised sentence (its parts joined by STOP marks) -> id.
    """
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    firsts = F.array(*[F.lit(w) for w in sorted({k.split(" ")[0] for k in table})])
    longest = max(sum(w != STOP for w in k.split(" ")) for k in table)

    def bare(piece: Column) -> Column:
        return F.regexp_replace(piece, f"^[{STOP}{BREAK}] ", "")

    def sentence(i: Column, n: Column) -> Column:
        """The id of the n pieces from i on; breaks inside don't count."""
        run = F.regexp_replace(bare(F.array_join(F.slice(pieces, i, n), " ")), f" {BREAK}(?= )", "")
        return F.try_element_at(lookup, run)

    def longest_from(i: Column) -> Column:
        none = F.struct(i.alias("i"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("id"))

        def better(best: Column, n: Column) -> Column:
            found = sentence(i, n)
            return F.when(found.isNotNull(), F.struct(i.alias("i"), n.alias("n"), found.alias("id"))).otherwise(best)

        return F.aggregate(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(pieces) - i + 1)), none, better)

    starts = F.filter(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.array_contains(
        firsts, F.substring_index(bare(F.get(pieces, i - 1)), " ", 1)))
    hits = F.filter(F.transform(starts, longest_from), lambda h: h["id"].isNotNull())

    def taken(done: Column, h: Column) -> Column:
        more = F.struct((h["i"] + h["n"]).alias("to"), F.concat(done["ids"], F.array(h["id"])).alias("ids"))
        return F.when(h["i"] >= done["to"], more).otherwise(done)

    nothing = F.struct(F.lit(0).alias("to"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(hits, nothing, taken, lambda done: done["ids"])


def rule_regex(steps: Sequence[str]) -> str:
    """A rule as a pattern over the text ``" id id id "``: its steps in order, anything between."""
    return r"( .*)? ".join(f"({s})" for s in steps).join((" ", " "))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sentences: Mapping[str, str] | None = None,
              rules: Sequence[tuple[str, Sequence[str]]] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``sentence_ids``, ``licenses`` (arrays) and ``status``.

    A row-wise expression: no shuffle, no broadcast; the tables are literals
    whose size the caller's code fixes.
    """
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    table = {f" {STOP} ".join(normalised_pieces(s)): sid for sid, s in sentences.items()}
    text = F.coalesce(F.col(text_col), F.lit(""))
    lowered = F.lower(text)
    hit = F.lit(False)
    if all(any(k in " ".join(normalised_pieces(s)) for k in KEYWORDS) for s in sentences.values()):
        # Marks inside a key phrase fall with the spaces: both sides are compared without them.
        for k in {w for key in KEYWORDS for w in [max(key.split(), key=len)]}:
            hit = hit | F.contains(lowered, F.lit(k))
    else:
        hit = F.lit(True)
    pieces = F.split(F.concat(F.trim(marked(text)), F.lit(" ")), f" (?=[{STOP}{BREAK}] | *$)")
    seq = F.concat(F.lit(" "), F.array_join(F.col("sentence_ids"), "  "), F.lit(" "))
    found = F.array_compact(F.array(*[F.when(F.rlike(seq, F.lit(rule_regex(steps))), F.lit(name))
                                      for name, steps in rules]))
    return (docs.select(F.col(id_col), hit.alias("_hit"), F.when(hit, pieces).otherwise(F.array().cast("array<string>")).alias("_pieces"))
            .select(id_col, F.when(F.col("_hit"), known_sentences(F.col("_pieces"), table))
                    .otherwise(F.array().cast("array<string>")).alias("sentence_ids"))
            .withColumn("licenses", F.array_distinct(found))
            .withColumn("status", F.when(F.size("licenses") > 0, "matched")
                        .when(F.size("sentence_ids") > 0, "unmatched").otherwise("none")))
