"""Chat formatting by schema fingerprints (DataFrame functions only).

The nested field paths of a layout are hashed; the hash selects a
declarative mapping that turns the layout into canonical turns
``(conv_id, turn, role, text)``. ``format_turns`` writes a conversation
with a template whose control strings are escaped inside texts,
``read_back`` recovers roles and texts from the formatted string.

Defined cases
* null text and null role count as empty strings; null ids form one conversation of their own.
* turns are ordered by turn (null first), then role, then text; repeated rows stay.
* an empty table gives an empty table; a layout that no mapping knows raises
  ``KeyError`` (whole tables) or keeps the row with status ``unknown`` (JSON rows).
* columns besides a mapping's own are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: What follows "<" or "[" in the control strings of this and of other common templates.
TAILS = r"\||/?s>|/?INST\]|</?SYS>>"
ESCAPE = (rf"([<\[])(\\*)({TAILS})", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*)({TAILS})", r"$1$2$3")


# ------------------------------------------------------------- fingerprints

def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema, arrays marked ``[]``, in no given order."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    """Hash of a set of field paths; types and order don't matter."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def _turn(turn: int | Column, role: str | Column, text: Column) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(turn).cast("long").alias("turn"), lit(role).cast("string").alias("role"),
                    text.cast("string").alias("text"))


def _pair(user: Column, assistant: Column, system: Column | None = None) -> Column:
    own = [_turn(0, "user", user), _turn(1, "assistant", assistant)]
    if system is None:
        return F.array(*own)
    return F.when(F.coalesce(system, F.lit("")) == "", F.array(*own)).otherwise(
        F.array(_turn(-1, "system", system), *own))


def _instruction(instruction: Column, given: Column) -> Column:
    return F.when(F.coalesce(given, F.lit("")) == "", instruction).otherwise(
        F.concat_ws("\n\n", instruction, given))


#: Layout -> (its field paths without the id, get -> array of turns). ``get(path)`` is a column.
LAYOUTS = {
    "prompt_response": (["prompt", "response"], lambda get: _pair(get("prompt"), get("response"))),
    "prompt_completion": (["prompt", "completion"], lambda get: _pair(get("prompt"), get("completion"))),
    "question_answer": (["question", "answer"], lambda get: _pair(get("question"), get("answer"))),
    "instruction": (["instruction", "input", "output"],
                    lambda get: _pair(_instruction(get("instruction"), get("input")), get("output"))),
    "instruction_only": (["instruction", "output"], lambda get: _pair(get("instruction"), get("output"))),
    "system_instruction": (["system", "instruction", "output"],
                           lambda get: _pair(get("instruction"), get("output"), get("system"))),
    "messages": (["messages[].role", "messages[].content"],
                 lambda get: F.transform(get("messages"), lambda m, i: _turn(i, m["role"], m["content"]))),
    "from_value": (["conversations[].from", "conversations[].value"],
                   lambda get: F.transform(get("conversations"), lambda m, i: _turn(
                       i, F.when(m["from"] == "human", "user").when(m["from"] == "gpt", "assistant")
                       .otherwise(m["from"]), m["value"]))),
}
TURN_ROWS = ["turn", "role", "text"]
#: Fingerprint -> layout; tables may also hold one turn a row.
REGISTRY = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}
TABLES = {fingerprint(TURN_ROWS): "turn_rows"} | REGISTRY

# The same layouts inside JSON rows, where arrays are read with a declared type.
_JSON_TYPES = {"messages": "array<struct<role:string,content:string>>",
               "conversations": "array<struct<from:string,value:string>>"}


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(conv_id, turn, role, text)`` rows of a table in any registered layout.

    The paths that a layout declares and the table has are fingerprinted and
    looked up, other columns are ignored; of several, the layout with the
    most fields is taken.
    """
    have = set(field_paths(T.StructType([f for f in df.schema.fields if f.name != id_col])))
    declared = [TURN_ROWS, *(paths for paths, _ in LAYOUTS.values())]
    fits = [(p, TABLES[fingerprint(p)]) for p in ([x for x in paths if x in have] for paths in declared)
            if fingerprint(p) in TABLES]
    if not fits:
        raise KeyError(f"no mapping for the layout {sorted(have)} ({fingerprint(list(have))})")
    name = max(fits, key=lambda x: len(x[0]))[1]
    mapping = None if name == "turn_rows" else LAYOUTS[name][1]
    if mapping is None:
        return df.select(F.col(id_col).alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (df.select(F.col(id_col).alias("conv_id"), F.explode(mapping(F.col)).alias("t"))
            .select("conv_id", "t.*"))


def _json_has(value: Column, path: str) -> Column:
    """Whether a JSON value has a path; an empty array has all of its elements' paths."""
    name, _, inner = path.partition("[].")
    if not inner:
        field = F.try_variant_get(value, f"$.{name}", "variant")
        return field.isNotNull() & ~F.schema_of_variant(field).rlike("^(OBJECT|ARRAY)<")
    items = F.try_variant_get(value, f"$.{name}", "array<variant>")
    return items.isNotNull() & ((F.size(items) == 0) | F.exists(
        items, lambda x: F.try_variant_get(x, f"$.{inner}", "variant").isNotNull()))


def json_fingerprint(record: Column, paths: list[str]) -> Column:
    """As ``fingerprint``, of those of the declared ``paths`` that a JSON record has."""
    value = F.try_parse_json(record)
    own = F.array_compact(F.array(*[F.when(_json_has(value, p), F.lit(p)) for p in sorted(set(paths))]))
    return F.substring(F.sha2(F.array_join(own, "\n"), 256), 1, 16)


def canonical_json(df: DataFrame, record_col: str, id_col: str = "conv_id") -> DataFrame:
    """Rows of heterogeneous JSON records: each row's fingerprint selects its mapping.

    Columns ``conv_id, layout, turns`` (array of turn, role, text); a record
    whose fingerprint is not registered keeps its row with layout ``unknown``.
    Fields that a layout doesn't declare are ignored, as in tables.
    """
    rec = F.col(record_col)
    out = df.select(F.col(id_col).alias("conv_id"), rec.alias("_record"))

    def get(name: str) -> Column:
        if name in _JSON_TYPES:
            return F.from_json(F.get_json_object("_record", f"$.{name}"), _JSON_TYPES[name])
        return F.get_json_object("_record", f"$.{name}")

    layout, turns = F.lit("unknown"), F.lit(None)
    # The last that fits decides: the one with the most fields, of equal ones the first.
    prints = {fingerprint(paths): paths for paths, _ in reversed(LAYOUTS.values())}
    for key, paths in sorted(prints.items(), key=lambda x: len(x[1])):
        name, mapping = REGISTRY[key], LAYOUTS[REGISTRY[key]][1]
        is_it = json_fingerprint(F.col("_record"), paths) == key
        layout = F.when(is_it, F.lit(name)).otherwise(layout)
        turns = F.when(is_it, mapping(get)).otherwise(turns)
    return out.select("conv_id", layout.alias("layout"), turns.alias("turns"))


# ----------------------------------------------------------------- template

def escape(text: Column) -> Column:
    """One backslash more after the opening bracket of every control string."""
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def _role_out(role: Column) -> Column:
    """A role on one line: a caret becomes ^c, a line break ^n; then control strings are escaped as in texts."""
    return escape(F.replace(F.replace(role, F.lit("^"), F.lit("^c")), F.lit("\n"), F.lit("^n")))


def _role_in(role: Column) -> Column:
    # Every caret is followed by c or n, so ^n is a line break wherever it stands.
    return F.replace(F.replace(unescape(role), F.lit("^n"), F.lit("\n")), F.lit("^c"), F.lit("^"))


def format_turns(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    ``loss_spans`` lists (start, length) in code points of ``formatted`` for
    the text of every turn of ``trained_role``. One shuffle by conversation;
    offsets are a running sum in turn order.
    """
    own = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(OPEN), _role_out(F.col("role")), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (own.select("*", head.alias("head"), escape(F.col("text")).alias("body"))
             .withColumn("pos", F.row_number().over(order))
             .withColumn("end", F.sum(F.length("head") + F.length("body") + F.lit(len(CLOSE))).over(whole)))
    piece = F.struct("pos", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "end",
                     F.length("body").cast("long").alias("n"), (F.col("role") == trained_role).alias("loss"))
    grouped = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    spans = F.transform(F.filter("p", lambda x: x["loss"]),
                        lambda x: F.struct((x["end"] - F.lit(len(CLOSE)) - x["n"]).alias("start"),
                                           x["n"].alias("length")))
    return grouped.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
                          spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of role, text) and ``loss_texts`` read from the formatted strings."""
    segments = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    bodies = F.transform(F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0))),
                         lambda s: F.substr(s, F.lit(len(OPEN) + 1)))
    turns = F.transform(bodies, lambda s: F.struct(
        _role_in(F.substring_index(s, "\n", 1)).alias("role"),
        unescape(F.substr(s, F.locate("\n", s) + F.lit(1))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss_texts"),
                            F.length("formatted").cast("long").alias("formatted_chars"))


def digest(back: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_back`` recovered."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
