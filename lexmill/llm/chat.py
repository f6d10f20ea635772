"""Chat formatting: schema fingerprints choose declarative mappings from any layout to turns, which one template writes.

A layout is known by its field paths: their sorted list, hashed, is the fingerprint. LAYOUTS says for each known layout
where turns, roles and texts are; it is data, so a new layout is a new entry. Tables are recognised by their columns, JSON by
the paths of each value, so one column may hold many layouts. All work is column expressions.

The template writes a turn as `<s>role newline [INST] text [/INST]</s>` (assistants without the instruction marks). Control strings inside
texts and roles are escaped by CODES, in that order, and `unescape` undoes it exactly. The loss mask is (start, length) in
code points of each assistant text.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings that would read as control, and what stands for them. The escape sign comes first.
CODES = [("\\", "\\0"), ("<s>", "\\1"), ("</s>", "\\2"), ("[INST]", "\\3"), ("[/INST]", "\\4")]
LINE = "\\5"  # a line feed in a role
OPEN, CLOSE, ASK, ASKED = "<s>", "</s>", "[INST]", "[/INST]"
LEARNED = "assistant"

# Layouts: field paths -> how to read the turns. `list`: a path to an array with role and text fields; `single`: (role, path) in
# order, absent or empty texts of optional ones being left out; `rows`: one row per turn, by conversation and place.
LAYOUTS = [
    {"paths": ["conv_id", "role", "text", "turn"], "rows": ("conv_id", "turn", "role", "text")},
    {"paths": ["messages[].content", "messages[].role"], "list": ("messages", "role", "content")},
    {"paths": ["conversations[].from", "conversations[].value"], "list": ("conversations", "from", "value")},
    {"paths": ["turns[].role", "turns[].text"], "list": ("turns", "role", "text")},
    {"paths": ["prompt", "response"], "single": [("user", "prompt", False), ("assistant", "response", False)]},
    {"paths": ["prompt", "completion"], "single": [("user", "prompt", False), ("assistant", "completion", False)]},
    {"paths": ["question", "answer"], "single": [("user", "question", False), ("assistant", "answer", False)]},
    {"paths": ["instruction", "output"], "single": [("user", "instruction", False), ("assistant", "output", False)]},
    {"paths": ["input", "instruction", "output"],
     "single": [("user", "instruction", False), ("user", "input", True), ("assistant", "output", False)]},
    {"paths": ["system", "prompt", "response"],
     "single": [("system", "system", True), ("user", "prompt", False), ("assistant", "response", False)]},
]
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role: string, text: string>>"


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def field_paths(schema: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves: `a.b`, with `[]` after arrays."""
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, at + "[]")
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return [at]


def json_paths(value: Column) -> Column:
    """Field paths of the JSON object in a variant column: two levels, as deep as any layout goes. An array has the
    fields of all its elements."""
    def keys(v: Column) -> Column:
        return F.map_keys(F.try_variant_get(v, "$", "map<string, variant>"))

    def below(k: Column, v: Column) -> Column:
        items = F.try_variant_get(v, "$", "array<variant>")
        names = F.flatten(F.transform(items, lambda e: F.coalesce(keys(e), F.array().cast("array<string>"))))
        return F.when(F.schema_of_variant(v).startswith("ARRAY<OBJECT"),
                      F.transform(F.array_distinct(names), lambda x: F.concat(k, F.lit("[]."), x))).otherwise(F.array(k))

    top = F.map_entries(F.try_variant_get(value, "$", "map<string, variant>"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(top, lambda e: below(e["key"], e["value"])))))


def _turn(role: Column, text: Column, named: bool = True) -> Column:
    """One turn; `named` puts the role names of other layouts into ours."""
    role = F.coalesce(role, F.lit("user"))
    ours = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    role = F.coalesce(F.try_element_at(ours, role), role) if named else role
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _read(layout: dict, text_at, list_at) -> Column:
    """Turns of one layout, given how to get a text by path and an array of (role, text) by path and fields."""
    if "list" in layout:
        return F.transform(list_at(*layout["list"]), lambda t: _turn(t["role"], t["text"]))
    parts = []
    for role, path, optional in layout["single"]:
        turn, text = _turn(F.lit(role), text_at(path)), text_at(path)
        parts.append(F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(TURNS)).otherwise(F.array(turn)) if optional else F.array(turn))
    return F.concat(*parts)


def json_turns(payload: Column) -> Column:
    """Turns of a JSON text by the layout of each value; null where it is not JSON or the layout is not known."""
    value = F.try_parse_json(payload)
    mark = F.sha2(F.array_join(json_paths(value), "\n"), 256)
    out = F.lit(None).cast(TURNS)
    for layout in (x for x in LAYOUTS if "rows" not in x):
        def listed(path, role, text):
            items = F.try_variant_get(value, f"$.{path}", "array<variant>")
            return F.transform(items, lambda v: F.struct(F.try_variant_get(v, f"$.{role}", "string").alias("role"),
                                                         F.try_variant_get(v, f"$.{text}", "string").alias("text")))
        turns = _read(layout, lambda path: F.try_variant_get(value, f"$.{path}", "string"), listed)
        out = F.when(mark == fingerprint(layout["paths"]), turns).otherwise(out)
    return out


def table_turns(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(conv_id, turns) of a table in a known layout; `columns` names those that make up the layout, where others stand beside.

    Tables of one row per turn are grouped: by conversation, turns in order of place, then role and text; their key stays.
    Other layouts have a conversation per row, numbered by `conv_id` if there is such a column, else null. A layout that is not
    known raises ValueError."""
    known = {fingerprint(x["paths"]): x for x in LAYOUTS}
    own = rows.select(*columns) if columns else rows.select(*[c for c in rows.columns if c != "conv_id"])
    for part in (own, rows):
        layout = known.get(fingerprint(field_paths(part.schema)))
        if layout:
            break
    else:
        raise ValueError(f"unknown layout: {sorted(field_paths(own.schema))}")
    if "rows" in layout:
        conv, place, role, text = layout["rows"]
        item = F.struct(F.col(place).alias("place"), _turn(F.col(role), F.col(text), named=False).alias("turn"))
        grouped = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(item)).alias("_items"))
        return grouped.select("conv_id", F.transform("_items", lambda x: x["turn"]).alias("turns"))
    key = F.col("conv_id") if "conv_id" in rows.columns else F.lit(None).cast("long").alias("conv_id")
    listed = lambda path, role, text: F.transform(F.col(path), lambda t: F.struct(
        t[role].cast("string").alias("role"), t[text].cast("string").alias("text")))
    return rows.select(key, _read(layout, lambda path: F.col(path).cast("string"), listed).alias("turns"))


def escape(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def format_turns(conversations: DataFrame) -> DataFrame:
    """Adds `formatted` and `loss_mask` (array of start, length) to (.., turns). Null turns give null, no turns the empty string;
    a null role is the user's, a null text empty."""
    def marks(t: Column) -> tuple[Column, Column]:
        learned = t["role"] == LEARNED
        head = F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n"), F.when(learned, "").otherwise(ASK))
        return head, F.when(learned, CLOSE).otherwise(ASKED + CLOSE)

    def write(t: Column) -> Column:
        head, tail = marks(t)
        body = escape(t["text"])
        return F.struct(F.concat(head, body, tail).alias("line"), F.length(head).cast("long").alias("skip"),
                        F.length(body).cast("long").alias("n"), (t["role"] == LEARNED).alias("learned"))

    out = conversations.withColumn("_lines", F.transform("turns", write))
    out = out.withColumn("formatted", F.concat_ws("", F.transform("_lines", lambda x: x["line"])))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["line"])).alias("at"),
        F.when(x["learned"], F.concat(acc["mask"], F.array(F.struct((acc["at"] + x["skip"]).alias("start"), x["n"].alias("length")))))
        .otherwise(acc["mask"]).alias("mask"))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("mask"))
    mask = F.aggregate(F.transform("_lines", lambda x: F.struct(x["line"], x["skip"], x["n"], x["learned"])), empty, step, lambda a: a["mask"])
    return out.withColumns({"loss_mask": mask, "formatted": F.when(F.col("turns").isNotNull(), F.col("formatted"))}).drop("_lines")


def read_back(formatted: Column) -> Column:
    """Turns that a formatted string holds: what `format_turns` was given."""
    lines = F.filter(F.split(formatted, CLOSE), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.regexp_extract(x, r"^<s>([^\n]*)\n", 1)
        body = F.substr(x, F.length(role) + len(OPEN) + 2)
        asked = unescape(F.substr(body, F.lit(len(ASK) + 1), F.length(body) - len(ASK) - len(ASKED)))
        return F.struct(_unescape_role(role).alias("role"), F.when(role == LEARNED, unescape(body)).otherwise(asked).alias("text"))

    return F.transform(lines, turn)


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts that the loss mask covers, unescaped and joined."""
    return F.concat_ws("", F.transform(mask, lambda m: unescape(F.substr(
        formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))))
