"""Conversations of any layout as canonical turns and training text. DataFrame functions only."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control strings of the template. Inside texts and roles the three characters they need are escaped.
TURN = "<turn {role}>\n{text}</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
ROLE_NAMES = {
    "human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
    "chatbot": "assistant", "ai": "assistant",
}


@dataclass(frozen=True)
class Layout:
    """How the turns of one layout are found.

    `parts`: (role, path) in order, each a text of its own that is skipped when it is null.
    `turns`: path of an array of turns, with `role` and `content` naming the fields of one turn.
    `rows`: the table has a row per turn; `key` names the conversation, `order` the turn.
    """

    name: str
    parts: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    content: str = ""
    key: str = ""
    order: str = ""

    def paths(self) -> tuple[str, ...]:
        if self.parts:
            return tuple(path for _, path in self.parts)
        fields = (f"{self.turns}[].{self.role}", f"{self.turns}[].{self.content}") if self.turns else (self.role, self.content)
        return tuple(p for p in (*fields, self.key, self.order) if p)


LAYOUTS = (
    Layout("rows", role="role", content="text", key="conv_id", order="turn"),
    Layout("messages", turns="messages", role="role", content="content"),
    Layout("conversations", turns="conversations", role="from", content="value"),
    Layout("nested_messages", turns="data.messages", role="role", content="content"),
    Layout("instruction_input", parts=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_with_input", parts=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction", parts=(("user", "instruction"), ("assistant", "output"))),
    Layout("prompt_response", parts=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", parts=(("user", "question"), ("assistant", "answer"))),
)


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Paths of all leaf fields; `[]` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def select_layout(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    """The layout whose fingerprint the schema has, among the paths that the layout asks for.

    Layouts with more paths are tried first, so extra columns never hide a layout and never choose a poorer one.
    """
    have = set(field_paths(schema))
    for layout in sorted(layouts, key=lambda x: -len(x.paths())):
        if fingerprint(have & set(layout.paths())) == fingerprint(layout.paths()):
            return layout
    raise ValueError(f"no layout has the fingerprint of {sorted(have)}")


def _role(role: Column) -> Column:
    lowered = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(known[lowered], lowered)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(_role(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>), by the mapping that the schema's fingerprint selects.

    In a table with a row per turn, rows of one conversation are sorted by turn, then role and text, repeated rows
    staying; a null turn sorts first. In the other layouts a row is a conversation: its id is the column `conv_id`
    or `id` where there is one, else null. Null texts are empty turns, except in layouts of named parts, where a
    null part is no turn. Role names become lower-case and known aliases `user` and `assistant`. An empty table gives an
    empty result; a conversation is one row of the result, however long its texts.
    """
    layout = select_layout(df.schema, layouts)
    if layout.key:
        turn = F.struct(F.col(layout.order).alias("at"), _turn(F.col(layout.role), F.col(layout.content)).alias("turn"))
        grouped = df.groupBy(F.col(layout.key).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        return grouped.select("conv_id", F.col("turns.turn").alias("turns"))
    named = [c for c in ("conv_id", "id") if c in df.columns]
    conv_id = F.col(named[0]) if named else F.lit(None).cast("bigint")
    if layout.turns:
        turns = F.transform(F.coalesce(F.col(layout.turns), F.array()), lambda x: _turn(x[layout.role], x[layout.content]))
    else:
        parts = [F.when(F.col(path).isNotNull(), _turn(F.lit(role), F.col(path))) for role, path in layout.parts]
        turns = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return df.select(conv_id.alias("conv_id"), turns.alias("turns"))


def from_json_rows(df: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turns) of a column of JSON texts in which each row has a layout of its own.

    Each row's own schema is inferred as a variant; the hash of its field paths selects the mapping for that row.
    Rows with no known layout, broken texts among them, come back with null turns.
    """
    row = F.try_parse_json(F.col(column))

    def at(path: str, kind: str) -> Column:
        return F.try_variant_get(row, f"$.{path}", kind)

    def mapping(layout: Layout) -> tuple[Column, Column]:
        """(whether the row's paths, among those the layout asks for, have its fingerprint; its turns)"""
        present = [F.when(at(path.split("[]")[0], "variant").isNotNull(), F.lit(path)) for path in layout.paths()]
        found = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*present)))), "\n")
        own = F.sha2(found.cast("binary"), 256) == fingerprint(layout.paths())
        if not layout.turns:
            parts = [F.when(at(path, "string").isNotNull(), _turn(F.lit(role), at(path, "string"))) for role, path in layout.parts]
            return own, F.filter(F.array(*parts), lambda x: x.isNotNull())
        items = at(layout.turns, "array<map<string,string>>")
        named = F.forall(items, lambda x: F.map_contains_key(x, layout.role) & F.map_contains_key(x, layout.content))
        return own & F.coalesce(named, F.lit(False)), F.transform(items, lambda x: _turn(x[layout.role], x[layout.content]))

    out = F.lit(None).cast("array<struct<role:string,text:string>>")
    chosen = [mapping(x) for x in sorted((x for x in layouts if not x.key), key=lambda x: -len(x.paths()))]
    for own, turns in reversed(chosen):
        out = F.when(own, turns).otherwise(out)
    conv_id = F.coalesce(F.try_variant_get(row, "$.conv_id", "bigint"), F.try_variant_get(row, "$.id", "bigint"))
    return df.select(conv_id.alias("conv_id"), out.alias("turns"))


def escape(text: Column) -> Column:
    """Text without `<` and `>`: each escape is a backslash and a letter, and a backslash is one too."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Inverse of `escape`. Every backslash begins an escape, so undoing the escaped backslash last is exact."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, formatted) from canonical turns.

    `formatted` is the segments put together. The segments under the loss mask are the escaped texts of the
    assistant's turns, without their control strings. No turns give no segments and an empty text.
    """
    head, tail = TURN.split("{text}")
    before, after = head.split("{role}")

    def segments(turn: Column) -> Column:
        own = turn["role"] == "assistant"
        return F.array(
            F.struct(F.concat(F.lit(before), escape(turn["role"]), F.lit(after)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), own.alias("loss")),
            F.struct(F.lit(tail).alias("text"), F.lit(False).alias("loss")),
        )

    made = turns.select("conv_id", F.flatten(F.transform(F.coalesce("turns", F.array()), segments)).alias("segments"))
    return made.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Formatted conversations read back: `turns` from the text, `loss_text` from the segments under the mask."""
    turn = r"<turn ([^<>]*+)>\n([^<>]*+)</turn>\n"
    whole = [F.regexp_extract_all("formatted", F.lit(turn), F.lit(i)) for i in (1, 2)]
    turns = F.transform(F.arrays_zip(whole[0].alias("role"), whole[1].alias("text")), lambda x: F.struct(unescape(x["role"]).alias("role"), unescape(x["text"]).alias("text")))
    loss = F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: unescape(x["text"]))
    return formatted.select("*", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"))
