"""Chat formatting: schema fingerprints select the mapping that turns a layout into canonical turns.

The fingerprint of a table is the SHA-256 of its sorted nested field paths. Each known layout declares its paths and how
its fields become turns (role, text); a table with the same fingerprint gets that mapping. A table with more columns is
matched by the fingerprint of the layout's own columns, the layout with the most paths first.

The template writes a turn as `<s>role[INST]text[/INST]</s>`. Backslashes in roles and texts are doubled and a backslash
is put after the first character of every control string, so marks and texts can't be confused and `read_back` restores
all texts. The loss mask lists the spans of assistant texts in the formatted string, by turn.

Scale: column expressions only. Layouts with a row per conversation need no shuffle; a row per turn takes one shuffle by
conversation. A conversation is one value of the result and has to fit a row; nothing else is collected.

Defined results: null roles and texts are empty; a null or empty list of turns gives an empty conversation; turns with
one number are ordered by role and text, and repeated rows stay repeated turns; null ids form one conversation of turn
rows; other columns are ignored, also those that share a name with a result column.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Layout:
    """`turns` names an array of structs, `fields` (role, columns) fixed turns, `order` a column of a row per turn."""

    name: str
    paths: tuple[str, ...]
    id: str
    role: str = "role"
    text: str = "text"
    turns: str | None = None
    order: str | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def columns(self) -> set[str]:
        return {p.split(".")[0].removesuffix("[]") for p in self.paths}


LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), "conv_id", order="turn"),
    Layout("messages", ("id", "messages[].role", "messages[].content"), "id", text="content", turns="messages"),
    Layout("from and value", ("id", "conversations[].from", "conversations[].value"), "id", "from", "value", "conversations",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("instruction", ("id", "instruction", "input", "output"), "id",
           fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt", ("id", "prompt", "response"), "id", fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system prompt", ("id", "system", "prompt", "response"), "id",
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
)


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def select_layout(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout:
    by_print = {fingerprint(x.paths): x for x in layouts}
    if found := by_print.get(fingerprint(field_paths(schema))):
        return found
    for x in sorted(layouts, key=lambda x: -len(x.paths)):
        own = T.StructType([f for f in schema.fields if f.name in x.columns])
        if fingerprint(field_paths(own)) in by_print and by_print[fingerprint(field_paths(own))] is x:
            return x
    raise ValueError(f"no mapping for the fields {field_paths(schema)}")


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as structs (role, text)."""
    x = select_layout(df.schema, layouts)
    whole = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def role_of(c: Column) -> Column:
        known = [F.when(c == old, new) for old, new in x.roles.items()]
        return F.coalesce(*known, whole(c))

    if x.order:
        rows = df.select(F.col(x.id).alias("conv_id"), F.struct(
            F.col(x.order).alias("at"), role_of(F.col(x.role)).alias("role"), whole(F.col(x.text)).alias("text")).alias("turn"))
        listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    if x.turns:
        turns = F.transform(F.col(x.turns), lambda t: F.struct(role_of(t[x.role]).alias("role"), whole(t[x.text]).alias("text")))
        none = F.expr("cast(array() as array<struct<role:string,text:string>>)")
        return df.select(F.col(x.id).alias("conv_id"), F.coalesce(turns, none).alias("turns"))
    turns = [
        F.struct(F.lit(role).alias("role"), F.array_join(F.filter(F.array(*[whole(F.col(c)) for c in cols]), lambda t: t != ""), "\n").alias("text"))
        for role, cols in x.fields
    ]
    return df.select(F.col(x.id).alias("conv_id"), F.array(*turns).alias("turns"))


OPEN, BODY, CLOSE = "<s>", "[INST]", "[/INST]</s>"
_CONTROL = r"(<|\[)(/?(?:s>|INST\]))"
_ESCAPED = r"(<|\[)\\(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _ESCAPED, "$1$2"), F.lit("\\\\"), F.lit("\\"))


def format_chat(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): `loss` lists the spans (turn, start, size) of assistant texts.

    A turn's number counts from 0, `start` from the turn's first mark, in code points. Places inside turns take one
    step per turn to write and to read, where places in the whole string would take a walk through it each.
    """
    safe = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")))
    rows = conversations.select("conv_id", safe.alias("safe"))
    chunks = F.transform("safe", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(BODY), t["text"], F.lit(CLOSE)))
    spans = F.transform("safe", lambda t, i: F.struct(
        i.alias("turn"), (F.length(t["role"]) + (len(OPEN) + len(BODY))).alias("start"),
        F.when(t["loss"], F.length(t["text"])).alias("size")))
    return rows.select("conv_id", F.array_join(chunks, "").alias("formatted"), F.filter(spans, lambda s: s["size"].isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) from the formatted string and the loss mask alone."""
    rows = formatted.select("conv_id", "formatted", "loss", F.split("formatted", r"\[/INST\]</s>", -1).alias("chunks"))
    bodies = F.transform(F.filter("chunks", lambda c: c != ""), lambda c: F.substring(c, len(OPEN) + 1, 2**31 - 1))
    split = lambda b: F.split(b, r"\[INST\]", 2)
    turns = F.transform(bodies, lambda b: F.struct(unescape(F.get(split(b), 0)).alias("role"), unescape(F.get(split(b), 1)).alias("text")))
    masked = F.transform("loss", lambda s: unescape(F.substring(F.get("chunks", s["turn"]), s["start"] + 1, s["size"])))
    return rows.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def digests(read: DataFrame) -> DataFrame:
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
