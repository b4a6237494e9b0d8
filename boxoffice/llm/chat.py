"""Chat formatting by schema fingerprint, in DataFrame functions only.

1. A table's nested field paths, or those of each JSON record, are hashed to a fingerprint.
2. The fingerprint selects a declarative mapping: which path holds the turns, the roles and the
   texts, or which paths are one turn each. All layouts become turns (conversation, turn, role,
   text); other names for the three roles are made canonical.
3. Turns are rendered by a template that marks every turn and escapes control strings inside
   texts, so that a formatted conversation can be read back exactly. ``loss_spans`` has a span for
   each turn, empty but for assistant texts.

Offsets and lengths count code points. A turn is a row until it is joined to its conversation;
only the text of one conversation, which is one value, is ever in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
HEAD, END = "### ", "\n</turn>\n"


@dataclass(frozen=True)
class Fields:
    """How one layout becomes turns; paths are JSON paths of a record or column names of a table."""

    turns: str | None = None  # an array of turns
    role: str | None = None  # within a turn
    text: str | None = None
    single: tuple[tuple[str, str], ...] = ()  # (role, path) of layouts with one field for each turn


def paths_of(schema: T.DataType, at: str = "") -> list[str]:
    """Nested field paths with the kind of their leaves; arrays are ``[]``."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in paths_of(f.dataType, f"{at}.{f.name.lower()}")]
    if isinstance(schema, T.ArrayType):
        return paths_of(schema.elementType, f"{at}[]")
    return [f"{at}:{'text' if isinstance(schema, T.StringType) else 'other'}"]


def fingerprint(schema: T.DataType) -> str:
    """Hash of the sorted nested field paths; the order of fields does not matter."""
    return hashlib.sha256("\n".join(sorted(paths_of(schema))).encode()).hexdigest()[:32]


def _layout(ddl: str) -> str:
    return fingerprint(T._parse_datatype_string(ddl))


# Layouts that are known by their fields; a caller may pass more.
LAYOUTS: dict[str, tuple[str, Fields]] = {
    "messages": ("messages array<struct<role string, content string>>", Fields("messages", "role", "content")),
    "sharegpt": ("conversations array<struct<from string, value string>>", Fields("conversations", "from", "value")),
    "instruction": (
        "instruction string, output string",
        Fields(single=(("user", "instruction"), ("assistant", "output"))),
    ),
    "instruction-input": (
        "instruction string, input string, output string",
        Fields(single=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    ),
    "prompt-response": ("prompt string, response string", Fields(single=(("user", "prompt"), ("assistant", "response")))),
    "prompt-completion": (
        "prompt string, completion string",
        Fields(single=(("user", "prompt"), ("assistant", "completion"))),
    ),
    "system-prompt-response": (
        "system string, prompt string, response string",
        Fields(single=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    ),
    "question-answer": ("question string, answer string", Fields(single=(("user", "question"), ("assistant", "answer")))),
    "turn-rows": ("turn bigint, role string, text string", Fields(role="role", text="text")),
}
TURN_ROWS = "turn-rows"


def known_layouts(more: Mapping[str, tuple[str, Fields]] | None = None) -> dict[str, Fields]:
    """Mapping by fingerprint."""
    return {_layout(ddl): mapping for ddl, mapping in {**LAYOUTS, **(more or {})}.values()}


def turns_of_table(df: DataFrame, key: str, more: Mapping[str, tuple[str, Fields]] | None = None) -> DataFrame:
    """(key, turn, role, text) of a table whose columns beside ``key`` are one of the known layouts.

    The mapping is the one whose fields are all there: first of the table's own fingerprint, then,
    as extra columns may be there, of the largest part of its columns that is a known layout.
    """
    layouts = {**LAYOUTS, **(more or {})}
    columns = [field for field in df.schema.fields if field.name != key]
    known = known_layouts(more)
    mapping = known.get(fingerprint(T.StructType(columns)))
    if mapping is None:
        sized = sorted(layouts.values(), key=lambda layout: -len(T._parse_datatype_string(layout[0]).fields))
        for ddl, candidate in sized:
            names = {field.name for field in T._parse_datatype_string(ddl).fields}
            part = [_narrowed(f, T._parse_datatype_string(ddl)) for f in columns if f.name.lower() in names]
            if fingerprint(T.StructType(part)) == _layout(ddl):
                mapping = candidate
                break
        else:
            raise ValueError(f"no mapping for {paths_of(T.StructType(columns))}")
    if mapping.turns is None and not mapping.single:
        rows = df.select(F.col(key).alias("key"), F.col("turn").cast("long"), F.col(mapping.role).alias("role"), F.col(mapping.text).alias("text"))
        return _canonical(rows)
    if mapping.single:
        parts = [F.struct(F.lit(role).alias("role"), F.col(path).cast("string").alias("text")) for role, path in mapping.single]
        turns = F.filter(F.array(*parts), lambda part: part["text"].isNotNull())
    else:
        turns = F.transform(
            F.col(mapping.turns),
            lambda turn: F.struct(turn[mapping.role].alias("role"), turn[mapping.text].alias("text")),
        )
    rows = df.select(F.col(key).alias("key"), F.posexplode(turns).alias("turn", "said"))
    return _canonical(rows.select("key", F.col("turn").cast("long"), "said.role", "said.text"))


def _narrowed(field: T.StructField, layout: T.StructType) -> T.StructField:
    """The field without members that the layout does not have."""
    wanted = layout[field.name.lower()].dataType
    if isinstance(wanted, T.ArrayType) and isinstance(field.dataType, T.ArrayType):
        inner = field.dataType.elementType
        if isinstance(inner, T.StructType):
            kept = [f for f in inner.fields if f.name.lower() in wanted.elementType.fieldNames()]
            return T.StructField(field.name, T.ArrayType(T.StructType(kept)))
    return field


def turns_of_records(df: DataFrame, key: str, record: str, more: Mapping[str, tuple[str, Fields]] | None = None) -> DataFrame:
    """(key, turn, role, text) of JSON records, each of its own layout.

    Every record's nested paths are hashed in the query itself and select its mapping; else, as
    keys may be added and values null, the largest known layout whose paths are all there does.
    ``unmapped_records`` returns the others, null and broken JSON among them.
    """
    marked = _mapped(df, F.col(key), record, more)
    rows = marked.select("key", F.posexplode("turns").alias("turn", "said"))
    return _canonical(rows.select("key", F.col("turn").cast("long"), "said.role", "said.text"))


def unmapped_records(df: DataFrame, key: str, record: str, more: Mapping[str, tuple[str, Fields]] | None = None) -> DataFrame:
    """(key, record) of the records that no known layout fits."""
    return _mapped(df, F.col(key), record, more).where("turns IS NULL").select("key", F.col("raw").alias("record"))


def _mapped(df: DataFrame, key: Column, record: str, more: Mapping[str, tuple[str, Fields]] | None) -> DataFrame:
    """(key, raw, turns): turns is null if no layout fits."""
    parsed = df.select(key.alias("key"), F.col(record).alias("raw"), F.try_parse_json(F.col(record)).alias("record"))
    marked = parsed.withColumn("schema", F.schema_of_variant("record"))
    layouts = [(T._parse_datatype_string(d), d, m) for d, m in {**LAYOUTS, **(more or {})}.values() if m.turns or m.single]
    turns = F.lit(None).cast("array<struct<role: string, text: string>>")
    for kind, _, mapping in sorted(reversed(layouts), key=lambda layout: len(layout[0].fields)):  # the largest comes last, so first
        turns = F.when(_there(F.col("record"), kind), _record_turns(mapping)).otherwise(turns)
    for _, ddl, mapping in layouts:
        found = F.sha2("schema", 256) == F.lit(record_fingerprint(ddl))
        turns = F.when(found, _record_turns(mapping)).otherwise(turns)
    return marked.select("key", "raw", turns.alias("turns"))


def _there(value: Column, kind: T.DataType) -> Column:
    """Whether a variant has all paths of a layout; null counts as any leaf."""
    if isinstance(kind, T.StructType):
        found = F.lit(True)
        for field in kind.fields:
            found = found & _there(F.try_variant_get(value, f"$.{field.name}", "variant"), field.dataType)
        return found
    if isinstance(kind, T.ArrayType):
        return F.coalesce(
            F.forall(F.try_variant_get(value, "$", "array<variant>"), lambda one: _there(one, kind.elementType)), F.lit(False)
        )
    leaf = "STRING" if isinstance(kind, T.StringType) else "BIGINT"
    return F.coalesce(F.schema_of_variant(value).isin(leaf, "VOID"), F.lit(False))


def record_fingerprint(ddl: str) -> str:
    """The fingerprint of records of a layout: the hash of the schema that ``schema_of_variant`` gives them."""
    return hashlib.sha256(_variant_schema(T._parse_datatype_string(ddl)).encode()).hexdigest()


def _variant_schema(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return "OBJECT<" + ", ".join(f"{f.name}: {_variant_schema(f.dataType)}" for f in fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_variant_schema(kind.elementType)}>"
    return "STRING" if isinstance(kind, T.StringType) else "BIGINT"


def _record_turns(mapping: Fields) -> Column:
    record = F.col("record")
    if mapping.single:
        parts = [
            F.struct(F.lit(role).alias("role"), F.try_variant_get(record, f"$.{path}", "string").alias("text"))
            for role, path in mapping.single
        ]
        return F.filter(F.array(*parts), lambda part: part["text"].isNotNull())
    inner = f"array<struct<`{mapping.role}`: string, `{mapping.text}`: string>>"
    return F.transform(
        F.try_variant_get(record, f"$.{mapping.turns}", inner),
        lambda turn: F.struct(turn[mapping.role].alias("role"), turn[mapping.text].alias("text")),
    )


def _canonical(rows: DataFrame) -> DataFrame:
    """Null roles and texts are empty; known other names of a role are replaced."""
    role = F.coalesce(F.col("role"), F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return rows.select(
        "key", "turn", F.coalesce(F.try_element_at(names, F.lower(role)), role).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def escaped(text: Column) -> Column:
    """No ``#`` or ``<`` is left without a backslash before it, so no control string can occur."""
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#<])", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """(key, formatted, loss_spans) of (key, turn, role, text); loss_spans is array<struct<start, length>> by turn.

    Turns are in order of turn, null first, then role and text, so repeated rows are repeated
    turns. Line ends in roles are escaped with the letter n.
    """
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(HEAD), role, F.lit("\n"))
    rows = turns.withColumn("body", escaped(F.col("text"))).withColumn("head", head)
    order = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    piece = F.concat("head", "body", F.lit(END))
    before = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    said = F.when(F.col("role") == "assistant", F.length("body")).otherwise(0).cast("long")
    placed = rows.withColumn("piece", piece).select(
        "key",
        F.row_number().over(order).alias("at"),
        "piece",
        F.struct((before + F.length("head")).alias("start"), said.alias("length")).alias("span"),
    )
    joined = placed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "span"))).alias("all"))
    return joined.select(
        "key",
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.col("all.span").alias("loss_spans"),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """(key, turn, role, text, loss_text) of (key, formatted, loss_spans): turn from 0, loss_text null without loss.

    Texts come from the formatted text alone; loss_text is what lies under the turn's span of it.
    """
    pieces = F.split("formatted", r"\n</turn>\n")
    whole = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last mark
    rows = formatted.select("key", F.posexplode(F.arrays_zip(whole.alias("piece"), "loss_spans")).alias("turn", "both"))
    rows = rows.select("key", F.col("turn").cast("long").alias("turn"), F.col("both.piece").alias("piece"), F.col("both.loss_spans").alias("span"))
    order = Window.partitionBy("key").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("piece") + len(END)).over(order), F.lit(0))
    mark = F.instr("piece", "\n")
    role = F.substring(F.col("piece"), F.lit(len(HEAD) + 1), mark - len(HEAD) - 1)
    # An escaped backslash before n is told from an escaped line end by looking at pairs.
    role = F.regexp_replace(role, r"\G((?:[^\\]|\\[\\#<])*?)\\n", "$1\n")
    under = F.substring(F.col("piece"), (F.col("span.start") - before + 1).cast("int"), F.col("span.length").cast("int"))
    return rows.select(
        "key",
        "turn",
        unescaped(role).alias("role"),
        unescaped(F.substring(F.col("piece"), mark + 1, F.length("piece"))).alias("text"),
        F.when(F.col("span.length") > 0, unescaped(under)).alias("loss_text"),
    )
