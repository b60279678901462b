"""Chat formatting by schema fingerprint, in DataFrame expressions only.

A record is a JSON text in one of several layouts (prompt and response,
instruction and output, message lists, ...). Its nested field paths, without
the scalar types, are hashed; the hash selects a declarative mapping that
turns the record into canonical turns (role, text). A template writes the
turns with control strings, escaping those inside texts reversibly, and marks
the characters that a loss is taken on.

A JSON parser's usual limit of 20 M characters a string and the 128 MiB of a
variant do not bound a record: the variant that the paths are taken from gets
the record's outline, without its texts, and these are read by ``from_json``
without a limit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
_TURNS = "array<struct<role: string, text: string>>"
_BAD = "_malformed"
_NO_LIMIT = {"maxStringLen": str(2**31 - 1), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'  # possessive, so of any length


@dataclass(frozen=True)
class Mapping:
    """One layout: the field paths it is known by, nested as an example
    record, and the turns of such a record, given as a struct of its fields."""

    name: str
    fields: dict
    turns: Callable[[Column], Column]

    def read(self, json: Column) -> Column:
        """The record's fields, and whether it is malformed."""
        return F.from_json(json, f"struct<{_ddl(self.fields)[7:-1]}, `{_BAD}`: string>", _NO_LIMIT)


def _ddl(example) -> str:
    """The type of an example; scalars of any type are read as texts."""
    if isinstance(example, dict):
        return "struct<" + ", ".join(f"`{k}`: {_ddl(v)}" for k, v in example.items()) + ">"
    return f"array<{_ddl(example[0])}>" if isinstance(example, list) else "string"


def _text(v: Column, field: str) -> Column:
    return F.coalesce(v[field], F.lit(""))


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _fields(*parts: tuple[str, str]) -> Callable[[Column], Column]:
    """Turns from single fields: (role, field) in order."""
    return lambda v: F.array(*[_turn(role, _text(v, field)) for role, field in parts])


def _listed(field: str, role: str, text: str, names: dict[str, str] | None = None) -> Callable[[Column], Column]:
    """Turns from a list of objects; ``names`` translates its role names."""

    def turns(v: Column) -> Column:
        rows = v[field]
        plain = F.coalesce  # a missing role or text is empty

        def one(m: Column) -> Column:
            r = plain(m[role], F.lit(""))
            for old, new in (names or {}).items():
                r = F.when(m[role] == old, F.lit(new)).otherwise(r)
            return F.struct(r.alias("role"), plain(m[text], F.lit("")).alias("text"))

        return F.transform(F.coalesce(rows, F.array()), one)

    return turns


def _instruction_input(v: Column) -> Column:
    given = _text(v, "input")
    ask = F.when(given == "", _text(v, "instruction")).otherwise(F.concat(_text(v, "instruction"), F.lit("\n\n"), given))
    return F.array(_turn("user", ask), _turn("assistant", _text(v, "output")))


_SHARED_NAMES = {"human": "user", "gpt": "assistant"}
MAPPINGS = (
    Mapping("messages", {"messages": [{"role": "", "content": ""}]}, _listed("messages", "role", "content")),
    Mapping("shared", {"conversations": [{"from": "", "value": ""}]},
            _listed("conversations", "from", "value", _SHARED_NAMES)),
    Mapping("prompt", {"prompt": "", "response": ""}, _fields(("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", {"prompt": "", "completion": ""}, _fields(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", {"instruction": "", "output": ""}, _fields(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction input", {"instruction": "", "input": "", "output": ""}, _instruction_input),
    Mapping("system instruction", {"system": "", "instruction": "", "output": ""},
            _fields(("system", "system"), ("user", "instruction"), ("assistant", "output"))),
)


def _shape(example) -> str:
    """The example's field paths as ``field_paths`` writes them."""
    if isinstance(example, dict):
        return "OBJECT<" + ", ".join(f"{k}: {_shape(v)}" for k, v in sorted(example.items())) + ">"
    return f"ARRAY<{_shape(example[0])}>" if isinstance(example, list) else "*"


def field_paths(v: Column) -> Column:
    """Nested field names of a variant, scalars of any type (or null) as ``*``."""
    return F.regexp_replace(F.schema_of_variant(v), r"\b(VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|STRING|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "*")


def fingerprint(v: Column) -> Column:
    return F.sha2(field_paths(v), 256)


def outline(json: Column) -> Column:
    """JSON with the same field paths: strings are emptied (not field names),
    and of equal objects in a row one is left."""
    emptied = F.regexp_replace(json, rf'("{_STRING}"\s*+:)|("){_STRING}(")', "$1$2$3")
    return F.regexp_replace(emptied, r"(\{[^{}\[\]]*+\})(?:\s*+,\s*+\1)++", "$1")


def canonical_turns(records: DataFrame, record: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` as ``row`` (struct of its columns, so names cannot clash),
    with ``fingerprint``, ``layout`` and ``turns``.

    A record that is null, is no JSON, is malformed anywhere, or has a layout
    that no mapping declares keeps its row, with a null layout and no turns.
    An empty message list cannot show its fields: it is such a record too,
    unless declared. Numbers and booleans used as texts are taken as they are
    written. Records of any size are read in the same way.
    """
    json = F.col("row")[record].cast("string")
    told = (records.select(F.struct(*[records[c] for c in records.columns]).alias("row"))
            .withColumn("fingerprint", fingerprint(F.try_parse_json(outline(json)))))
    hits = [F.col("fingerprint") == F.sha2(F.lit(_shape(m.fields)), 256) for m in mappings]
    read = told.select("row", "fingerprint", *[F.when(hit, m.read(json)).alias(f"m{i}")
                                               for i, (hit, m) in enumerate(zip(hits, mappings, strict=True))])
    layout, turns = F.lit(None).cast("string"), F.array().cast(_TURNS)
    for i, m in enumerate(mappings):
        fields = F.col(f"m{i}")
        whole = fields.isNotNull() & fields[_BAD].isNull()
        layout, turns = F.when(whole, F.lit(m.name)).otherwise(layout), F.when(whole, m.turns(fields)).otherwise(turns)
    return read.select("row", "fingerprint", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    r"""``<|`` becomes ``<\|``, and ``<\|`` one backslash more, so no control
    string is left in the text and ``unescape`` restores it exactly."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """Roles end at the line's end, so line breaks in them are escaped too."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.array_join(F.transform(F.split(unescape(role), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def render(turns: Column) -> Column:
    """Struct of ``formatted`` and ``loss``: the spans (start, chars, in code
    points) of the formatted text that hold what the assistant says."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), _escape_role(F.coalesce(t["role"], F.lit(""))), F.lit("\n")).alias("head"),
        escape(F.coalesce(t["text"], F.lit(""))).alias("body"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("own")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, chars: int>>").alias("spans"))
    spans = F.aggregate(parts, zero, lambda a, p: F.struct(
        (a["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).alias("at"),
        F.when(p["own"], F.array_append(a["spans"], F.struct((a["at"] + F.length(p["head"])).alias("start"),
                                                             F.length(p["body"]).alias("chars"))))
        .otherwise(a["spans"]).alias("spans")))["spans"]
    formatted = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return F.struct(formatted.alias("formatted"), spans.alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, exactly as they were rendered."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    body = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))
    return F.transform(body, lambda p: F.struct(
        _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["chars"]))), "")


def as_records(turns: DataFrame) -> DataFrame:
    """``conv_id, record``: the rows (conv_id, turn, role, text) of each
    conversation by turn (ties by role, then text) as a JSON record, in the
    narrowest layout that holds its roles. Null roles and texts are empty."""
    rows = F.array_sort(F.collect_list(F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))))  # the turns of one conversation
    convs = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(rows.alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    said = [F.get("t", F.lit(i))["text"] for i in range(3)]
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    shared = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    pick = F.pmod("conv_id", F.lit(4))
    speaker = {"user": "human", "assistant": "gpt"}

    def shared_name(r: Column) -> Column:
        out = r
        for new, old in speaker.items():
            out = F.when(r == new, F.lit(old)).otherwise(out)
        return out

    record = (
        F.when(pair & (pick == 0), F.to_json(F.struct(said[0].alias("prompt"), said[1].alias("response"))))
        .when(pair & (pick == 1), F.to_json(F.struct(said[0].alias("instruction"), said[1].alias("output"))))
        .when(pair & (pick == 2), F.to_json(F.struct(said[0].alias("prompt"), said[1].alias("completion"))))
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.to_json(F.struct(
            said[0].alias("system"), said[1].alias("instruction"), said[2].alias("output"))))
        .when(shared & (pick == 3), F.to_json(F.struct(F.transform("t", lambda t: F.struct(
            shared_name(t["role"]).alias("from"), t["text"].alias("value"))).alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))))
    return convs.select("conv_id", record.alias("record"))


def format_records(records: DataFrame, record: str, **options) -> DataFrame:
    """``row, layout, formatted, loss`` of every record."""
    turns = canonical_turns(records, record, **options)
    return turns.select("row", "layout", render(F.col("turns")).alias("r")).select("row", "layout", "r.formatted", "r.loss")
