"""Chat formatting: records of different layouts become turns, turns become text, and text becomes turns again.

A layout is known by its fingerprint, a hash of the sorted paths of its nested
fields. Declared mappings say for each layout where the turns are. All work is
done by DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<turn: bigint, role: string, text: string>>"

#: Control strings of the template: openings and closings of the roles' turns.
USER, USER_END = "[INST] ", " [/INST]"
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
ASSISTANT_END = "</s>"
OTHER, OTHER_TEXT, OTHER_END = "<|role|>", "<|text|>", "<|end|>"
#: What a text may not hold unescaped; a backslash after the first character escapes it, further ones are kept.
_CONTROL = r"(/?INST\]|</?SYS>>|/?s>|\|(?:role|text|end)\|>)"
#: Roles under other names.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


# -- layouts --------------------------------------------------------------------

def field_paths(kind: T.DataType, path: str = "$") -> Iterator[str]:
    """Paths of the leaves; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from field_paths(field.dataType, f"{path}.{field.name}")
    elif isinstance(kind, T.ArrayType):
        yield from field_paths(kind.elementType, f"{path}[]")
    else:
        yield path


def fingerprint(paths: Iterator[str] | list[str]) -> str:
    return xxhash.xxh64_hexdigest("\n".join(sorted(paths)))


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns: in a list of messages, in fields of one record, or one turn per row."""

    paths: tuple[str, ...]
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()  # role, field
    turn: str | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(list(self.paths))


MAPPINGS = {m.fingerprint: m for m in (
    Mapping(("$.messages[].role", "$.messages[].content"), messages="messages"),
    Mapping(("$.conversations[].from", "$.conversations[].value"), messages="conversations", role="from", text="value"),
    Mapping(("$.prompt", "$.completion"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping(("$.prompt", "$.response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping(("$.instruction", "$.output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping(("$.instruction", "$.input", "$.output"),
            fields=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping(("$.system", "$.prompt", "$.response"),
            fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping(("$.turn", "$.role", "$.text"), turn="turn", text="text"),
)}


class UnknownLayout(ValueError):
    """No mapping has the layout's fingerprint."""


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    role = F.coalesce(role.cast("string"), F.lit(""))
    return F.coalesce(known[F.lower(role)], role)


def _text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def canonical_turns(records: DataFrame, key: str) -> DataFrame:
    """``key, turns`` from records of one layout; ``turns`` is an array of (turn, role, text) in order.

    The fingerprint is taken over all columns but ``key`` that some mapping
    names at its top level; other columns are not looked at. Where columns of several layouts
    are there, so that no mapping has the fingerprint, the layout counts that has the most of them, if there is one
    such; a column named like a field of another layout does no harm. NULL roles and texts are
    empty; empty fields of one-record layouts (no ``input``, say) give no turn.
    Other names of roles are made ours, save in layouts of one row per turn, where
    roles stay as they are. There, rows are ordered by turn (NULL first), then
    role and text, and repeated rows stay; rows of a key are gathered, as a
    conversation is one output row. A NULL key is a conversation like any other.
    """
    named = {p.split(".")[1].removesuffix("[]") for m in MAPPINGS.values() for p in m.paths}
    own = [f for f in records.schema.fields if f.name != key and f.name in named]
    paths = set(field_paths(T.StructType(own)))
    m = MAPPINGS.get(fingerprint(list(paths)))
    if m is None:
        whole = sorted((m for m in MAPPINGS.values() if paths.issuperset(m.paths)), key=lambda m: -len(m.paths))
        if not whole or len(whole) > 1 and len(whole[0].paths) == len(whole[1].paths):
            raise UnknownLayout(f"no mapping for {sorted(paths)}")
        m = whole[0]
    if m.turn:
        row = F.struct(
            F.col(m.turn).cast("long").alias("turn"), _text(F.col(m.role)).alias("role"), _text(F.col(m.text)).alias("text"))
        return records.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("turns"))
    if m.messages:
        turns = F.transform(F.coalesce(F.col(m.messages), F.array()), lambda x, i: F.struct(
            i.cast("long").alias("turn"), _role(x[m.role]).alias("role"), _text(x[m.text]).alias("text")))
        return records.select(key, turns.alias("turns"))
    filled = F.filter(F.array(*[
        F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), _text(F.col(field)).alias("text"))
        for k, (role, field) in enumerate(m.fields)
    ]), lambda x: (x["text"] != "") | (x["role"] == "assistant"))
    return records.select(key, filled.alias("turns"))


def json_turns(records: DataFrame, key: str, record: str) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records of mixed layouts, and the records that no mapping fits (key, fingerprint, record).

    Each record's paths are read off its own fields, so that one table may hold
    every layout. Layouts of one row per turn need a table of their own. Records
    that are NULL or not JSON have no paths and are returned with the unknown.
    """
    value = F.try_parse_json(F.col(record).cast("string"))
    shape = F.regexp_replace(F.schema_of_variant(value), r": (?!OBJECT|ARRAY)[A-Z_]+(\([0-9,]*\))?", "")
    shaped = records.select(key, record, F.xxhash64(shape).alias("shape"), value.alias("value"))
    known, seen = None, []
    for m in MAPPINGS.values():
        if m.turn:
            continue
        if m.messages:
            layout = f"OBJECT<{m.messages}: ARRAY<OBJECT<{', '.join(sorted((m.role, m.text)))}>>>"
            kind = f"array<struct<{m.role}: string, {m.text}: string>>"
            columns = [F.try_variant_get("value", f"$.{m.messages}", kind).alias(m.messages)]
        else:
            layout = f"OBJECT<{', '.join(sorted(f for _, f in m.fields))}>"
            columns = [F.try_variant_get("value", f"$.{f}", "string").alias(f) for _, f in m.fields]
        own = F.xxhash64(F.lit(layout))
        seen.append(own)
        turns = canonical_turns(shaped.where(F.col("shape") == own).select(F.col(key), *columns), key)
        known = turns if known is None else known.unionByName(turns)
    fits = F.coalesce(F.col("shape").isin(*[v for v in records.sparkSession.range(1).select(*seen).first()]), F.lit(False))
    return known, shaped.where(~fits).select(key, F.col("shape").alias("fingerprint"), record)


# -- template -------------------------------------------------------------------

def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def _written(turn: Column) -> Column:
    text, role = escaped(turn["text"]), turn["role"]
    return (
        F.when(role == "user", F.concat(F.lit(USER), text, F.lit(USER_END)))
        .when(role == "assistant", F.concat(text, F.lit(ASSISTANT_END)))
        .when(role == "system", F.concat(F.lit(SYSTEM), text, F.lit(SYSTEM_END)))
        .otherwise(F.concat(F.lit(OTHER), escaped(role), F.lit(OTHER_TEXT), text, F.lit(OTHER_END)))
    )


def formatted(turns: DataFrame) -> DataFrame:
    """``formatted`` (the conversation as one string) and ``loss_spans`` beside the columns of ``turns``.

    ``loss_spans`` are the (first, last) code points, last exclusive, of each
    assistant text as it stands in the string. Conversations without turns are
    empty strings.
    """
    parts = turns.withColumn("parts", F.transform("turns", _written))
    text = F.array_join("parts", "")
    place = F.aggregate(
        F.arrays_zip(F.col("parts").alias("part"), F.transform("turns", lambda t: t["role"]).alias("role")),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<first: bigint, last: bigint>>").alias("spans")),
        lambda done, x: F.struct(
            (done["at"] + F.char_length(x["part"])).alias("at"),
            F.when(x["role"] == "assistant", F.array_append(done["spans"], F.struct(
                done["at"].alias("first"),
                (done["at"] + F.char_length(x["part"]) - len(ASSISTANT_END)).alias("last"))))
            .otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return parts.select(*turns.columns, text.alias("formatted"), place.alias("loss_spans"))


#: One turn of a formatted conversation.
_TURN = (
    r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>.*?<</SYS>>|<\|role\|>.*?<\|text\|>.*?<\|end\|>|.*?</s>"
)


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation."""
    def turn(part: Column, i: Column) -> Column:
        def inner(start: str, end: str) -> Column:
            return F.substring(part, F.lit(len(start) + 1), F.char_length(part) - len(start) - len(end))

        other = F.split(inner(OTHER, OTHER_END), r"<\|text\|>", 2)
        kinds = (
            F.when(part.startswith(USER), F.struct(F.lit("user").alias("role"), inner(USER, USER_END).alias("text")))
            .when(part.startswith(SYSTEM), F.struct(F.lit("system").alias("role"), inner(SYSTEM, SYSTEM_END).alias("text")))
            .when(part.startswith(OTHER), F.struct(other[0].alias("role"), other[1].alias("text")))
            .otherwise(F.struct(F.lit("assistant").alias("role"), inner("", ASSISTANT_END).alias("text")))
        )
        return F.struct(i.cast("long").alias("turn"), unescaped(kinds["role"]).alias("role"), unescaped(kinds["text"]).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), turn)


def digest(chats: DataFrame, key: str) -> DataFrame:
    """Counts and digests of formatted conversations, all read back from ``formatted`` and ``loss_spans``."""
    turns = chats.withColumn("read", read_turns(F.col("formatted")))
    listing = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substring(F.col("formatted"), s["first"].cast("int") + 1, (s["last"] - s["first"]).cast("int")))), "")
    return turns.select(
        key,
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(listing, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
