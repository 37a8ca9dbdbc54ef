"""Chat formatting with schema fingerprints; DataFrame functions only.

A layout is known by the hash of its nested field paths. A registry of declarative mappings, by that hash, turns
prompt, instruction and message layouts into canonical turns ``(conv_id, turn, role, text)``. A template with marked
turns and reversible escapes then makes one text a conversation, with the spans that the loss counts.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfield.llm.common import stash

MARK, END = "<|im_start|>", "<|im_end|>"
#: Strings that a tokenizer may take for control tokens; none may stand in a text unescaped.
CONTROLS = (MARK, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested paths of a type; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping_:
    """How a layout becomes turns.

    ``rows``: each row is a turn, with the columns for turn, role and text. ``messages``: an array column with the fields for
    role and text. ``fields``: ``(role, column, ...)`` per turn, whose non-empty columns are joined by an empty line; a turn with
    none of them is left out. ``roles`` renames roles.
    """

    paths: tuple[str, ...]
    rows: tuple[str, str, str] | None = None
    messages: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, ...], ...] = ()
    roles: tuple[tuple[str, str], ...] = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))


LAYOUTS = (
    Mapping_(("turn", "role", "text"), rows=("turn", "role", "text")),
    Mapping_(("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping_(("prompt", "completion"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping_(("question", "answer"), fields=(("user", "question"), ("assistant", "answer"))),
    Mapping_(("instruction", "input", "output"), fields=(("user", "instruction", "input"), ("assistant", "output"))),
    Mapping_(("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping_(("system", "prompt", "response"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping_(("messages[].role", "messages[].content"), messages=("messages", "role", "content")),
    Mapping_(("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value")),
)
REGISTRY: Mapping[str, Mapping_] = {fingerprint(x.paths): x for x in LAYOUTS}


#: Mappings of one registry, at most, as each set of them has a fingerprint.
MOST_LAYOUTS = 12


def known_paths(registry: Mapping[str, Mapping_]) -> list[str]:
    return sorted({p for m in registry.values() for p in m.paths})


def resolved(registry: Mapping[str, Mapping_]) -> dict[str, Mapping_]:
    """The mapping for every fingerprint that a row can have: of the paths of the mappings that it satisfies, and no others.

    A row may satisfy several; the one with most paths is meant, ties by its paths.
    """
    if len(registry) > MOST_LAYOUTS:
        raise ValueError(f"a registry has {MOST_LAYOUTS} layouts at most")
    found: dict[frozenset[str], Mapping_] = {}
    for m in sorted(registry.values(), key=lambda m: (len(m.paths), m.paths)):
        # sets with m, which is the largest of them so far
        found |= {paths | frozenset(m.paths): m for paths in [frozenset(), *found]}
    best = {}
    for paths in found:
        fits = [m for m in registry.values() if set(m.paths) <= paths]
        best[fingerprint(sorted(paths))] = max(fits, key=lambda m: (len(m.paths), m.paths))
    return best


def layout_of(df: DataFrame, id_col: str, registry: Mapping[str, Mapping_]) -> Mapping_:
    """The mapping of ``df``'s layout, by the fingerprint of those of its paths that some mapping needs and finds whole; other columns and fields don't count."""
    paths = set(field_paths(T.StructType([f for f in df.schema.fields if f.name != id_col])))
    own = {p for m in registry.values() if set(m.paths) <= paths for p in m.paths}
    use = resolved(registry).get(fingerprint(sorted(own)))
    if use is None:
        raise ValueError(f"no mapping for a layout with the paths {sorted(paths)}")
    return use


TURNS = "array<struct<turn: bigint, role: string, text: string>>"


def turns_of(use: Mapping_, value: Callable[[str], Column]) -> Column:
    """The turns of one row of a layout with messages or fields, from its columns (``value`` of a name)."""
    if use.messages:
        items, role, text = use.messages
        return F.transform(value(items), lambda m, i: F.struct(i.cast("long").alias("turn"), m[role].alias("role"), m[text].alias("text")))
    made = []
    for role, *columns in use.fields:
        parts = F.array_compact(F.array(*(F.when(value(c) != "", value(c)) for c in columns)))
        made.append(F.struct(F.lit(role).alias("role"), F.when(F.size(parts) > 0, F.array_join(parts, "\n\n")).alias("text")))
    return F.transform(F.filter(F.array(*made), lambda m: m["text"].isNotNull()), lambda m, i: F.struct(i.cast("long").alias("turn"), m["role"], m["text"]))


def named(role: Column, use: Mapping_) -> Column:
    names = F.create_map(*(F.lit(x) for pair in use.roles for x in pair))
    return F.coalesce(names[F.coalesce(role, F.lit(""))], role, F.lit(""))


def complete(turns: Column, use: Mapping_) -> Column:
    """Turns with canonical roles and without nulls."""
    return F.transform(turns, lambda t: F.struct(t["turn"].alias("turn"), named(t["role"], use).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))


def canonical_turns(df: DataFrame, id_col: str = "conv_id", registry: Mapping[str, Mapping_] = REGISTRY) -> DataFrame:
    """``(conv_id, turn, role, text)`` of any registered layout; null roles and texts become empty."""
    use = layout_of(df, id_col, registry)
    conv = F.col(id_col).alias("conv_id")
    if use.rows:
        turn, role, text = (F.col(c) for c in use.rows)
        out = df.select(conv, turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    else:
        out = df.select(conv, F.inline(turns_of(use, F.col)))
    return out.select("conv_id", "turn", named(F.col("role"), use).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def step(name: str) -> str:
    """A field in a path of ``variant_get``."""
    return f"""$['{name}']"""


def has_path(value: Column, path: str) -> Column:
    """Whether a JSON value has a path of fields, or of the fields of an array's elements: of any of them, or of none where the array is empty or null."""
    if "[]" not in path:
        return F.try_variant_get(value, step(path), "variant").isNotNull()
    items, field = path.split("[].")
    some = F.exists(F.try_variant_get(value, step(items), "array<variant>"), lambda x: F.try_variant_get(x, step(field), "variant").isNotNull())
    empty = F.size(F.try_variant_get(value, step(items), "array<variant>")) == 0
    return F.coalesce(some | empty, F.is_variant_null(F.try_variant_get(value, step(items), "variant")), F.lit(False))


def variant_layouts(df: DataFrame, column: str, id_col: str = "conv_id", registry: Mapping[str, Mapping_] = REGISTRY) -> tuple[DataFrame, DataFrame]:
    """``(turns, rejects)`` of a column of JSON texts whose layout differs from row to row; layouts of one turn a row aren't looked for.

    Each row's fingerprint is that of its paths that some mapping needs and finds whole, as in ``canonical_turns``, and the mapping under that fingerprint makes its turns, in one pass for all
    layouts. Other fields don't count, wherever they are; an empty or null array of messages is a conversation without turns, and a message without role or text has an empty one. A row that is null,
    isn't JSON or satisfies no mapping is a reject (``conv_id, value, error``).
    """
    registry = {k: m for k, m in registry.items() if not m.rows}
    table, order = resolved(registry), list(registry.values())
    text = F.col(column)
    parsed = df.select(F.col(id_col).alias("conv_id"), text.alias("value"), F.try_parse_json(text).alias("__v"))
    has = {p: F.col("__has")[i] for i, p in enumerate(known_paths(registry))}
    parsed = parsed.withColumn("__has", F.array(*(has_path(F.col("__v"), p) for p in has)))
    whole = [(m, functools.reduce(lambda a, b: a & b, (has[p] for p in m.paths))) for m in order]
    kept = [F.when(functools.reduce(lambda a, b: a | b, (ok for m, ok in whole if p in m.paths)), F.lit(p)) for p in has]
    parsed = parsed.withColumn("__layout", F.substring(F.sha2(F.array_join(F.array_compact(F.array(*kept)), "\n"), 256), 1, 16))
    which = F.from_json(F.lit(json.dumps({k: order.index(m) for k, m in table.items()})), "map<string, int>")
    parsed = parsed.withColumn("__use", F.try_element_at(which, F.col("__layout")))
    turns = F.lit(None).cast(TURNS)
    for i, use in enumerate(order):
        if use.messages:
            items, role, said = use.messages
            get = lambda m, c: F.try_variant_get(m, step(c), "string")
            own = F.transform(F.try_variant_get("__v", step(items), "array<variant>"), lambda m, k: F.struct(k.cast("long").alias("turn"), get(m, role).alias("role"), get(m, said).alias("text")))
            own = F.coalesce(own, F.array().cast(TURNS))
        else:
            own = turns_of(use, lambda c: F.try_variant_get("__v", step(c), "string"))
        turns = F.when(F.col("__use") == i, complete(own, use)).otherwise(turns)
    error = F.when(F.col("value").isNull(), "null").when(F.col("__v").isNull(), "not JSON").when(F.col("__use").isNull(), "no mapping for this layout")
    # written once, for both results
    out = stash(parsed.select("conv_id", F.when(error.isNotNull(), F.col("value")).alias("value"), error.alias("error"), turns.alias("turns")), "layouts")
    return out.filter("error IS NULL").select("conv_id", F.inline("turns")), out.filter("error IS NOT NULL").select("conv_id", "value", "error")


def control_pattern(controls: Sequence[str] = CONTROLS) -> tuple[str, str]:
    """The first characters of the controls, and what follows them after any number of backslashes, as patterns."""
    for c in controls:
        if any(re.search(re.escape(d[0]) + r"\\*" + re.escape(d[1:]), c[1:]) for d in controls):
            raise ValueError(f"{c!r} holds another control string")
    heads = "[" + "".join(re.escape(h) for h in sorted({c[0] for c in controls})) + "]"
    rest = "|".join(re.escape(c) for c in sorted({c[1:] for c in controls}))
    return heads, rest


def escape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    """A backslash after the first character of each control string, or of one that has backslashes there already."""
    heads, rest = control_pattern(controls)
    return F.regexp_replace(text, rf"({heads})(?=\\*(?:{rest}))", r"$1\\")


def unescape(text: Column, controls: Sequence[str] = CONTROLS) -> Column:
    heads, rest = control_pattern(controls)
    return F.regexp_replace(text, rf"({heads})\\(?=\\*(?:{rest}))", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    whole = F.transform(F.split(role, r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(whole, "\\"))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_spans)``, a row a conversation.

    ``formatted`` has ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn, by turn; ties are put in the order of role and text.
    ``loss_spans`` are ``(start, length)`` in code points of the texts of ``trained_role``. Turns without a ``conv_id`` are one
    conversation; roles and texts may be null (then empty). Repeated turns are turns of their own, and an empty table gives no row. One conversation is one row, so it has to fit in one: its turns meet in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({"head": F.concat(F.lit(MARK), escape_role(F.col("role")), F.lit("\n")), "body": escape(F.col("text"))})
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)))
    span = F.struct((F.col("start") + F.length("head")).cast("int").alias("start"), F.length("body").alias("length"))
    parts = F.sort_array(F.collect_list(F.struct("start", "piece")))
    spans = F.sort_array(F.collect_list(F.when(F.col("role") == trained_role, span)))
    out = rows.groupBy("conv_id").agg(parts.alias("parts"), spans.alias("loss_spans"))
    return out.select("conv_id", F.array_join(F.col("parts.piece"), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, formatted, turns, loss_text)`` from the output of ``format_chats``: turns with role and text, and the text under the mask."""
    pieces = F.slice(F.split("formatted", re.escape(MARK)), 2, F.lit(1 << 30))
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END) - 1)).alias("text"),
        ),
    )
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))
