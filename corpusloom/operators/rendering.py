"""Rows to text: one rendered ``text`` per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions import layout as names
from corpusloom.functions.messages import render_conversation, render_roles
from corpusloom.functions.text import (
    INPUT_HEAD, INSTRUCTION_HEAD, RESPONSE_HEAD, append_eos, as_text, is_blank, json_text, strip,
    truthy, wrap_prompt,
)
from corpusloom.session import BROADCAST_ROWS

# A conversation of more turns than this is put together from parts.
TURNS_PER_PART = 100_000


def _field(df: DataFrame, name: str) -> tuple[Column, object]:
    # Resolving the name here makes a wrong one an AnalysisException before any job.
    c = F.col(f"`{name}`")
    return c, df.select(c).schema[0].dataType


def _text_of(df: DataFrame, name: str) -> Column:
    return strip(as_text(*_field(df, name)))


def render_text(df: DataFrame, text: str | None = None, key: str = "row_id") -> Column:
    """The stripped text column; null reads ``None``."""
    return _text_of(df, names.resolve_field(df, "text", text, key=key))


def render_instruction(df: DataFrame, prompt: str | None = None, response: str | None = None,
                       clean: bool = False, key: str = "row_id") -> Column:
    """Prompt and response under their headings, with an input section where there is one.

    The section is shown for any input that is not empty before it is stripped. ``clean=True`` tests
    it after stripping and never uses one column as prompt and as input.
    """
    prompt_name = names.resolve_field(df, "prompt", prompt, clean, key)
    response_name = names.resolve_field(df, "response", response, clean, key)
    input_name = names.resolve_field(df, "input", key=key)
    head = F.concat(F.lit(INSTRUCTION_HEAD), _text_of(df, prompt_name))
    tail = F.concat(F.lit(RESPONSE_HEAD), _text_of(df, response_name))
    if input_name is None or (clean and input_name == prompt_name):
        return F.concat(head, tail)
    value, dtype = _field(df, input_name)
    section = _text_of(df, input_name)
    shown = truthy(value, dtype) & (F.length(section) > 0 if clean else F.lit(True))
    return F.when(shown, F.concat(head, F.lit(INPUT_HEAD), section, tail)).otherwise(
        F.concat(head, tail))


def render_messages(df: DataFrame, conversation: str | None = None, style: str | dict = "manual",
                    clean: bool = False, key: str = "row_id") -> Column:
    """A message list as text, plain (``manual``) or with the markers of a style."""
    name = names.resolve_field(df, "conversation", conversation, key=key)
    c, dtype = _field(df, name)
    if style == "manual":
        return render_conversation(c, dtype, clean)
    return render_roles(c, dtype, style, clean)


def render(df: DataFrame, layout: str = "auto", text: str | None = None, prompt: str | None = None,
           response: str | None = None, conversation: str | None = None,
           style: str | dict = "manual", eos: str | None = None, key: str = "row_id",
           clean: bool = False) -> DataFrame:
    """Render every row and keep only the key, the split and ``text``.

    A projection; no row moves. Lines that could not be read (``split_bad_lines``) are no rows to
    render and are left out. ``clean=True`` drops rows whose content is null or blank before the
    end marker is added.
    """
    df, _ = split_bad_lines(df)
    if layout == "auto":
        layout = names.detect_layout(df, prompt, response, clean, key)
    if layout == "instruction":
        body = render_instruction(df, prompt, response, clean, key)
        used = [names.resolve_field(df, "prompt", prompt, clean, key),
                names.resolve_field(df, "response", response, clean, key)]
    elif layout in ("chat", "conversation"):
        body = render_messages(df, conversation, style, clean, key)
        used = [names.resolve_field(df, "conversation", conversation, key=key)]
    else:
        body = render_text(df, text, key)
        used = [names.resolve_field(df, "text", text, key=key)]
    if clean:
        for name in used:
            df = df.where(F.col(f"`{name}`").isNotNull())
    kept = [c for c in (key, "split") if c in df.columns and c != "text"]
    out = df.select(*kept, body.alias("text"))
    if clean:
        out = drop_blank(out)
    return out.withColumn("text", append_eos(F.col("text"), eos))


def render_trace(df: DataFrame, fields: tuple[str, ...] = ("context", "cot", "output", "completion"),
                 json_fields: tuple[str, ...] = ("output",), field_sep: str = "\n",
                 key: str = "row_id", json_as_is: bool = False, clean: bool = False) -> DataFrame:
    """Several fields of a row as one text, those of ``json_fields`` as JSON.

    A null text field is an error; ``clean=True`` drops the row. ``json_as_is=True`` takes a string
    column of ``json_fields`` for JSON text and copies it, instead of quoting it.
    """
    parts = []
    for name in fields:
        c, dtype = _field(df, name)
        if name in json_fields:
            as_is = json_as_is and dtype.typeName() in ("string", "varchar", "char")
            parts.append(F.coalesce(c, F.lit("null")) if as_is else json_text(c, dtype))
        elif clean:
            df = df.where(c.isNotNull())
            parts.append(c)
        else:
            parts.append(F.coalesce(
                c, F.raise_error(F.lit(f"null in text field {name}")).cast("string")))
    joined = F.concat(*[p for i, part in enumerate(parts)
                        for p in ([F.lit(field_sep)] if i else []) + [part]])
    kept = [c for c in (key, "split") if c in df.columns]
    return df.select(*kept, joined.alias("text"))


def wrap_prompts(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    return df.withColumn(prompt, wrap_prompt(F.col(prompt)))


def split_bad_lines(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows that were read, and the lines that were not (or None, if the reader kept none).

    Readers of JSON and CSV put a line that does not parse into a column of its own; that column
    goes from the first table, and the second has it as ``line`` beside key-like columns.
    """
    if names.CORRUPT not in df.columns:
        return df, None
    bad = F.col(names.CORRUPT)
    # Spark does not read that column of a file alone; any other one makes it read whole lines.
    other = next((F.col(f"`{c}`") for c in df.columns if c not in (names.CORRUPT, "split")), bad)
    read = other.isNull() | other.isNotNull()
    return df.where(bad.isNull() & read).drop(names.CORRUPT), df.where(
        bad.isNotNull() & read).select(
        *[c for c in ("row_id", "split") if c in df.columns], bad.alias("line"))


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is neither null nor blank."""
    return df.where(~is_blank(F.col(text)))


def keep_only(df: DataFrame, *columns: str, key: str = "row_id") -> DataFrame:
    """The named columns, with key and split where there are such."""
    system = [c for c in (key, "split") if c in df.columns and c not in columns]
    return df.select(*system, *columns)


def conversation_parts(df: DataFrame, key: str, order: str, role: str = "role",
                       text: str = "text", out: str = "messages",
                       turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """A table of turns to ordered message lists: ``key, part, out``.

    A conversation is one part, unless it has more than ``turns_per_part`` turns: then it is cut at
    values of ``order`` (a number, date or time) into parts of about that many, each a group of its
    own, and no task holds it whole. Parts in turn are the conversation.
    """
    return _parts(df, key, order, role, text, out, turns_per_part)[0]


def _parts(df, key, order, role, text, out, turns_per_part) -> tuple[DataFrame, bool]:
    """The parts, and whether any conversation has more than one."""
    turn = F.struct(
        F.col(order).alias("_order"), F.col(role).alias("role"), F.col(text).alias("content"))
    turns = df.select(key, turn.alias("_turn"))
    part = F.lit(0)
    long = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > turns_per_part)
    n_long, most = long.agg(F.count("*"), F.max("_n")).first()
    if n_long:
        pieces = -(-most // turns_per_part)
        shares = [i / pieces for i in range(1, pieces)]
        bounds = df.join(long, key, "left_semi").groupBy(key).agg(
            F.percentile_approx(order, shares, 10_000).alias("_bounds"))
        small = n_long * pieces <= BROADCAST_ROWS
        turns = turns.join(F.broadcast(bounds) if small else bounds, key, "left")
        part = F.coalesce(F.size(F.filter(
            "_bounds", lambda b: F.coalesce(b <= F.col("_turn._order"), F.lit(False)))), F.lit(0))
        part = F.when(F.col("_bounds").isNull(), 0).otherwise(part)
    grouped = turns.groupBy(key, part.alias("part")).agg(
        F.array_sort(F.collect_list("_turn")).alias("_turns"))
    bare = F.transform("_turns", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content")))
    return grouped.select(key, "part", bare.alias(out)), bool(n_long)


def assemble_conversations(df: DataFrame, key: str, order: str, role: str = "role",
                           text: str = "text", out: str = "messages",
                           turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """A table of turns to one ordered message list per conversation.

    The list is one value of one row, so a conversation ends in one task whatever is done: the parts
    of :func:`conversation_parts` are put one behind the other, without sorting them again. Go on
    with the parts where a conversation may not fit a task.
    """
    parts, several = _parts(df, key, order, role, text, out, turns_per_part)
    if not several:
        return parts.drop("part")
    whole = F.array_sort(F.collect_list(F.struct("part", out)))
    return parts.groupBy(key).agg(F.flatten(F.transform(whole, lambda p: p[out])).alias(out))
