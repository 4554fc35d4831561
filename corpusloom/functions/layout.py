"""Layout detection and column look-up by name. Driver-side, no job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

LAYOUTS = ("auto", "text", "instruction", "chat", "conversation")

# The column names that tell a layout.
DETECT_CONVERSATION = ("conversations", "messages", "dialogue", "dialog")
DETECT_PROMPT = ("instruction", "prompt", "question", "input")
DETECT_RESPONSE = ("output", "response", "answer", "completion", "text")

# The column names looked up for a part, in order of preference.
FIELD_NAMES = {
    "text": ("text", "content", "document", "passage", "sentence"),
    "prompt": ("instruction", "prompt", "question", "input_text"),
    "response": ("output", "response", "answer", "completion", "target", "target_text"),
    "input": ("input", "context"),
    "conversation": ("conversations", "messages", "dialogue", "dialog", "chat"),
}

# The column that holds a line which could not be read, and nothing else.
CORRUPT = "_corrupt_record"

# Bookkeeping columns that are never content; the key is another one.
SYSTEM_COLUMNS = ("row_id", "split", CORRUPT)


def content_columns(df: DataFrame, key: str = "row_id") -> list[str]:
    return [c for c in df.columns if c not in SYSTEM_COLUMNS and c != key]


def detect_layout(df: DataFrame, prompt: str | None = None, response: str | None = None,
                  clean: bool = False, key: str = "row_id") -> str:
    """The layout of a table, from the names of its content columns.

    ``clean=True`` also lets explicit fields decide and knows the column name ``chat``.
    """
    names = set(content_columns(df, key))
    if clean and prompt and response:
        return "instruction"
    conversation = DETECT_CONVERSATION + (("chat",) if clean else ())
    if names.intersection(conversation):
        return "conversation"
    if names.intersection(DETECT_PROMPT) and names.intersection(DETECT_RESPONSE):
        return "instruction"
    return "text"


def resolve_field(df: DataFrame, kind: str, explicit: str | None = None,
                  clean: bool = False, key: str = "row_id") -> str | None:
    """The column that plays the part ``kind``; an explicit name always wins.

    Without a known name the first column is taken (the second for a response); the optional input
    has no such fallback. ``clean=True`` also looks up the names that detection knows.
    """
    if explicit:
        return explicit
    columns = content_columns(df, key)
    if not columns:
        raise ValueError("the table has no column with content")
    names = FIELD_NAMES[kind]
    if clean and kind == "prompt":
        names += ("input",)
    if clean and kind == "response":
        names += ("text",)
    for name in names:
        if name in columns:
            return name
    if kind == "input":
        return None
    return columns[1] if kind == "response" and len(columns) > 1 else columns[0]
