"""Message lists as text: typed arrays, JSON text, and marker styles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from corpusloom.functions.text import as_text, capitalize

# The keys of a message, in order of preference.
ROLE_KEYS = ("role", "from")
CONTENT_KEYS = ("content", "value", "text")
UNKNOWN_ROLE = "unknown"

# What the JSON parser takes. Single quotes are no JSON; NaN and infinities are read.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}

# Fixed values: (style, role) -> text before and after the content.
STYLES = {
    "chatml": {
        "system": ("<|im_start|>system\n", "<|im_end|>\n"),
        "user": ("<|im_start|>user\n", "<|im_end|>\n"),
        "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n"),
    },
    "inst": {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": (" ", " "),
    },
}


def _no_role(clean: bool, why: str) -> Column:
    if clean:
        return F.lit(UNKNOWN_ROLE)
    return F.raise_error(F.lit(why)).cast("string")


def _turn(role: Column, content: Column) -> Column:
    return F.concat(capitalize(role), F.lit(": "), content)


# --- typed arrays --------------------------------------------------------------------------------

def _struct_parts(m: Column, fields: dict[str, T.DataType], clean: bool) -> tuple[Column, Column]:
    role_key = next((k for k in ROLE_KEYS if k in fields), None)
    content_key = next((k for k in CONTENT_KEYS if k in fields), None)
    role = F.lit(UNKNOWN_ROLE)
    if role_key:
        role = F.coalesce(m[role_key].cast("string"), _no_role(clean, "message with a null role"))
    content = as_text(m[content_key], fields[content_key]) if content_key else F.lit("")
    return role, content


def _render_typed(c: Column, element: T.DataType, clean: bool) -> Column:
    if isinstance(element, T.StructType):
        fields = {f.name: f.dataType for f in element.fields}

        def one(m):
            return F.when(m.isNull(), "None").otherwise(_turn(*_struct_parts(m, fields, clean)))
    else:
        def one(m):
            return as_text(m, element)
    return F.array_join(F.transform(c, one), "\n\n")


# --- JSON text -----------------------------------------------------------------------------------

def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _value_text(v: Column) -> Column:
    kind = _kind(v)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(F.is_variant_null(v), "None")
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def _first_present(v: Column, keys: tuple[str, ...]) -> Column:
    # A key that is there with a null is a variant null, one that is not there is an SQL null.
    return F.coalesce(*[F.variant_get(v, "$." + k, "variant") for k in keys])


def _variant_parts(role: Column, content: Column, clean: bool) -> tuple[Column, Column]:
    role_text = (
        F.when(role.isNull(), UNKNOWN_ROLE)
        .when(_kind(role) == "STRING", F.try_variant_get(role, "$", "string"))
        .otherwise(_no_role(clean, "message whose role is not text"))
    )
    return role_text, F.when(content.isNull(), "").otherwise(_value_text(content))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _only(c: Column, element: str) -> Column:
    """JSON text as one value of the type ``element``; null unless all of the text is that value.

    The text stands in a list before an empty one: the parser stops where a list ends, so that
    anything left over shows in the number of values.
    """
    whole = F.from_json(F.concat(F.lit("["), c, F.lit(",[]]")), f"array<{element}>", STRICT)
    return _let(whole, lambda w: F.when(F.size(w) == 2, F.get(w, F.lit(0))))


def _items(c: Column) -> Column:
    """The items of a JSON list, each a variant of its own; null for anything else."""
    return _only(c, "array<variant>")


def _item_text(v: Column, clean: bool) -> Column:
    parts = _variant_parts(_first_present(v, ROLE_KEYS), _first_present(v, CONTENT_KEYS), clean)
    return F.when(F.startswith(_kind(v), F.lit("OBJECT")), _turn(*parts)).otherwise(_value_text(v))


def _repeating_text(item: Column, clean: bool) -> Column:
    """An item as JSON text that may be an object with repeated keys, of which the last counts."""
    def value(entries, key):
        return F.try_element_at(
            F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]

    def last(entries, keys):
        return F.coalesce(*[value(entries, key) for key in keys])

    def one(entries):
        parts = _variant_parts(last(entries, ROLE_KEYS), last(entries, CONTENT_KEYS), clean)
        return F.when(entries.isNotNull(), _turn(*parts))

    entries = F.map_entries(F.from_json(item, "map<string,variant>", STRICT))
    return F.when(F.startswith(item, F.lit("{")), F.coalesce(_let(entries, one), item)).otherwise(
        F.coalesce(item, F.lit("None")))


def _render_json(c: Column, clean: bool) -> Column:
    def joined(items, one):
        return F.when(items.isNotNull(), F.array_join(F.transform(items, one), "\n\n"))

    listed = _let(_items(c), lambda x: joined(x, lambda v: _item_text(v, clean)))
    single = _let(_only(c, "variant"), lambda v: F.when(v.isNotNull(), _value_text(v)))
    # A variant has no repeated keys: lists with such objects are taken apart as text.
    repeating = _let(_only(c, "array<string>"), lambda x: joined(
        x, lambda v: _repeating_text(v, clean)))
    return F.when(c.isNull(), "None").otherwise(F.coalesce(listed, single, repeating, c))


def render_conversation(c: Column, dtype: T.DataType, clean: bool = False) -> Column:
    """``Role: content`` per message, joined by an empty line; the text is not stripped.

    Takes arrays of structs, arrays of scalars and JSON text. Text that is no JSON as a whole stays
    as it is. JSON is read strictly, by one rule for texts of any size; an item may not pass the
    size limit of a variant. Of repeated keys in a message the last counts (a message
    with repeated keys further down stays as its JSON text), NaN and infinities print as they are written. Null lists read ``None``; ``clean=True`` leaves them null, and reads a null role as unknown.
    """
    if isinstance(dtype, T.ArrayType):
        text = _render_typed(c, dtype.elementType, clean)
    elif isinstance(dtype, T.StringType):
        text = _render_json(c, clean)
    else:
        text = as_text(c, dtype)
    if clean:
        return F.when(c.isNotNull(), text)
    return F.coalesce(text, F.lit("None"))


def _role_content(c: Column, dtype: T.DataType) -> Column | None:
    """The messages as ``array<struct<role, content>>``; null parts where there is no such text."""
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        fields = dtype.elementType.names
        if "role" not in fields or "content" not in fields:
            return None
        return F.transform(c, lambda m: F.struct(
            m["role"].cast("string").alias("role"), m["content"].cast("string").alias("content")))
    if isinstance(dtype, T.StringType):
        return F.transform(_items(c), lambda v: F.struct(
            F.try_variant_get(v, "$.role", "string").alias("role"),
            F.try_variant_get(v, "$.content", "string").alias("content")))
    return None


def render_roles(c: Column, dtype: T.DataType, style: str | dict = "chatml",
                 clean: bool = False) -> Column:
    """Messages with the markers of a style: a name of ``STYLES`` or a map role -> (before, after).

    A list with a role that the style lacks, or without role and content, is written in the plain
    form of :func:`render_conversation`.
    """
    markers = STYLES[style] if isinstance(style, str) else style
    plain = render_conversation(c, dtype, clean)
    messages = _role_content(c, dtype)
    if messages is None:
        return plain
    known = F.forall(
        messages, lambda m: F.coalesce(m["role"].isin(*markers), F.lit(False))
        & m["content"].isNotNull())

    def one(m):
        return F.coalesce(*[
            F.when(m["role"] == role, F.concat(F.lit(before), m["content"], F.lit(after)))
            for role, (before, after) in markers.items()])

    marked = F.array_join(F.transform(messages, one), "")
    return F.when(F.coalesce(known, F.lit(False)), marked).otherwise(plain)
