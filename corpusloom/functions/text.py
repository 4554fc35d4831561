"""Text expressions with the string semantics of Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The headings of the instruction layout.
INSTRUCTION_HEAD = "### Instruction:\n"
INPUT_HEAD = "\n\n### Input:\n"
RESPONSE_HEAD = "\n\n### Response:\n"
PREFORMATTED_PREFIXES = ("<|im_start|>", "[INST]")


def strip(c: Column) -> Column:
    """Unicode strip; Spark's own ``trim`` only removes spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return F.coalesce(F.length(strip(c)) == 0, F.lit(True))


def as_text(c: Column, dtype: T.DataType) -> Column:
    """A value of any type as text: null is ``None``, booleans are ``True`` / ``False``.

    Nested values become JSON text.
    """
    if isinstance(dtype, T.StringType):
        text = c
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(c.cast("string"))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = json_text(c, dtype)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("None"))


def truthy(c: Column, dtype: T.DataType) -> Column:
    """Whether a value counts as present: not null, not empty, not zero, not false."""
    if isinstance(dtype, T.StringType):
        test = c != ""
    elif isinstance(dtype, T.BooleanType):
        test = c
    elif isinstance(dtype, T.NumericType):
        test = c != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    elif isinstance(dtype, T.BinaryType):
        test = F.length(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def capitalize(c: Column) -> Column:
    """First letter upper, the rest lower (``initcap`` would raise every word)."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))


def append_eos(c: Column, eos: str | None) -> Column:
    """Add the end marker unless the text ends with it already."""
    if not eos:
        return c
    return F.when(F.endswith(c, F.lit(eos)), c).otherwise(F.concat(c, F.lit(eos)))


def wrap_prompt(c: Column) -> Column:
    """Put a prompt into the instruction layout unless it is formatted already."""
    formatted = F.contains(c, F.lit(INSTRUCTION_HEAD.rstrip()))
    for prefix in PREFORMATTED_PREFIXES:
        formatted = formatted | F.startswith(c, F.lit(prefix))
    return F.when(formatted, c).otherwise(
        F.concat(F.lit(INSTRUCTION_HEAD), c, F.lit(RESPONSE_HEAD))
    )


def _json_string(c: Column) -> Column:
    # The value of a one-field object, without the object around it: {"v":"..."}
    whole = F.to_json(F.struct(c.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def json_text(c: Column, dtype: T.DataType) -> Column:
    """JSON with ``", "`` and ``": "`` as separators, fields in declared order, null as ``null``."""
    if isinstance(dtype, T.StructType):
        parts = []
        for i, field in enumerate(dtype.fields):
            lead = ("{" if i == 0 else ", ") + '"' + field.name + '": '
            parts += [F.lit(lead), json_text(c.getField(field.name), field.dataType)]
        text = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda v: json_text(v, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.concat(
                _json_string(e["key"].cast("string")), F.lit(": "),
                json_text(e["value"], dtype.valueType),
            ),
        )
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        text = c.cast("string")
    elif isinstance(dtype, T.VariantType):
        text = F.to_json(c)
    else:
        text = _json_string(c.cast("string"))
    return F.when(c.isNull(), "null").otherwise(text)
