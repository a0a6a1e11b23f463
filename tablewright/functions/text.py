"""Column expressions for text: stripping, number recognition, canonical keys.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------

# Characters Python's str.strip() removes: ASCII whitespace and separators
# 0x1C-0x1F, NEL, and every Unicode space separator (category Z).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　"
)

# The same whitespace as a regular-expression class (Java and RE2 syntax).
WS_CLASS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]"

# Text accepted as a number by the coercion step: optional surrounding
# whitespace, optional sign, digits with optional fraction (or a bare
# fraction), optional exponent; or an infinity word. Spark's own cast also
# accepts forms such as "1d" or "1f", which must not count as numbers here.
NUMBER_TEXT = (rf"^{WS_CLASS}*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
               rf"|(?i:inf|infinity)){WS_CLASS}*$")

# A boolean cell: one of BOOLEAN_TOKENS ("Y", "N" in config) with optional
# surrounding whitespace.
BOOLEAN_TEXT = rf"^{WS_CLASS}*(?:Y|N){WS_CLASS}*$"

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType,
)


INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# The spellings a CSV reader takes for a boolean; a column of nothing else
# counts as numeric, and its keys are "True" and "False".
TRUTH_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (the Python ``str.strip`` set)."""
    return F.btrim(c, F.lit(WHITESPACE))


def left_strip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def looks_numeric(text: Column) -> Column:
    """True when the text (ignoring surrounding whitespace) is a number; one
    anchored regular expression, no copy of the string."""
    return text.rlike(NUMBER_TEXT)


def looks_boolean(text: Column) -> Column:
    return text.rlike(BOOLEAN_TEXT)


def starts_with_after_space(text: Column, char: str) -> Column:
    """True when the first non-whitespace character is ``char`` (an
    anchored regular expression: no stripped copy of the text)."""
    return text.rlike(rf"^{WS_CLASS}*\{char}")


def try_number(c: Column, dtype: T.DataType) -> Column:
    """Value as DOUBLE: numeric types are cast, text is parsed only when it is
    number-shaped; anything else (and NaN) becomes null."""
    if isinstance(dtype, T.BooleanType):
        v = c.cast("int").cast("double")
    elif is_numeric_type(dtype):
        v = c.cast("double")
    else:
        s = c.cast("string")
        # Spark's cast trims ASCII whitespace itself; the stripped copy is
        # made only for number cells with other (Unicode) spaces around them.
        v = F.when(looks_numeric(s), F.coalesce(s.try_cast("double"), strip(s).try_cast("double")))
    # nanvl evaluates ``v`` once (a when(~isnan(v), v) would parse twice).
    return F.nanvl(v, F.lit(None).cast("double"))


def number_text(x: Column) -> Column:
    """Canonical text of a DOUBLE: integral values without a fraction."""
    integral = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    return F.when(integral, x.cast("long").cast("string")).otherwise(x.cast("string"))


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Category key of a value: canonical number text for numeric columns
    (integers and decimals digit by digit, without a detour over DOUBLE), the
    text itself otherwise."""
    if isinstance(dtype, INTEGER_TYPES):
        return c.cast("string")
    if isinstance(dtype, T.DecimalType):
        # 1.50 -> 1.5 and 1.00 -> 1
        return F.regexp_replace(c.cast("string"), r"\.0+$|(\.[0-9]*[1-9])0+$", "$1")
    if is_numeric_type(dtype):
        return number_text(try_number(c, dtype))
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def looks_truth(text: Column) -> Column:
    return text.isin(*TRUTH_TOKENS)


def number_or_truth_text(c: Column, dtype: T.DataType) -> Column:
    """Category key of a text cell in a column typed numeric_categorical: its
    number ("3", "3.0" and " 3" are all "3"; whole numbers digit by digit) or
    its truth word."""
    s = strip(c.cast("string"))
    whole = F.when(s.rlike(r"^[+-]?[0-9]{16,38}$"), s.try_cast("decimal(38,0)").cast("string"))
    word = F.when(looks_truth(c.cast("string")), F.initcap(c.cast("string")))
    return F.coalesce(whole, number_text(try_number(c, dtype)), word)


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null, or NaN for floating columns (both count as missing)."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
