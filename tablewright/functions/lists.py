"""Parsing of list-valued and dict-valued cells into an ARRAY<STRING>.

Rules, in order, for one text cell:

1. null or blank after stripping -> no items;
2. hint ``dict``/``json`` and the text is bracketed ``[...]`` -> parsed as a
   JSON/Python list literal (single quotes allowed), items are the elements
   (nested values keep their JSON text, null elements are dropped);
   bracketed ``{...}`` and a valid object -> one item, the object text;
3. a bracketed list that does not parse loses its brackets and continues;
4. hint ``csv`` or a comma in the text -> split on commas, strip every part,
   drop blank parts;
5. otherwise the text is one item.

Array-typed cells are already lists: their elements are the items.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.config import HINT_CSV, HINT_DICT, HINT_JSON
from tablewright.functions.text import strip

ITEMS = T.ArrayType(T.StringType())
OBJECT = T.MapType(T.StringType(), T.StringType())


# A quoted string with its escapes, a run of text without quotes, or a quote
# that nothing closes.
TOKEN = r"""("[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"|'[^'\\]*+(?:\\[\s\S][^'\\]*+)*+'|[^"']+|["'])"""
ANY_ESCAPE = {"allowBackslashEscapingAnyCharacter": "true"}


def _python_literal_to_json(s: Column, true: str = "true", false: str = "false") -> Column:
    """Second-chance normalisation for literals JSON rejects: outside quoted
    text ``None``/``True``/``False``, tuples and trailing commas, inside it
    two-digit ``\\x`` escapes."""
    def token(t: Column) -> Column:
        bare = t
        for old, new in ((r"\bNone\b", "null"), (r"\bTrue\b", true), (r"\bFalse\b", false),
                         (r"\(", "["), (r"\)", "]"), (r",(\s*[\]}])", "$1")):
            bare = F.regexp_replace(bare, old, new)
        quoted = F.regexp_replace(t, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        return F.when(t.startswith('"') | t.startswith("'"), quoted).otherwise(bare)

    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit(TOKEN), 1), token), "")


def _python_list(s: Column) -> Column:
    """Items of a Python list literal; a boolean element keeps its Python text."""
    plain = F.from_json(_python_literal_to_json(s), ITEMS, ANY_ESCAPE)
    spelled = F.from_json(_python_literal_to_json(s, '"True"', '"False"'), ITEMS, ANY_ESCAPE)
    return F.zip_with(plain, spelled, lambda a, b: F.when(F.lower(b) == a, b).otherwise(a))


def _split_items(s: Column) -> Column:
    parts = F.transform(F.split(s, ","), strip)
    return F.filter(parts, lambda x: x != F.lit(""))


def parse_items(c: Column, dtype: T.DataType, hint: str | None) -> Column:
    """ARRAY<STRING> of the items of one cell (null when the cell has none)."""
    if isinstance(dtype, T.ArrayType):
        return F.filter(F.transform(c, lambda x: x.cast("string")), lambda x: x.isNotNull())
    if isinstance(dtype, (T.MapType, T.StructType)):
        return F.array(F.to_json(c))

    s = strip(c.cast("string"))
    s = F.when(s != F.lit(""), s)
    rest = s
    parsed = F.lit(None).cast(ITEMS)
    if hint in (HINT_DICT, HINT_JSON):
        is_list = s.startswith("[") & s.endswith("]")
        is_obj = s.startswith("{") & s.endswith("}")
        as_list = F.coalesce(F.from_json(s, ITEMS), _python_list(s))
        valid = F.coalesce(F.from_json(s, OBJECT), F.from_json(_python_literal_to_json(s), OBJECT, ANY_ESCAPE))
        as_obj = F.when(valid.isNotNull(), F.array(s))
        parsed = (
            F.when(is_list, F.filter(as_list, lambda x: x.isNotNull()))
            .when(is_obj, as_obj)
        )
        # A list literal that failed to parse continues without its brackets.
        unbracketed = strip(s.substr(F.lit(2), F.length(s) - 2))
        rest = F.when(is_list & as_list.isNull(), unbracketed).otherwise(s)
    if hint == HINT_CSV:
        fallback = _split_items(rest)
    else:
        fallback = F.when(rest.contains(","), _split_items(rest)).otherwise(F.array(rest))
    return F.when(s.isNotNull(), F.coalesce(parsed, fallback))
