"""Column functions: cleaning, lenient parsing, array text, JSON, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trimmed(c: Column) -> Column:
    """Without white space at both ends; null if nothing is left."""
    return F.nullif(F.regexp_replace(c, r"^\s+|\s+$", ""), F.lit(""))


def to_second(c: Column, pattern: str) -> Column:
    """A text as a timestamp of whole seconds; null where it doesn't fit the pattern."""
    return F.date_trunc("second", F.try_to_timestamp(c, F.lit(pattern)))


#: What an unquoted element can't hold, and stand-ins for quoted characters while a text is cut at
#: its commas: code points that Unicode keeps from being characters.
_SPECIAL = r'[{}",\\]|^\s|\s$|^$|^(?i:null)$'
_BACKSLASH, _QUOTE, _COMMA, _OPEN, _CLOSE, _QUOTED = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4", "\ufdd5"


def _element_text(x: Column, kind: T.DataType | None) -> Column:
    if isinstance(kind, T.ArrayType):
        return array_text(x, kind)
    text = F.concat(F.lit("\\x"), F.lower(F.hex(x))) if isinstance(kind, T.BinaryType) else x.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(text.rlike(_SPECIAL), quoted).otherwise(text)


def _depth(kind: T.DataType) -> int:
    return 1 + _depth(kind.elementType) if isinstance(kind, T.ArrayType) else 0


def array_text(c: Column, kind: T.ArrayType | None = None) -> Column:
    """An array as ``{a,b,null}``; null stays null. Elements with commas, braces, quotes, backslashes
    or blanks at their ends, empty ones and the word null are quoted, as databases write arrays.
    Arrays of arrays need their ``kind``; those of two levels can be read back."""
    if kind is not None and _depth(kind) > 2:
        raise ValueError("array text has two levels at most")
    element = kind.elementType if kind is not None else None
    texts = F.transform(c, lambda x: F.coalesce(_element_text(x, element), F.lit("null")))
    return F.when(c.isNotNull(), F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")))


def _protected(c: Column) -> Column:
    """Array text whose quoted parts hold no comma, brace or quote any more.

    Escaped characters become stand-ins first; then every other piece between quotes is quoted text.
    """
    free = F.replace(F.replace(c, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    free = F.regexp_replace(free, r"\\(.)", "$1")
    hidden = lambda x: F.translate(x, ",{}", _COMMA + _OPEN + _CLOSE)
    return F.array_join(F.transform(F.split(free, '"'), lambda x, i: F.when(i % 2 == 1, F.concat(F.lit(_QUOTED), hidden(x), F.lit(_QUOTED))).otherwise(x)), "")


def _element(x: Column, kind: T.DataType) -> Column:
    trimmed = F.trim(x)
    quoted = trimmed.startswith(_QUOTED)
    text = F.translate(F.replace(trimmed, F.lit(_QUOTED), F.lit("")), _COMMA + _OPEN + _CLOSE + _QUOTE + _BACKSLASH, ',{}"\\')
    value = F.unhex(F.substring(text, 3, 1 << 30)) if isinstance(kind, T.BinaryType) else text.try_cast(kind)
    return F.when(quoted | (F.lower(trimmed) != "null"), value)


def _inner(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*\{|\}\s*$", "")


def _elements(c: Column, kind: T.DataType) -> Column:
    inner = _inner(c)
    return F.when(F.trim(inner) == "", F.array().cast(T.ArrayType(kind))).otherwise(F.transform(F.split(inner, ","), lambda x: _element(x, kind)))


def text_array(c: Column, element: str | T.DataType) -> Column:
    """The inverse of array_text(): ``{a,"b,c",null}`` as an array of ``element``; an element that can't
    be read is null, and so is the array of a null text. Texts with U+FDD0 to U+FDD5, which are
    reserved against being characters, can't be read."""
    kind = T.DataType.fromDDL(element) if isinstance(element, str) else element
    if not isinstance(kind, T.ArrayType):
        return F.when(c.isNotNull(), _elements(_protected(c), kind))
    if _depth(kind) > 1:
        raise ValueError("array text has two levels at most")
    # commas next to a brace part arrays; what is left between them is a row of nulls
    parts = F.split(_inner(_protected(c)), r"(?<=\}),|,(?=\{)")
    rows = F.flatten(F.transform(parts, lambda x: F.when(F.trim(x).startswith("{"), F.array(x)).otherwise(F.split(x, ","))))
    read = F.transform(rows, lambda x: F.when(F.trim(x).startswith("{"), _elements(F.trim(x), kind.elementType)))
    return F.when(c.isNotNull(), F.when(F.trim(_inner(_protected(c))) == "", F.array().cast(T.ArrayType(kind))).otherwise(read))


def text_boolean(c: Column) -> Column:
    """t, true, 1 and f, false, 0 as a boolean; anything else is null."""
    return F.when(F.lower(c).isin("t", "true", "1"), True).when(F.lower(c).isin("f", "false", "0"), False)


def one_line_ends(c: Column) -> Column:
    """Text without NUL and with plain line feeds."""
    return F.regexp_replace(F.regexp_replace(c, "\u0000", ""), r"\r\n|\r", "\n")


def _as_json(kind: T.DataType) -> bool:
    """Maps, structs, arrays that hold them and arrays of more than two levels."""
    while isinstance(kind, T.ArrayType):
        if _depth(kind) > 2:
            return True
        kind = kind.elementType
    return isinstance(kind, (T.MapType, T.StructType))


def nested_to_json(df: DataFrame) -> DataFrame:
    """Map and struct columns as JSON text, and arrays of them."""
    nested = [f.name for f in df.schema if _as_json(f.dataType)]
    return df.withColumns({n: F.to_json(F.col(f"`{n}`")) for n in nested}) if nested else df


def to_flat_text(df: DataFrame) -> DataFrame:
    """Arrays as array text, strings with plain line ends, nested columns as JSON: what fits into CSV."""
    df, change = nested_to_json(df), {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            change[f.name] = array_text(c, f.dataType)
        elif isinstance(f.dataType, T.StringType):
            change[f.name] = one_line_ends(c)
    return df.withColumns(change) if change else df


def from_flat_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The inverse of to_flat_text() for arrays, JSON and booleans, and a lenient cast for the rest."""
    change = {}
    for f in schema:
        c = F.col(f"`{f.name}`")
        if _as_json(f.dataType):
            change[f.name] = F.from_json(c, f.dataType)
        elif isinstance(f.dataType, T.ArrayType):
            change[f.name] = text_array(c, f.dataType.elementType)
        elif isinstance(f.dataType, T.BooleanType):
            change[f.name] = text_boolean(c.cast("string"))
        else:
            change[f.name] = c.try_cast(f.dataType)
    return df.withColumns(change)


def row_hash(*columns: Column) -> Column:
    """32-bit Murmur3 of the columns. Null columns are skipped by it, so different rows may share
    one even more often than 32 bits make likely; row_digest() has no such collisions."""
    return F.hash(*columns)


def row_digest(*columns: Column) -> Column:
    """SHA-256 over the columns as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
