"""Column expressions that decode one push frame.

Every frame is parsed once into a VARIANT (``try_parse_json``), as the only element
of a list; all fields are then read from that value by their paths (a part of it taken
out as a VARIANT is copied whole, an order book too). VARIANT keeps number text as written (``12345678.9``
stays ``12345678.9``; ``get_json_object`` would print ``1.23456789E7``) and lets
us test JSON types, which the classification and error rules depend on.

All helpers return ``pyspark.sql.Column`` and run inside whole-stage codegen;
there is no Python on the per-row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.schema import (
    CONTROL_FRAMES, DEADLETTER_CHARS, FIELD_DEFAULT, FUNDING_RATE_FORMAT, FUNDING_RATE_ZERO,
    JSON_WHITESPACE, MAX_DEPTH_LEVELS, PY_WHITESPACE,
)

_NUMERIC_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "BOOLEAN")
# Widest range datetime accepts: years 1 to 9999, in epoch milliseconds.
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def vget(v: Column, path: str, type_: str = "variant") -> Column:
    return F.try_variant_get(v, path, type_)


#: Paths of a frame and of its payload in the list that it is parsed into.
FRAME = "$[0]"
DATA = f"{FRAME}.data"


def vtype(v: Column) -> Column:
    """Type name of a variant value: 'OBJECT<..>', 'ARRAY<..>', 'STRING', 'VOID' (JSON null), ..."""
    return F.schema_of_variant(v)


def is_numeric_type(t: Column) -> Column:
    return t.isin(*_NUMERIC_TYPES) | t.startswith("DECIMAL")


def is_control(value: Column) -> Column:
    """Rule 1: a frame that trims to ``ping`` or ``pong``."""
    return F.trim(value, F.lit(PY_WHITESPACE)).isin(*CONTROL_FRAMES)


_NEXT_VALUE_RE = r"[}\]]\s*(?:,\s*)?[\[{]"


# Room for the shortest digits of any double without an exponent.
_PLAIN_FORMAT = "0." + "#" * 340
# From here on doubles are whole; their text is read as a decimal while it fits one.
_WHOLE = 1e16


def plain_decimal(x: Column) -> Column:
    """A DOUBLE's shortest text without an exponent: 1e-20 keeps its twenty decimals, 1e25 its zeros.

    Two formatting calls: the same by regular expressions, for every field, is more code than a method may hold.
    """
    size = F.abs(x)
    whole = F.when(size >= _WHOLE, size.cast("string").try_cast("decimal(38,0)"))
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")),
                    F.coalesce(F.call_function("format_number", whole, F.lit("0")), F.call_function("format_number", size, F.lit(_PLAIN_FORMAT))))


def in_list(value: Column) -> Column:
    """The frame parsed as the element of a list: text after a whole document is then no JSON, or a second element."""
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))


def is_one_object(listed: Column) -> Column:
    """The list holds one object and nothing else: an ordinary frame, a whole document and no text after it."""
    return vget(listed, FRAME, "struct<>").isNotNull() & vget(listed, "$[1]").isNull()


def has_trailing_text(value: Column, listed: Column, one: Column) -> Column:
    """A JSON document followed by more text (Python rejects it; VARIANT parsing does not).

    An object must end with ``}`` and an array with ``]``. Where a bracket closes and
    another value begins right after it, two documents in a row are no JSON, or two
    elements, as the element of a list (``listed``). Frames that are ``one`` object
    there are not searched for such a place.
    """
    s = F.trim(value, F.lit(JSON_WHITESPACE))
    two = listed.isNull() | vget(listed, "$[1]").isNotNull()
    return ((s.startswith("{") & ~s.endswith("}")) | (s.startswith("[") & ~s.endswith("]"))
            | F.when(one, F.lit(False)).when(s.rlike(_NEXT_VALUE_RE), two).otherwise(F.lit(False)))


def number_text(v: Column, path: str) -> Column:
    """Text of a scalar field: numbers in canonical decimal form, strings as written.

    JSON null and absent both give NULL (callers apply the field default).
    Doubles (exponent notation in the frame) are printed as plain decimals.
    """
    return F.when(vtype(vget(v, path)) == "DOUBLE", plain_decimal(vget(v, path, "double"))).otherwise(vget(v, path, "string"))


def event_time_source(frame: Column) -> Column:
    """Rule 5: the variant holding the event time: ``data.ts``, else top-level ``ts``, else NULL."""
    return F.coalesce(vget(frame, f"{DATA}.ts"), vget(frame, f"{FRAME}.ts"))


def event_millis(ts_v: Column) -> Column:
    return F.floor(vget(ts_v, "$", "double"))


def event_time(ts_v: Column, ms: Column, arrival_ts: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP; arrival time (truncated to ms) when there is none."""
    return F.when(ts_v.isNull(), F.date_trunc("millisecond", arrival_ts)).otherwise(
        F.timestamp_millis(F.when(ms.between(_MIN_MS, _MAX_MS), ms.cast("long"))))


def event_time_error(ts_v: Column, ms: Column) -> Column:
    """A present event time that is not a number, or out of datetime range (NaN included)."""
    return ts_v.isNotNull() & (~is_numeric_type(vtype(ts_v)) | ~F.coalesce(ms.between(_MIN_MS, _MAX_MS), F.lit(False)))


def field_or_default(frame: Column, name: str) -> Column:
    return F.coalesce(number_text(frame, f"{DATA}.{name}"), F.lit(FIELD_DEFAULT))


def funding_rate_text(frame: Column) -> Column:
    """Rule 6: fixed 8 decimals; absent, null, falsy, ``'0'`` or unparseable (no DOUBLE, or zero) give zero."""
    x = vget(frame, f"{DATA}.fundingRate", "double")
    return F.when(x != 0, F.format_string(FUNDING_RATE_FORMAT, x)).otherwise(F.lit(FUNDING_RATE_ZERO))


def ticker_text(frame: Column) -> Column:
    """Rule 6 / F2: ``lastPrice|fairPrice|indexPrice|holdVol|fundingRate``."""
    return F.concat_ws("|", field_or_default(frame, "lastPrice"), field_or_default(frame, "fairPrice"),
                       field_or_default(frame, "indexPrice"), field_or_default(frame, "holdVol"),
                       funding_rate_text(frame))


def deal_direction(frame: Column) -> Column:
    """Rule 7: 1 only when ``T`` is numerically 1 (text ``"1"`` is not), else 2."""
    path = f"{DATA}.T"
    is_one = is_numeric_type(vtype(vget(frame, path))) & (vget(frame, path, "double") == 1.0)
    return F.when(F.coalesce(is_one, F.lit(False)), F.lit("1")).otherwise(F.lit("2"))


def deal_text(frame: Column) -> Column:
    """``price|volume|direction``."""
    return F.concat_ws("|", field_or_default(frame, "p"), field_or_default(frame, "v"), deal_direction(frame))


# One JSON string element or null, as printed by to_json.
_JSON_ELEM = r'(?:"(?:[^"\\]|\\.)*"|null)'
# A level with two or more elements: keep the first two.
_LEVEL_RE = r'\[(' + _JSON_ELEM + r'),(' + _JSON_ELEM + r')(?:,' + _JSON_ELEM + r')*\]'
# A level with fewer than two elements (levels start after '[' or ',').
# A level that is not a list converts to a NULL level: that is an error too.
_SHORT_LEVEL_RE = r'(?:^\[|,)\[' + _JSON_ELEM + r'?\]' + r'|(?:^\[|\],)null(?:,|\]$)'
_QUOTED_RE = r'"((?:[^"\\]|\\.)*)"'


# Fast path for depth sides whose JSON text is a list of flat lists with no
# strings (the normal feed): regular expressions over the side's JSON text.
# No part of them is tried twice (possessive): what ends a part is no character of it.
_FLAT_LEVEL_RE = r'\[[^\[\]"]*+\]'
_FIRST_LEVELS_RE = r'^\[(%s(?:,%s){0,%d}+)(?:,%s)*+\]$' % (_FLAT_LEVEL_RE, _FLAT_LEVEL_RE, MAX_DEPTH_LEVELS - 1, _FLAT_LEVEL_RE)
_NO_LEVELS_RE = r'^\[\]$'
_FIRST_TWO_RE = r'\[([^,\[\]]*+),([^,\[\]]*+)(?:,[^\[\]]*+)?\]'
_FLAT_SHORT_RE = r'(?:^|,)\[[^,\[\]]*\]'
_EXPONENT_RE = r'[0-9][eE][-+]?[0-9]'
# An exponent of two digits or more, or one behind nine digits or more.
_WIDE_RE = r'[eE][-+]?[0-9]{2,}|[0-9.]{10,}[eE]'
_TRAILING_ZEROS_RE = r'(\.[0-9]*?)0+(?=[,\]])'
_BARE_POINT_RE = r'\.(?=[,\]])'


def depth_side_first_levels(side_text: Column) -> Column:
    """Fast path: text of the first 20 levels (``[p,q,c],[p,q,c]``), '' for an empty side.

    NULL when the side is absent or not a list of flat, string-free lists;
    those frames take the general path (``depth_side_json``).
    """
    first = F.regexp_extract(side_text, _FIRST_LEVELS_RE, 1)
    return F.when((first != "") | side_text.rlike(_NO_LEVELS_RE), first)


def _plain_first_levels(frame: Column, side: str) -> Column:
    """The first 20 levels with every number as a plain decimal (for exponent notation).

    Cast to decimals, which print plain, then strip trailing zeros over the text.
    """
    dec = F.regexp_replace(F.slice(vget(frame, f"{DATA}.{side}", "array<array<decimal(38,18)>>"), 1, MAX_DEPTH_LEVELS)
                           .cast("string"), ", ", ",")
    plain = F.regexp_replace(F.regexp_replace(dec, _TRAILING_ZEROS_RE, "$1"), _BARE_POINT_RE, "")
    return F.regexp_extract(plain, r"^\[(.*)\]$", 1)


def depth_fast_text(first: Column, frame: Column, side: str) -> Column:
    """Fast path text: first two elements of each level; exponent numbers (rare) become
    plain decimals, like ticker and deal fields, unless 18 decimals and 20 digits before the point
    may not hold them: then the levels stay as written. Only the payload projection runs this."""
    exponent = (first.contains("E") | first.contains("e")) & first.rlike(_EXPONENT_RE)
    levels = F.when(exponent & ~first.rlike(_WIDE_RE), _plain_first_levels(frame, side)).otherwise(first)
    return F.regexp_replace(levels, _FIRST_TWO_RE, "[$1,$2]")


def depth_fast_short(first: Column) -> Column:
    """Fast path rule 9: one of the first 20 levels has fewer than two elements."""
    return first.rlike(_FLAT_SHORT_RE)


def depth_side_json(frame: Column, side: str) -> Column:
    """The first 20 levels of a side as JSON text of ``array<array<string>>``.

    Fast path: the whole side converts to ``array<array<string>>``. Slow path
    (a level past the first 20 is not a list): re-read only the first 20
    levels. NULL when the side is absent, not a list, or one of its first 20
    levels is not a list. One conversion per side feeds both the error rule
    and the payload text through plain regular expressions: no per-level
    lambdas, which would switch whole-stage codegen off for the projection.
    """
    path = f"{DATA}.{side}"
    typed = vget(frame, path, "array<array<string>>")
    first20 = F.to_json(F.slice(vget(frame, path, "array<variant>"), 1, MAX_DEPTH_LEVELS))
    retyped = vget(F.try_parse_json(first20), "$", "array<array<string>>")
    return F.to_json(F.slice(F.coalesce(typed, retyped), 1, MAX_DEPTH_LEVELS))


def depth_side_text(side_json: Column) -> Column:
    """levels of one side, first two elements each: ``[p,q],[p,q]``; absent side is empty."""
    levels = F.regexp_replace(side_json, _LEVEL_RE, "[$1,$2]")
    text = F.regexp_replace(levels.substr(F.lit(2), F.length(levels) - 2), _QUOTED_RE, "$1")
    return F.coalesce(text, F.lit(""))


def depth_side_error(frame: Column, side: str, side_json: Column) -> Column:
    """Rule 9 for depth: a side present but null or not a list, or one of its
    first 20 levels not a list or with fewer than 2 elements."""
    present = vget(frame, f"{DATA}.{side}").isNotNull()
    return present & (side_json.isNull() | side_json.rlike(_SHORT_LEVEL_RE))


def deadletter_text(value: Column) -> Column:
    """The first 500 characters of the frame."""
    return F.substring(value, 1, DEADLETTER_CHARS)


def text_contains_ts_key(data: Column, data_type: Column) -> Column:
    """``'ts' in data`` for a list (an element equal to "ts") or a string (a substring "ts")."""
    in_list = F.coalesce(F.array_contains(vget(data, "$", "array<string>"), F.lit("ts")), F.lit(False))
    in_text = F.contains(vget(data, "$", "string"), F.lit("ts"))
    return (F.when(data_type.startswith("ARRAY"), in_list)
            .when(data_type == "STRING", in_text)
            .otherwise(F.lit(False)))
