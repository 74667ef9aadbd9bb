"""Column builders for normalising codes, flags, numbers and dates.

Every builder takes a column (name or ``Column``) and returns a ``Column``.
They hold no state and use only Spark built-ins, so they stay inside
whole-stage codegen and work the same on batch and streaming frames.

ANSI mode is on by default in Spark 4, where ``cast`` and ``to_date`` raise
on bad input. Dirty values must become null instead, so every parse here is a
``try_`` variant.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType

ColumnOrName = Column | str

# Flag synonyms of the reference's cleaners.
# Two-synonym form (lab abnormal_flag, adverse-event serious_event).
FLAG_TWO_SYNONYMS = {"TRUE": "Y", "FALSE": "N"}
# Four-synonym form (visit completed, protocol_deviation).
FLAG_FOUR_SYNONYMS = {"YES": "Y", "TRUE": "Y", "NO": "N", "FALSE": "N"}


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: ColumnOrName) -> Column:
    """Strip leading and trailing spaces only; tabs, newlines and case stay."""
    return F.trim(col_of(c))


def upper_trim(c: ColumnOrName) -> Column:
    """Code normaliser: ``upper(trim(c))``; null stays null."""
    return F.upper(F.trim(col_of(c)))


def _fallback(c: Column, fallback: str) -> Column:
    if fallback == "upper_trim":
        return upper_trim(c)
    if fallback == "trim":
        return trim_spaces(c)
    if fallback == "keep":
        return c
    if fallback == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown fallback {fallback!r}")


def map_values(
    c: ColumnOrName, mapping: Mapping[str, str | None], fallback: str = "upper_trim"
) -> Column:
    """Replace values by a mapping matched on ``upper(trim(c))``; a mapped null gives null.

    Unmapped values become ``fallback``: ``"upper_trim"`` (default),
    ``"trim"`` (case kept), ``"keep"`` (untouched) or ``"null"``.
    Null in gives null out.
    """
    c = col_of(c)
    key = upper_trim(c)
    otherwise = _fallback(c, fallback)
    if not mapping:
        return otherwise
    expr = None
    for k, v in mapping.items():
        cond, value = key == F.lit(k), F.lit(v).cast("string")
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise)


def normalize_flag(c: ColumnOrName, synonyms: Mapping[str, str] = FLAG_FOUR_SYNONYMS) -> Column:
    """Y/N flag from its spellings; anything else is upper-trimmed and kept."""
    return map_values(c, synonyms, fallback="upper_trim")


_LETTER_RUN = re.compile(r"'[^']*'|([A-Za-z])\1*|.", re.S)
_REGEX_META = set(".^$*+?()[]{}|\\")


def _literal(text: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def date_shape(fmt: str) -> str | None:
    """Anchored regex of the digit shape a datetime pattern accepts.

    ``yyyy-MM-dd`` gives ``^\\d{4}-\\d{2}-\\d{2}\\z``. Returns None for a
    pattern with text fields (month names and the like) or optional sections,
    which is then parsed without a gate.
    """
    out = []
    for m in _LETTER_RUN.finditer(fmt):
        tok = m.group(0)
        if tok.startswith("'"):
            out.append(_literal(tok[1:-1] if len(tok) > 2 else "'"))
        elif tok in "[]#{}":
            return None
        elif tok[0].isalpha():
            letter, n = tok[0], len(tok)
            if letter == "y" and n in (2, 4):
                out.append(r"\d{%d}" % n)
            elif letter in "MdHhms" and n in (1, 2):
                out.append(r"\d{1,2}" if n == 1 else r"\d{2}")
            elif letter == "S":
                out.append(r"\d{%d}" % n)
            else:
                return None
        else:
            out.append(_literal(tok))
    return "^" + "".join(out) + r"\z"


def parse_date(c: ColumnOrName, formats: Sequence[str]) -> Column:
    """Date from text in any of ``formats``; the first that parses wins.

    Each format is tried only where the text has its digit shape. That gate
    keeps a failed parse off the slow path and gives the same null for
    ``2025-3-5`` or padded text under every parser policy. Text that fits no
    format, or names no real day (``2025-02-30``), gives null.
    """
    c = col_of(c)
    parts = []
    for fmt in formats:
        parsed = F.try_to_date(c, fmt)
        shape = date_shape(fmt)
        parts.append(parsed if shape is None else F.when(c.rlike(shape), parsed))
    return parts[0] if len(parts) == 1 else F.coalesce(*parts)


def to_int(c: ColumnOrName) -> Column:
    """Integer, truncated toward zero; NaN, overflow and bad text give null."""
    return col_of(c).try_cast("int")


def to_double(c: ColumnOrName) -> Column:
    """Double from text; text that is not a number gives null."""
    return col_of(c).try_cast("double")


def range_flag(
    c: ColumnOrName, low: ColumnOrName | float, high: ColumnOrName | float,
    inside: str = "N", outside: str = "Y",
) -> Column:
    """``outside`` when c < low or c > high, else ``inside`` (null c → inside)."""
    v = col_of(c)
    lo = low if isinstance(low, Column) else (F.col(low) if isinstance(low, str) else F.lit(low))
    hi = high if isinstance(high, Column) else (F.col(high) if isinstance(high, str) else F.lit(high))
    return F.when((v < lo) | (v > hi), F.lit(outside)).otherwise(F.lit(inside))


def flag_when(condition: Column, yes: str = "Y", no: str = "N") -> Column:
    """``yes`` where the condition holds, ``no`` where it fails or is null."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def round_half_even(c: ColumnOrName, scale: int = 2) -> Column:
    """Round to ``scale`` places, ties to even (on the decimal value)."""
    return F.bround(col_of(c), scale)


def format_id(c: ColumnOrName, prefix: str, width: int) -> Column:
    """Zero-padded id text, ``P0007``; wider numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", col_of(c))


def add_days(c: ColumnOrName, days: ColumnOrName | int) -> Column:
    """Date plus a day offset (timestamps are taken at their date)."""
    n = F.lit(days) if isinstance(days, int) else col_of(days)
    return F.date_add(F.to_date(col_of(c)), n)


def date_text(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Date as text in ``fmt``."""
    return F.date_format(col_of(c), fmt)


def starts_with(c: ColumnOrName, prefix: str) -> Column:
    """True if the text starts with ``prefix``; null text gives False."""
    return F.coalesce(F.startswith(col_of(c), F.lit(prefix)), F.lit(False))


def key_text(keys: Sequence[ColumnOrName], df: DataFrame | None = None) -> Column:
    """Record id text for a key: the value itself, or parts joined by ``|``.

    In a composite key a null part is ``\\N`` and a backslash or ``|`` within a
    part stands behind a backslash, so the id is never null and no two keys
    share one. With ``df``, the frame the id is made for, only its text parts are
    searched for them: numbers and dates hold neither.
    """
    cols = [col_of(k) for k in keys]
    if len(cols) == 1:
        return cols[0].cast("string")
    kinds = [f.dataType for f in df.select(*cols).schema.fields] if df is not None else [None] * len(cols)
    plain = (NumericType, BooleanType, DateType)
    texts = [c.cast("string") if isinstance(k, plain) else F.regexp_replace(c.cast("string"), r"([\\|])", r"\\$1") for c, k in zip(cols, kinds)]
    return F.concat_ws("|", *[F.coalesce(t, F.lit("\\N")) for t in texts])
