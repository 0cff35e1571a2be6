"""Text helpers for business keys held inside strings.

SKU = ``PREFIX-...-SIZE``; order text = ``ORDER/seq``; product label =
``[CODE] Name``; many-to-one pairs land as ``struct<id, label>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Col

__all__ = [
    "col_", "order_before_slash", "bracket_code", "strip_brackets", "strip_text",
    "sku_prefix", "sku_suffix", "pair_label", "first_text", "yes_no", "full_name",
    "plant_name", "last_path_part", "order_number", "null_concat", "nonempty", "like_pattern",
]


#: What the sources' own trimming takes off: all ASCII and Unicode white space.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(c) -> Column:
    """White space of any kind off both ends."""
    return F.btrim(c, F.lit(WHITE))


def col_(c) -> Column:
    return c if isinstance(c, _Col) else F.col(c)


def order_before_slash(c) -> Column:
    """Order text before the first ``/``, else the whole text; null stays null."""
    return F.substring_index(col_(c), "/", 1)


def bracket_code(c) -> Column:
    """Code inside the first ``[...]``, trimmed; ``''`` when there is none."""
    return F.coalesce(strip(F.regexp_extract(col_(c), r"\[(.*?)\]", 1)), F.lit(""))


def strip_brackets(c) -> Column:
    """Remove every bracketed part, then trim."""
    return strip(F.regexp_replace(col_(c), r"\[.*?\]", ""))


def strip_text(c, text: str) -> Column:
    """Remove every occurrence of a literal text."""
    return F.replace(col_(c), F.lit(text), F.lit(""))


def sku_prefix(c) -> Column:
    """All hyphen parts but the last; ``''`` if there is no hyphen."""
    return F.regexp_extract(col_(c), r"^(.*)-[^-]*$", 1)


def sku_suffix(c) -> Column:
    """The last hyphen part; ``''`` if there is no hyphen."""
    return F.regexp_extract(col_(c), r"-([^-]*)$", 1)


def pair_label(c) -> Column:
    """Label of a many-to-one pair ``struct<id, label>``.

    A pair with a label gives the label, a pair with only an id gives the id
    as text, an empty pair (the source's ``false``) gives ``''``.
    """
    c = col_(c)
    return F.coalesce(c.getField("label"), c.getField("id").cast("string"), F.lit(""))


def first_text(*cols, default=None) -> Column:
    """First value that is neither null nor empty text, else ``default``."""
    parts = [F.nullif(col_(c), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def yes_no(c) -> Column:
    return F.when(F.coalesce(col_(c), F.lit(False)), F.lit("yes")).otherwise(F.lit("no"))


def full_name(first, last) -> Column:
    """``first + ' ' + last`` trimmed; a missing part counts as empty."""
    return strip(F.concat_ws(" ", F.coalesce(col_(first), F.lit("")),
                              F.coalesce(col_(last), F.lit(""))))


def plant_name(c) -> Column:
    """Part before the first `` - `` (trimmed), else the whole; null gives ``''``."""
    c = F.coalesce(col_(c), F.lit(""))
    return F.when(c.contains(" - "), strip(F.substring_index(c, " - ", 1))).otherwise(c)


def last_path_part(c) -> Column:
    """Last ``/`` part of a global id such as ``gid://shop/Product/12``."""
    return F.substring_index(col_(c), "/", -1)


def order_number(c) -> Column:
    """Number after the leading character: leading digits, else 0."""
    digits = F.regexp_extract(F.substring(col_(c), 2, 1 << 30), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def null_concat(*cols) -> Column:
    """SQL ``||``: null if any part is null (``F.concat`` semantics)."""
    return F.concat(*[col_(c) for c in cols])


def nonempty(c) -> Column:
    """Predicate: a key that is neither null nor empty (written as two simple
    predicates so that it can reach the parquet scan)."""
    c = col_(c)
    return c.isNotNull() & (c != F.lit(""))


def like_pattern(c, pattern: str, case_blind: bool = False) -> Column:
    """SQL LIKE, written so that simple patterns reach the parquet scan.

    A pattern that is a literal prefix followed by ``%`` becomes
    ``startswith`` (pushed down as StringStartsWith). Case-blind, a prefix of
    one character becomes two ``startswith`` tests (upper and lower case),
    which still push down; anything else stays ``ilike``/``like``.
    """
    c = col_(c)
    head = pattern[:-1]
    simple = pattern.endswith("%") and not any(ch in head for ch in "%_\\")
    if simple and not case_blind:
        return c.startswith(head)
    if simple and len(head) == 1:
        variants = sorted({head.upper(), head.lower()})
        cond = c.startswith(variants[0])
        for v in variants[1:]:
            cond = cond | c.startswith(v)
        return cond
    return F.ilike(c, F.lit(pattern)) if case_blind else F.like(c, F.lit(pattern))
