"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` removes spaces only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def replace_first(c: Column | str, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match of a regular expression."""
    return F.regexp_replace(_col(c), f"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def replace_first_literal(c: Column | str, search: str, replacement: str) -> Column:
    return replace_first(c, r"\Q" + search + r"\E", replacement.replace("$", r"\$"))


def part(c: Column | str, separator: str, n: int) -> Column:
    """The n-th piece (1-based, negative from the end) around a literal separator."""
    return F.split_part(_col(c), F.lit(separator), F.lit(n))


def two_parts(c: Column | str, separator: str, names: tuple[str, str]) -> Column:
    """A struct of the first two pieces; a missing second piece is NULL, later pieces are dropped."""
    text = _col(c)
    second = F.when(F.contains(text, F.lit(separator)), part(text, separator, 2))
    return F.struct(part(text, separator, 1).alias(names[0]), second.alias(names[1]))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL where the pattern does not match."""
    text = _col(c)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def piece(c: Column | str, offset: int, length: int | None = None) -> Column:
    """Substring by 0-based offset."""
    return F.substring(_col(c), offset + 1, length if length is not None else 2**31 - 1)


def joined(separator: str, *cols: Column | str) -> Column:
    """Concatenate with a separator; NULL if any input is NULL (unlike ``concat_ws``)."""
    pieces: list[Column] = []
    for c in cols:
        if pieces and separator:
            pieces.append(F.lit(separator))
        pieces.append(_col(c).cast("string"))
    return F.concat(*pieces)


def capitalise(c: Column | str) -> Column:
    """First letter upper, the rest lower."""
    text = _col(c)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(piece(text, 1)))


def initials(c: Column | str, words: int = 2) -> Column:
    """First letters of the first ``words`` space-separated words."""
    letters = F.transform(F.split(_col(c), " "), lambda w: F.substring(w, 1, 1))
    return F.array_join(F.slice(letters, 1, words), "")


def currency(c: Column | str, scales: dict[str, int], digits: int = 2) -> Column:
    """``$12.5M`` to 12500000 as a decimal; a text without a known suffix has scale 1.

    The number is rounded to ``digits`` before it is scaled. Suffixes are single letters.
    """
    text = F.btrim(_col(c), F.lit(" \t\r\n"))
    number = F.translate(text, "$," + "".join(scales), "")
    factor = F.lit(1).cast("bigint")
    for suffix, scale in scales.items():
        factor = F.when(text.endswith(suffix), F.lit(scale).cast("bigint")).otherwise(factor)
    # at most 18 digits: Spark sorts and hashes longer decimals as objects
    return (F.round(number.cast("decimal(18,6)"), digits) * factor).cast("decimal(18,2)")
