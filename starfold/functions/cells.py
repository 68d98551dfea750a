"""Column expressions on single text cells: typing, sizes, names, hashes."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranks of the type lattice; the type of a column is the highest rank of its cells.
NULL, INTEGER, LONG, DOUBLE, TEXT = 0, 1, 2, 3, 4
TYPE_OF_RANK = {NULL: "string", INTEGER: "int", LONG: "bigint", DOUBLE: "double", TEXT: "string"}
RANK_OF_TYPE = {"int": INTEGER, "bigint": LONG, "double": DOUBLE, "string": TEXT}

INT_SHAPE = r"^\s*-?(0|[1-9][0-9]*)\s*$"
NUMBER_SHAPE = (
    r"^\s*(-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|-?inf(inity)?))\s*$"
)
MARKER = "'"


def col(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Rank of one cell, as SQL text: the tree is large and one profile needs it for every
# column, which is far quicker to parse than to build call by call.
#
# - A first character that no number begins with makes a cell text, by plain
#   comparisons; labels never reach a regular expression.
# - Few digits without a leading zero are an integer; most numeric cells end here.
# - Shapes are tested before any cast, because a cast that fails costs a Java exception,
#   some hundred times the price of a match. Up to nine characters always fit INTEGER,
#   up to eighteen always fit BIGINT.
_RANK_SQL = rf"""
CASE
  WHEN {{c}} IS NULL OR {{c}} = '' THEN {NULL}
  WHEN ({{c}} >= '!' AND {{c}} < '-') OR {{c}} = '/'
    OR ({{c}} >= ':' AND left({{c}}, 1) NOT IN ('n', 'N', 'i', 'I')) THEN {TEXT}
  WHEN octet_length({{c}}) <= 9 AND btrim({{c}}, '0123456789') = ''
    AND ({{c}} = '0' OR {{c}} >= '1') THEN {INTEGER}
  WHEN {{c}} RLIKE r'{INT_SHAPE}' THEN
    CASE
      WHEN {{width}} <= 9 THEN {INTEGER}
      WHEN {{width}} <= 18 THEN
        IF(try_cast({{c}} AS BIGINT) BETWEEN -2147483648 AND 2147483647, {INTEGER}, {LONG})
      WHEN {{width}} <= 20 AND try_cast({{c}} AS DECIMAL(20, 0))
        BETWEEN -9223372036854775808BD AND 9223372036854775807BD THEN {LONG}
      ELSE {DOUBLE}
    END
  WHEN {{c}} RLIKE r'{NUMBER_SHAPE.replace("{", "{{").replace("}", "}}")}' THEN {DOUBLE}
  ELSE {TEXT}
END
"""


def cell_rank_sql(name: str) -> str:
    """Rank of the narrowest type that holds a cell without losing anything, as SQL.

    Leading zeros and plus signs stay text.
    """
    c = quote_identifier(name)
    width = f"length(btrim({c}, ' \t\n\r\u000b\u000c'))"
    return _RANK_SQL.replace("{c}", c).replace("{width}", width)


def cell_rank(name: str) -> Column:
    return F.expr(cell_rank_sql(name))


def rank_type(rank: Column) -> Column:
    """Type name of a rank, as a column."""
    expression = F.when(rank == INTEGER, "int").when(rank == LONG, "bigint")
    return expression.when(rank == DOUBLE, "double").otherwise("string")


def as_number(c: Column) -> Column:
    """Safe cast to DOUBLE: text that is not a plain number becomes NULL.

    ``try_cast`` alone would accept Java suffixes such as ``1d``.
    """
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def is_marked(c: Column) -> Column:
    """True for a cell that starts with the spreadsheet text marker."""
    return c.startswith(MARKER)


def unmarked(c: Column) -> Column:
    return F.substring(c, 2, 2**31 - 1)


def size_in_bytes(c: Column) -> Column:
    """``77KB``, ``1.2 GB`` or a plain number as bytes (1 KB = 1024); else NULL."""
    text = F.regexp_replace(F.upper(c), r"\s", "")
    unit = F.regexp_extract(text, r"([KMGT]?B)$", 1)
    number = F.regexp_replace(text, r"[KMGT]?B$", "")
    plain = number.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(E[+-]?[0-9]+)?$")
    factor = (
        F.when(unit == "KB", float(1 << 10))
        .when(unit == "MB", float(1 << 20))
        .when(unit == "GB", float(1 << 30))
        .when(unit == "TB", float(1 << 40))
        .otherwise(1.0)
    )
    product = F.when(plain, number.try_cast("double")) * factor
    # Truncation toward zero, in a form both engines define the same way.
    whole = F.when(product >= 0, F.floor(product)).otherwise(F.ceil(product))
    return F.when(F.abs(product) < float(2**63), whole.cast("bigint"))


def archive_name(url: Column, code: Column) -> Column:
    """Last path part of a URL when it names a ZIP, else ``<code>.zip``."""
    tail = F.regexp_extract(F.regexp_replace(url, r"/+$", ""), r"([^/]*)$", 1)
    return F.when(F.lower(tail).endswith(".zip"), tail).otherwise(F.concat(code, F.lit(".zip")))


def content_hash(c: Column) -> Column:
    """SHA-256 of text or bytes, as lower-case hex."""
    return F.sha2(c.cast("binary"), 256)


def matches_label(c: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression match, as users search labels."""
    return c.rlike("(?i)" + pattern)


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def safe_name(text: str) -> str:
    """A table-name-safe form of a dataset code, and another one for each code.

    Codes of capitals and digits just become lower case. All others keep what a name
    can hold, and a digest of the code tells apart those that look alike then.
    """
    if re.fullmatch(r"[0-9A-Z]+", text):
        return text.lower()
    digest = hashlib.sha256(text.encode()).hexdigest()[:12]
    return f"{re.sub(r'[^0-9a-z]+', '_', text.lower())}_{digest}"
