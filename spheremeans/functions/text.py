"""Turning text lines into fields and fields into numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators of each raw layout, as regular expressions.
COMMA = ","
TAB = r"\t"
SPACES = " +"
COMMA_PIPE_SLASH = r",|\||/"

# Fixed value: an optional minus sign, digits, a point, digits.
DECIMAL_SHAPE = r"^-?\d+\.\d+"

# Fixed value: text that is a number as a whole; casts also accept 12.5d and 12.5f.
NUMBER = r"(?i)^\s*([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)\s*$"

# Something besides white space and control characters.
NOT_BLANK = r"[^\x00-\x20]"


def fields(line: Column | str, pattern: str, needed: int) -> Column:
    """Split a line into its first ``needed`` fields and the unsplit rest.

    Everything after the last needed separator stays one string, so a wide
    record costs no more than its leading fields. Null when the line is null.
    """
    return F.split(line, pattern, needed + 1)


def to_double(value: Column | str) -> Column:
    """Null instead of an error for text that is not a number."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c.rlike(NUMBER), c.try_cast("double"))
