"""Column expressions for text and for the lines of a server-sent event."""

from pyspark.sql import Column, functions as F

# The characters that count as white space when a line is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop white space at both ends; only the ends are scanned, unlike with a regex."""
    return F.trim(text, F.lit(WHITESPACE))


def sse_lines(block: Column) -> Column:
    """The lines of a block without the white space before them."""
    return F.transform(F.split(block, "\n"), lambda line: F.ltrim(line, F.lit(WHITESPACE)))


def sse_values(lines: Column, field: str) -> Column:
    """The values of every ``field:`` line, in order."""
    prefix = f"{field}:"
    return F.transform(
        F.filter(lines, lambda line: line.startswith(prefix)),
        lambda line: strip(F.substr(line, F.lit(len(prefix) + 1))),
    )


def sse_last(lines: Column, field: str) -> Column:
    """The value of the last ``field:`` line, NULL if there is none."""
    return F.try_element_at(sse_values(lines, field), F.lit(-1))
