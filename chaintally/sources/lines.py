"""Raw-line sources: text scans and positional field access.

A line collection is a ``DataFrame[value: string]`` — what
``spark.read.text`` returns, and what a Spark job can derive from any
table.  Fields are found by splitting on commas:

* ``naive`` splits on every comma, like ``str.split(',')`` (trailing empty
  fields kept), which is how the published analysis counted fields;
* ``quoted`` does not split inside double quotes, so a quoted comma list
  (a contract's function signatures) stays one field.  Only lines that
  contain a quote take the slower path, which is linear in the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "fields"
LINE = "value"

# Stands for a comma outside quotes while a quoted line is split.  A line
# that itself holds these three characters in a row would split there too.
_SEPARATOR = "\x01,\x02"

CSV_MODES = ("quoted", "naive")


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Line scan of text files (one row per line, header lines included)."""
    return spark.read.text(path)


def _unquote(c: Column) -> Column:
    quoted = c.startswith('"') & c.endswith('"') & (F.length(c) >= 2)
    inner = F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(c)


def _split_quoted(line: Column) -> Column:
    """Cut at every quote: pieces 0, 2, 4, ... lie outside quotes, so only
    their commas separate fields.  No pattern looks ahead, and the pieces are
    read once, so a line of any number of quotes takes linear time."""
    pieces = F.transform(F.split(line, '"', -1), lambda p, i: F.when(
        i % 2 == 0, F.replace(p, F.lit(","), F.lit(_SEPARATOR))).otherwise(p))
    return F.transform(F.split(F.array_join(pieces, '"'), _SEPARATOR, -1), _unquote)


def split_line(line, mode: str = "naive") -> Column:
    """Fields of a comma separated line as ``array<string>``."""
    if mode not in CSV_MODES:
        raise ValueError(f"csv mode must be one of {CSV_MODES}, got {mode!r}")
    line = F.col(line) if isinstance(line, str) else line
    plain = F.split(line, ",", -1)
    if mode == "naive":
        return plain
    return F.when(F.instr(line, '"') > 0, _split_quoted(line)).otherwise(plain)


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns, evaluated once per row.

    They go through a one-element ``inline``: filters on them cannot be
    pushed below a generator, so the optimizer does not copy their
    expressions into every check that reads them.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def with_fields(lines: DataFrame, mode: str = "naive", line: str = LINE) -> DataFrame:
    """The line collection with its ``fields`` array, split once per line."""
    others = [F.col(c) for c in lines.columns if c not in (line, FIELDS)]
    return computed_once(lines, *others, F.col(line).alias(line), split_line(line, mode).alias(FIELDS))


def field(i: int, fields: str = FIELDS) -> Column:
    """Field ``i`` (0-based) of the split line; NULL when the line is short."""
    return F.try_element_at(F.col(fields), F.lit(i + 1))


def arity(fields: str = FIELDS) -> Column:
    return F.size(F.col(fields))
