"""Raw delimited text ingest: lines -> split -> arity guard -> try-parse.

This is the path for files a CSV reader should not be trusted with: repeated
header lines inside files, rows cut short, unparseable fields. Everything is
a JVM-side expression over ``spark.read.text`` lines (no Python per row):

* the header is the first raw line of the files; every line equal to it is
  dropped, wherever it appears (S3);
* ``split(value, delimiter, n + 1)`` cuts off the first ``n`` fields a
  query needs, keeping empty ones (S4);
* a row shorter than the last field a caller *needs* is dropped (F4), so a
  query that reads two columns keeps rows that are short further right;
  ``min_fields`` asks for more, ``optional`` names columns a row may lack at its
  end (they are NULL there);
* fields parse with ``try_cast`` (empty text = NULL, bad text = NULL) (X6);
  timestamps must match ``yyyy-M-d H:m:s`` (X2, F9);
* ``drop_malformed`` drops a row whose non-empty field failed to parse (F10).

Fields are located by name through the header, never by fixed position. The
split is naive: a quoted field keeps its quotes and is cut at a comma inside
them. ``quoted=True`` reads quoted fields with ``from_csv`` instead, under the
same guard and field parsing; files without rows cut short or bad fields can
go through ``files.read_csv`` as well. Files whose headers differ go through
``hackney.sources.layouts``.
"""

from __future__ import annotations

import csv
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the accepted timestamp text shape; parts need not be padded.
TIMESTAMP_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw text lines, one row per line, column ``value`` (S2)."""
    return spark.read.text(path)


def header_line(spark: SparkSession, path: str) -> str:
    """The first raw line of the files of ``path``."""
    first = read_lines(spark, path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first["value"]


def header_names(line: str, delimiter: str = ",") -> list[str]:
    """Field names of a header line, without quotes."""
    return [name.strip() for name in next(csv.reader([line], delimiter=delimiter))]


def drop_header(lines: DataFrame, header: str) -> DataFrame:
    """Drop every line equal to ``header`` (each file repeats it) (S3)."""
    return lines.where(F.col("value") != F.lit(header))


def parse_field(text: Column, dtype: T.DataType) -> Column:
    """Text -> ``dtype``; empty or unparseable text becomes NULL."""
    text = F.when(text != F.lit(""), text)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast(dtype))
    if isinstance(dtype, T.StringType):
        return text
    return text.try_cast(dtype)


def parse_lines(lines: DataFrame, header: list[str], schema: T.StructType,
                columns: list[str] | None = None, delimiter: str = ",",
                drop_malformed: bool | Collection[str] = False, absent_as_null: bool = False,
                optional: Collection[str] = (), min_fields: int = 0,
                header_text: str | None = None, quoted: bool = False) -> DataFrame:
    """Typed rows for ``columns`` (default: all of ``schema``) from raw lines.

    ``header`` gives the field names in file order; ``columns`` resolve against
    it case-insensitively (``Airport_fee`` is ``airport_fee``). Lines equal to
    ``header_text`` (default: the names joined) are removed. Rows with fewer
    than ``min_fields`` fields, or too short to hold every requested column but
    the ``optional`` ones, are dropped. A requested column the header lacks is
    an error, or a NULL column with ``absent_as_null`` (a file of another
    layout). ``drop_malformed`` tests all requested columns, or those named.
    ``quoted`` reads fields in double quotes (see :func:`quoted_fields`).
    """
    columns = list(columns or schema.fieldNames())
    position = {name.lower(): i for i, name in enumerate(header)}
    present = [c for c in columns if c.lower() in position]
    absent = [c for c in columns if c.lower() not in position]
    if absent and not absent_as_null:
        raise ValueError(f"columns not in header: {absent}")
    if not present:
        raise ValueError("none of the requested columns is in the header")
    pos = {c: position[c.lower()] for c in present}
    may_lack = {c.lower() for c in optional}
    needed = max([min_fields, *(i + 1 for c, i in pos.items() if c.lower() not in may_lack)])
    # Split off only the fields in question: with this limit everything after
    # them stays in one trailing element, so unused fields are never copied.
    width = max(needed, *(i + 1 for i in pos.values()))
    value = F.col("value")
    fields = quoted_fields(value, delimiter, width) if quoted else F.split(value, _regex_literal(delimiter), width + 1)
    rows = (drop_header(lines, header_text if header_text is not None else delimiter.join(header))
            .select(_once(fields, "_f")).where(F.size("_f") >= needed))
    text = {c: F.get(F.col("_f"), i) for c, i in pos.items()}
    typed = {c: parse_field(text[c], schema[c].dataType) for c in present}
    strict = present if drop_malformed is True else [c for c in present if c in (drop_malformed or ())]
    bad = [(text[c] != F.lit("")) & typed[c].isNull() for c in strict
           if not isinstance(schema[c].dataType, T.StringType)]
    typed.update({c: F.lit(None).cast(schema[c].dataType) for c in absent})
    if not bad:
        return rows.select(*[typed[c].alias(c) for c in columns])
    malformed = reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in bad])
    row = F.struct(*[typed[c].alias(c) for c in columns], malformed.alias("__malformed"))
    return rows.select(F.inline(F.array(row))).where(~F.col("__malformed")).drop("__malformed")


def quoted_fields(line: Column, delimiter: str, width: int) -> Column:
    """The first ``width`` fields of a line, unquoted; an array as long as the line has fields (at most ``width``).

    A delimiter between double quotes belongs to its field, and two double
    quotes there are one. ``from_csv`` does the reading; how many fields there
    are (it gives NULL for an absent field as for an empty one) is the number of
    delimiters outside quotes. Empty fields are empty, and a quote that is not
    closed ends with its line: a field has no line feed.
    """
    schema = ", ".join(f"f{i} STRING" for i in range(width))
    row = F.from_csv(line, schema, {"sep": delimiter, "escape": '"', "maxCharsPerColumn": "-1", "emptyValue": "",
                                    "maxColumns": str(max(20480, width))})
    # Quotes count at the start of a field; possessive, so that no long field costs stack.
    sep = _regex_literal(delimiter)
    outside = F.regexp_replace(line, f'(^|{sep})"[^"]*+(?:""[^"]*+)*+(?:"|$)', "$1")
    count = F.octet_length(outside) - F.octet_length(F.replace(outside, F.lit(delimiter), F.lit(""))) + F.lit(len(delimiter))
    texts = F.transform(F.array(*[row[f"f{i}"] for i in range(width)]), lambda x: F.coalesce(x, F.lit("")))
    return F.slice(texts, F.lit(1), F.least(F.floor(count / len(delimiter)).cast("int"), F.lit(width)))


def _once(value: Column, name: str) -> Column:
    """``value`` as the only row of a generator, through which no filter is pushed.

    A filter above a projection takes the projection's expressions along: a
    split used by ten conditions would run ten times a line.
    """
    return F.explode(F.array(value)).alias(name)


def ingest(spark: SparkSession, path: str, schema: T.StructType,
           columns: list[str] | None = None, delimiter: str = ",",
           drop_malformed: bool | Collection[str] = False, absent_as_null: bool = False,
           optional: Collection[str] = (), min_fields: int = 0, quoted: bool = False) -> DataFrame:
    """Read and parse a folder of header-led delimited text files; the header is their first line."""
    line = header_line(spark, path)
    return parse_lines(read_lines(spark, path), header_names(line, delimiter), schema, columns=columns,
                       delimiter=delimiter, drop_malformed=drop_malformed, absent_as_null=absent_as_null,
                       optional=optional, min_fields=min_fields, header_text=line, quoted=quoted)


def _regex_literal(delimiter: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in delimiter)
