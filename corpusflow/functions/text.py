"""Column expressions over text and sample rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Plain text fields in order of preference, and the shortest string
# the fallback accepts.
TEXT_FIELDS = ("text", "content", "instruction", "prompt", "question")
FALLBACK_MIN_CHARS = 10
BLANK_LINE = "\n\n"

# Matches one character that Unicode does not count as white space.
_NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"


def has_text(text: Column) -> Column:
    """False for NULL, empty and white-space-only strings."""
    return F.coalesce(text.rlike(_NOT_SPACE), F.lit(False))


def cut(text: Column, limit: int) -> Column:
    """First ``limit`` characters, followed by ``...`` where something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def keep_tail(text: Column, limit: int = 40) -> Column:
    """Last characters of a long name, marked with a leading ``...``."""
    tail = F.right(text, F.lit(limit - 3))
    return F.when(F.length(text) > limit, F.concat(F.lit("..."), tail)).otherwise(text)


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 where there is no whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def size_label(mb: Column) -> Column:
    """``12.34 MB``, or ``1.23 GB`` from 1024 MB on."""
    return F.when(mb >= 1024, F.format_string("%.2f GB", mb / 1024)).otherwise(F.format_string("%.2f MB", mb))


def megabytes(n_bytes: Column) -> Column:
    return n_bytes / F.lit(1024.0 * 1024.0)


def data_uri(image: Column, media_type: str = "image/png") -> Column:
    """Binary column as a data URI; the encoder's line breaks are taken out."""
    return F.concat(F.lit(f"data:{media_type};base64,"), F.regexp_replace(F.base64(image), r"[\r\n]", ""))


# One well-formed UTF-8 sequence, or a run of ASCII, over bytes read as Latin-1 characters; else one byte.
_UTF8_OR_BYTE = (
    r"([\x00-\x7F]++|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
    r"|\xED[\x80-\x9F][\x80-\xBF]|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})"
    r"|[\x80-\xFF]"
)


def _decode_ignoring(body: Column) -> Column:
    kept = F.regexp_replace(F.decode(body, "ISO-8859-1"), _UTF8_OR_BYTE, "$1")
    return F.encode(kept, "ISO-8859-1").cast("string")


def decoded(df: DataFrame, column: str) -> Column:
    """UTF-8 text of a column, invalid bytes left out. Strings pass through."""
    if not isinstance(df.schema[column].dataType, T.BinaryType):
        return F.col(column)
    text = F.col(column).cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(_decode_ignoring(F.col(column)))


def _contents(df: DataFrame, column: str) -> Column:
    """Message contents of a list column, joined by a blank line; NULL contents are skipped."""
    element = df.schema[column].dataType.elementType
    if isinstance(element, T.MapType) or (isinstance(element, T.StructType) and "content" in element.names):
        texts = F.transform(F.col(column), lambda m: m["content"].cast("string"))
        return F.array_join(F.filter(texts, lambda t: t.isNotNull()), BLANK_LINE)
    return F.when(F.col(column).isNotNull(), F.lit(""))


def _plain(df: DataFrame, column: str) -> Column:
    text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.initcap(text)
    return text


def _all_strings(columns: Sequence[str]) -> Column:
    """Every string column longer than ten characters, in column order."""
    long_ones = [F.when(F.length(c) > FALLBACK_MIN_CHARS, F.col(c)) for c in columns]
    return F.concat_ws(BLANK_LINE, *long_ones) if long_ones else F.lit("")


def sample_text(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """The one text of a sample, whatever the shape of its dataset.

    ``messages`` (list or string) wins, then a ``conversation`` list, then the first plain
    field that exists, then all longer strings. The columns of a split are the same in each
    row, so the choice is made once from the schema; only a NULL ``messages`` or
    ``conversation`` value moves a row on to the next rule. ``exclude`` names columns that
    are not part of the sample, such as partition columns.
    """
    fields = {f.name: f.dataType for f in df.schema if f.name not in exclude}
    steps: list[Column] = []
    if isinstance(fields.get("messages"), T.ArrayType):
        steps.append(_contents(df, "messages"))
    elif isinstance(fields.get("messages"), T.StringType):
        steps.append(F.col("messages"))
    if isinstance(fields.get("conversation"), T.ArrayType):
        steps.append(_contents(df, "conversation"))
    plain = next((name for name in TEXT_FIELDS if name in fields), None)
    if plain:
        steps.append(_plain(df, plain))
    else:
        steps.append(_all_strings([n for n, t in fields.items() if isinstance(t, T.StringType)]))
    return F.coalesce(*steps)
