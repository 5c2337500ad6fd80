"""Text rules: file names, field parsing, display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name of a dated drop file.
DROP_NAME = r"^drop_(\d{4}-\d{2}-\d{2})\.csv$"

# Field texts that mean "no value" in a delivered number or date.
NO_VALUE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_LARGEST = float(1 << 63)
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def has_drop_name(file_name: Column) -> Column:
    return file_name.rlike(DROP_NAME)


def drop_date(file_name: Column) -> Column:
    """Delivery date in a file name; null if the name has none or no such day exists."""
    return F.nullif(F.regexp_extract(file_name, DROP_NAME, 1), F.lit("")).try_cast("date")


def field(column: Column) -> Column:
    """A delivered field without padding, null where it says "no value"."""
    trimmed = F.trim(column)
    return F.when(~trimmed.isin(*NO_VALUE), trimmed)


def number(column: Column) -> Column:
    """A delivered number; null if it is none or too large for a bigint, infinity included."""
    text = field(column)
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(_LARGEST), value)


def has_open_quote(line: Column) -> Column:
    """Whether the quotes of a line do not pair, as where a quoted field goes on in the next line."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.coalesce(quotes % 2 == 1, F.lit(False))


def day(column: Column) -> Column:
    text = field(column)
    return F.when(text.rlike(_DAY), text.try_cast("date"))


def reversed_order(column: Column) -> Column:
    """A string that sorts in exactly the opposite order of ``column``.

    Each hex digit of the bytes is mirrored; the closing ``~`` is greater than every
    digit, so a text sorts after its own extensions.
    """
    mirrored = F.translate(F.hex(column), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.concat(mirrored, F.lit("~"))


def percent_text(column: Column) -> Column:
    return F.when(column.isNotNull(), F.format_string("%.2f%%", column * 100))


def thousands_text(column: Column) -> Column:
    return F.format_number(column, 0)


def label_text(column: Column) -> Column:
    return F.replace(column, F.lit("_"), F.lit(" "))
