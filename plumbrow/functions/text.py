"""Text and unit expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbrow.functions.keys import any_of
from plumbrow.schema import ITEM_LABELS

# An item containing any of these is expected to change size and sign. They match as
# substrings; the last one ends in a space.
VARIANCE_WORDS = (
    "variance",
    "difference",
    "change",
    "movement",
    "adjust",
    "revaluation",
    "gain",
    "loss",
    "tax",
    "profit",
    "surplus",
    "deferred",
    "wash",
    "balance",
    "net ",
)

# What counts as a number. A plain cast would also take Java suffixes such as '1d'.
_NUMBER = r"(?i)^[+-]?((\d+[.]?\d*|[.]\d+)(e[+-]?\d+)?|inf|infinity|nan)$"


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def join_labels(*columns: Column | str) -> Column:
    """The non-NULL labels joined with ' / '; an empty string when all are NULL."""
    return F.concat_ws(" / ", *columns)


def line_item() -> Column:
    return join_labels(*ITEM_LABELS)


def regex_contains(column: Column, pattern: str) -> Column:
    return column.rlike(pattern)


def regex_replace_all(column: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(column, pattern, replacement)


def is_variance_like(item: Column) -> Column:
    # Plain searches: a regular expression of these alternatives is several times slower. They are inside a function
    # of an array, since the optimizer would write the item's expression out once for each word: filters of that
    # size are never compiled, and it moves them below joins, to all rows.
    return F.exists(
        F.array(F.lower(item)),
        lambda lowered: any_of([lowered.contains(word) for word in VARIANCE_WORDS]),
    )


def text_to_double(column: Column) -> Column:
    """Text (or a number) as a double without its commas; NULL when it is not a number."""
    bare = F.replace(F.trim(column.cast("string")), F.lit(","), F.lit(""))
    return F.when(regex_contains(F.trim(bare), _NUMBER), bare.try_cast("double"))


def normalised_unit(column: Column) -> Column:
    """A unit for comparing spellings: '$000s' = '$000', 'TJ.km' = 'TJ km', 'kilometres' = 'km'."""
    lowered = F.lower(column)
    squashed = regex_replace_all(lowered, r"[\s._-]+", "")
    has_plural = (F.length(squashed) > 2) & squashed.endswith("s")
    return (
        F.when(lowered.isin("kilometre", "kilometres"), "km")
        .when(lowered.isin("metre", "metres"), "m")
        .when(has_plural, F.substring(squashed, F.lit(1), F.length(squashed) - 1))
        .otherwise(squashed)
    )


def shortest_text(number: Column) -> Column:
    """The digits that tell a number apart, as Java writes them: 3.0, 1.25E-4."""
    return number.cast("string")


def number_text(number: Column, shortest: Column | None = None) -> Column:
    """A number in plain notation: 3.0 -> '3', 1e-7 -> '0.0000001'. `shortest` is its shortest_text.

    Both arguments occur several times: let them be columns, not expressions, where rows are many. Up to ten million the
    shortest text is plain already; a decimal holds nearly all others; the rest gets its zeros by hand.
    """
    shortest = shortest_text(number) if shortest is None else shortest
    exact = number.try_cast("decimal(38,18)")
    digits = F.replace(F.split_part(shortest, F.lit("E"), F.lit(1)), F.lit("."), F.lit(""))
    power = F.split_part(shortest, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(number < 0, "-").otherwise("")
    bare = F.ltrim(digits, F.lit("-"))
    # Beyond a decimal's range the point lies outside the digits.
    far = F.when(power > 0, F.concat(sign, F.rpad(bare, power + 1, F.lit("0")))).otherwise(
        F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), F.rtrim(bare, F.lit("0")))
    )
    return (
        F.when(~shortest.contains("E"), _without_zeros(shortest))
        .when(exact.cast("double") == number, _without_zeros(exact.cast("string")))
        .otherwise(far)
    )


def _without_zeros(text: Column) -> Column:
    return F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
