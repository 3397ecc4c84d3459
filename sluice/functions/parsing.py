"""Text cell to typed value, as column expressions that stay inside the JVM.

Every parser settles ordinary cells with one cast; the wider patterns and the
error branch are reached only by cells that cast rejects. That rare path is a
function of an array of one cell, which Spark works out beside its generated
code: the code of a table of many columns stays small enough to be compiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "missing", in columns of any type.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"
INFINITY = r"^\s*[+-]?(?i:inf|infinity)\s*$"
# Java reads 1d, 1f and 0x1p3 as doubles; none of them is a number here.
JAVA_ONLY = "[dDfFxX]"
# The forms a timestamp column without a declared pattern may have, one for the whole column.
ISO_FORMS = {
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]": r"^\d\d\d\d-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?\z",
    "yyyy-MM-ddTHH:mm:ss[.SSSSSS]": r"^\d\d\d\d-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?\z",
    "yyyy-MM-dd": r"^\d\d\d\d-\d\d-\d\d\z",
}
SPACED = next(iter(ISO_FORMS))
PLAIN_DECIMAL = r"^[+-]?\d{1,300}(\.\d{0,300})?\z"  # too short to overflow a double, and no exponent


def is_missing(text: Column) -> Column:
    return text.isNull() | text.isin(*NULL_TOKENS)


def reject(name: str, expected: str, text: Column, where: Column) -> Column:
    """Fail the job, naming the column, the cell and the file."""
    return F.raise_error(
        F.concat(F.lit(f"column {name}: '"), text, F.lit(f"' is not {expected} (file "), where, F.lit(")"))
    )


def rarely(text: Column, path: Callable[[Column], Column]) -> Column:
    """A long expression of a cell, kept out of generated code."""
    return F.get(F.transform(F.array(text), path), F.lit(0))


def parse_string(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def whole_number(text: Column) -> Column:
    """A whole number written with a point or an exponent, read digit by digit; null for any other text.

    Nothing is rounded: 1e-30 and 1.0000000000000000001 are fractions however small the rest is.
    """
    sign, before, after, exponent = (F.regexp_extract(text, NUMBER, i) for i in range(1, 5))
    digits = F.concat(before, after)
    shift = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
    point = (F.length(before) + shift).try_cast("int")
    kept = (
        F.when(point <= 0, F.lit(""))
        .when(point <= F.length(digits), F.substr(digits, F.lit(1), point))
        .otherwise(F.rpad(digits, F.least(point, F.length(digits) + 20), "0"))  # 20 more digits overflow in any case
    )
    rest = F.when(point <= 0, digits).otherwise(F.substr(digits, F.greatest(point, F.lit(0)) + 1))
    value = F.regexp_replace(kept, r"\A0+", "")
    number = F.concat(sign, F.when(value == "", F.lit("0")).otherwise(value))
    fits = text.rlike(NUMBER) & (digits != "") & rest.rlike(r"\A0*\z") & (F.length(value) <= 19)
    zero = text.rlike(NUMBER) & (digits != "") & digits.rlike(r"\A0*\z")
    return F.when(zero, F.lit(0).cast("bigint")).when(fits, number.try_cast("bigint"))


def parse_bigint(name: str, text: Column, where: Column) -> Column:
    """Whole numbers, also written as 1.0 or 1e3; a fraction or an overflow fails."""

    def rest(cell: Column) -> Column:
        return F.when(~is_missing(cell), F.coalesce(whole_number(cell), reject(name, "a 64-bit integer", cell, where)))

    # A failed cast to bigint is slow (it throws inside the JVM), so texts bound to fail skip it.
    point_zero = F.when(text.endswith(".0"), F.substr(text, F.lit(1), F.char_length(text) - 2).try_cast("bigint"))
    plain = F.when(text.contains("."), point_zero).otherwise(text.try_cast("bigint"))
    return F.when(text.isNotNull(), F.coalesce(plain, rarely(text, rest)))


def parse_double(name: str, text: Column, where: Column) -> Column:
    """Decimal numbers and inf; Java-only forms and finite text that overflows fail."""

    def rest(cell: Column) -> Column:
        number = cell.try_cast("double")
        finite = F.abs(number) < F.lit(float("inf"))  # NaN sorts above every number, so it fails too
        return (
            F.when(is_missing(cell), F.lit(None).cast("double"))
            .when(finite & ~cell.rlike(JAVA_ONLY), number)
            .when(cell.rlike(INFINITY), number)
            .otherwise(reject(name, "a number", cell, where))
        )

    plain = F.when(text.rlike(PLAIN_DECIMAL), text.try_cast("double"))
    return F.when(text.isNotNull(), F.coalesce(plain, rarely(text, rest)))


def timestamp_or_null(text: Column, pattern: str | None) -> Column:
    """The timestamp, or null where the text does not fit the pattern, or the form of ISO 8601 that is named."""
    form = ISO_FORMS.get(pattern or SPACED)
    if form is not None:
        return F.when(text.rlike(form), text.try_cast("timestamp_ntz"))
    fits = F.try_to_timestamp(text, F.lit(pattern)).isNotNull()
    return F.when(fits, F.to_timestamp_ntz(text, F.lit(pattern)))


def iso_forms(text: Column) -> Column:
    """The forms that a cell is a timestamp of, as bits; 0 for missing cells, a bit of its own for any other text."""
    found = F.lit(1 << len(ISO_FORMS))
    for bit, form in enumerate(ISO_FORMS.values()):
        found = F.when(text.rlike(form) & text.try_cast("timestamp_ntz").isNotNull(), F.lit(1 << bit)).otherwise(found)
    return F.when(is_missing(text), F.lit(0)).otherwise(found)


def iso_form_of(text: str) -> int:
    """The same for a text at hand, whether or not there is such a day."""
    for bit, form in enumerate(ISO_FORMS.values()):
        if re.match(form.replace(r"\z", r"\Z"), text):
            return 1 << bit
    return 1 << len(ISO_FORMS)


def parse_timestamp(name: str, text: Column, where: Column, pattern: str | None = None) -> Column:
    """One pattern per column; any other form fails."""
    expected = f"a timestamp of the form {pattern or SPACED}"
    rest = lambda cell: F.when(~is_missing(cell), reject(name, expected, cell, where).cast("timestamp_ntz"))
    return F.when(text.isNotNull(), F.coalesce(timestamp_or_null(text, pattern), rarely(text, rest)))


def is_bad_timestamp(text: Column, pattern: str | None = None) -> Column:
    return ~is_missing(text) & timestamp_or_null(text, pattern).isNull()
