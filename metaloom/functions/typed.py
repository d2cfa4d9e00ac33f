"""Literals to typed columns. Nothing here raises: what cannot be read is null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaloom.constants import FLOAT_TYPES, INTEGER_TYPES, MOMENT_TYPES, XSD
from metaloom.functions.text import let, strip
from metaloom.functions.uris import as_column

_MOMENT = ("^(\\d{4}-\\d{2}-\\d{2})(?:.(\\d{2})(?::?(\\d{2})(?::?(\\d{2})(?:[.,](\\d+))?)?)?"
           "(Z|[+-]\\d{2}(?::?\\d{2})?)?)?$")


def local_datatype(datatype) -> Column:
    return F.regexp_replace(datatype, "^" + XSD.replace(".", "\\."), "")


def _is_date(day) -> Column:
    return F.try_to_date(day, "yyyy-MM-dd").isNotNull()


def moment_text(text) -> Column:
    """ISO date and time where the text is one: `T` between, fractions as six digits, the
    offset as `+hh:mm`."""
    # One match gives all parts; text that does not match stays in one piece.
    parts = F.split(F.regexp_replace(strip(text), _MOMENT, "$1\u0001$2\u0001$3\u0001$4\u0001$5\u0001$6"),
                    "\u0001", -1)

    def clock(p, n):
        return F.when(p[n] == "", "00").otherwise(p[n])

    def offset(mark):
        return (F.when(mark == "Z", "+00:00")
                .when(F.length(mark) == 3, F.concat(mark, F.lit(":00")))
                .when(F.length(mark) == 5, F.concat(F.substring(mark, 1, 3), F.lit(":"), F.substring(mark, 4, 2)))
                .otherwise(mark))

    def written(p):
        fraction = F.rpad(F.substring(p[4], 1, 6), 6, "0")
        real = _is_date(p[0]) & (p[1] < "24") & (p[2] < "60") & (p[3] < "60")
        return F.when((F.size(p) == 6) & real, F.concat(
            p[0], F.lit("T"), clock(p, 1), F.lit(":"), clock(p, 2), F.lit(":"), clock(p, 3),
            F.when((p[4] != "") & (fraction != "000000"), F.concat(F.lit("."), fraction)).otherwise(""),
            offset(p[5])))

    return let(parts, lambda p: F.when(F.size(p) == 6, written(p)))


def _day_of(moment) -> Column:
    return F.substring(moment, 1, 10)


def date_text(value, datatype) -> Column:
    """A literal as an ISO date or date-time string, or null. The datatype decides; without one
    that gives a date, a `T` in the text means a moment and anything else a day."""
    value, local = as_column(value), F.coalesce(local_datatype(datatype), F.lit(""))
    whole = local.isin(MOMENT_TYPES) | ((local != "date") & F.contains(value, F.lit("T")))
    day = (F.length(value) == 10) & value.rlike("^\\d{4}-\\d{2}-\\d{2}$")
    return F.when(day, F.when(_is_date(value), F.when(whole, F.concat(value, F.lit("T00:00:00"))).otherwise(value))).otherwise(
        let(moment_text(value), lambda m: F.when(whole, m).otherwise(_day_of(m))))


def integer_value(value) -> Column:
    """A whole number with optional sign; no fractions."""
    text = strip(value)
    return F.when(text.rlike("^[+-]?\\d+$"), text.try_cast("bigint"))


def float_value(value) -> Column:
    return strip(value).try_cast("double")


def boolean_value(value) -> Column:
    word = F.lower(strip(value))
    return (F.when(word.isin("true", "1"), F.lit(True))
            .when(word.isin("false", "0"), F.lit(False)))


def typed_literal(value, datatype) -> Column:
    """One literal in the column of its datatype's family; unread text stays text."""
    value = as_column(value)

    def read(local):
        moment = F.when((local == "date") | local.isin(MOMENT_TYPES), moment_text(value))
        return F.struct(
            F.when(local.isin(INTEGER_TYPES), integer_value(value))
            .when(local == "gYear", integer_value(F.substring(strip(value), 1, 4))).alias("integer"),
            F.when(local.isin(FLOAT_TYPES), float_value(value)).alias("float"),
            F.when(local == "boolean", boolean_value(value)).alias("boolean"),
            local.alias("local"), moment.alias("moment"))

    def split(v):
        dated = v["local"] == "date"
        return F.struct(v["integer"].alias("integer"), v["float"].alias("float"), v["boolean"].alias("boolean"),
                        F.when(dated, _day_of(v["moment"])).alias("date"),
                        F.when(~dated, v["moment"]).alias("datetime"))

    def named(v):
        family = F.lit("string")
        for name in ("datetime", "date", "boolean", "float", "integer"):
            family = F.when(v[name].isNotNull(), name).otherwise(family)
        return F.struct(family.alias("family"), *[v[n].alias(n) for n in
                                                  ("integer", "float", "boolean", "date", "datetime")],
                        F.when(family == "string", value).alias("string"))

    return let(let(let(local_datatype(datatype), read), split), named)


def byte_size(text) -> Column:
    """A non-negative whole number as publishers write one: spaces between thousands, or a
    fraction of zeros."""
    digits = F.translate(text, " \t\n\r\u00a0\u202f\u2009", "")
    return F.when(digits.rlike("^\\d+(\\.0*)?$"),
                  F.substring_index(digits, ".", 1).try_cast("bigint"))


def second_stamp(text) -> Column:
    """A date or moment cut to seconds as comparable text; a day starts at midnight. Offsets are
    ignored on purpose: the answer depends on what was written."""
    text = as_column(text)
    full = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    return F.substring(full, 1, 19)


def registry_moment(text) -> Column:
    """The registry's own change stamp as a UTC timestamp."""
    return F.try_to_timestamp(strip(text))
