"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

PT_FORMAT = "yyyyMMdd"

# How an absent category is shown, by consumer.
MISSING_IN_MONITORING = "__missing__"
MISSING_IN_REPORTS = "__NULL__"
MISSING_IN_PROFILES = "<null>"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- partition values and dates -------------------------------------------------------------


def pt_to_date(pt: str | Column) -> Column:
    return F.to_date(col(pt), PT_FORMAT)


def date_to_pt(day: str | Column) -> Column:
    """Partition value of a day, by arithmetic: formatting a date costs far more for every row."""
    d = col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("string")


def parse_pt(pt: str) -> date:
    return datetime.strptime(pt, "%Y%m%d").date()


def shift_pt(pt: str, days: int) -> str:
    return (parse_pt(pt) + timedelta(days=days)).strftime("%Y%m%d")


def to_day(value: str | Column) -> Column:
    """Day of a date, timestamp or text column; text that is no date becomes NULL."""
    return col(value).try_cast("timestamp_ntz").cast("date")


def week_start(day: str | Column) -> Column:
    return F.date_trunc("week", col(day)).cast("date")


# --- numbers -------------------------------------------------------------------------------


def ratio(numerator: str | Column, denominator: str | Column, undefined: float | None = None) -> Column:
    """Quotient as double; `undefined` (NULL unless given) where the denominator is zero."""
    quotient = F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))
    return quotient if undefined is None else F.coalesce(quotient, F.lit(undefined))


def share(condition: Column) -> Column:
    """Aggregate: share of rows for which the condition holds (rows where it is NULL count as no)."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def no_number(value: str | Column) -> Column:
    return col(value).isNull() | F.isnan(col(value))


def bad_score(value: str | Column) -> Column:
    """Missing, NaN, or outside [0, 1]; each row counts once."""
    return no_number(value) | (col(value) < 0.0) | (col(value) > 1.0)


# --- text ----------------------------------------------------------------------------------


def blank(value: str | Column) -> Column:
    return col(value).isNull() | (F.trim(col(value)) == "")


def labelled(value: str | Column, missing: str) -> Column:
    return F.coalesce(col(value).cast("string"), F.lit(missing))


def treatment_combo(tokens: str | Column, flag: str | Column) -> Column:
    """Label of the channels named in a pipe-separated list, read as a set."""
    named = F.array_sort(
        F.array_distinct(F.filter(F.transform(F.split(col(tokens), r"\|"), lambda t: F.trim(t)), lambda t: t != ""))
    )
    absent = F.when(col(flag).try_cast("bigint") == 0, "no_treatment").otherwise("unknown")
    return (
        F.when(col(tokens).isNull(), absent)
        .when(F.size(named) == 0, "no_treatment")
        .when(named == F.array(F.lit("voucher")), "voucher_only")
        .when(named == F.array(F.lit("sms")), "sms_only")
        .when(named == F.array(F.lit("sms"), F.lit("voucher")), "voucher_and_sms")
        .otherwise("other_multi_treatment")
    )
