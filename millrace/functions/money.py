"""Exact decimal expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantise(value: Column, digits: int, scale: int) -> Column:
    """A whole or decimal number, or its text, rounded half away from zero; floats, NaN, other texts and more digits than fit are errors."""
    kind = F.typeof(value)
    exact = kind.isin("tinyint", "smallint", "int", "bigint", "string") | kind.startswith("decimal")
    refused = F.raise_error(F.concat(F.lit("an exact number is needed, not "), kind)).cast("decimal(38,10)")
    return F.round(F.when(exact, value.cast("decimal(38,10)")).otherwise(refused), scale).cast(f"decimal({digits},{scale})")


def minor_units(amount: Column, scale: int = 2) -> Column:
    """An exact amount in units of its last decimal; a fraction of one is an error."""
    units = amount.cast("decimal(38,10)") * 10**scale
    return F.when(units == F.round(units, 0), units.cast("long")).otherwise(F.when(units.isNotNull(), F.raise_error(F.concat(amount.cast("string"), F.lit(f" has more than {scale} decimals"))).cast("long")))


#: Hours until a case of each priority is due.
SLA_HOURS = {"Low": 72, "Medium": 48, "High": 24, "Critical": 4}


def due_at(opened: Column, priority: Column, hours: dict[str, int] | None = None) -> Column:
    """When a case is due: its priority's hours after it was opened; null for another priority."""
    out = F.lit(None).cast("timestamp")
    for name, n in (hours or SLA_HOURS).items():
        out = F.when(priority == name, opened.cast("timestamp") + F.expr(f"INTERVAL {int(n)} HOURS")).otherwise(out)
    return out


def convert(amount: Column, rate: Column) -> Column:
    """amount * rate, rounded once to four decimals; null without a positive rate.

    The amount is taken at scale 4 with 18 digits, so that the product keeps its ten
    decimals and is not rounded twice.
    """
    return F.when(rate > 0, F.round(amount.cast("decimal(18,4)") * rate, 4))


def signed_amount(debit: Column, credit: Column, normal_balance: Column) -> Column:
    """Debit less credit for accounts that grow by debits, credit less debit for others."""
    d, c = F.coalesce(debit, F.lit(0)), F.coalesce(credit, F.lit(0))
    return F.when(normal_balance == "Debit", d - c).otherwise(c - d)


def percent_change(before: Column, after: Column, digits: int = 2) -> Column:
    """Null for a base of zero."""
    return F.round((after - before).cast("double") * 100.0 / F.nullif(before.cast("double"), F.lit(0.0)), digits)


def quarter_bounds(day: Column) -> tuple[Column, Column]:
    """The half-open calendar quarter that holds a day."""
    start = F.date_trunc("quarter", day).cast("date")
    return start, F.add_months(start, 3)
