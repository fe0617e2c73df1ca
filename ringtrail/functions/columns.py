"""Column expressions shared by several operators. All built-in, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringtrail import constants as K


def account_key(bank: str, account: str) -> Column:
    """NULL if a part is: half a key would name another account."""
    return F.concat(F.col(bank), F.lit(":"), F.col(account))


def whole_hours(start: str, end: str) -> Column:
    """Hours between two NTZ timestamps, half rounded up, in exact integer arithmetic."""
    micros = f"timestampdiff(MICROSECOND, {start}, {end})"
    return F.expr(f"({micros} + 1800000000) div 3600000000")


def rounded_ratio(num: str, den: str) -> Column:
    """num / den to four decimals, NULL unless the denominator is positive."""
    quotient = F.col(num).cast("double") / F.col(den).cast("double")
    return F.when(F.col(den) > 0, F.round(quotient, 4))


def severity_rank(severity: Column) -> Column:
    """0 for CRITICAL up to 3 for LOW, 4 for anything else."""
    rank = F.lit(len(K.SEVERITY_ORDER))
    for position, name in reversed(list(enumerate(K.SEVERITY_ORDER))):
        rank = F.when(severity == name, position).otherwise(rank)
    return rank


def lookup(value: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed dictionary, NULL when the key is unknown."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(entries, value)


def null_if_empty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)
