"""Damage strings (``10.00K``, ``2.5M``, ``500``) as dollars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffix -> factor. K and T both mean thousands.
FACTORS = {"K": 1e3, "T": 1e3, "M": 1e6, "B": 1e9}

# Spark would also read "5f" and "1.0d"; only plain decimal and exponent forms count as numbers here.
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _number(text: Column) -> Column:
    return F.when(text.rlike(NUMERIC), F.trim(text).try_cast("double"))


def damage_usd(text: Column, strict: bool = False) -> Column:
    """Dollars; NULL when blank, a bare suffix, or unreadable.

    ``strict`` fails the job on a suffix-less string that is no number. All letters equal to the suffix are
    removed, not only the last one.
    """
    raised = F.upper(text)
    plain = _number(text)
    if strict:
        plain = F.when(text.rlike(NUMERIC), plain).otherwise(
            F.raise_error(F.concat(F.lit("not a damage amount: "), text)).cast("double")
        )
    parsed = F.when(F.trim(text) == "", F.lit(None).cast("double"))
    for suffix, factor in FACTORS.items():
        amount = _number(F.replace(raised, F.lit(suffix), F.lit(""))) * F.lit(factor)
        parsed = parsed.when(raised.endswith(suffix), amount)
    return F.when(text.isNotNull(), parsed.otherwise(plain))


def damage_rejects(df: DataFrame, *columns: str) -> DataFrame:
    """Per column: texts that are present but give no amount."""
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & damage_usd(F.col(c)).isNull()).alias(c)
            for c in columns
        ]
    )
    return counts.unpivot([], list(columns), "column_name", "rejected")
