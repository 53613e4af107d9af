"""Amounts, rates, delays and pay tiers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (highest average rate, share of the base, lowest pay). The first
# tier excludes its bound, the next two include it, the last one is open.
PAY_TIERS = (
    (4.0, Decimal("0.05"), Decimal("100")),
    (4.5, Decimal("0.07"), Decimal("150")),
    (4.9, Decimal("0.08"), Decimal("175")),
    (None, Decimal("0.10"), Decimal("200")),
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def courier_pay(avg_rate: Column | str, base: Column | str) -> Column:
    """Pay by average rate: a share of the base, at least the tier's floor; NULL rate or base gives NULL."""
    rate, amount = _col(avg_rate), _col(base)

    def tier(share: Decimal, floor: Decimal) -> Column:
        part = amount * F.lit(share)
        return F.when(part > F.lit(floor), part).when(part <= F.lit(floor), F.lit(floor))

    (first_bound, *first), *middle, (_, *last) = PAY_TIERS
    pay = F.when(rate < first_bound, tier(*first))
    for bound, share, floor in middle:
        pay = pay.when(rate <= bound, tier(share, floor))
    return pay.when(rate.isNotNull(), tier(*last))


def signed_amount(status: Column | str, amount: Column | str) -> Column:
    """Refunds count as negative, shipped rows as they are, any other status as NULL."""
    status, amount = _col(status), _col(amount)
    return F.when(status == "refunded", -amount).when(status == "shipped", amount)


def to_base(amount: Column | str, rate: Column | str) -> Column:
    """Absolute amount in the base currency."""
    return F.abs(_col(amount)) * _col(rate)


def tax(payment: Column | str, *rates: Column | str) -> Column:
    """Payment times the sum of the rates."""
    total = _col(rates[0])
    for rate in rates[1:]:
        total = total + _col(rate)
    return _col(payment) * total


def profit(payment: Column | str, commission: Column | str) -> Column:
    """Payment times the commission."""
    return _col(payment) * _col(commission)


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Full days from start to end, cut toward zero."""
    return F.extract(F.lit("day"), _col(end) - _col(start)).cast("long")


def delay_days(end: Column | str, plan: Column | str) -> Column:
    """Full days after the plan, 0 when on time or open."""
    end, plan = _col(end), _col(plan)
    return F.when(end > plan, whole_days(plan, end)).otherwise(F.lit(0).cast("long"))


def rounded_ratio(numerator: Column, count: Column, scale: int = 2) -> Column:
    """Exact decimal ratio, rounded half up once; NULL for a zero count."""
    top = numerator.cast("decimal(22,2)")
    bottom = F.nullif(count, F.lit(0)).cast("decimal(12,0)")
    return (top / bottom).cast(f"decimal(14,{scale})")
