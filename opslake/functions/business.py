"""Business rules as Column expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
ON_TIME_WEIGHT = 0.6
QUALITY_WEIGHT = 0.4
DEFECT_PPM_SCALE = 5000.0
SLA_TARGET_HOURS = {"P1": 48, "P2": 120}
SLA_TARGET_OTHER = 240
URGENT_SHORTFALL = 10
TIER_FLOORS = (("Preferred", 0.85), ("Approved", 0.70))
TIER_BELOW = "Probation"


def net_price(unit_price: Column, discount: Column) -> Column:
    """Unit price after discount."""
    return unit_price * (F.lit(1.0) - discount)


def composite_score(on_time_rate: Column, defect_ppm: Column) -> Column:
    """Weighted delivery and quality score; double literals keep it off decimals."""
    quality = F.lit(1.0) - defect_ppm / F.lit(DEFECT_PPM_SCALE)
    return F.lit(ON_TIME_WEIGHT) * on_time_rate + F.lit(QUALITY_WEIGHT) * quality


def cents(amount: Column) -> Column:
    """An amount to two places, half up on its decimal value: exact halves, which prices times
    discounts often are, round the same way whatever double stands for them."""
    return F.round(amount.cast("decimal(28,8)"), 2).cast("double")


def savings_vs_list(list_price: Column, paid: Column) -> Column:
    """Share saved against list; NULL without a positive list price, may be negative."""
    return F.when(list_price > 0, (list_price - paid) / list_price)


def duration_hours(start: Column, end: Column) -> Column:
    """Hours between two timestamps at whole-second precision."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0)


def sla_target_hours(priority: Column) -> Column:
    """Hours allowed per priority; unknown and NULL priorities get the longest target."""
    target = None
    for name, hours in SLA_TARGET_HOURS.items():
        matched = priority == name
        target = F.when(matched, hours) if target is None else target.when(matched, hours)
    return target.otherwise(SLA_TARGET_OTHER)


def month_of(ts: Column) -> Column:
    """Month as yyyy-MM text."""
    return F.date_format(ts, "yyyy-MM")


def recommended_tier(rounded_score: Column) -> Column:
    """Tier for a composite score that was already rounded to three places."""
    tier = None
    for name, floor in TIER_FLOORS:
        reached = rounded_score >= floor
        tier = F.when(reached, name) if tier is None else tier.when(reached, name)
    return tier.otherwise(TIER_BELOW)


def reorder_value(shortfall: Column, list_price: Column) -> Column:
    """Estimated cost of refilling a shortfall; NULL for parts without a price."""
    return (shortfall * list_price).cast("decimal(18,2)")


def part_description(
    name: Column, category: Column, manufacturer: Column, hazmat: Column, price: Column
) -> Column:
    """Text that the similarity index embeds.

    The labels carry no space before their value and a part without hazard leaves an
    empty piece, so two spaces stand there: both belong to the text that is matched.
    """
    return F.concat_ws(
        " ",
        name,
        F.concat(F.lit("Category:"), category),
        F.concat(F.lit("Manufactured by"), manufacturer),
        F.when(hazmat == 1, "Hazardous material handling required.").otherwise(""),
        F.concat(F.lit("List price USD"), price.cast("string")),
    )


def money_sum(amount: Column) -> Column:
    """Aggregate: the sum of amounts of money, in whole millionths, so that it does not depend on the
    order in which rows are added. Billions of millionths and the rest are added apart, in 64 bits
    each; an amount may have up to nine digits before the point."""
    units = F.rint(amount * F.lit(1e6)).cast("bigint")
    billion = F.lit(1_000_000_000).cast("bigint")
    rest = units % billion
    whole = ((units - rest) / billion).cast("bigint")
    total = F.sum(whole).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    total = (total + F.sum(rest).cast("decimal(20,0)")).cast("decimal(31,0)")
    return (total * F.expr("0.000001BD")).cast("double")
