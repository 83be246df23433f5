"""The tariff as column arithmetic, so pricing stays inside whole-stage codegen."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tariff:
    """Prices in euro. Any field may also be a Column, for a table of many plans."""

    # Fixed values of the 2024/2025 plan.
    offpeak_per_kwh: float | Column = 0.0999
    onpeak_per_kwh: float | Column = 0.1799
    power_per_day: float | Column = 0.38
    network_per_day: float | Column = 0.0
    audiovisual_per_month: float | Column = 2.85
    exploitation_per_month: float | Column = 0.0023
    special_per_kwh: float | Column = 0.001
    vat_reduced: float | Column = 0.06
    vat_normal: float | Column = 0.23
    reduced_limit_kwh: float | Column = 200.0
    discount: float | Column = 1.8


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def add_bill(
    df: DataFrame,
    name: str = "bill",
    offpeak: str = "offpeak_kwh",
    onpeak: str = "onpeak_kwh",
    days: str = "days_in_month",
    tariff: Tariff = Tariff(),
    breakdown: bool = False,
) -> DataFrame:
    """Add the bill as column ``name``; with ``breakdown`` a struct of the bill and its parts.

    One negative component voids both. Up to the limit all energy carries the reduced rate and the discount
    comes off it; above the limit energy is split by share of kWh and the discount comes off the upper part
    only, which makes the price jump at the limit.

    The steps are separate projections: each amount is computed once, and the generated code stays small enough
    for the JIT compiler, which a single nested expression would not.
    """
    t = {k: _col(v) for k, v in vars(tariff).items()}
    zero = F.lit(0.0)
    reduced, normal = 1 + t["vat_reduced"], 1 + t["vat_normal"]
    usage = df.withColumns(
        {
            "_void": (F.col(offpeak) < 0) | (F.col(onpeak) < 0),
            "_days": F.when(F.col(days) <= 0, 30).otherwise(F.col(days)).cast("double"),
        }
    ).withColumns(
        {
            "_off": F.when(F.col("_void"), zero).otherwise(F.col(offpeak)),
            "_on": F.when(F.col("_void"), zero).otherwise(F.col(onpeak)),
        }
    )
    sums = usage.withColumns(
        {
            "_total": F.col("_off") + F.col("_on"),
            "_base": F.col("_off") * t["offpeak_per_kwh"] + F.col("_on") * t["onpeak_per_kwh"],
            "_months": F.col("_days") / F.lit(365 / 12),
        }
    ).withColumn("_lower", F.least(F.lit(1.0), F.try_divide(t["reduced_limit_kwh"], F.col("_total"))))
    within = F.col("_total") <= t["reduced_limit_kwh"]
    discounted = F.greatest(zero, F.when(within, F.col("_base")).otherwise(F.col("_base") * (1 - F.col("_lower"))) - t["discount"])
    energy = sums.withColumn("_discounted", discounted).withColumns(
        {
            "_energy": F.when(within, F.col("_discounted") * reduced).otherwise(
                F.col("_base") * F.col("_lower") * reduced + F.col("_discounted") * normal
            ),
            "_power": t["power_per_day"] * F.col("_days"),
            "_network": t["network_per_day"] * F.col("_days"),
            "_audiovisual": F.col("_months") * t["audiovisual_per_month"],
            "_exploitation": F.col("_months") * t["exploitation_per_month"],
            "_special": F.col("_total") * t["special_per_kwh"],
        }
    )
    amount = F.greatest(
        zero,
        F.col("_energy")
        + F.col("_power") * normal
        + F.col("_network")
        + F.col("_audiovisual") * reduced
        + F.col("_exploitation") * normal
        + F.col("_special") * normal,
    )
    parts = {
        "bill": amount,
        "energy": F.col("_energy"),
        "energy_base": F.col("_base"),
        "power": F.col("_power") * normal,
        "power_base": F.col("_power"),
        "network": F.col("_network"),
        "audiovisual": F.col("_audiovisual") * reduced,
        "audiovisual_base": F.col("_audiovisual"),
        "exploitation": F.col("_exploitation") * normal,
        "exploitation_base": F.col("_exploitation"),
        "special": F.col("_special") * normal,
        "special_base": F.col("_special"),
        "discount": t["discount"],
        "total_kwh": F.col("_total"),
        "offpeak_kwh": F.col("_off"),
        "onpeak_kwh": F.col("_on"),
    }
    result = F.struct(*[c.alias(n) for n, c in parts.items()]) if breakdown else amount
    return energy.select(*[F.col(c) for c in df.columns if c != name], result.alias(name))


def with_bill(monthly: DataFrame, tariff: Tariff = Tariff()) -> DataFrame:
    """Add the label column ``bill`` unless the table already carries one."""
    return monthly if "bill" in monthly.columns else add_bill(monthly, tariff=tariff)
