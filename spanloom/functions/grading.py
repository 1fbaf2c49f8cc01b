"""Colour correction: rules over frame statistics, presets and the colour model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecode import fixed

# The named corrections.
PRESETS = {
    "subtle": "eq=contrast=1.03:saturation=0.98",
    "neutral_punch": "eq=contrast=1.06:brightness=0.0:saturation=1.0,curves=master='0/0 0.25/0.23 0.75/0.77 1/1'",
    "warm_cinematic": "eq=contrast=1.12:brightness=-0.02:saturation=0.88,colorbalance=rs=0.02:gs=0.0:bs=-0.03:rm=0.04:gm=0.01:bm=-0.02:rh=0.08:gh=0.02:bh=-0.05,curves=master='0/0 0.25/0.22 0.75/0.78 1/1'",
    "none": "",
}
AUTO = "__AUTO__"


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


# The limits and steps of the rules.
def corrections(y_mean: Column, y_range: Column, saturation: Column) -> dict[str, Column]:
    """Contrast, gamma and saturation for a clip."""
    flat = F.lit(1.08) - F.lit(0.05) * clamp((y_range - 0.50) / 0.15, 0.0, 1.0)
    dark = F.lit(1.10) - F.lit(0.08) * clamp((y_mean - 0.30) / 0.12, 0.0, 1.0)
    return {
        "contrast": clamp(F.when(y_range < 0.65, flat).otherwise(F.lit(1.03)), 0.94, 1.08),
        "gamma": clamp(F.when(y_mean < 0.42, dark).when(y_mean > 0.60, F.lit(0.97)).otherwise(F.lit(1.0)), 0.94, 1.10),
        "saturation": clamp(F.when(saturation < 0.18, F.lit(1.04)).when(saturation > 0.38, F.lit(0.96)).otherwise(F.lit(0.98)), 0.94, 1.06),
    }


def auto_grade(y_mean: Column, y_range: Column, saturation: Column) -> Column:
    """The correction as a filter; axes within 0.005 of 1 are left out."""
    parts = [F.when(F.abs(x - 1) > 0.005, F.concat(F.lit(f"{axis}="), fixed(x, 3))) for axis, x in corrections(y_mean, y_range, saturation).items()]
    text = F.concat_ws(":", *parts)
    return F.when(text == "", "").otherwise(F.concat(F.lit("eq="), text))


def resolve_grade(grade: Column) -> Column:
    """A preset by its name; ``auto`` as a mark; anything else as it is."""
    presets = F.create_map(*[F.lit(x) for item in PRESETS.items() for x in item])
    named = F.when(grade.rlike(r"^[A-Za-z0-9_-]+\z"), F.element_at(presets, grade))
    return F.when(F.coalesce(grade, F.lit("")) == "", "").when(grade == "auto", AUTO).otherwise(F.coalesce(named, grade))


def color_transform(value: Column, slope: float, offset: float, power: float) -> Column:
    """(value * slope + offset) ** power, negative bases taken as 0."""
    return F.pow(F.greatest(value * slope + offset, F.lit(0.0)), F.lit(power))


def sampling_rate(n: int, seconds: Column) -> Column:
    """Frames a second for about ``n`` frames of a clip, from 0.5 to 10."""
    return clamp(F.lit(float(n)) / F.greatest(seconds, F.lit(0.1)), 0.5, 10.0)


#: The weights of red, green and blue in brightness.
LUMA = (0.2126, 0.7152, 0.0722)


def saturate(red: Column, green: Column, blue: Column, saturation: float) -> list[Column]:
    """The three channels drawn towards (below 1) or away from their brightness."""
    grey = red * LUMA[0] + green * LUMA[1] + blue * LUMA[2]
    return [grey + (c - grey) * saturation for c in (red, green, blue)]


def ease_out(t: Column) -> Column:
    return 1 - F.pow(1 - t, F.lit(3.0))


def ease_in_out(t: Column) -> Column:
    return F.when(t < 0.5, 4 * F.pow(t, F.lit(3.0))).otherwise(1 - F.pow(-2 * t + 2, F.lit(3.0)) / 2)
