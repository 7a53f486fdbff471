"""Scores, bands, units, digests and bit fields as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_score(x: Column, low: Column, high: Column) -> Column:
    """10 times the position of ``x`` between two bounds on a log scale, clamped; null unless all are positive."""
    ok = (x > 0) & (low > 0) & (high > low)
    place = (F.ln(x) - F.ln(low)) / (F.ln(high) - F.ln(low))
    return F.when(ok, 10.0 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), place)))


def band(x: Column, floors: Sequence[float]) -> Column:
    """Number of the highest floor that ``x`` reaches, from 0; null below the first."""
    return F.array_max(F.filter(F.transform(F.array(*[F.lit(f) for f in floors]), lambda f, k: F.when(f <= x, k)), lambda k: k.isNotNull()))


def nearest_rank(values: Column, q: float) -> Column:
    """Element int(q * n) of the sorted array, or the last: no interpolation."""
    ordered = F.array_sort(values)
    n = F.size(ordered)
    return F.when(n > 0, F.get(ordered, F.least(n - 1, F.floor(F.lit(q) * n).cast("int"))))


def convert(amount: Column, rate: Column) -> Column:
    """Amount in standard units; null where the rate is unknown or not positive."""
    return F.when(rate > 0, amount * rate)


def hash_seed(c: Column, digits: int = 8) -> Column:
    """An integer from the first hex digits of a SHA-256 digest."""
    return F.conv(F.substring(F.sha2(c, 256), 1, digits), 16, 10).cast("long")


def pack_bits(fields: Sequence[tuple[Column, int]]) -> Column:
    """Fields (value, width) in one long, first field highest; null if a value does not fit its width."""
    out, fits = F.lit(0).cast("long"), F.lit(True)
    for value, width in fields:
        fits = fits & value.isNotNull() & (value >= 0) & (value < (1 << width))
        out = F.shiftleft(out, width).bitwiseOR(value.cast("long"))
    return F.when(fits, out)


def unpack_bits(packed: Column, widths: Sequence[int]) -> list[Column]:
    out, shift = [], sum(widths)
    for width in widths:
        shift -= width
        out.append(F.shiftright(packed, shift).bitwiseAND((1 << width) - 1))
    return out


def return_level(sample_max: Column, n_scored: Column, n_all: Column, tail: float = 1.0) -> Column:
    """Extreme-value correction of a maximum for the part not scored: log2(N / n) / tail more."""
    return F.when((n_scored > 0) & (n_all >= n_scored), sample_max + F.log2(n_all / n_scored) / F.lit(tail))


def kardashev(watts: Column) -> Column:
    return F.when(watts > 0, (F.log10(watts) - 6.0) / 10.0)


def kinetic(mass_kg: Column, speed: Column) -> Column:
    return 0.5 * mass_kg * speed * speed


def sphere_volume(radius: Column) -> Column:
    return F.lit(4.0 / 3.0 * 3.141592653589793) * radius * radius * radius


def lag_years(distance: Column, per_unit: float = 1000.0, exponent: float = 1.35) -> Column:
    """Apparent lag of a path of the given length; null where there is no path."""
    return F.when(distance >= 0, F.lit(per_unit) * F.pow(distance, F.lit(exponent)))


def lognormal_product(factors: Sequence[tuple[Column, Column]], correlation: float = 0.0) -> tuple[Column, Column]:
    """(log10 median, spread in powers of ten) of a product of log-normal factors with one correlation."""
    median = sum((m for m, _ in factors), F.lit(0.0))
    variance = sum((s * s for _, s in factors), F.lit(0.0))
    for k, (_, a) in enumerate(factors):
        for _, b in factors[:k]:
            variance = variance + 2 * correlation * a * b
    return median, F.sqrt(variance)


#: A number with an optional power of ten (raised or after a caret) and a unit.
QUANTITY = r"([0-9][0-9,]*(?:\.[0-9]+)?)\s*(?:[x×]\s*10\s*\^?\s*([⁻-]?[⁰¹²³⁴⁵⁶⁷⁸⁹0-9]+))?\s*(km|kg|m|j|w|tons?|joules?|watts?)\b"


def quantities(text: Column) -> Column:
    """array<struct<value, unit>> of the quantities in a text."""
    i = f"(?i){QUANTITY}"
    part = lambda k: F.regexp_extract_all(text, F.lit(i), F.lit(k))
    raised = lambda c: F.translate(c, "⁻⁰¹²³⁴⁵⁶⁷⁸⁹", "-0123456789")

    def one(q: Column) -> Column:
        number = F.regexp_replace(q["0"], ",", "").cast("double")
        power = F.coalesce(F.nullif(raised(q["1"]), F.lit("")).cast("int"), F.lit(0))
        return F.struct((number * F.pow(F.lit(10.0), power.cast("double"))).alias("value"), F.lower(q["2"]).alias("unit"))

    return F.transform(F.arrays_zip(part(1), part(2), part(3)), one)
