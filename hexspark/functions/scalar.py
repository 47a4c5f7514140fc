"""Column functions: rounding, shares, presence of a source, and the bitwise parts of cell indexes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x: Column | str, digits: int = 0) -> Column:
    """Round by scaling doubles, halves away from zero; Spark's own round(x, d) goes by the exact decimal."""
    x = _col(x)
    return F.round(x) if digits == 0 else F.round(x * float(10**digits)) / float(10**digits)


def share(part: Column | str, whole: Column | str) -> Column:
    """Percentage with one decimal; null where the whole is 0."""
    return rnd(_col(part) * 100.0 / F.nullif(_col(whole), F.lit(0)), 1)


def is_finite(x: Column | str) -> Column:
    x = _col(x)
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


#: Fixed-point digits of exact_sum: so many bits each, so many of them, the topmost counting whole multiples of 2 to the TOP.
DIGIT_BITS, DIGITS, TOP = 24, 9, 96


def exact_sum(x: Column | str) -> Column:
    """Sum of doubles that is the same to the last bit however the rows are divided or ordered; nulls are passed over, null where nothing else is.

    Every value is split into nine whole numbers of 24 bits with its sign, from 2^119 down to 2^-96, which doubles hold exactly; their
    sums are longs, exact for 2^39 rows a group.  The carries are settled once at the end, so the result depends on the exact sum alone,
    of which it is one of the two nearest doubles.  Infinities and NaN give what they give in any sum.  A finite value of 2^119 or more
    raises; bits below 2^-96 are cut off, of each value alike.
    """
    x = _col(x)
    number = is_finite(x)
    size = F.when(number & (F.abs(x) >= 2.0 ** (TOP + DIGIT_BITS - 1)), F.raise_error(F.lit("exact_sum: a value is beyond its range")).cast("double")).when(number, F.abs(x))
    sums = []
    for i in range(DIGITS):
        digit = F.floor(size * 2.0 ** (DIGIT_BITS * i - TOP) % float(1 << DIGIT_BITS))
        sums.append(F.coalesce(F.sum(F.when(x < 0, -digit).otherwise(digit)), F.lit(0).cast("long")))
    return F.when(F.count(x) > 0, F.coalesce(F.sum(F.when(~number, x)), _settled(sums)))


def _settled(sums: list[Column]) -> Column:
    """The double that sums of the digits stand for."""

    def digits(signed: list[Column]) -> tuple[Column, list[Column]]:
        carry, out = F.lit(0).cast("long"), []
        for s in reversed(signed[1:]):
            total = s + carry
            carry = F.shiftright(total, DIGIT_BITS)
            out.append(total.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)))
        return signed[0] + carry, out

    def value(signed: list[Column]) -> Column:
        top, low = digits(signed)
        out = F.lit(0.0)
        for i, d in enumerate([*low, top]):  # from the least
            out = out + d.cast("double") * 2.0 ** (TOP - DIGIT_BITS * (DIGITS - 1 - i))
        return out

    # The digits of a negative sum would cancel, so it is turned round.
    return F.when(digits(sums)[0] < 0, -value([-s for s in sums])).otherwise(value(sums))


def finite_sum(x: Column | str) -> Column:
    """exact_sum of the finite values; a null counts as 0."""
    x = _col(x)
    return exact_sum(F.when(is_finite(x), x).otherwise(0.0))


def has_source(name: str, sources: str = "sources") -> Column:
    """Whether any source is of a data set; reads the one nested column only."""
    return F.array_contains(F.col(f"{sources}.dataset"), name)


def centre(box: str = "bbox") -> tuple[Column, Column]:
    """Latitude and longitude of a box's centre."""
    return (F.col(f"{box}.ymin") + F.col(f"{box}.ymax")) / 2.0, (F.col(f"{box}.xmin") + F.col(f"{box}.xmax")) / 2.0


def in_closed_box(w: float, s: float, e: float, n: float, box: str = "bbox") -> Column:
    """The box's least corner lies in the area, its edges included."""
    return F.col(f"{box}.xmin").between(w, e) & F.col(f"{box}.ymin").between(s, n)


def in_half_open_box(w: float, s: float, e: float, n: float, box: str = "bbox") -> Column:
    """As in_closed_box without the east and north edges: adjacent areas share nothing."""
    x, y = F.col(f"{box}.xmin"), F.col(f"{box}.ymin")
    return (x >= w) & (x < e) & (y >= s) & (y < n)


def cell_hex(cell: Column | str) -> Column:
    """A cell index as text."""
    return F.lower(F.hex(_col(cell)))


def hex_cell(text: Column | str) -> Column:
    """A cell index from its text."""
    return F.conv(_col(text), 16, 10).cast("long")


def cell_resolution(cell: Column | str) -> Column:
    return F.shiftrightunsigned(_col(cell), 52).bitwiseAND(F.lit(15)).cast("int")


def cell_parent(cell: Column | str, resolution: int) -> Column:
    """The ancestor at a coarser resolution: its resolution bits, and digits beyond it unused (7)."""
    if not 0 <= resolution <= 15:
        raise ValueError(f"no such resolution: {resolution}")
    cleared = _col(cell).bitwiseAND(F.lit(~(15 << 52)))
    return cleared.bitwiseOR(F.lit(resolution << 52)).bitwiseOR(F.lit((1 << (3 * (15 - resolution))) - 1))


def gap(population: Column | str, part: Column | str, whole: Column | str) -> Column:
    """People weighted by the share of buildings that the source lacks; without buildings, all of them."""
    done = F.coalesce(_col(part) * 1.0 / F.nullif(_col(whole), F.lit(0)), F.lit(0.0))
    return rnd(F.coalesce(_col(population), F.lit(0.0)) * (1.0 - done))


def pixel_centre(index: Column | str, offset: Column | float, origin: float, size: float) -> Column:
    """Coordinate of a pixel's centre."""
    return F.lit(origin) + (_col(index) + offset + 0.5) * size


def view_area_km2(w: Column, s: Column, e: Column, n: Column) -> Column:
    """Rough area of a viewport: 111.32 km a degree of longitude at the equator, 110.57 of latitude."""
    return F.abs((e - w) * 111.32 * F.cos((n + s) / 2.0 * math.pi / 180.0) * (n - s) * 110.57)


#: Places and colours of the ramp's stops.
STOPS = ((0.0, (215, 48, 39)), (0.5, (254, 224, 139)), (1.0, (26, 152, 80)))


def ramp(t: Column | str) -> tuple[Column, Column, Column]:
    """Red, green and blue of a value from 0 to 1, clamped; null stays null."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(t)))
    t = F.when(_col(t).isNotNull(), t)

    def channel(i: int) -> Column:
        (_, a), (mid, b), (_, c) = STOPS
        low = F.lit(float(a[i])) + (b[i] - a[i]) * (t / mid)
        high = F.lit(float(b[i])) + (c[i] - b[i]) * ((t - mid) / (1.0 - mid))
        return F.floor(F.when(t <= mid, low).otherwise(high) + 0.5).cast("int")

    return channel(0), channel(1), channel(2)


def change_since(now: Column | str, base: Column | str) -> Column:
    """Whole percents of change, halves upward; 0 where the base is 0 or null."""
    now, base = F.coalesce(_col(now), F.lit(0.0)), F.coalesce(_col(base), F.lit(0.0))
    return F.when(base == 0, 0).otherwise(F.floor((now - base) / F.nullif(base, F.lit(0.0)) * 100.0 + 0.5)).cast("long")


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371008.8) -> Column:
    """Haversine distance in metres."""
    a, b, d, e = (F.radians(c) for c in (lat1, lat2, lat2 - lat1, lon2 - lon1))
    h = F.pow(F.sin(d / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(e / 2), 2)
    return 2.0 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def shown(x: Column | str, digits: int = 0, suffix: str = "") -> Column:
    """A number for reading, with thousands separators; a hyphen for none."""
    return F.coalesce(F.concat(F.format_number(_col(x), digits), F.lit(suffix)), F.lit("-"))
