"""Column functions: time, grids, nodata, quantisation, polynomials.

Missing values are NULL inside the library.  ``clip`` keeps NULL (``least`` and
``greatest`` alone would not), and ``finite`` is the test that a value is
neither NULL, NaN nor infinite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -9999.0
#: What the sensor's masked pixels hold.
MASKED = -0.01
#: Quantised nodata, and the scale of quantised reflectance.
U16_NODATA, U16_SCALE = 65535, 10_000.0


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull() & ~F.isnan(x), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def close_to(x: Column, ref: float, atol: float = 1e-3, rtol: float = 1e-5) -> Column:
    """Within ``atol + rtol * |ref|``; false for NULL and NaN."""
    return F.coalesce(~F.isnan(x) & (F.abs(x - ref) <= atol + rtol * abs(ref)), F.lit(False))


def solar_time(ts: Column, lon: Column) -> Column:
    """Local solar time in hours, from whole seconds of UTC and a longitude."""
    hours = F.hour(ts) + F.minute(ts) / F.lit(60.0) + F.second(ts) / F.lit(3600.0) + lon / F.lit(15.0)
    return F.pmod(hours, F.lit(24.0))


def circular_hours(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(24.0))
    return F.least(d, F.lit(24.0) - d)


def snap_inward(low: Column, high: Column, origin: float, step: float, eps: float = 1e-9) -> tuple[Column, Column]:
    """The largest whole-step interval inside [low, high]."""
    return (F.ceil((low - origin) / step - eps) * step + origin, F.floor((high - origin) / step + eps) * step + origin)


def snap_outward(low: Column, high: Column, origin: float, step: float, eps: float = 1e-9) -> tuple[Column, Column]:
    """The smallest whole-step interval around [low, high]."""
    return (F.floor((low - origin) / step + eps) * step + origin, F.ceil((high - origin) / step - eps) * step + origin)


def snap_half_up(x: Column, origin: float, step: float) -> Column:
    return F.floor((x - origin) / step + 0.5) * step + origin


def quantize_u16(x: Column) -> Column:
    """Reflectance as 0..65534 in float32 arithmetic, rounded half to even; invalid as 65535."""
    f = x.cast("float")
    scaled = F.rint((f * F.lit(U16_SCALE).cast("float")).cast("double"))
    return F.when(finite(f), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(65534.0)).cast("int")).otherwise(U16_NODATA)


def decode_u16(q: Column, scale: float = 1 / U16_SCALE, offset: float = 0.0) -> Column:
    return F.when(q != U16_NODATA, q * F.lit(scale) + F.lit(offset))


def quantize_range(x: Column, low: Column, high: Column) -> Column:
    """Linear from [low, high] to 0..65535; NULL becomes 0."""
    part = (x - low) / F.when(high > low, high - low).otherwise(F.lit(1.0))
    return F.coalesce(F.rint(F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)) * 65535).cast("int"), F.lit(0))


def logit(x: Column, eps: float = 1e-4) -> Column:
    p = clip(x, eps, 1 - eps)
    return F.log(p / (1 - p))


def sigmoid(x: Column, bound: float = 50.0) -> Column:
    return 1 / (1 + F.exp(-clip(x, -bound, bound)))


def horner(x: Column, coefficients: Sequence[float]) -> Column:
    """A polynomial, highest power first."""
    out = F.lit(0.0)
    for c in coefficients:
        out = out * x + F.lit(float(c))
    return out


def even_bands(n: int, k: int) -> list[int]:
    """``k`` of ``n`` band indices, evenly spaced with half-to-even rounding; raises if n < k."""
    if n < k:
        raise ValueError(f"{k} bands asked of {n}")
    return sorted({round(i * (n - 1) / (k - 1)) for i in range(k)}) if k > 1 else [0]


def href_suffix(url: Column) -> Column:
    """Lower-case extension of a URL's path without the query; ``.tif`` if there is none."""
    name = F.element_at(F.split(F.element_at(F.split(url, r"\?"), 1), "/"), -1)
    found = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return F.when(found == "", F.lit(".tif")).otherwise(found)


def envi_header(path: Column, existing: Column | None = None) -> Column:
    """The header beside an ENVI image.

    ``x.img``, ``x.dat`` and ``x.raw`` have ``x.hdr``, or ``x.img.hdr`` if of the
    two only that is among the ``existing`` paths (an array); any other ``x`` has
    ``x.hdr`` behind its whole name; a header is its own.
    """
    beside, behind = F.regexp_replace(path, r"\.(img|dat|raw)$", ".hdr"), F.concat(path, F.lit(".hdr"))
    only_behind = F.lit(False) if existing is None else F.array_contains(existing, behind) & ~F.array_contains(existing, beside)
    image = F.rlike(path, F.lit(r"\.(img|dat|raw)$"))
    return F.when(F.endswith(path, F.lit(".hdr")), path).when(image & ~only_behind, beside).otherwise(behind)


def envi_list(text: Column) -> Column:
    """``{a, b, ...}`` as an array of doubles."""
    return F.from_json(F.translate(text, "{}", "[]"), "array<double>")
