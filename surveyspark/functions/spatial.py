"""Spatial column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_bin_text(x: Column, size: float) -> Column:
    """Text of ``(x // size) * size`` rounded to 2 decimals, as Python floats print it.

    Floor division is done the way CPython/numpy do it for floats: take the
    C ``fmod`` remainder, step down when it is negative, then round the
    quotient to the nearest integer instead of truncating it, because
    ``(x - r) / s`` can land a hair below an integer. A plain ``floor(x / s)``
    puts values that sit on a cell edge into the wrong cell.
    """
    s = F.lit(float(size))
    r = x % s
    q = (x - r) / s - F.when(r < 0, F.lit(1.0)).otherwise(F.lit(0.0))
    fq = F.floor(q).cast("double")
    k = fq + F.when(q - fq > 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.bround(k * s, 2).cast("string")


def present(x: Column) -> Column:
    """The coordinate, or null where it is null or NaN."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def grid_cell(lat: Column, lon: Column, size: float = 0.2) -> Column:
    """Grid-cell id ``grid_<lat>_<lon>``; null when either coordinate is null or NaN."""
    lat, lon = present(lat), present(lon)
    return F.concat(F.lit("grid_"), floor_bin_text(lat, size), F.lit("_"), floor_bin_text(lon, size))


def has_coords(lat: Column, lon: Column) -> Column:
    return present(lat).isNotNull() & present(lon).isNotNull()


def coarse_group(region: Column, lat: Column) -> Column:
    """``<region>_<int(lat)>`` with the latitude truncated toward zero."""
    return F.concat(F.coalesce(region, F.lit("unknown")), F.lit("_"),
                    F.coalesce(present(lat).cast("int"), F.lit(0)).cast("string"))


def duck_floor_bin_text(x: str, size: float = 0.2) -> str:
    """The same expression as DuckDB SQL text (used by the oracles)."""
    s = f"{float(size)!r}e0" if "e" not in repr(float(size)) else repr(float(size))
    r = f"({x} % {s})"
    q = f"(({x} - {r}) / {s} - case when {r} < 0 then 1e0 else 0e0 end)"
    k = f"(floor({q}) + case when {q} - floor({q}) > 0.5e0 then 1e0 else 0e0 end)"
    return f"cast(round_even({k} * {s}, 2) as varchar)"


def duck_grid_cell(lat: str, lon: str, size: float = 0.2) -> str:
    return f"('grid_' || {duck_floor_bin_text(lat, size)} || '_' || {duck_floor_bin_text(lon, size)})"
