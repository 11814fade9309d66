"""Stability-index physics as Column expressions. Three conventions exist and never mix: theory and roll-based indexes are 1 when
stable, the risk index is 0 when upright and 1 at tipping."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the roll-based index.
PHI_C_DEG, H_CG_M, TRACK_M, G = 33.79, 1.85, 2.48, 9.81


def si_theory(ax: Column, az: Column, gy_mean: Column, k1: Column, k2: Column, d1_m: Column, s_mm: Column, coeff: Column, alphav: Column) -> Column:
    """1 - k1 |atan(ax/az)| / phi_c - k2 (gy/wc)^2; a zero az counts as 1e-9. 6.28 stands for the full circle, as in the logger."""
    half = s_mm / 2
    h = F.sqrt(F.pow(1000 * d1_m, 2) - F.pow(half, 2))
    phi_c = F.atan(half / h)
    wc = F.sqrt(coeff * s_mm / 1000 * alphav / 4) * (360 / 6.28) * 1000
    return 1 - k1 * F.abs(F.atan(ax / F.when(az == 0, F.lit(1e-9)).otherwise(az))) / phi_c - k2 * F.pow(gy_mean / wc, 2)


def si_static_roll(roll_deg: Column) -> Column:
    pc = math.radians(PHI_C_DEG)
    return F.greatest(F.lit(0.1), F.least(F.lit(1.5), F.sin(F.lit(pc) - F.radians(roll_deg)) / math.sin(pc)))


def si_dynamic(ay: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ay / 100 * H_CG_M) / (G * TRACK_M / 2)))


def si_total(roll_deg: Column, ay: Column) -> Column:
    return F.greatest(F.lit(0.1), F.least(F.lit(1.5), si_static_roll(roll_deg) + si_dynamic(ay)))


def risk_class(si: Column) -> Column:
    return F.when(si < 0.7, "CRITICAL").when(si < 0.9, "HIGH").when(si < 1.0, "MEDIUM").otherwise("LOW")


def quality_class(mae: Column, corr: Column) -> Column:
    """How well two series agree."""
    # The classes' names, largest mae and least correlation.
    classes = [("COINCIDEN BIEN", 0.05, 0.9), ("COINCIDENCIA ACEPTABLE", 0.1, 0.85), ("COINCIDENCIA MODERADA", 0.2, 0.7)]
    out = F.lit("NO COINCIDEN BIEN")
    for name, most, least in reversed(classes):
        out = F.when((mae <= most) & (corr >= least), name).otherwise(out)
    return out


def match_state(measured: Column, theory: Column, tolerance: float = 0.02) -> Column:
    return F.when(measured.isNull() | theory.isNull(), "missing").when(F.abs(measured - theory) <= tolerance, "match").otherwise("mismatch")


def si_color(si: Column) -> Column:
    """#RRGGBB between red (0) and green (1), clamped, truncated to integers."""
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), si))
    low = F.format_string("#%02X%02X%02X", F.lit(255), F.floor(s * 2 * 255).cast("int"), F.lit(0))
    high = F.format_string("#%02X%02X%02X", F.floor((1 - s) * 2 * 255).cast("int"), (255 - F.floor((s - 0.5) * 2 * 85)).cast("int"), F.lit(0))
    return F.when(s < 0.5, low).otherwise(high)


def acceleration(ax: Column, ay: Column, az: Column) -> Column:
    return F.sqrt(ax * ax + ay * ay + az * az)


def critical_angle_deg(track_m: Column, h_cg_m: Column) -> Column:
    """Inferred: atan(track / (2 h))."""
    return F.degrees(F.atan(track_m / (2 * h_cg_m)))


def si_static_risk(roll_deg: Column, critical_deg: Column) -> Column:
    """Inferred: 0 upright, 1 at the critical angle, more beyond."""
    return F.abs(F.tan(F.radians(roll_deg))) / F.tan(F.radians(critical_deg))
