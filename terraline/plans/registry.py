"""Every registered query of the library and its ANSI-SQL oracle."""

from __future__ import annotations

from terraline.plans import analytics, motion, reports, streams, telemetry  # noqa: F401  (the others add to telemetry's tables)


def queries() -> dict:
    return dict(telemetry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(telemetry.ORACLES)
