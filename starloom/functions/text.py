"""String scalars: safe file names, durations, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitised(name: Column) -> Column:
    """Characters that file systems refuse become underscores."""
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def duration(seconds: Column, with_seconds: bool = True) -> Column:
    """45.2s, 2m 5s, 2h 15m 30s (or 2h 15m)."""
    s = seconds.cast("double")
    hours, minutes = F.floor(s / 3600), F.floor((s - F.floor(s / 3600) * 3600) / 60)
    rest = F.format_string("%.0f", F.bround(s - F.floor(s / 60) * 60, 0))
    long = F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m"))
    if with_seconds:
        long = F.concat(long, F.lit(" "), rest, F.lit("s"))
    return (
        F.when(s < 60, F.format_string("%.1fs", s))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit("m "), rest, F.lit("s")))
        .otherwise(long)
    )


def byte_size(n: Column) -> Column:
    """1.5 KB and the like, up to PB."""
    v = n.cast("double")
    out = None
    for i, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        text = F.format_string(f"%.1f {unit}", F.bround(v / 1024.0**i, 1))
        out = F.when(v < 1024.0 ** (i + 1), text) if out is None else out.when(v < 1024.0 ** (i + 1), text)
    return out.otherwise(F.format_string("%.1f PB", F.bround(v / 1024.0**5, 1)))
