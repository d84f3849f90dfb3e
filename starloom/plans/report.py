"""Run manifests and reports as rows of JSON or Markdown, one per session."""

from __future__ import annotations

import platform

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import __version__
from starloom.operators.quality import ends


def run_metadata() -> dict[str, Column]:
    """version, platform, timestamp (UTC, ISO; one for the whole query) as columns for a report's rows."""
    where = f"{platform.system()} {platform.release()} / Python {platform.python_version()} / Spark "
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return {"version": F.lit(__version__), "platform": F.concat(F.lit(where), F.split(F.version(), " ")[0]), "timestamp": now}


def manifests(scores: DataFrame, rejected: DataFrame, session: list[str], name: str, settings_hash: str) -> DataFrame:
    """session, manifest: JSON of inputs, kept and rejected frames with reasons, scores and the settings' hash."""
    kept = scores.groupBy(*session).agg(
        F.array_sort(F.collect_list(F.when(F.col("kept"), F.col(name)))).alias("kept"),
        F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col(name).alias("name"), F.round("composite_score", 6).alias("score")))).alias("scores"),
        F.count(F.lit(1)).alias("n_scored"),
    )
    lost = rejected.groupBy(*session).agg(F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), "reason"))).alias("rejected"))
    own = kept.join(lost, session, "full")
    body = F.struct(
        F.lit(settings_hash).alias("config_hash"),
        F.coalesce("n_scored", F.lit(0)).alias("n_scored"),
        F.size(F.coalesce("kept", F.array())).alias("n_kept"),
        F.size(F.coalesce("rejected", F.array())).alias("n_rejected"),
        "kept", "rejected", "scores",
    )
    return own.select(*session, F.to_json(body).alias("manifest"))


def manifest_frames(rows: DataFrame, session: list[str], kind: str = "bigint") -> DataFrame:
    """session, name, rank, score, kept, reason of every frame that the manifests (column manifest) name; kind is that of names.

    Scored frames have rank and score, rejected ones a reason; a text that is no manifest gives no rows.
    """
    body = f"kept array<{kind}>, rejected array<struct<name:{kind},reason:string>>, scores array<struct<rank:int,name:{kind},score:double>>"
    own = rows.select(*session, F.from_json("manifest", body).alias("m"))
    keys = [*session, "name"]
    scores = own.select(*session, F.explode("m.scores").alias("s")).select(*keys[:-1], "s.name", "s.rank", "s.score")
    kept = own.select(*session, F.explode("m.kept").alias("name"), F.lit(True).alias("kept"))
    lost = own.select(*session, F.explode("m.rejected").alias("s")).select(*keys[:-1], "s.name", "s.reason")
    got = scores.join(kept, keys, "left").join(lost, keys, "full")
    return got.select(*keys, "rank", "score", F.coalesce("kept", F.lit(False)).alias("kept"), "reason")


def markdown(scores: DataFrame, rejected: DataFrame, stats: DataFrame, session: list[str], name: str, n: int = 5) -> DataFrame:
    """session, report: summary, statistics, rejections by reason, the best and worst frames, as Markdown."""
    line = F.concat(F.lit("- "), F.col(name), F.lit(": "), F.format_string("%.4f", F.col("composite_score")))
    places = ends(scores, session, name, n).groupBy(*session).agg(
        *[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") == p, F.struct("rank", line.alias("t"))))), lambda s: s["t"]), "\n").alias(p) for p in ("top", "bottom")]
    )
    reasons = rejected.groupBy(*session, "reason").agg(F.count(F.lit(1)).alias("n")).groupBy(*session).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), F.col("reason"), F.lit(": "), F.col("n").cast("string")))), "\n").alias("reasons")
    )
    own = stats.join(places, session, "left").join(reasons, session, "left")
    numbers = [F.format_string(f"- {c}: %.4f", F.col(c).cast("double")) for c in ("total_exposure_s", "mean_clipped_fraction", "snr_proxy")]
    text = F.concat_ws(
        "\n", F.lit("# Run report"), F.format_string("- frames: %d", F.col("n_frames").cast("long")), *numbers,
        F.lit("## Rejected"), F.coalesce("reasons", F.lit("none")), F.lit("## Best"), "top",
        F.when(F.col("bottom") != "", F.concat(F.lit("## Worst\n"), F.col("bottom"))),
    )
    return own.select(*session, text.alias("report"))


def write_all_reports(
    scores: DataFrame, rejected: DataFrame, stats: DataFrame, session: list[str], name: str, settings_hash: str, path: str
) -> dict[str, str]:
    """Manifests, statistics and Markdown reports of all sessions below path, a file per session; report -> folder."""
    tables = {
        "manifest": manifests(scores, rejected, session, name, settings_hash).withColumnRenamed("manifest", "value"),
        "json": stats.select(*session, F.to_json(F.struct(*[c for c in stats.columns if c not in session])).alias("value")),
        "markdown": markdown(scores, rejected, stats, session, name).withColumnRenamed("report", "value"),
    }
    for kind, rows in tables.items():
        rows.select(*session, "value").write.mode("overwrite").partitionBy(*session).text(f"{path}/{kind}")
    return {kind: f"{path}/{kind}" for kind in tables}
