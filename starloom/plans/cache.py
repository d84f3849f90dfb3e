"""Results kept between runs, under a key of the settings and the frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class ResultCache:
    """Tables below root/<step>/<key>; a changed key misses, so stale results are never read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, step: str, key: str) -> str:
        return f"{self.root}/{step}/{key}"

    def load(self, step: str, key: str) -> DataFrame | None:
        """The table, or None if it is missing or was not finished."""
        try:
            return self.spark.read.parquet(self.path(step, key))
        except AnalysisException:
            return None

    def has(self, step: str, key: str) -> bool:
        return self.load(step, key) is not None

    def fetch(self, step: str, key: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
        """The kept table, or what build gives, written first."""
        got = None if refresh else self.load(step, key)
        if got is None:
            build().write.mode("overwrite").parquet(self.path(step, key))
            got = self.spark.read.parquet(self.path(step, key))
        return got

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def status(self) -> list[tuple[str, str]]:
        """(step, key) of what is kept."""
        fs, root = self._files()
        if not fs.exists(root):
            return []
        steps = [s.getPath() for s in fs.listStatus(root)]
        return sorted((s.getName(), k.getPath().getName()) for s in steps for k in fs.listStatus(s))

    def clear(self, step: str | None = None) -> None:
        fs, root = self._files()
        gone = root if step is None else self.spark._jvm.org.apache.hadoop.fs.Path(root, step)
        if fs.exists(gone):
            fs.delete(gone, True)


def session_key(frames: DataFrame, settings_hash: str, name: str = "name") -> str:
    """One key for all frames and the settings; the sum of name hashes does not depend on their order."""
    x = frames.agg(F.expr(f"bit_xor(xxhash64({name}))").alias("x"), F.count(F.lit(1)).alias("n")).first()
    return f"{settings_hash}-{x['n']}-{(x['x'] or 0) & 0xFFFFFFFFFFFFFFFF:016x}"
