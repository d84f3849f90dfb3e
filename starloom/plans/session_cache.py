"""The kept steps of a session under a manifest that is published whole: what is not in it does not exist.

Every step's table goes to a folder of its own; then a manifest that names it takes the place of the old one by a rename.
A run that breaks off between the two leaves the old manifest, which names the old tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

#: What each step is made from; scores depend on the frames alone.
STEPS = ("scores", "transforms", "aligned", "stack", "channels", "calibration")


class SessionCache:
    """Steps of one session below root, valid for its frames and settings."""

    def __init__(self, spark: SparkSession, root: str, keep: tuple[str, ...] = ("scores",)):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.state = self._read()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _read(self) -> dict:
        """The manifest; an empty one where there is none, or none that can be read."""
        empty = {"frames_hash": None, "config_hash": None, "steps": {}}
        if not self.files.exists(self._path("manifest.json")):
            return empty
        try:
            text = self.spark.read.text(f"{self.root}/manifest.json", wholetext=True).first()
            got = json.loads(text[0]) if text else {}
        except (ValueError, PySparkException, Py4JJavaError):  # damaged: its tables stay until they are swept
            return empty
        return got if empty.keys() <= got.keys() and isinstance(got["steps"], dict) else empty

    def _publish(self, state: dict) -> None:
        """Put the manifest in place whole, then remove the tables that it no longer names."""
        state = state | {"updated": datetime.now(UTC).isoformat(timespec="seconds")}
        name = f"._manifest-{uuid.uuid4().hex}"
        out = self.files.create(self._path(name), True)
        out.write(bytearray(json.dumps(state, indent=1).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(self._path(name), self._path("manifest.json"), options)
        old, self.state = self.state, state
        for step, entry in old["steps"].items():
            if state["steps"].get(step, {}).get("table") != entry["table"]:
                self.files.delete(self._path(entry["table"]), True)

    def open(self, frames_hash: str, config_hash: str) -> dict:
        """The manifest for these frames and settings: other frames drop all steps, other settings all but those kept."""
        known = self.state
        if (known["frames_hash"], known["config_hash"]) != (frames_hash, config_hash):
            kept = {s: e for s, e in known["steps"].items() if s in self.keep} if known["frames_hash"] == frames_hash else {}
            self._publish({"frames_hash": frames_hash, "config_hash": config_hash, "steps": kept})
        return self.state

    def has(self, step: str) -> bool:
        return step in self.state["steps"]

    def load(self, step: str) -> DataFrame | None:
        """The step's table, None where the manifest names none."""
        return self.spark.read.parquet(f"{self.root}/{self.state['steps'][step]['table']}") if self.has(step) else None

    def save(self, step: str, table: DataFrame) -> DataFrame:
        """Write the table, then publish it under the step, in place of an earlier one."""
        if step not in STEPS:
            raise ValueError(f"unknown step {step}")
        name = f"{step}-{uuid.uuid4().hex}"
        table.write.parquet(f"{self.root}/{name}")
        self._publish(self.state | {"steps": self.state["steps"] | {step: {"table": name}}})
        return self.load(step)

    def fetch(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.load(step) if self.has(step) else self.save(step, build())

    def clear(self, keep: tuple[str, ...] = ()) -> None:
        """Forget all steps but those named."""
        self._publish(self.state | {"steps": {s: e for s, e in self.state["steps"].items() if s in keep}})

    def status(self) -> dict:
        """Which steps are there, and for what."""
        return {s: self.has(s) for s in STEPS} | {k: self.state[k] for k in ("frames_hash", "config_hash")}

    def sweep(self) -> list[str]:
        """Remove what broken-off runs left: tables and manifests that the manifest does not name."""
        named = {e["table"] for e in self.state["steps"].values()} | {"manifest.json"}
        gone = [f.getPath().getName() for f in self.files.listStatus(self._path(""))] if self.files.exists(self._path("")) else []
        gone = [n for n in gone if n not in named and not n.endswith(".crc")]
        for n in gone:
            self.files.delete(self._path(n), True)
        return sorted(gone)
