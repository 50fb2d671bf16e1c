"""The iterations of a fit, held by the driver or appended to a folder from which it resumes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession

from spheremeans.config import new_path

HISTORY_SCHEMA = (
    "iteration int, cluster_id int, latitude double, longitude double, "
    "n_points bigint, displacement_km double, seconds double"
)
_STORED_SCHEMA = HISTORY_SCHEMA + ", n_unlocated bigint"
_ARROW = pa.schema(
    [("iteration", pa.int32()), ("cluster_id", pa.int32()), ("latitude", pa.float64()), ("longitude", pa.float64()),
     ("n_points", pa.int64()), ("displacement_km", pa.float64()), ("seconds", pa.float64()), ("n_unlocated", pa.int64())]
)
_SETTINGS_SCHEMA = "k int, metric string, float32_centroids boolean, exact boolean"

# Rows the driver holds before a history without a folder gets one.
MOST_HELD = 200_000


class History:
    """One row for each iteration and cluster, iteration 0 being the seeds.

    In a folder each iteration is a table of its own, which counts once Spark has marked it
    as complete, so a run that is lost while it writes leaves the iterations before whole.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path
        self._held: list[tuple] = []
        self._stored: list[str] = []

    @classmethod
    def create(cls, spark: SparkSession, path: str, *settings: object) -> History:
        """``settings`` are k, metric, float32_centroids and exact, which a resumed fit takes over."""
        history = cls(spark, path)
        if history._names():
            raise ValueError(f"{path} already holds a history; resume from it or name another folder")
        history._write([settings], _SETTINGS_SCHEMA, "settings")
        return history

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> tuple[History, Row]:
        """The history in a folder and the settings of its fit."""
        history = cls(spark, path)
        names = history._names()
        history._stored = sorted(n for n in names if n.startswith("iteration-"))
        if "settings" not in names or not history._stored:
            raise ValueError(f"{path} holds no history to resume from")
        return history, spark.read.schema(_SETTINGS_SCHEMA).parquet(f"{path}/settings").first()

    def append(self, iteration: int, rows: list[tuple], n_unlocated: int = 0) -> None:
        rows = [(iteration, *r, n_unlocated) for r in rows]
        if self.path is None and len(self._held) + len(rows) <= MOST_HELD:
            self._held += rows
            return
        if self.path is None:
            self.path = new_path(self.spark, "history")
            self._store("held", self._held)
            self._held = []
        self._store(f"iteration-{iteration:08d}", rows)

    def last(self) -> tuple[list[Row], list[Row]]:
        """Rows of the last iteration and of the one before, if any, by cluster."""
        tables = [self._read([name]).orderBy("cluster_id").collect() for name in self._stored[-2:]]
        return tables[-1], tables[0] if len(tables) > 1 else []

    def rows(self) -> list[tuple]:
        if self.path is None:
            return [r[:-1] for r in self._held]
        return [tuple(r) for r in self.frame().orderBy("iteration", "cluster_id").collect()]

    def frame(self) -> DataFrame:
        if self.path is None:
            return self.spark.createDataFrame(self.rows(), HISTORY_SCHEMA)
        return self._read(self._stored).drop("n_unlocated")

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(_STORED_SCHEMA).parquet(*(f"{self.path}/{n}" for n in names))

    def _store(self, name: str, rows: list[tuple]) -> None:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
        self._write(pa.Table.from_arrays(columns, schema=_ARROW), None, name)
        self._stored.append(name)

    def _write(self, rows, schema: str | None, name: str) -> None:
        made = self.spark.createDataFrame(rows, schema) if schema else self.spark.createDataFrame(rows)
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def _names(self) -> set[str]:
        """Complete tables in the folder."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return set()
        found = [s.getPath() for s in files.listStatus(folder)]
        return {p.getName() for p in found if files.exists(hadoop.Path(p, "_SUCCESS"))}
