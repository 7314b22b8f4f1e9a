"""Trained models as files in the shared folder, one per state of the data."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder
from .model import TrainedModel, names_of


def data_version(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of all files under a folder."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(folder, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:24]


class ModelStore:
    """Training is a step of its own: it writes the pipeline and its scores of the held-out rows, and whoever scores,
    measures or explains reads these.  A model counts as stored once its last part is written."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/models"

    def _path(self, kind: str, version: str) -> str:
        return f"{self.root}/{kind}-{version}"

    def __contains__(self, key: tuple[str, str]) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(*key)}/test/_SUCCESS")
        return done.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(done)

    def save(self, trained: TrainedModel, version: str) -> None:
        path = self._path(trained.kind, version)
        trained.model.write().overwrite().save(f"{path}/pipeline")
        rows = [(k, None if v is None else float(v)) for k, v in trained.metrics.items()]
        self.spark.createDataFrame(rows, "measure string, value double").write.mode("overwrite").parquet(f"{path}/metrics")
        trained.test.write.mode("overwrite").parquet(f"{path}/test")

    def load(self, kind: str, version: str) -> TrainedModel:
        path = self._path(kind, version)
        model = PipelineModel.load(f"{path}/pipeline")
        measured = {r["measure"]: r["value"] for r in self.spark.read.parquet(f"{path}/metrics").collect()}
        return TrainedModel(model, kind, names_of(model), self.held_out(kind, version), measured)

    def held_out(self, kind: str, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path(kind, version)}/test")

    def ensure(self, kind: str, version: str, train: Callable[[], TrainedModel]) -> None:
        """The training step, left out where this state of the data has been trained on."""
        if (kind, version) not in self:
            self.save(train(), version)
