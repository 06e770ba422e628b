"""Artefact store of a study (S10): preparations, fitted models, predictions.

A store is a folder that driver and executors share. Every artefact has a
fingerprint of all that it depends on - the training rows, the features, the
preparation, the family with its version, its parameters and its seed - and
is found by it, so a changed input is fitted anew and an unchanged one is
opened. The index (Parquet, one row per artefact) gets its row only after the
artefact has been written in full, under a path of its own: what a stopped
run left half-written is never opened, and a run that is started again fits
just what is missing.

Artefacts are chosen by fields of the index (study, fold, family), not by
parts of file names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INDEX = "kind string, fingerprint string, study string, fold string, family string, params string, path string"


def fingerprint(*parts) -> str:
    """Digest of JSON values."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


def rows_fingerprint(df: DataFrame, columns: Sequence[str]) -> str:
    """Digest of a table's rows, whatever their order: one aggregate of row hashes.

    Copies count (sum and number of rows); nulls differ from every value by their place among the non-nulls.
    """
    cells = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    h = df.select(F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(1), *cells).alias("g"))
    # sums of 64-bit hashes as decimals: no overflow below 1e18 rows
    r = h.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("a"),
              F.sum(F.col("g").cast("decimal(20,0)")).alias("b")).first()
    kinds = [[c, df.schema[c].dataType.simpleString()] for c in columns]
    return fingerprint(kinds, r["n"], str(r["a"]), str(r["b"]))


class ArtifactStore:
    """Artefacts below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._known: dict[tuple[str, str], str] | None = None

    def index(self) -> DataFrame:
        """One row per stored artefact."""
        try:
            return self.spark.read.schema(_INDEX).parquet(f"{self.root}/index")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _INDEX)

    def find(self, kind: str, print_: str) -> str | None:
        """Path of a stored artefact."""
        if self._known is None:                           # one row per artefact of all studies in this folder
            self._known = {(r["kind"], r["fingerprint"]): r["path"] for r in self.index().collect()}
        return self._known.get((kind, print_))

    def new_path(self, kind: str, print_: str) -> str:
        return f"{self.root}/{kind}/{print_[:16]}-{uuid.uuid4().hex}"

    def commit(self, kind: str, print_: str, path: str, *, study: str = "", fold: str = "", family: str = "",
               params: str = "") -> None:
        """Make a written artefact findable."""
        row = [(kind, print_, study, fold, family, params, path)]
        self.spark.createDataFrame(row, _INDEX).coalesce(1).write.mode("append").parquet(f"{self.root}/index")
        if self._known is not None:
            self._known[kind, print_] = path

    def get(self, kind: str, print_: str, *, make, save, load, **fields):
        """(artefact, whether it was stored before): opened if its fingerprint is known, else made and stored."""
        path = self.find(kind, print_)
        if path is not None:
            return load(path), True
        made = make()
        path = self.new_path(kind, print_)
        save(made, path)
        self.commit(kind, print_, path, **fields)
        return made, False

    def entries(self, kind: str, study: str, fold: str | None = None) -> list:
        """Index rows of a study, in a fixed order."""
        found = self.index().where((F.col("kind") == kind) & (F.col("study") == study))
        if fold is not None:
            found = found.where(F.col("fold") == fold)
        return found.dropDuplicates(["kind", "fingerprint"]).orderBy("fold", "family", "params").collect()
