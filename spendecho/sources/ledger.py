"""Answers of the enricher, a file per batch, written by the task that got them.

A batch is known by what is in it, so a task that runs again finds the answers of its
earlier attempt and sends only the other batches. What a stopped run has left is read
by the next one before anything is sent.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schemas import RAW_RECORD_SCHEMA
from . import files

ANSWER_SCHEMA = T.StructType([T.StructField("content_hash", T.StringType()), *RAW_RECORD_SCHEMA.fields])


def uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tasks open it without Spark."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def batch_key(rows: list[tuple[str, str]]) -> str:
    """Of (feedback_id, content_hash) in the order of the batch."""
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()


@dataclass(frozen=True)
class Ledger:
    """The folder is made when the first answers are written. It has to be one that all
    executors share and that pyarrow can open (local or mounted folders, HDFS, S3, GCS)."""

    folder: str

    def _at(self, key: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(f"{self.folder}/{key[:2]}/{key}.json")

    def get(self, key: str) -> list[dict] | None:
        """The answers of a batch, None if it has not been sent."""
        from pyarrow import fs

        store, path = self._at(key)
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path) as f:
            return [json.loads(line) for line in f.read().decode().splitlines()]

    def put(self, key: str, answers: list[dict]) -> None:
        """Put down a batch at once: a file beside it, renamed. A second attempt that got
        answers meanwhile replaces the first one's."""
        import uuid

        store, path = self._at(key)
        folder, name = path.rsplit("/", 1)
        store.create_dir(folder, recursive=True)
        draft = f"{folder}/_{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as f:
            f.write("".join(json.dumps(a) + "\n" for a in answers).encode())
        store.move(draft, path)


def usable(ledger: Ledger) -> bool:
    """Whether tasks can open the folder's file system by themselves."""
    try:
        ledger.get("0" * 64)
    except (OSError, ValueError, ImportError):
        return False
    return True


def left_over(spark: SparkSession, folder: str) -> DataFrame | None:
    """All answers in a ledger's folder; None if there are none."""
    if not any(files.names(spark, f"{folder}/{part}") for part in files.names(spark, folder)):
        return None
    return spark.read.schema(ANSWER_SCHEMA).option("recursiveFileLookup", True).json(folder)
