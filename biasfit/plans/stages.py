"""Stages that outlive their driver: written tables published by a manifest.

A run has a root folder and a fingerprint of all that its tables depend on: the
input files (path, length, time), the package's source and the parameters.  A
stage is written to ``<root>/<name>-<fingerprint>`` and exists once its
manifest, a small file written in one step after the table, is there; it holds
what was observed while writing.  A new run with the same fingerprint reads
published stages and makes the missing ones; what a lost driver left half
written is overwritten.  :meth:`Stages.clean` removes what other fingerprints
left.  Files are reached through Hadoop's file systems, as Spark reaches them.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from biasfit.session import shuffles_removed

Write = Callable[..., DataFrame]
_MARK = "_published"


class Files:
    """The few file operations needed, on any store that Spark can read."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def state(self, path: str) -> list[tuple[str, int, int]]:
        """Path, length and time of every file below ``path``, in order."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        out, todo = [], [p]
        while todo:
            for s in fs.listStatus(todo.pop()):
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        return sorted(out)

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        with_ = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(with_, "UTF-8")
        finally:
            with_.close()

    def publish(self, path: str, text: str) -> None:
        """The file appears whole or not at all."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        _, tmp = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(tmp, True)
        stream.write(text.encode())
        stream.close()
        fs.delete(p, False)
        if not fs.rename(tmp, p):
            raise OSError(f"can't publish {path}")

    def children(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def code_version() -> str:
    """Hash of the package's own source (without the optional subpackage)."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for folder, dirs, names in sorted(os.walk(top)):
        dirs[:] = sorted(d for d in dirs if d not in ("llm", "__pycache__"))
        for n in sorted(names):
            if n.endswith(".py"):
                with open(os.path.join(folder, n), "rb") as f:
                    h.update(n.encode() + f.read())
    return h.hexdigest()


class Stages:
    def __init__(self, spark: SparkSession, root: str, inputs: Sequence[str], params: object):
        self.spark, self.root, self.inputs, self.params = spark, root.rstrip("/"), list(inputs), params
        self.files = Files(spark)
        self.made: list[str] = []       # stages written by this run, not read

    @cached_property
    def fingerprint(self) -> str:
        state = {p: self.files.state(p) for p in self.inputs}
        text = json.dumps([state, code_version(), repr(self.params)], sort_keys=True)
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{self.fingerprint}"

    def run(self, name: str, make: Callable[[Write], dict]) -> tuple[DataFrame, dict]:
        """The stage's table and what was observed of it.

        ``make(write)`` calls ``write(df, partition_by=...)`` once and returns
        what is to be remembered (JSON)."""
        path = self.path(name)
        found = self.files.read(f"{path}/{_MARK}")
        if found is None:
            def write(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
                w = df.write.mode("overwrite").option("compression", "zstd")
                with shuffles_removed(self.spark):
                    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
                return self.spark.read.parquet(path)

            info = make(write)
            self.files.publish(f"{path}/{_MARK}", json.dumps(info))
            self.made.append(name)
            # what a resumed run would see
            found = json.dumps(info)
        return self.spark.read.parquet(path), json.loads(found)

    def clean(self) -> list[str]:
        """Delete what other fingerprints, or stopped runs of them, left below the root."""
        gone = [n for n in self.files.children(self.root) if not n.endswith(f"-{self.fingerprint}")]
        for n in gone:
            self.files.delete(f"{self.root}/{n}")
        return gone
