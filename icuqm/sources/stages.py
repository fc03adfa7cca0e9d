"""Stages stored under a graph of fingerprints: what a stage depends on decides whether it is reused."""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from icuqm.session import cut_lineage

#: How plans store a stage: its name, how it is built, the stages and tables it reads, its settings.
Keep = Callable[..., DataFrame]


def cut(name: str, build: Callable[[], DataFrame], of: Sequence[str] = (), config: object = None) -> DataFrame:
    """The ``Keep`` of plans that run without stored stages: build and cut the lineage."""
    return cut_lineage(build())


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()[:32]


@functools.cache
def code_version() -> str:
    """Digest of the code that builds stages, so that stages of older code are not reused."""

    def files(folder, prefix: str):
        for entry in sorted(folder.iterdir(), key=lambda e: e.name):
            if entry.is_dir():
                yield from files(entry, f"{prefix}{entry.name}/")
            elif entry.name.endswith(".py"):
                yield prefix + entry.name, entry.read_text(encoding="utf-8")

    package = resources.files("icuqm")
    parts = [package / "config.py", package / "catalog" / "roles.py", *(package / p for p in ("functions", "operators", "plans", "sources"))]
    text = [(p.name, p.read_text(encoding="utf-8")) for p in parts if p.is_file()]
    return digest(text + [f for p in parts if p.is_dir() for f in files(p, f"{p.name}/")])


class StageGraph:
    """Stages of one site on shared storage.

    A node's key covers its name, the code, its settings and the keys of all it reads, down
    to size and time of every input file. A stage is reused when its manifest lies under
    its key; so a changed file, setting or code gives new keys to exactly what depends on
    it. A stage is published by its manifest, renamed into place after the data are
    complete: readers see a whole stage or none, whoever else builds it. ``refresh`` names
    nodes to build again; all that reads them is built again, too.
    """

    def __init__(self, spark: SparkSession, root: str, refresh: Iterable[str] = ()):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys: dict[str, str] = {}
        self.edges: dict[str, tuple[str, ...]] = {}
        self.stale, self.built = set(refresh), []
        self._jvm = spark.sparkContext._jvm

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _files(self, path: str) -> list[tuple[str, int, int]]:
        found, out = self._fs(path).listFiles(self._path(path), True), []
        while found.hasNext():
            entry = found.next()
            out.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
        return sorted(out)

    def _add(self, name: str, key: str, of: Sequence[str]) -> str:
        if self.keys.setdefault(name, key) != key:
            raise ValueError(f"two different stages are called {name!r}")
        self.edges[name] = tuple(of)
        if self.stale.intersection(of):
            self.stale.add(name)
        return key

    def source(self, name: str, *paths: str) -> str:
        """An input: its key changes with the files under its paths."""
        return self._add(name, digest("source", name, [self._files(p) for p in paths]), ())

    def derived(self, name: str, of: Sequence[str], config: object = None) -> str:
        """A node that is not stored: its key follows what it reads."""
        return self._add(name, digest("derived", name, code_version(), config, [self.keys[n] for n in of]), of)

    def _manifest(self, folder: str) -> dict | None:
        hits = self._fs(folder).globStatus(self._path(f"{folder}/manifest-*.json")) or []
        names = sorted(h.getPath().toString() for h in hits)
        return json.loads(self.spark.read.text(names[-1], wholetext=True).first()[0]) if names else None

    def _publish(self, folder: str, manifest: dict) -> None:
        fs = self._fs(folder)
        draft, place = self._path(f"{folder}/draft-{uuid.uuid4().hex}"), self._path(f"{folder}/manifest-{manifest['generation']:06d}.json")
        out = fs.create(draft, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        # where another run was first, its stage stands and the draft goes
        if fs.exists(place) or not fs.rename(draft, place):
            fs.delete(draft, False)

    def keep(self, name: str, build: Callable[[], DataFrame], of: Sequence[str] = (), config: object = None) -> DataFrame:
        """The stored stage, built and published first where no manifest lies under its key."""
        folder = f"{self.root}/{name}/{self.derived(name, of, config)}"
        manifest = self._manifest(folder)
        if manifest is None or name in self.stale and name not in self.built:
            data, generation = f"data-{uuid.uuid4().hex}", manifest["generation"] + 1 if manifest else 0
            df = build()
            df.write.parquet(f"{folder}/{data}")
            self.built.append(name)
            self._publish(folder, {"name": name, "generation": generation, "data": data, "schema": df.schema.jsonValue(), "of": {n: self.keys[n] for n in of}})
            manifest = self._manifest(folder)
            # Spark deletes shuffle files once the driver has collected the plan that wrote them
            del df
            gc.collect()
            self._jvm.System.gc()
        return self.spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(f"{folder}/{manifest['data']}")

    def depend_on(self, name: str) -> set[str]:
        """All nodes of this run that read ``name``, directly or not."""
        found = {name}
        for node, of in self.edges.items():
            if found.intersection(of):
                found.add(node)
        return found - {name}
