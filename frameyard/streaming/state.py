"""What a run carries over to the next one: decided rows, accepted images with their embeddings, and quota counts.

All of it is committed together, batch by batch. A batch writes its tables into folders of its own attempt and then a
small manifest that names all folders that hold the state; the manifest is renamed into place last. Readers open only
folders that the newest manifest before their batch names, so an attempt that was lost leaves nothing that anyone reads, and
a batch that is run again after its commit does nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.functions.durable import _fs_path

#: Folders of accepted rows from which on a commit writes them as one.
COMPACT = 8
EMPTY = {"batch": -1, "rows": [], "accepted": [], "schema": None, "quota": {}, "last_rank": 0}


class RunState:
    """State under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, compact: int = COMPACT):
        self.spark, self.root, self.compact = spark, root.rstrip("/"), compact

    def _read(self, path) -> dict:
        fs, p = _fs_path(self.spark, str(path))
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commits(self) -> list[int]:
        fs, p = _fs_path(self.spark, f"{self.root}/commits")
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def latest(self, before: int | None = None) -> dict:
        """The newest manifest, of batches below `before` if given."""
        known = [n for n in self.commits() if before is None or n < before]
        return self._read(f"{self.root}/commits/{known[-1]:012d}.json") if known else dict(EMPTY)

    def rows(self, manifest: dict | None = None) -> DataFrame | None:
        """All decided rows with outcome; None before the first commit."""
        paths = (manifest or self.latest())["rows"]
        return self.spark.read.parquet(*paths) if paths else None

    def accepted(self, manifest: dict | None = None, views: list[str] | None = None) -> DataFrame | None:
        """The index: accepted rows; with views, only the folders of those views are read."""
        manifest = manifest or self.latest()
        if not manifest["accepted"]:
            return None
        frames = [self.spark.read.schema(manifest["schema"]).parquet(p) for p in manifest["accepted"]]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out if views is None else out.where(F.col("view").isin(views))

    def quota(self, targets: dict[str, int], manifest: dict | None = None) -> dict[str, int]:
        """What each view still takes: configured targets less the stored counts."""
        counts = (manifest or self.latest())["quota"]
        return {v: max(0, n - counts.get(v, 0)) for v, n in targets.items()}

    def commit(self, number: int, decided: DataFrame, index: list[str]) -> None:
        """Store a batch's decided rows (rank, view, outcome, ...) and its accepted rows' index columns (view among
        them). decided must be durable, for it is read several times."""
        before = self.latest(number)
        attempt = uuid.uuid4().hex
        rows, new = f"{self.root}/rows/{attempt}", f"{self.root}/accepted/{attempt}"
        decided.write.parquet(rows)
        taken = decided.where("outcome = 'accepted'").select(*index)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in taken.schema)
        accepted = [*before["accepted"], new]
        if len(accepted) > self.compact:
            taken, accepted = self.accepted(before).unionByName(taken), [new]
        taken.write.partitionBy("view").parquet(new)
        counts = dict(before["quota"])
        for r in decided.where("outcome = 'accepted'").groupBy("view").count().collect():  # a row a view
            counts[r["view"]] = counts.get(r["view"], 0) + r["count"]
        last = decided.agg(F.max("rank")).collect()[0][0]
        self._publish(number, {"batch": number, "rows": [*before["rows"], rows], "accepted": accepted, "schema": schema, "quota": counts, "last_rank": max(before["last_rank"], last or 0)})

    def _publish(self, number: int, manifest: dict) -> None:
        fs, draft = _fs_path(self.spark, f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        _, final = _fs_path(self.spark, f"{self.root}/commits/{number:012d}.json")
        fs.mkdirs(final.getParent())
        if not fs.rename(draft, final):
            fs.delete(draft, False)
            if number not in self.commits():
                raise OSError(f"could not commit batch {number} under {self.root}")

    def vacuum(self) -> int:
        """Delete folders that the newest manifest does not name, of lost attempts and before compaction; returns how
        many. Not while a batch is being written."""
        manifest, gone = self.latest(), 0
        named = {p.rsplit("/", 1)[1] for kind in ("rows", "accepted") for p in manifest[kind]}
        for kind in ("rows", "accepted"):
            fs, p = _fs_path(self.spark, f"{self.root}/{kind}")
            for s in fs.listStatus(p) if fs.exists(p) else []:
                if s.getPath().getName() not in named:
                    gone += fs.delete(s.getPath(), True)
        return gone
