"""URL filters by a sorted digest array.

Rules "host/path" are hashed with 64-bit xxhash; the sorted keys lie in a file that each worker memory-maps. A url
probes every suffix of its host with every rule-path length, all at once by vectorised binary search, and a hit
counts only if the stored string equals the probed one.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Verdict and rule.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
MAX_RULE_BYTES = 64_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without '://'."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host_end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    path_end = min((i for c in "?#" if (i := rest.find(c, host_end)) >= 0), default=len(rest))
    return rest[:host_end].translate(UPPER), rest[host_end:path_end]


class Digests:
    """Sorted 64-bit keys, memory-mapped, with the rule behind each key."""

    def __init__(self, rules, digest=lambda b: xxhash.xxh64_intdigest(b)):
        self.digest = digest
        self.rules = sorted(((digest(r.encode()), r, v) for v, r in rules), key=lambda x: x[:2])
        self.lengths = sorted({len(r) - r.index("/") for _, r, _ in self.rules})
        fd, path = tempfile.mkstemp(suffix=".digests")
        with os.fdopen(fd, "wb") as f:
            f.write(np.array([k for k, *_ in self.rules] or [0], dtype="<u8").tobytes())
        self.keys = np.memmap(path, dtype="<u8", mode="r")
        os.unlink(path)  # the map stays until the worker ends
        self.n = len(self.rules)

    def best(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """The longest fitting rule of each url with its verdict, or None."""
        owner, probe = [], []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            if not h:
                continue
            at = -1
            while True:
                tail = h[at + 1 :]
                for n in self.lengths:
                    if n <= len(p):
                        owner.append(i)
                        probe.append(tail + p[:n])
                at = h.find(".", at + 1)
                if at < 0:
                    break
        out: list[tuple[str, str] | None] = [None] * len(hosts)
        if not probe or not self.n:
            return out
        keys = np.fromiter((self.digest(s.encode()) for s in probe), dtype="<u8", count=len(probe))
        found = np.searchsorted(self.keys[: self.n], keys)
        for j in np.flatnonzero(self.keys[np.minimum(found, self.n - 1)] == keys):
            at = int(found[j])
            while at < self.n and self.rules[at][0] == keys[j]:  # several strings may share a key
                _, rule, verdict = self.rules[at]
                if rule == probe[j] and ((old := out[owner[j]]) is None or len(rule) > len(old[0])):
                    out[owner[j]] = rule, verdict
                at += 1
        return out


def url_filter(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow", no_host: str = "block") -> DataFrame:
    """One row per row of pages: page_id, host, path, rule (null if none fits), verdict.

    A null url, or one without '://', has empty host and path and the verdict no_host; a url that no rule fits has
    the verdict default. Repeated rows are judged each. rules must stay under MAX_RULE_BYTES, for every worker
    holds them; other columns of pages are not read.
    """
    if sum(len(r) for _, r in rules) > MAX_RULE_BYTES:
        raise ValueError("too many rules to hold in each worker; filter with several rule sets")
    rules = tuple(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests(rules)
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            hosts, paths = [h for h, _ in split], [p for _, p in split]
            best = digests.best(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                    pa.array([b and b[0] for b in best], pa.string()),
                    pa.array([b[1] if b else default if h else no_host for b, h in zip(best, hosts, strict=True)], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).mapInArrow(
        judge, "page_id long, host string, path string, rule string, verdict string"
    )
