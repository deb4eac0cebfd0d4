"""URL filters by a sorted digest array.

Rules ``(host, path, verdict)`` become one index file: their 64-bit xxhash keys in ascending order, the verdicts,
and the full strings behind offsets. Spark ships the file to every executor; workers memory-map it, probe all
candidate strings of a batch with one vectorised binary search and confirm each hit against the stored string, so a
key that two strings share never decides.

A rule fits its host and all subdomains when the path starts with the rule's path; the longest rule (host and path
together) wins, of equally long ones that with the longer host, and of equal strings the first given. A url without a rule gets ``default``: the array lists what is
known, and what it doesn't list is allowed unless the caller says otherwise.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and the default verdict.
Repeated rows are judged each by itself. Urls of any length are read whole. An empty table gives an empty result, no rules give the default everywhere.
Only the id and url columns are read, so other columns may have any names.
"""

from __future__ import annotations

import struct
import threading
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.batches import BATCH_ROWS, bounded, emit
from corpusloom.session import scratch_path, written

#: The index travels to each executor whole, so its size is checked; larger rule sets go by ``judge_urls_by_join``.
MAX_INDEX_BYTES = 1 << 30
_MAGIC = b"CLURL001"
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    if slash < 0:
        return rest[:end].translate(_LOWER), ""
    return rest[:slash].translate(_LOWER), rest[slash:end]


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The index file of the rules ``(host, path, verdict)``."""
    first: dict[str, str] = {}
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        if "/" in host or (path and not path.startswith("/")):
            raise ValueError(f"not a host and a path: {host!r}, {path!r}")
        first.setdefault(host.translate(_LOWER) + path, verdict)
    items = sorted((xxhash.xxh64_intdigest(k.encode()), k.encode(), v) for k, v in first.items())
    texts = [k for _, k, _ in items]
    offsets = np.concatenate([[0], np.cumsum([len(k) for k in texts], dtype=np.int64)]).astype("<i8")
    lengths = sorted({len(k) - k.find("/") if "/" in k else 0 for k in first})
    depth = max((k.partition("/")[0].count(".") + 1 for k in first), default=0)
    head = _MAGIC + struct.pack("<QII", len(items), depth, len(lengths)) + np.array(lengths, "<i8").tobytes()
    data = head + np.array([h for h, _, _ in items], "<u8").tobytes() + offsets.tobytes() + bytes(v == "block" for _, _, v in items) + b"".join(texts)
    if len(data) > MAX_INDEX_BYTES:
        raise ValueError(f"the index has {len(data)} bytes, over {MAX_INDEX_BYTES}; use judge_urls_by_join")
    return data


class DigestArray:
    """A memory-mapped index."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != _MAGIC:
            raise ValueError("not a url index")
        n, self.depth, kinds = struct.unpack("<QII", raw[8:24].tobytes())
        at = 24
        self.lengths = raw[at : at + 8 * kinds].view("<i8").tolist()[::-1]  # longest first
        at += 8 * kinds
        self.keys = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = raw[at : at + 8 * (n + 1)].view("<i8")
        at += 8 * (n + 1)
        self.block = raw[at : at + n]
        self.texts = raw[at + n :]

    def candidates(self, host: str, path: str) -> list[bytes]:
        """Every rule string that could fit: suffixes of the host at its dots, no deeper than any rule, each with the
        starts of the path that have the length of some rule's path; longest string first."""
        if not host:
            return []
        labels = host.split(".")
        found = {".".join(labels[-d:]) + path[:n] for d in range(1, min(len(labels), self.depth) + 1) for n in self.lengths if n <= len(path)}
        return sorted((s.encode() for s in found), key=lambda s: (-len(s), -len(s.partition(b"/")[0])))

    def lookup(self, probes: list[bytes]) -> np.ndarray:
        """The position of each probe, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return out
        wanted = np.fromiter((xxhash.xxh64_intdigest(p) for p in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, wanted, "left")
        hit = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted))
        for i in hit.tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == wanted[i]:  # strings that share a key lie side by side
                if self.texts[self.offsets[k] : self.offsets[k + 1]].tobytes() == probes[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str | None, str | None]]:
        """Rule and verdict of each host and path."""
        each = [self.candidates(*u) for u in urls]
        order = {p: i for i, p in enumerate(dict.fromkeys(p for c in each for p in c))}
        at = self.lookup(list(order))
        out = []
        for c in each:
            p = next((p for p in c if at[order[p]] >= 0), None)
            out.append((None, None) if p is None else (p.decode(), "block" if self.block[at[order[p]]] else "allow"))
        return out


_open: dict[str, DigestArray] = {}
_lock = threading.Lock()


def _opened(path: str) -> DigestArray:
    with _lock:
        if path not in _open:
            _open[path] = DigestArray(path)
        return _open[path]


def ship(spark: SparkSession, index: bytes) -> str:
    """Put the index into the shared folder, have Spark copy it to every executor, and give its name there."""
    target = scratch_path(spark, "urls") + ".idx"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(conf).create(path)
    try:
        for i in range(0, len(index), 1 << 24):
            out.write(bytearray(index[i : i + (1 << 24)]))
    finally:
        out.close()
    spark.sparkContext.addFile(target)
    return target.rpartition("/")[2]


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of every row."""
    spark = pages.sparkSession
    bounded(spark)
    name = ship(spark, build_index(rules))
    plain = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    kind = plain.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _opened(SparkFiles.get(name))

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    urls = [split_url(u) for u in part.column(1).to_pylist()]
                    for key, (host, path), (rule, verdict) in zip(part.column(0).to_pylist(), urls, index.judge(urls), strict=True):
                        yield key, host, path, rule, verdict or default

        yield from emit(rows(), schema, lambda r: len(r[1]) + len(r[2]))

    return plain.mapInArrow(judge, f"id {kind.simpleString()}, host string, path string, rule string, verdict string")


def judge_urls_by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same for rule tables of any size (``host``, ``path``, ``verdict``, one row for each host and path).

    The longest fitting rule is found by joins on the host's suffixes and filtering by path; rows are told apart by
    a number of their own, so repeated rows stay apart.
    """
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/]*", 0), upper, lower)
    base = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), host.alias("host"), F.regexp_extract(rest, r"(?s)/.*$", 0).alias("path"))
    base = written(base, "url-rows")  # both sides of the last join must see the same numbers
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = base.where("host <> ''").select("row", "path", F.explode(suffixes).alias("suffix"))
    known = rules.select(F.translate("host", upper, lower).alias("suffix"), F.col("path").alias("start"), "verdict")
    best = (
        probes.join(known, "suffix")
        .where(F.expr("startswith(path, start)"))
        .groupBy("row")
        .agg(F.max(F.struct((F.octet_length("suffix") + F.octet_length("start")).alias("size"), F.octet_length("suffix").alias("host_size"), F.concat("suffix", "start").alias("rule"), "verdict")).alias("best"))
    )
    return base.join(best, "row", "left").select("id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
