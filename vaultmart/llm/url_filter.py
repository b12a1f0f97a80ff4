"""URL filters: rules found by their digests in a memory-mapped sorted array.

A rule is (host, path, action).  It fits a url whose host is the rule's or a subdomain of it and whose path
starts with the rule's; the longest rule that fits (characters of host and path) gives the verdict, and a url that no rule
fits is allowed.

* Spark sorts the rules' entries by the 64-bit xxhash of their string.  They are written as files of at most PART_ENTRIES
  entries in the shared folder: sorted digests, kinds, offsets and the full strings.  The driver streams the
  sorted rows and holds one file's entries at a time.  Spark hands the files to every executor
  (`addFile`), whose Python workers map them: only the pages that probes touch are read.
* Host entries carry the lengths of their rules' paths, so a url is probed with its host's suffixes (no longer
  than the longest rule host) and, for those found, with path prefixes of just these lengths.
* A batch's probes are one vectorised binary search.  Every hit is confirmed by comparing the full string,
  going on over equal digests, so a collision never gives a verdict.

Defined results: a null url, or one without `://`, has an empty host and path; hosts are lower-cased in A-Z only; a rule
given twice with both actions blocks; urls and pages given twice are judged twice; an empty table or list of rules
gives no row or no match; other columns are ignored, whatever their names; any length of host or path is judged whole.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.llm.common import LOWER, UPPER, new_run_dir

SEED = 42  # Spark's xxhash64 starts from it too
HOST, ALLOW, BLOCK = 0, 1, 2
PART_ENTRIES = 1 << 20
LONGEST = "longest"


# -- url parts -------------------------------------------------------------------------------------
def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first `://` up to `/`, `?`, `#` or the end; then up to `?`, `#` or the end."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    rest = F.when(F.instr(url, "://") > 0, rest).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


# -- the rule files --------------------------------------------------------------------------------
def _entries(rules: DataFrame) -> DataFrame:
    """(key, kind, string, extra): one entry per rule and one per host."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", F.when(F.col("action") == "block", BLOCK).otherwise(ALLOW).alias("kind"))
    one = rules.groupBy("host", "path").agg(F.max("kind").alias("kind"))
    hosts = one.groupBy("host").agg(F.array_join(F.array_sort(F.collect_set(F.length("path"))).cast("array<string>"), ",").alias("extra"))
    both = one.select("kind", F.concat("host", "path").alias("string"), F.lit("").alias("extra")).unionByName(
        hosts.select(F.lit(HOST).alias("kind"), F.col("host").alias("string"), "extra"))
    return both.withColumn("key", F.xxhash64("string"))


class RuleWriter:
    """Collects sorted entries into files in the shared folder that executors are given a copy of."""

    def __init__(self, spark: SparkSession, part_entries: int) -> None:
        self.spark, self.limit, self.folder = spark, part_entries, new_run_dir(spark, "url-rules")
        self.names, self.fences = [], []
        self._clear()

    def _clear(self) -> None:
        self.keys, self.kinds, self.offsets, self.strings = [], [], [0], bytearray()

    def add(self, key: int, kind: int, string: str, extra: str) -> None:
        if len(self.keys) >= self.limit and key != self.keys[-1]:  # equal digests stay in one file
            self.flush()
        self.keys.append(key)
        self.kinds.append(kind)
        self.strings += f"{string}\n{extra}".encode()
        self.offsets.append(len(self.strings))

    def flush(self) -> None:
        if not self.keys:
            return
        data = b"".join((np.array([len(self.keys)], "<u8").tobytes(), np.array(self.keys, "<u8").tobytes(),
                         np.array(self.offsets, "<u8").tobytes(), np.array(self.kinds, "u1").tobytes(), bytes(self.strings)))
        name = f"url-rules-{hashlib.sha256(data).hexdigest()[:16]}-{os.path.basename(self.folder)}.bin"
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        out = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        self.spark.sparkContext.addFile(path.toString() if ":" in path.toString() else f"file://{path.toString()}")
        self.names.append(name)
        self.fences.append(self.keys[0])
        self._clear()


def write_rules(spark: SparkSession, rules: DataFrame, part_entries: int = PART_ENTRIES) -> dict:
    """Write `rules` (host, path, action) as rule files; returns what `judge` needs to find them."""
    entries = _entries(rules)
    longest = entries.agg(F.max(F.when(F.col("kind") == HOST, F.length("string"))).alias("n")).first()["n"]
    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))  # signed order of this is unsigned order of the key
    writer = RuleWriter(spark, part_entries)
    for r in entries.orderBy(unsigned, "kind", "string").toLocalIterator():
        writer.add(r["key"] & 0xFFFFFFFFFFFFFFFF, r["kind"], r["string"], r["extra"])
    writer.flush()
    return {"files": writer.names, "fences": writer.fences, LONGEST: longest or 0}


class RulePart:
    """One mapped rule file."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<u8")[0])
        self.keys = raw[8:8 + 8 * n].view("<u8")
        self.offsets = raw[8 + 8 * n:16 + 16 * n].view("<u8")
        self.kinds = raw[16 + 16 * n:16 + 17 * n]
        self.strings = raw[16 + 17 * n:]

    def entry(self, i: int) -> tuple[int, str, str]:
        string, _, extra = bytes(self.strings[int(self.offsets[i]):int(self.offsets[i + 1])]).decode().rpartition("\n")
        return int(self.kinds[i]), string, extra

    def confirm(self, at: int, key: int, string: str, host: bool):
        """The entry for `string` among those with its digest, from place `at` on."""
        while at < len(self.keys) and int(self.keys[at]) == key:
            kind, known, extra = self.entry(at)
            if known == string and (kind == HOST) == host:
                return kind, extra
            at += 1
        return None


@lru_cache(maxsize=4096)
def _part(path: str) -> RulePart:
    return RulePart(path)


def digest(string: str) -> int:
    return xxhash.xxh64_intdigest(string.encode("utf-8", "surrogatepass"), SEED)


def lookup(index: dict, strings: list[str], host: bool) -> dict:
    """The entries of those of `strings` that the files hold."""
    if not strings or not index["files"]:
        return {}
    keys = np.array([digest(s) for s in strings], np.uint64)
    part = np.searchsorted(np.array(index["fences"], np.uint64), keys, side="right") - 1
    found = {}
    for p in np.unique(part[part >= 0]):
        rules = _part(SparkFiles.get(index["files"][p]))
        mine = np.flatnonzero(part == p)
        at = np.searchsorted(rules.keys, keys[mine])
        hit = (at < len(rules.keys)) & (np.asarray(rules.keys)[np.minimum(at, len(rules.keys) - 1)] == keys[mine])
        for k, place in zip(mine[hit], at[hit]):
            entry = rules.confirm(int(place), int(keys[k]), strings[k], host)
            if entry:
                found[strings[k]] = entry
    return found


def suffixes(host: str, longest: int) -> list[str]:
    """The host and its parent domains, as far as a rule host is that long."""
    out = [host] if len(host) <= longest else []
    at = host.find(".", max(0, len(host) - longest - 1))
    while at >= 0:
        out.append(host[at + 1:])
        at = host.find(".", at + 1)
    return out


def match(index: dict, hosts: list[str], paths: list[str]) -> list[tuple[str, int] | None]:
    """(rule, kind) of the longest rule that fits each (host, path)."""
    parents = {h: suffixes(h, index[LONGEST]) for h in set(hosts)}
    known = lookup(index, list({s for ss in parents.values() for s in ss}), True)
    lengths = {h: [(s, int(n)) for s in ss if s in known for n in known[s][1].split(",")] for h, ss in parents.items()}
    probes = [[s + p[:n] for s, n in lengths[h] if n <= len(p)] for h, p in zip(hosts, paths)]
    fits = lookup(index, list({s for ss in probes for s in ss}), False)
    out = []
    for ss in probes:
        best = max((s for s in ss if s in fits), key=lambda s: (len(s), len(s.partition("/")[0])), default=None)
        out.append(None if best is None else (best, fits[best][0]))
    return out


def judge(urls: DataFrame, index: dict, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict (`allow` or `block`) of every row."""
    host, path = host_and_path(F.coalesce(urls[url_col], F.lit("")))

    @F.pandas_udf("rule string, verdict string")
    def verdicts(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = match(index, hosts.tolist(), paths.tolist())
        return pd.DataFrame({"rule": [f and f[0] for f in found],
                             "verdict": ["block" if f and f[1] == BLOCK else "allow" for f in found]})
    parts = urls.select(urls[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    return parts.withColumn("v", verdicts("host", "path")).select("page_id", "host", "path", "v.rule", "v.verdict")
