"""URL filter: a sorted array of 64-bit digests, memory-mapped by every task.

The rules (host, path prefix, verdict) become one file: sorted xxhash64 keys,
offsets and the full rule strings. The file goes to the shared folder and from
there to every executor (``addFile``), so a lost executor fetches it again. A
task maps the file instead of loading it, hashes the few rule strings that
could fit a url, finds them all with one ``searchsorted`` and then compares the
stored full strings, so a hash collision cannot decide a verdict.

Defined results
* null url, or one without ``://``: host and path are empty, no rule fits;
* no rule fits: ``rule`` is null and ``verdict`` is ``default``;
* several fit: the longest rule string wins, then the longer host; the same
  rule given twice: the last one given counts;
* repeated urls are judged each; an empty table gives an empty result; input
  columns named like an output give way to it.
"""

from __future__ import annotations

import hashlib
import mmap
import struct
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream.llm.common import ascii_lower, fresh_folder, with_outputs, write_shared

VERDICTS = ("block", "allow")
Rule = tuple[str, str, str]  # host, path prefix, verdict


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(keys: Iterable[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64)


def build_digest(rules: Iterable[Rule]) -> bytes:
    """Header, sorted keys, string offsets, path lengths, verdicts, strings. A
    path is empty or begins with the first ``/`` of its rule string."""
    by_key = {f"{h.lower()}{p}".encode(): VERDICTS.index(v) for h, p, v in rules}
    strings = list(by_key)
    keys = digest(strings)
    order = np.argsort(keys, kind="stable")
    strings = [strings[i] for i in order]
    offsets = np.zeros(len(strings) + 1, np.uint64)
    np.cumsum([len(s) for s in strings], out=offsets[1:])
    lengths = np.array(sorted({len(s) - len(s.partition(b"/")[0]) for s in strings}), np.uint64)
    verdicts = np.array([by_key[s] for s in strings], np.uint8)
    head = struct.pack("<QQ", len(strings), len(lengths))
    return b"".join([head, keys[order].tobytes(), offsets.tobytes(), lengths.tobytes(), verdicts.tobytes(), *strings])


class DigestFile:
    """The mapped file; arrays are views of it and are paged in on demand."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, m = struct.unpack_from("<QQ", self.map)
        at = 16
        self.keys = np.frombuffer(self.map, np.uint64, n, at)
        self.offsets = np.frombuffer(self.map, np.uint64, n + 1, at := at + 8 * n)
        self.path_lengths = np.frombuffer(self.map, np.uint64, m, at := at + 8 * (n + 1)).astype(int).tolist()
        self.verdicts = np.frombuffer(self.map, np.uint8, n, at := at + 8 * m)
        self.strings_at = at + n

    def find(self, strings: list[bytes]) -> np.ndarray:
        """Index of each string, or -1. Runs of equal keys are all compared."""
        keys = digest(strings)
        left, right = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = np.full(len(strings), -1)
        for i in np.flatnonzero(right > left):
            for j in range(left[i], right[i]):
                if self.string(j) == strings[i]:
                    found[i] = j
        return found

    def string(self, j: int) -> bytes:
        return self.map[self.strings_at + int(self.offsets[j]) : self.strings_at + int(self.offsets[j + 1])]


def candidates(host: str, path: bytes, path_lengths: list[int]) -> list[bytes]:
    """The rule strings that could fit, the one that wins first."""
    out = []
    while True:
        out += [(host.encode(), path[:n]) for n in path_lengths if n <= len(path)]
        if "." not in host:
            break
        host = host[host.index(".") + 1 :]
    return [h + p for h, p in sorted(out, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


@lru_cache(maxsize=4)
def opened(path: str) -> DigestFile:
    return DigestFile(path)


def judge(digest_file: DigestFile, hosts: pd.Series, paths: pd.Series, default: str) -> pd.DataFrame:
    """Rule and verdict of each (host, path); equal heads are probed once."""
    longest = max(digest_file.path_lengths, default=0)
    codes, distinct = pd.factorize(hosts + paths.str.slice(0, longest))
    probes, owner = [], []
    for i, head in enumerate(distinct):
        host, slash, rest = head.partition("/")
        c = candidates(host, (slash + rest).encode(), digest_file.path_lengths)
        probes += c
        owner += [i] * len(c)
    best = np.full(len(distinct), -1)
    found = digest_file.find(probes)
    for k in np.flatnonzero(found >= 0)[::-1]:  # the first hit of a head is written last
        best[owner[k]] = found[k]
    rules = [None if j < 0 else digest_file.string(j).decode() for j in best]
    verdicts = [default if j < 0 else VERDICTS[digest_file.verdicts[j]] for j in best]
    return pd.DataFrame({"rule": pd.Series(rules, dtype=object).take(codes).values, "verdict": np.array(verdicts, dtype=object)[codes]})


def ship_rules(spark: SparkSession, rules: Iterable[Rule]) -> str:
    """Write the digest file to the shared folder and hand it to all executors."""
    data = build_digest(rules)
    name = f"url-rules-{hashlib.sha256(data).hexdigest()[:24]}-{fresh_folder(spark, 'r')[-8:]}.digest"
    spark.sparkContext.addFile(write_shared(spark, f"{fresh_folder(spark, 'urls')}/{name}", data))
    return name


def filter_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict of its url column."""
    name = ship_rules(df.sparkSession, rules)

    @F.pandas_udf("rule string, verdict string")
    def probe(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        return judge(opened(SparkFiles.get(name)), hosts, paths, default)

    link = F.col(f"`{url}`")
    found = probe(url_host(link), url_path(link))
    return with_outputs(df, host=url_host(link), path=url_path(link), rule=found["rule"], verdict=found["verdict"])
