"""URL verdicts: rules first, then a sorted array of digests of listed hosts."""

from __future__ import annotations

import mmap
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules of the query: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Hosts that the query's list blocks, with their subdomains.
LISTED = ("ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.net", "free-bets.example.net", "spam-farm.example.org")
#: Labels of a host name that put it on a list made from pages.
NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: A list up to this size is sent to the tasks as one array; a longer one is joined.
MOST_ENTRIES = 4_000_000
CAPS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPS, SMALL), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as its text and its verdict; null where none does."""
    text = verdict = None
    for word, own, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r), reverse=True):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        text = F.when(fits, own + start) if text is None else text.when(fits, own + start)
        verdict = F.when(fits, word) if verdict is None else verdict.when(fits, word)
    return text, verdict


class DigestArray:
    """Sorted 64-bit keys with the full strings behind them, in one block of bytes.

    Layout: number of entries, keys in order, ends of the strings, strings. ``opened`` maps
    the block from a nameless file, so that tasks share pages and nothing is left behind.
    """

    def __init__(self, block):
        count = int(np.frombuffer(block, dtype=np.int64, count=1)[0])
        self.keys = np.frombuffer(block, dtype=np.uint64, count=count, offset=8)
        self.ends = np.frombuffer(block, dtype=np.int64, count=count + 1, offset=8 + 8 * count)
        self.block, self.base = block, 8 + 8 * count + 8 * (count + 1)

    @staticmethod
    def packed(entries: Iterable[str], key=xxhash.xxh64_intdigest) -> bytes:
        strings = [s.encode() for s in sorted(set(entries))]
        keys = np.fromiter(map(key, strings), dtype=np.uint64, count=len(strings))
        order = np.argsort(keys, kind="stable")
        strings = [strings[i] for i in order]
        ends = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        return np.int64(len(strings)).tobytes() + keys[order].tobytes() + ends.tobytes() + b"".join(strings)

    @classmethod
    def opened(cls, data: bytes) -> DigestArray:
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def holds(self, strings: list[bytes], key=xxhash.xxh64_intdigest) -> np.ndarray:
        """Whether each string is listed: binary search of all keys at once, then the strings themselves."""
        asked = np.fromiter(map(key, strings), dtype=np.uint64, count=len(strings))
        first, last = np.searchsorted(self.keys, asked, "left"), np.searchsorted(self.keys, asked, "right")
        found = np.zeros(len(strings), dtype=bool)
        for i in np.flatnonzero(first < last):
            # equal keys stand together, whatever their strings
            found[i] = any(self.block[self.base + self.ends[k] : self.base + self.ends[k + 1]] == strings[i] for k in range(first[i], last[i]))
        return found


def suffixes(host: bytes) -> list[bytes]:
    """The host and its parent domains."""
    parts = host.split(b".")
    return [b".".join(parts[i:]) for i in range(len(parts))]


def _listed(data, names: list[str]):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray.opened(data.value)
        for frame in frames:
            column = frame.column("host").cast(pa.binary())
            hosts = column.unique()
            asked = [suffixes(h) for h in hosts.to_pylist()]
            flat = array.holds([s for own in asked for s in own])
            ends = np.cumsum([0] + [len(own) for own in asked])
            hit = np.array([flat[a:b].any() for a, b in zip(ends, ends[1:], strict=False)], dtype=bool)
            at = pc.index_in(column, hosts).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(frame.column(c) for c in names), pa.array(hit[at])], [*names, "listed"])

    return run


def named_hosts(pages: DataFrame, names: Iterable[str] = NAMES) -> DataFrame:
    """``(host)``: every domain in the urls of ``pages`` that begins with one of the labels, whatever lies before it."""
    host, _ = url_parts(F.col("url").cast("string"))
    labels = "|".join(re.escape(n) for n in names)
    found = pages.select(F.regexp_extract(host, rf"(?:^|\.)((?:{labels})(?:\..*)?)$", 1).alias("host"))
    return found.where("host <> ''").distinct()


def judge_urls(pages: DataFrame, entries: Iterable[str] | DataFrame = LISTED, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)`` for every row of ``pages (page_id, url)``.

    The longest fitting rule decides; without one a url is blocked if its host or a parent
    domain is in ``entries``. ``entries`` are strings, or a table with a column ``host``,
    which is joined if it has more than ``MOST_ENTRIES`` rows.

    Defined results: a null url, or one without ``://``, has empty host and path and is
    allowed; each row is judged on its own, so repeats get equal rows and a null ``page_id``
    stays null; an empty table or list is no error; further columns are ignored.
    """
    host, path = url_parts(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    if isinstance(entries, DataFrame):
        entries = entries.select("host").where("host is not null").distinct()
        few = entries.limit(MOST_ENTRIES + 1).count() <= MOST_ENTRIES
        entries = [r["host"] for r in entries.collect()] if few else entries
    if isinstance(entries, DataFrame):
        hosts = rows.select("host").distinct()
        parts = F.split("host", r"\.")
        tails = hosts.select("host", F.explode(F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))).alias("tail"))
        hit = tails.join(entries.withColumnRenamed("host", "tail"), "tail", "left_semi").select("host").distinct().withColumn("listed", F.lit(True))
        rows = rows.join(hit, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        data = pages.sparkSession.sparkContext.broadcast(DigestArray.packed(entries))
        rows = rows.mapInArrow(_listed(data, ["page_id", "host", "path"]), f"page_id {kind}, host string, path string, listed boolean")
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "listed")
