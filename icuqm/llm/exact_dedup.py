"""Exact duplicates against an immutable snapshot, screened by static binary-fuse filters."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.llm.text import mixed
from icuqm.session import write_stage

#: Keys of one filter; a snapshot has as many filters as it takes.
SHARD_KEYS = 250_000


class FuseFilter:
    """A static filter of 8-bit fingerprints at three places of neighbouring segments.

    Sizes follow the published construction of binary fuse filters. No key that was put in
    is ever denied; about one foreign key in 256 passes.
    """

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys + np.uint64(seed))
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = 1 << min(18, max(2, math.floor(math.log(n) / math.log(3.33) + 2.25)))
        cells = round(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
        segments = max(1, -(-cells // segment) - 2)
        for seed in range(1, 1000):
            places, prints = cls._places(keys, seed, segment, segments)
            order = cls._peel(places, (segments + 2) * segment)
            if order is not None:
                break
        else:
            raise ValueError("no seed gives a filter")
        table = np.zeros((segments + 2) * segment, dtype=np.uint8)
        for at, own in reversed(order):
            table[own] = 0
            table[own] = prints[at] ^ table[places[0, at]] ^ table[places[1, at]] ^ table[places[2, at]]
        return cls(seed, segment, segments, table)

    @staticmethod
    def _peel(places: np.ndarray, cells: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Keys that alone hold a place, round by round; None if some are never alone."""
        number = np.tile(np.arange(places.shape[1]), 3)
        count = np.bincount(places.ravel(), minlength=cells)
        total = np.bincount(places.ravel(), weights=number, minlength=cells)
        order, left, lone = [], places.shape[1], np.flatnonzero(count == 1)
        while len(lone):
            at, one = np.unique(total[lone].astype(np.int64), return_index=True)
            order.append((at, lone[one]))
            left -= len(at)
            touched = places[:, at].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.tile(at, 3))
            touched = np.unique(touched)
            lone = touched[count[touched] == 1]
        return None if left else order

    def holds(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return prints == self.cells[places[0]] ^ self.cells[places[1]] ^ self.cells[places[2]]


def _build(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter per shard of a partition sorted by shard."""
    names = ["shard", "seed", "segment", "segments", "cells"]
    now, held = None, []

    def done():
        f = FuseFilter.build(np.concatenate(held).view(np.uint64))
        values = [[now], [f.seed], [f.segment], [f.segments], [f.cells.tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [pa.int32()] * 4 + [pa.binary()], strict=True)], names)

    for frame in frames:
        shards, keys = frame.column("shard").to_numpy(zero_copy_only=False), frame.column("key").to_numpy(zero_copy_only=False)
        for shard in np.unique(shards):
            if shard != now:
                if now is not None:
                    yield done()
                now, held = int(shard), []
            held.append(keys[shards == shard])
    if now is not None:
        yield done()


def _probe(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests that their shard's filter lets pass; a shard's filter comes before its digests."""
    now, own = None, None
    for frame in frames:
        shards = frame.column("shard").to_numpy(zero_copy_only=False)
        keys = frame.column("key").to_numpy(zero_copy_only=False)
        filters = frame.column("cells")
        passed = np.zeros(len(shards), dtype=bool)
        for shard in np.unique(shards):
            at = np.flatnonzero(shards == shard)
            if shard != now:
                now, own = shard, None
            if filters[int(at[0])].is_valid:
                k = int(at[0])
                own = FuseFilter(*(frame.column(c)[k].as_py() for c in ("seed", "segment", "segments")), np.frombuffer(filters[k].as_py(), dtype=np.uint8))
                at = at[1:]
            if own is not None and len(at):
                passed[at] = own.holds(keys[at].view(np.uint64))
        yield pa.RecordBatch.from_arrays([frame.column("digest").filter(pa.array(passed))], ["digest"])


def build_filters(digests: DataFrame, shards: int) -> DataFrame:
    """The snapshot's filter table from distinct ``digests (digest, key)``."""
    rows = digests.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key").repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(_build, "shard int, seed int, segment int, segments int, cells binary")


def screen(digests: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Those of distinct ``digests (digest, key)`` that the filters let pass."""
    none = {c: F.lit(None).cast(t) for c, t in (("seed", "int"), ("segment", "int"), ("segments", "int"), ("cells", "binary"))}
    asked = digests.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "digest", "key").withColumns(none)
    held = filters.withColumns({"digest": F.lit(None).cast("string"), "key": F.lit(0).cast("long")})
    rows = held.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("cells").isNull())
    return rows.mapInArrow(_probe, "digest string")


def exact_groups(docs: DataFrame, in_snapshot: Column, digest=None) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row for each of ``docs (doc_id, text)``.

    Rows under ``in_snapshot`` are the immutable snapshot, the others the incoming batch.
    Distinct incoming digests are screened by the snapshot's filters; those that pass join
    the snapshot's exact digests, and copies inside either side are found by grouping. Only
    texts of digests that occur twice are then compared byte by byte with the text of the
    row that stays; a text that differs under an equal digest forms a group of its own.

    Defined results: null text is empty text. Of equal texts the largest ``doc_id`` stays; a
    null ``doc_id`` is smaller than any, and a group with null ids only keeps one of its
    rows with a null ``keep_id``. Of rows that repeat both ``doc_id`` and text one is kept.
    An empty table gives an empty result; further columns are ignored.
    """
    digest = digest or (lambda text: F.sha2(text.cast("binary"), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(in_snapshot, F.lit(False)).alias("old"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    plain = rows.groupBy("digest", "doc_id", "old").agg(F.count("*").alias("n"), F.first(F.sha2(F.col("text").cast("binary"), 256)).alias("text_sha256"))
    plain = write_stage(plain, "exact-digests")
    seen = plain.groupBy("digest", "old").agg(F.sum("n").alias("n"))
    key = F.xxhash64("digest").alias("key")
    old, new = seen.where("old").select("digest", key), seen.where("not old").select("digest", key)
    shards = max(1, -(-old.count() // SHARD_KEYS))
    filters = write_stage(build_filters(old, shards), "exact-filters")
    known = screen(new, filters, shards).join(old.select("digest"), "digest")
    twice = write_stage(known.union(seen.where("n > 1").select("digest")).distinct(), "exact-twice")

    first = plain.join(twice, "digest").groupBy("digest").agg(F.max("doc_id").alias("top"))
    texts = rows.select("digest", "doc_id", "text").join(first, "digest")
    top = texts.where("doc_id <=> top").groupBy("digest").agg(F.min("text").alias("kept_text"))
    other = F.when(F.col("text") != F.col("kept_text"), F.col("text")).alias("other")
    checked = texts.join(top, "digest").groupBy("digest", "doc_id", other).agg(F.count("*").alias("n"), F.first(F.sha2(F.col("text").cast("binary"), 256)).alias("text_sha256"))
    checked = write_stage(checked, "exact-checked")
    groups = checked.groupBy("digest", "other").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    told = checked.alias("c").join(groups.alias("g"), (F.col("c.digest") == F.col("g.digest")) & F.col("c.other").eqNullSafe(F.col("g.other")))
    told = told.select("c.doc_id", "g.keep_id", "g.group_size", "c.n", "c.text_sha256")
    single = plain.join(twice, "digest", "left_anti").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "n", "text_sha256")
    every = told.unionByName(single)
    every = every.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return every.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def newer_half(docs: DataFrame) -> Column:
    """The snapshot of the query: rows in the upper half of the ``doc_id`` range."""
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    return F.col("doc_id") >= F.lit(((ends["low"] or 0) + (ends["high"] or 0)) // 2)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    kept = exact_groups(docs, newer_half(docs)).where("kept").select("doc_id", F.col("text_sha256").alias("_sha"), (F.col("group_size") > 1).alias("_many"))
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    rows = docs.withColumn("_sha", sha).alias("d").join(kept.alias("k"), F.expr("d.doc_id <=> k.doc_id and d._sha = k._sha"))
    rows = rows.select("d.*", "k._many").drop("_sha")
    # rows that repeat id and text are alike in the kept ones only where a group had several
    alone, many = rows.where("not _many").drop("_many"), rows.where("_many").drop("_many")
    return alone.unionByName(many.dropDuplicates(["doc_id", "text"]))
