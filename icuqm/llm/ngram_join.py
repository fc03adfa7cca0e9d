"""Jaccard join of documents on word shingles, by a token-group matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.llm.components import components
from icuqm.llm.text import SPREAD, WIDTH, batches_of, byte_texts, mixed, shingle_keys
from icuqm.session import write_stage

SHARE = 75
#: A set of n is indexed under n / SLACK tokens more than one common token would need.
SLACK = 16
CHUNK_BITS = 16
#: Rows of one token that one task takes before they are salted.
PER_TASK = 100_000
#: Prefix tokens that a task packs at once, bytes of text whose prefix tokens one task takes.
PACKED = 1 << 20
PART_BYTES = 1 << 24
#: Tokens of one part of a group, members that all parts of a group share, queries to one part that one task takes.
TOKENS = 1 << 19
#: A document joins a leader's group from this part of the tokens on that a link takes.
LOOSER = 4
PIVOTS = 32
QUERIES = 4000
LEVEL_STEP = 8
#: Groups are merged while documents would meet more than this many groups per token that they hold.
SPARE = 2
#: Digests that a task remembers to spot copies early; beyond it they are indexed as any text.
SEEN = 500_000


def needed(n: int | np.ndarray, share: int):
    """Smallest overlap that any partner of a set of ``n`` must reach."""
    return -((-n * share) // 100)


def hits_needed(n: int | np.ndarray):
    """Prefix tokens that two similar sets share at least, beyond the usual one."""
    return 1 + n // SLACK


def sketch_bits(n_bytes: int) -> int:
    """Counters of the token sketch: one for some 32 tokens, 2^24 at most, which is a broadcast of 16 MB.

    Any size gives the same result, a larger one fewer candidates.
    """
    return min(24, max(CHUNK_BITS, math.ceil(math.log2(n_bytes + 1)) - 8))


def filter_bits(n_docs: int) -> int:
    """Bits of a filter of documents or tokens: some 16 for each, 2^27 at most, which is a broadcast of 16 MB.

    It spares most rows that nothing asks for; those let through are joined exactly.
    """
    return min(27, max(16, math.ceil(math.log2(n_docs + 1)) + 4))


def _measure(bits: int, width: int):
    """Per document its set size, per task a compressed sketch of token frequencies."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int64)
        for frame in batches_of(frames):
            sizes, held = [], []
            for data in byte_texts(frame.column("text")):
                keys = shingle_keys(data, width)
                sizes.append(len(keys))
                held.append(keys >> np.uint64(64 - bits))
            if held:
                counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << bits)
            none = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array(sizes, pa.int64()), none, pa.nulls(len(sizes), pa.binary())], ["doc_id", "n_shingles", "part", "counts"]
            )
        pack = zstandard.ZstdCompressor(level=1)
        for part in range(1 << (bits - CHUNK_BITS)):
            chunk = np.minimum(counts[part << CHUNK_BITS : (part + 1) << CHUNK_BITS], 0xFFFFFFFF)
            # a byte each where that is enough, as in most tasks
            chunk = chunk.astype(np.uint8 if chunk.max() < 256 else np.uint32)
            if chunk.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([part], pa.int32()), pa.array([pack.compress(chunk.tobytes())], pa.binary())],
                    ["doc_id", "n_shingles", "part", "counts"],
                )

    return run


def _levels(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the sketches of a partition, which is sorted by part, and yield log levels."""
    unpack, now, total = zstandard.ZstdDecompressor(), None, None

    def done():
        level = np.minimum(LEVEL_STEP * np.log2(1.0 + total), 255).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "level"])

    for frame in frames:
        for part, data in zip(frame.column("part").to_pylist(), frame.column("counts").to_pylist(), strict=True):
            if part != now:
                if now is not None:
                    yield done()
                now, total = part, np.zeros(1 << CHUNK_BITS, dtype=np.int64)
            chunk = unpack.decompress(data)
            total += np.frombuffer(chunk, dtype=np.uint8 if len(chunk) == 1 << CHUNK_BITS else np.uint32)
    if now is not None:
        yield done()


def _salts(tokens: np.ndarray, ids: np.ndarray, per_task: int) -> np.ndarray:
    """Tokens of more documents than one task takes are dealt over several salts from 1 on, all others have salt 0."""
    spread = (2.0 ** ((tokens.view(np.uint64) >> np.uint64(56)).astype(np.float64) / LEVEL_STEP) // per_task).astype(np.uint64) + np.uint64(1)
    return np.where(spread > 1, np.uint64(1) + mixed(ids.astype(np.uint64)) % spread, np.uint64(0)).astype(np.int32)


def _packed_rows(tokens: np.ndarray, ids: np.ndarray, sizes: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """The three columns byte by byte, ids as steps, which takes half of what such rows take in an exchange."""
    steps = np.diff(ids, prepend=np.int64(0))
    return pack.compress(b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in (tokens, steps, sizes)))


def _unpacked_rows(data: bytes, unpack: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(unpack.decompress(data), dtype=np.uint8).reshape(20, -1)
    tokens, steps, sizes = (np.ascontiguousarray(raw[at:to].T).view(kind).ravel() for at, to, kind in ((0, 8, np.int64), (8, 16, np.int64), (16, 20, np.int32)))
    return tokens, np.cumsum(steps), sizes


def _prefixes(levels, bits: int, share: int, width: int, parts: int):
    """Rows ``(part, id, head, packed)``: the rarest tokens of each set under one order for all documents.

    Order: frequency level, then key. Of two sets with the wanted similarity, the prefixes of
    ``n - needed(n) + hits_needed(n)`` tokens share at least the smaller ``hits_needed``. Rows
    ``(token, id, n)`` of one token and salt go to one part, those of a part are packed. A
    copy met again in the same task is not indexed; its row names the first one as ``head``.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen, pack = levels.value, {}, zstandard.ZstdCompressor(level=1)
        held, copies, heads, n_held = [], [], [], 0

        def flush():
            to, own, packed = np.zeros(0, dtype=np.int64), [], []
            if held:
                tokens, ids, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
                salts = _salts(tokens, ids, PER_TASK)
                to = (mixed(tokens.view(np.uint64) + salts.astype(np.uint64) * SPREAD) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                tokens, ids, sizes = tokens[order], ids[order], sizes[order]
                own, starts = np.unique(to[order], return_index=True)
                ends = np.append(starts[1:], len(order))
                packed = [_packed_rows(tokens[x:y], ids[x:y], sizes[x:y], pack) for x, y in zip(starts, ends, strict=True)]
            k = len(copies)
            columns = [
                pa.array([*own, *(i % parts for i in copies)], pa.int32()),
                pa.array([*[None] * len(packed), *copies], pa.int64()),
                pa.array([*[None] * len(packed), *heads], pa.int64()),
                pa.array([*packed, *[None] * k], pa.binary()),
            ]
            held.clear(), copies.clear(), heads.clear()
            return pa.RecordBatch.from_arrays(columns, ["part", "id", "head", "packed"])

        for frame in batches_of(frames):
            for doc_id, data in zip(frame.column("doc_id").to_pylist(), byte_texts(frame.column("text")), strict=True):
                keys = shingle_keys(data, width)
                if doc_id is None or len(keys) == 0:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                head = seen.setdefault(xxhash.xxh3_128_digest(keys.tobytes()), doc_id)
                if head != doc_id:
                    copies.append(doc_id)
                    heads.append(head)
                    continue
                level = table[(keys >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
                order = (level << np.uint64(56)) | (keys & np.uint64((1 << 56) - 1))
                take = len(keys) - needed(len(keys), share) + hits_needed(len(keys))
                if take < len(keys):
                    # ties at the border all stay
                    order = order[order <= np.partition(order, take - 1)[take - 1]]
                held.append((order.view(np.int64), np.full(len(order), doc_id, dtype=np.int64), np.full(len(order), len(keys), dtype=np.int32)))
                n_held += len(order)
            if n_held >= PACKED:
                yield flush()
                n_held = 0
        yield flush()

    return run


def _shared(per_task: int):
    """Rows of one part: tokens that several documents hold or that are salted, with the smallest document of each token and salt, and copies."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor(), []
        names = ["token", "salt", "id", "n", "head", "leader", "m"]
        for frame in frames:
            held += [_unpacked_rows(x, unpack) for x in frame.column("packed").to_pylist() if x is not None]
            copies = frame.filter(frame.column("head").is_valid())
            ids, none = copies.column("id"), pa.array(np.zeros(copies.num_rows, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([ids, none, ids, none, copies.column("head"), ids, none], names)
        if not held:
            return
        tokens, ids, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        salts = _salts(tokens, ids, per_task)
        order = np.lexsort((sizes, ids, salts, tokens))
        tokens, salts, ids, sizes = tokens[order], salts[order], ids[order], sizes[order]
        first = np.flatnonzero(np.append(True, (tokens[1:] != tokens[:-1]) | (salts[1:] != salts[:-1])))
        many = np.diff(np.append(first, len(tokens)))
        stays = np.repeat(ids[first] != ids[first + many - 1], many) | (salts > 0)
        leaders, least = np.repeat(ids[first], many)[stays], np.repeat(sizes[first], many)[stays]
        columns = [pa.array(x) for x in (tokens[stays], salts[stays], ids[stays], sizes[stays])]
        rows = pa.RecordBatch.from_arrays([*columns, pa.nulls(len(leaders), pa.int64()), pa.array(leaders), pa.array(least)], names)
        yield from batches_of([rows], 1 << 16)

    return run


def shared_tokens(docs: DataFrame, levels, bits: int, share: int, width: int, n_bytes: int) -> DataFrame:
    """``(token, salt, id, n, head, leader, m)``: prefix tokens of several documents, and copies with their ``head``."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // PART_BYTES)
    tokens = docs.mapInArrow(_prefixes(levels, bits, share, width, parts), "part int, id long, head long, packed binary")
    return tokens.repartitionById(parts, "part").mapInArrow(_shared(PER_TASK), "token long, salt int, id long, n int, head long, leader long, m int")


def _filter_places(ids: np.ndarray, bits: int) -> np.ndarray:
    """Two places of each id in the filter."""
    keys = mixed(ids.astype(np.uint64))
    return np.stack([keys >> np.uint64(64 - bits), keys & np.uint64((1 << bits) - 1)]).astype(np.int64)


def _filter_of(bits: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits, dtype=bool)
        for frame in frames:
            own[_filter_places(frame.column("id").to_numpy(zero_copy_only=False), bits).ravel()] = True
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([pa.array([pack.compress(np.packbits(own).tobytes())], pa.binary())], ["bits"])

    return run


def filter_over(ids: DataFrame, bits: int):
    """Broadcast filter that lets every number of ``ids (id)`` through and, as a rule, few others."""
    masks = ids.mapInArrow(_filter_of(bits), "bits binary").rdd.map(lambda r: np.frombuffer(zstandard.ZstdDecompressor().decompress(r["bits"]), dtype=np.uint8))
    return ids.sparkSession.sparkContext.broadcast(masks.treeAggregate(np.zeros(1 << (bits - 3), dtype=np.uint8), np.bitwise_or, np.bitwise_or))


def _let_through(own: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    at = _filter_places(ids, bits)
    return ((own[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def _among(mask, bits: int):
    """Rows whose ``id`` the filter lets through."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield frame.filter(pa.array(_let_through(mask.value, frame.column("id").to_numpy(zero_copy_only=False), bits), pa.bool_()))

    return run


def _listed(mask, bits: int):
    """Rows ``(id, n, token)`` of the tokens that the filter lets through."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            lists = frame.column("tokens")
            tokens, of = lists.flatten(), pc.list_parent_indices(lists)
            held = pa.array(_let_through(mask.value, tokens.to_numpy(zero_copy_only=False), bits), pa.bool_())
            of = of.filter(held)
            yield pa.RecordBatch.from_arrays([frame.column("id").take(of), frame.column("n").take(of), tokens.filter(held)], ["id", "n", "token"])

    return run


def _opened(mask, bits: int):
    """Compressed texts of the documents that the filter lets through."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pack = mask.value, zstandard.ZstdCompressor(level=3)
        for frame in batches_of(frames):
            frame = frame.filter(frame.column("doc_id").is_valid())
            frame = frame.filter(pa.array(_let_through(own, frame.column("doc_id").to_numpy(zero_copy_only=False), bits), pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array([pack.compress(x) for x in byte_texts(frame.column("text"))], pa.binary())], ["id", "packed"]
            )

    return run


class TokenGroup:
    """The token union of some documents, with the documents behind each token."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], share: int):
        self.ids, self.sets, self.share = ids, sets, share
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.tokens, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))
        self.who = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]
        self.least = int(self.sizes.min())

    def linked(self, keys: np.ndarray) -> np.ndarray:
        """Places of the documents that link with a set. The group is opened only where the union allows a link."""
        at = np.searchsorted(self.tokens, keys)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == keys]
        if 100 * len(at) < self.share * (len(keys) + max(self.least, needed(len(keys), self.share)) - len(at)):
            return at[:0]
        many = self.starts[at + 1] - self.starts[at]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        both = np.bincount(self.who[np.repeat(self.starts[at], many) + within], minlength=len(self.sets))
        return np.flatnonzero((both > 0) & (100 * both >= self.share * (len(keys) + self.sizes - both)))

    def join_up(self) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """A label per document, alike where links connect them, and links enough to do so."""
        label, links = np.arange(len(self.sets)), []
        for i, keys in enumerate(self.sets):
            found = self.linked(keys)
            labels, first = np.unique(label[found], return_index=True)
            other = labels != label[i]
            if other.any():
                links += [(self.ids[i], self.ids[j]) for j in found[first[other]]]
                label[np.isin(label, labels)] = min(labels.min(), label[i])
        return label, links


MEETING = ["grp", "sub", "salt", "asks"]


def _meet(share: int, width: int):
    """Stream a partition sorted by group, members before queries, and yield links.

    Members without a known component are joined up first. A query is answered with one
    member of each other component that it links with.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, now = zstandard.ZstdDecompressor(), None
        ids, sets, comps, group, label = [], [], [], None, None
        a, b = [], []

        def close() -> None:
            nonlocal group, label
            if group is None and sets:
                group = TokenGroup(ids, sets, share)
                if comps[0] is not None:
                    label = np.array(comps)
                else:
                    label, links = group.join_up()
                    a.extend(x for x, _ in links)
                    b.extend(y for _, y in links)

        for frame in frames:
            for *key, asks, doc_id, comp, packed in zip(*(frame.column(c).to_pylist() for c in (*MEETING, "id", "comp", "packed")), strict=True):
                if key != now:
                    close()
                    now, ids, sets, comps, group, label = key, [], [], [], None, None
                keys = shingle_keys(unpack.decompress(packed), width)
                if not asks:
                    ids.append(doc_id)
                    sets.append(keys)
                    comps.append(comp)
                    continue
                close()
                if group is not None:
                    found = group.linked(keys)
                    labels, first = np.unique(label[found], return_index=True)
                    for own, j in zip(labels.tolist(), first.tolist(), strict=True):
                        if comp is None or own != comp:
                            a.append(doc_id)
                            b.append(ids[found[j]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear()
            b.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def met_links(rows: DataFrame, opened: DataFrame, share: int, width: int) -> DataFrame:
    """``(a, b)`` found among ``rows (grp, sub, salt, asks, id, comp)`` with the texts of ``opened (id, packed)``."""
    rows = rows.join(opened, "id").repartition("grp", "sub", "salt").sortWithinPartitions(*MEETING, "id")
    return rows.mapInArrow(_meet(share, width), "a long, b long")


def _wanted(n: str, m: str, share: int = 100):
    """``hits_needed`` of the smaller of two sets, or of ``share`` of it."""
    return 1 + F.floor(F.ceil(F.least(F.col(n), F.col(m)) * share / 100) / SLACK)


def compatible(n: str, m: str, share: int):
    """Sizes that allow the similarity."""
    return (F.col(n) * share <= F.col(m) * 100) & (F.col(m) * share <= F.col(n) * 100)


def _numbers(top, of):
    """Rows repeated for every number from 0 below ``top``."""
    return F.explode(F.sequence(F.lit(0), (top - 1).cast("int"))).alias(of)


def _place(parts):
    return F.pmod(F.xxhash64("id"), parts).cast("int")


def split_groups(group: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(grp, parts, sub, id)``: groups in parts of some ``TOKENS`` tokens, so that a task can hold one."""
    members = group.select("id", F.col("component").alias("grp")).join(sizes, "id")
    parts = members.groupBy("grp").agg(F.ceil(F.sum("n") / TOKENS).cast("int").alias("parts"))
    return members.join(parts, "grp").select("grp", "parts", _place(F.col("parts")).alias("sub"), "id")


def pivots(members: DataFrame) -> DataFrame:
    """``(grp, sub, id)``: some members of each split group in all of its parts, so that most links are found through them."""
    own = members.where("parts > 1").groupBy("grp", "parts", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PIVOTS))).agg(F.min("id").alias("id"))
    return own.select("grp", _numbers(F.col("parts"), "sub"), "id", _place(F.col("parts")).alias("home")).where("sub <> home").drop("home")


def _gather(share: int):
    """One row per document from rows sorted by it: its prefix tokens, their leaders, and the leader with which it shares most.

    Documents with fewer shared prefix tokens than any link takes are left out. A leader is
    named from a part of the tokens on that a link takes.
    """
    names = ["id", "n", "tokens", "leaders", "leader"]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def document():
            doc_id, n = now
            tokens, leaders, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(tokens) < hits_needed(needed(n, share)):
                return None
            fits = (leaders != doc_id) & (sizes * share <= n * 100) & (n * share <= sizes * 100)
            found, first, hits = np.unique(leaders[fits], return_index=True, return_counts=True)
            enough = hits * LOOSER >= hits_needed(np.minimum(n, sizes[fits][first]))
            best = int(found[enough][hits[enough].argmax()]) if enough.any() else None
            return doc_id, n, tokens, leaders, best

        def batch(rows):
            ids, ns, tokens, leaders, best = zip(*rows, strict=True)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (tokens, leaders)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int32()), *lists, pa.array(best, pa.int64())], names)

        rows = []
        for frame in frames:
            ids, ns, tokens, leaders, sizes = (frame.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n", "token", "leader", "m"))
            cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (ns[1:] != ns[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if start == end:
                    continue
                key = int(ids[start]), int(ns[start])
                if key != now:
                    if held and (row := document()):
                        rows.append(row)
                    now, held = key, []
                held.append((tokens[start:end], leaders[start:end], sizes[start:end]))
            if rows:
                yield batch(rows)
                rows = []
        if held and (row := document()):
            yield batch([row])

    return run


def gather(index: DataFrame, share: int) -> DataFrame:
    """``(id, n, tokens, leaders, leader)`` of documents that may have links, from ``index (token, id, n, leader, m)``."""
    rows = index.select("id", "n", "token", "leader", "m").repartition("id").sortWithinPartitions("id", "n")
    return rows.mapInArrow(_gather(share), "id long, n int, tokens array<long>, leaders array<long>, leader long")


def leaders_of_salts(index: DataFrame, share: int) -> DataFrame:
    """``(a, b)``: a salted token's leaders follow the first of them, so that their groups are one."""
    own = index.where("salt > 0 and id = leader").select("token", "id", "n")
    firsts = own.groupBy("token").agg(F.min(F.struct("id", "n")).alias("first"))
    pairs = own.join(firsts, "token").select(F.col("first.id").alias("a"), F.col("first.n").alias("m"), F.col("id").alias("b"), "n")
    pairs = pairs.where("a <> b").where(compatible("n", "m", share)).groupBy("a", "b").agg(F.count("*").alias("hits"), F.min("n").alias("n"), F.min("m").alias("m"))
    return pairs.where(F.col("hits") * LOOSER >= _wanted("n", "m")).select("a", "b")


def torn_tokens(index: DataFrame, salted: DataFrame, group: DataFrame) -> DataFrame:
    """Tokens that documents of several groups hold: those of a document in another group than the token's leader, or whose leaders differ."""
    to = group.select(F.col("id").alias("to"), F.col("component").alias("led"))
    ties = index.select("id", F.explode(F.array_distinct("leaders")).alias("to")).join(group, "id", "left").join(to, "to", "left")
    ties = ties.where(F.coalesce("component", "id") != F.coalesce("led", "to")).groupBy("id").agg(F.collect_set("to").alias("foreign"))
    ties = write_stage(ties, "ngram-ties")
    # only these documents' tokens are exchanged
    bits = filter_bits(ties.count())
    pairs = index.select("id", "tokens", "leaders").mapInArrow(_among(filter_over(ties.select("id"), bits), bits), "id long, tokens array<long>, leaders array<long>").join(ties, "id").select("foreign", F.explode(F.arrays_zip("tokens", "leaders")).alias("z"))
    torn = pairs.where(F.array_contains("foreign", F.col("z.leaders"))).select(F.col("z.tokens").alias("token"))
    heads = salted.select("token", F.col("leader").alias("to")).distinct().join(to, "to", "left").select("token", F.coalesce("led", "to").alias("led"))
    several = heads.groupBy("token").agg(F.min("led").alias("low"), F.max("led").alias("high")).where("low <> high").select("token")
    return torn.union(several).distinct()


def owned_tokens(index: DataFrame, salted: DataFrame, group: DataFrame, share: int) -> DataFrame:
    """``(token, id, n, own)``: torn tokens of documents that hold enough of them for a link into another group."""
    tokens = write_stage(torn_tokens(index, salted, group), "ngram-torn")
    # few tokens are torn, so the others are left out before the exchange
    bits = filter_bits(tokens.count())
    listed = index.select("id", "n", "tokens").mapInArrow(_listed(filter_over(tokens.select(F.col("token").alias("id")), bits), bits), "id long, n int, token long")
    owned = listed.join(tokens, "token").join(group, "id", "left")
    return asking(write_stage(owned.select("token", "id", "n", F.coalesce("component", "id").alias("own")), "ngram-owned"), share)


def asking(owned: DataFrame, share: int) -> DataFrame:
    """``owned`` without documents that have too few tokens in other groups."""
    enough = owned.groupBy("id", "n").agg(F.count("*").alias("hits")).where(F.col("hits") >= _wanted("n", "n", share)).select("id")
    return write_stage(owned.join(enough.distinct(), "id", "left_semi"), "ngram-asking")


def merged_groups(owned: DataFrame, group: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """``(owned, group)`` after groups of one family have become one.

    Where a family of near copies lies in many groups, each of its documents would meet each
    of those under every token. Instead a document's group then joins the heaviest group of
    a token, the one with which it shares most, so a round costs one row per document and
    token. Merging loses no link, as members of a group all meet.
    """
    while True:
        weights = owned.groupBy("own").agg(F.count("*").alias("weight"))
        cells = owned.groupBy("token", "own").agg(F.count("*").alias("docs")).join(weights, "own").withColumn("rank", F.struct("weight", "own"))
        leads = cells.groupBy("token").agg(F.sum("docs").alias("docs"), F.max_by("docs", "rank").alias("led"), F.count("*").alias("groups"), F.max("rank").alias("lead"))
        leads = write_stage(leads.select("token", "docs", "led", "groups", F.col("lead.own").alias("lead")), "ngram-leads")
        # the heaviest group asks no other, so its documents make no rows
        meet = leads.agg(F.sum((F.col("docs") - F.col("led")) * (F.col("groups") - 1)).alias("rows"), F.sum("docs").alias("held")).first()
        if (meet["rows"] or 0) <= SPARE * (meet["held"] or 0):
            return owned, group
        hits = owned.join(leads.select("token", "lead"), "token").where("own <> lead").groupBy("id", "n", "own", "lead").agg(F.count("*").alias("hits"))
        hits = hits.where(F.col("hits") * LOOSER >= _wanted("n", "n", share))
        edges = hits.groupBy("id", "own").agg(F.max_by("lead", F.struct("hits", "lead")).alias("lead"))
        edges = write_stage(edges.select(F.col("own").alias("a"), F.col("lead").alias("b")).distinct(), "ngram-merging")
        if edges.isEmpty():
            return owned, group
        fresh = components(edges, "ngram-merged")
        to = fresh.select(F.col("id").alias("was"), F.col("component").alias("to"))
        renamed = group.join(to, group["component"] == to["was"], "left").select("id", F.coalesce("to", "component").alias("component"))
        group = write_stage(renamed.union(fresh.join(group, "id", "left_anti").select("id", "component")), "ngram-regrouped")
        owned = write_stage(owned.join(to, owned["own"] == to["was"], "left").select("token", "id", "n", F.coalesce("to", "own").alias("own")), "ngram-owned")
        torn = owned.groupBy("token").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high").select("token")
        owned = asking(owned.join(torn, "token", "left_semi"), share)


def near_groups(owned: DataFrame, share: int) -> DataFrame:
    """``(id, other)``: documents with the further groups that they may link with.

    The token-group matrix holds, per token and group, the range of set sizes. Of two
    similar documents in different groups, one finds at least ``hits_needed`` of its
    prefix tokens in the other's row, so groups with fewer are not opened for it. The one in
    the lighter group asks, so that a great group's documents do not each ask the small ones.
    """
    owned = write_stage(owned.join(owned.groupBy("own").agg(F.count("*").alias("weight")), "own"), "ngram-weighed")
    matrix = owned.groupBy("token", F.col("own").alias("other"), F.col("weight").alias("heavier")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (F.struct("weight", "own") < F.struct("heavier", "other")) & (F.col("least") * share <= F.col("n") * 100) & (F.col("n") * share <= F.col("most") * 100)
    near = owned.join(matrix, "token").where(fits).groupBy("id", "n", "other").agg(F.count("*").alias("hits"), F.min("least").alias("least"))
    smallest = F.greatest("least", -F.floor(-F.col("n") * share / 100))
    return near.where(F.col("hits") >= 1 + F.floor(F.least("n", smallest) / SLACK)).select("id", "other").distinct()


def ngram_groups(docs: DataFrame, share: int = SHARE, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs (doc_id, text)``.

    Two documents link when ``100 * |A and B| >= share * |A or B|`` over distinct
    ``width``-word shingles. Every link between different sets is honoured, though not every
    linked pair is visited:

    1. Documents are indexed under their rarest tokens (``_prefixes``).
    2. Each token's smallest document leads the others. A document joins the group of the
       leader with which it shares most, so similar documents lie in one group, linked or
       not.
    3. A group's whole sets meet in one task, or in parts of bounded size. There the token
       union with the members behind each token is held; a set whose overlap with the
       union cannot reach the similarity opens nothing, any other is compared with all
       members at once.
    4. The token-group matrix tells which further groups a document may link with
       (``near_groups``); it is sent to those as a query. Groups among which there would be
       many such meetings are merged before (``merged_groups``).
    5. Parts of one group share some members, which connect most of it. Members outside
       the largest component are then sent to the other parts.

    Defined results: null or wordless text has 0 shingles and is a component of its own. A
    null ``doc_id`` links with nothing and has a null component. Rows that repeat a
    ``doc_id`` are one document that links by any of its texts. A very long text is one
    set, as long as its words. Shingles are told apart by 64-bit keys. An empty table gives
    an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_bytes = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = sketch_bits(held_bytes)
    measured = write_stage(docs.mapInArrow(_measure(bits, width), "doc_id long, n_shingles long, part int, counts binary"), "ngram-sizes")
    sizes = measured.where("part is null").select("doc_id", "n_shingles")
    sketches = measured.where("part is not null").select("part", "counts").repartition("part").sortWithinPartitions("part")
    level = np.zeros((1 << (bits - CHUNK_BITS), 1 << CHUNK_BITS), dtype=np.uint8)
    # one row per chunk of the sketch, whatever the corpus
    for row in sketches.mapInArrow(_levels, "part int, level binary").collect():
        level[row["part"]] = np.frombuffer(row["level"], dtype=np.uint8)
    held = spark.sparkContext.broadcast(level.ravel())

    shared = write_stage(shared_tokens(docs, held, bits, share, width, held_bytes), "ngram-shared")
    copies = shared.where("head is not null").select(F.col("head").alias("a"), F.col("id").alias("b"))
    rows = shared.where("head is null")
    index = write_stage(gather(rows, share), "ngram-index")
    best = index.where("leader is not null").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    group = components(best.union(leaders_of_salts(rows, share)), "ngram-groups")
    owned, group = merged_groups(owned_tokens(index, rows.where("salt > 0"), group, share), group, share)
    members = write_stage(split_groups(group, index.groupBy("id").agg(F.max("n").alias("n"))), "ngram-members")
    near = write_stage(near_groups(owned, share), "ngram-near")

    # members of groups, single documents that are asked for, and queries
    parts = members.select("grp", "parts").distinct()
    asked = near.groupBy(F.col("other").alias("grp")).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts"))
    single = asked.select("grp").join(parts, "grp", "left_anti").select("grp", F.lit(0).alias("sub"), F.col("grp").alias("id"))
    inside = members.select("grp", "sub", "id").union(pivots(members)).union(single).join(asked, "grp", "left")
    inside = inside.select("grp", "sub", _numbers(F.coalesce("salts", F.lit(1)), "salt"), F.lit(0).alias("asks"), "id")
    queries = near.withColumnRenamed("other", "grp").join(parts, "grp", "left").join(asked, "grp")
    queries = queries.select("grp", _numbers(F.coalesce("parts", F.lit(1)), "sub"), _place(F.col("salts")).alias("salt"), F.lit(1).alias("asks"), "id")
    rows = write_stage(inside.union(queries).withColumn("comp", F.lit(None).cast("long")), "ngram-meetings")
    wanted = filter_bits(sizes.count())
    mask = filter_over(rows.select("id"), wanted)
    opened = write_stage(docs.mapInArrow(_opened(mask, wanted), "id long, packed binary"), "ngram-opened")
    links = copies.union(write_stage(met_links(rows, opened, share, width), "ngram-links"))

    split = members.where("parts > 1")
    if not split.isEmpty():
        known = write_stage(split.join(components(links, "ngram-parts"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component"), "ngram-known")
        largest = known.groupBy("grp", "comp").agg(F.count("*").alias("n")).groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"))
        left = known.join(largest, "grp").where("comp <> largest")
        left = left.select("grp", _numbers(F.col("parts"), "to"), "sub", "id", "comp").where("to <> sub").select("grp", F.col("to").alias("sub"), "id", "comp")
        salts = left.groupBy("grp", "sub").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts"))
        inside = known.join(salts, ["grp", "sub"]).select("grp", "sub", _numbers(F.col("salts"), "salt"), F.lit(0).alias("asks"), "id", "comp")
        left = left.join(salts, ["grp", "sub"]).select("grp", "sub", _place(F.col("salts")).alias("salt"), F.lit(1).alias("asks"), "id", "comp")
        links = links.union(write_stage(met_links(inside.union(left), opened, share, width), "ngram-links"))
    final = components(links, "ngram-final")
    return sizes.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_copies(docs: DataFrame, share: int = SHARE, width: int = WIDTH) -> DataFrame:
    """``docs`` with the smallest ``doc_id`` of each group; rows without an id stay."""
    groups = ngram_groups(docs, share, width).where("component_id = doc_id").select("doc_id").distinct()
    return docs.where("doc_id is not null").join(groups, "doc_id", "left_semi").select(docs.columns).union(docs.where("doc_id is null"))
