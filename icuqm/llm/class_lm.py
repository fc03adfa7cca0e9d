"""Class-based bigram scoring: exchange clustering puts words in classes; classes follow classes and emit words."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.llm.text import batches_of, byte_texts, word_keys, words_of
from icuqm.session import write_stage

#: Most frequent words that the exchange clusters first, word by word; against their classes every
#: other word from ``LEAST`` occurrences on then finds its own, however many there are.
CLUSTERED = 4096
LEAST = 5
#: How many words' counts every task holds, the most frequent ones; it bounds a broadcast. What is
#: known of the others is joined, so it steers cost alone as long as it is above ``CLUSTERED``.
HELD = 1 << 20
#: Classes of the exchange, then one class for text ends, then one for each shape of other words.
CLASSES = 64
EXCHANGES = 5
#: Weight of the class frequencies in the smoothed transitions.
PRIOR = 20.0
#: Distinct words or tokens that a task gathers before it passes them on.
GATHERED = 400_000
END = b"\x00end"
TAILS = {ord("."): 1, ord(","): 2, ord("!"): 3, ord("?"): 3, ord(";"): 3, ord(":"): 3}
SHAPES = 5 * 5 * 3


def shape_of(word: bytes) -> int:
    """Class of a word by its look: its first letter beyond ASCII, its end and its length."""
    accent = 0
    if not word.isascii():
        accent = 1 + next(word[i + 1] for i in range(len(word) - 1) if word[i] >= 0xC0) % 4
    last = word[-1]
    tail = TAILS.get(last, 0 if last >= 128 or chr(last).isalpha() else 4)
    return (accent * 5 + tail) * 3 + (0 if len(word) <= 4 else 1 if len(word) <= 9 else 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, shape, n)`` of words; the end of each text counts as a word of its own."""

    def told(ids, counts):
        words = list(ids)
        keys, shapes = word_keys(words), [-1 if w == END else shape_of(w) for w in words]
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(shapes, pa.int32()), pa.array(counts)], ["key", "shape", "n"])

    ids, counts = defaultdict(count().__next__), np.zeros(0, dtype=np.int64)
    for frame in batches_of(frames, 500):
        own = [np.fromiter(map(ids.__getitem__, [*words_of(d), END]), dtype=np.int64) for d in byte_texts(frame.column("text"))]
        if own:
            new = np.bincount(np.concatenate(own), minlength=len(ids))
            new[: len(counts)] += counts
            counts = new
        if len(ids) > GATHERED:
            yield told(ids, counts)
            ids, counts = defaultdict(count().__next__), np.zeros(0, dtype=np.int64)
    if len(ids):
        yield told(ids, counts)


def _numbered(held):
    """A row per text with a number for each word: its rank if it is held, else -1 less its place among the text's ``rare`` keys."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks = held.value
        schema = pa.schema([("rid", pa.string()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("ids", pa.binary()), ("rare", pa.list_(pa.int64())), ("shapes", pa.binary())])
        rare_keys: list[int] = []
        rare_shapes: list[int] = []
        places: dict[bytes, int] = {}
        limit = len(keys)

        def learn(new):
            asked = word_keys(new)
            at = np.minimum(np.searchsorted(keys, asked), max(limit - 1, 0))
            found = keys[at] == asked if limit else np.zeros(len(new), dtype=bool)
            places.update((new[i], int(ranks[at[i]])) for i in np.flatnonzero(found).tolist())
            for i in np.flatnonzero(~found).tolist():
                places[new[i]] = limit + len(rare_keys)
                rare_keys.append(int(asked[i : i + 1].view(np.int64)[0]))
                rare_shapes.append(shape_of(new[i]))

        for frame in batches_of(frames, 500):
            if len(places) > GATHERED:
                places.clear()
                rare_keys.clear()
                rare_shapes.clear()
            texts = [words_of(data) for data in byte_texts(frame.column("text"))]
            learn(list(set().union(*texts).difference(places)))
            out: list[list] = [[] for _ in schema]
            for doc_id, train, words in zip(frame.column("doc_id").to_pylist(), frame.column("train").to_pylist(), texts, strict=True):
                ids = np.fromiter(map(places.__getitem__, words), dtype=np.int64, count=len(words))
                rare = ids >= limit
                distinct, at = np.unique(ids[rare] - limit, return_inverse=True)
                ids[rare] = -1 - at
                own = distinct.tolist()
                values = (uuid.uuid4().hex, doc_id, train, ids.astype(np.int32).tobytes(), [rare_keys[i] for i in own], bytes([rare_shapes[i] for i in own]))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return run


def _told(frame: pa.RecordBatch, table: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row its numbers and their values in ``table``; a word that is not held has its joined class, else ``first`` and its shape."""
    for ids, shapes, far in zip(frame.column("ids").to_pylist(), frame.column("shapes").to_pylist(), frame.column("far").to_pylist(), strict=True):
        ids = np.frombuffer(ids, dtype=np.int32).astype(np.int64)
        rare = first + np.frombuffer(shapes, dtype=np.uint8).astype(np.int64)
        for x in far or ():
            rare[x["j"]] = x["class"]
        values, beyond = table[np.maximum(ids, 0)], ids < 0
        values[beyond] = rare[-1 - ids[beyond]]
        yield ids, values


def _pairs(numbers):
    """``(pair, n)`` of neighbouring words; a word outside the first clustered counts as its shape, text ends as number 0 beyond."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def told():
            pairs, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

        for frame in frames:
            for _, own in _told(frame, numbers.value, CLUSTERED + 1):
                ids = np.full(len(own) + 2, CLUSTERED, dtype=np.int64)
                ids[1:-1] = own
                waiting.append((ids[:-1] << 20) | ids[1:])
                size += len(ids)
            if size > 10 * GATHERED:
                yield told()
                waiting, size = [], 0
        if waiting:
            yield told()

    return run


def _contexts(model, first: int, clustered: int, far: bool):
    """``(key, rank, cell, n)``: how often a word stands behind each class and, in cells from the width on, before it.

    The words are those held with a rank from ``first`` to ``clustered`` and, if ``far``, all that are not held.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = model.value
        wide = CLASSES + 1 + SHAPES
        waiting, size, names = [], 0, ["key", "rank", "cell", "n"]

        def told():
            cells, n = np.unique(np.concatenate(waiting), return_counts=True)
            ranks = cells // (2 * wide)
            columns = [keys[ranks].view(np.int64), ranks.astype(np.int32), (cells % (2 * wide)).astype(np.int32), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for frame in frames:
            beyond = []
            every = frame.column("rare").to_pylist() if far else [None] * frame.num_rows
            for (ids, own), rare in zip(_told(frame, table, CLASSES + 1), every, strict=True):
                line = np.full(len(own) + 2, CLASSES, dtype=np.int64)
                line[1:-1] = own
                cells = np.stack([line[:-2], wide + line[2:]])
                take = (ids >= first) & (ids < clustered)
                waiting.append((ids[take] * (2 * wide) + cells[:, take]).ravel())
                size += len(waiting[-1])
                if rare:
                    take = ids < 0
                    beyond.append((np.tile(np.array(rare)[-1 - ids[take]], 2), cells[:, take].ravel()))
            if beyond:
                found, cells = (np.concatenate(x) for x in zip(*beyond, strict=True))
                columns = [found, np.full(len(found), -1, dtype=np.int32), cells.astype(np.int32), np.ones(len(found), dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
            if size > 10 * GATHERED:
                yield told()
                waiting, size = [], 0
        if size:
            yield told()

    return run


def _assigned(cells):
    """``(key, rank, class)``: each word's best class against the counts of class after class. Rows come sorted by word."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = cells.value.astype(np.float64)
        size, wide = np.maximum(total.sum(axis=1), 1.0), len(total)
        flow = np.log((total + 0.1) / (size[:, None] + 0.1 * wide))

        def best(rows):
            key, rank, cell, n = rows
            words, at, word = np.unique(key, return_index=True, return_inverse=True)
            counts = np.zeros((len(words), 2 * wide))
            np.add.at(counts, (word, cell), n)
            before, behind = counts[:, :wide], counts[:, wide:]
            mass = before.sum(axis=1, keepdims=True)
            gain = before @ flow[:, :CLASSES] + behind @ flow[:CLASSES].T - mass * np.log(size[:CLASSES] + mass)
            columns = [words, rank[at], gain.argmax(axis=1).astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "rank", "class"])

        rest = None
        for frame in frames:
            rows = [frame.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rank", "cell", "n")]
            rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            if not len(rows[0]):
                continue
            # the last word may go on in the next batch
            cut = int(np.flatnonzero(rows[0] == rows[0][-1])[0])
            if cut:
                yield best([x[:cut] for x in rows])
            rest = [x[cut:] for x in rows]
        if rest is not None:
            yield best(rest)

    return run


def _flows(table):
    """``(cell, n)``: counts of class after class in whole texts."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = CLASSES + 1 + SHAPES
        total = np.zeros(wide * wide, dtype=np.int64)
        for frame in frames:
            for _, own in _told(frame, table.value, CLASSES + 1):
                line = np.full(len(own) + 2, CLASSES, dtype=np.int64)
                line[1:-1] = own
                np.add.at(total, line[:-1] * wide + line[1:], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return run


def _transitions(classes):
    """``(cell, n)``: counts of class after class."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = classes.value
        wide = CLASSES + 1 + SHAPES
        total = np.zeros(wide * wide)
        for frame in frames:
            pairs = frame.column("pair").to_numpy(zero_copy_only=False)
            n = frame.column("n").to_numpy(zero_copy_only=False)
            total += np.bincount(of[pairs >> 20] * wide + of[pairs & 0xFFFFF], weights=n, minlength=wide * wide)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["cell", "n"])

    return run


def _exchange(classes, cells):
    """``(word, class)``: each word of a partition moves to its best class, and later words see the move.

    A partition holds all pairs of its words, sorted by word: as ``(word, other, after, n)``.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = classes.value.copy(), cells.value.astype(np.float64).copy()
        size, wide = total.sum(axis=1), len(total)
        words, classes_out = [], []
        counts, own = np.zeros((2, CLUSTERED * wide)), np.zeros(CLUSTERED)
        for frame in frames:
            word, other, after, n = (frame.column(c).to_numpy(zero_copy_only=False) for c in ("word", "other", "after", "n"))
            np.add.at(counts, (after, word * wide + of[other]), n)
            # a word beside itself stands on both sides
            same = (word == other) & (after == 1)
            np.add.at(own, word[same], n[same])
        counts = counts.reshape(2, CLUSTERED, wide)
        mine = np.flatnonzero(counts.sum(axis=(0, 2)))
        for w in mine.tolist():
            before, behind = counts[0, w], counts[1, w]
            now, mass = of[w], before.sum()
            total[:, now] -= before
            total[now, :] -= behind
            total[now, now] += own[w]
            size = np.maximum(total.sum(axis=1), 1.0)
            # classes of neighbours that moved in this round leave small negative rests
            flow = np.log((np.maximum(total, 0.0) + 0.1) / (size[:, None] + 0.1 * wide))
            gain = before @ flow[:, :CLASSES] + flow[:CLASSES] @ behind - mass * np.log(size[:CLASSES] + mass)
            best = int(np.argmax(gain))
            total[:, best] += before
            total[best, :] += behind
            total[best, best] -= own[w]
            of[w] = best
            words.append(w)
            classes_out.append(best)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int32()), pa.array(classes_out, pa.int32())], ["word", "class"])

    return run


def _matrix(counted: DataFrame) -> np.ndarray:
    """Counts of class after class; at most as many rows as cells come to the driver."""
    wide = CLASSES + 1 + SHAPES
    cells = np.zeros(wide * wide, dtype=np.int64)
    for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[r["cell"]] = r["n"]
    return cells.reshape(wide, wide)


def cluster(pairs: DataFrame, clustered: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each number and the counts of class after class, by parallel exchange.

    Words start dealt over the classes by rank. In a round every partition moves its own
    words one after another against the counts of the round's start; then counts are taken
    anew from all pairs.
    """
    spark = pairs.sparkSession

    def counted():
        return _matrix(pairs.mapInArrow(_transitions(spark.sparkContext.broadcast(of)), "cell long, n long"))

    of = np.concatenate([np.arange(CLUSTERED) % CLASSES, np.full(1, CLASSES), CLASSES + 1 + np.arange(SHAPES)])
    word, other = (F.shiftright("pair", 20).cast("int"), F.col("pair").bitwiseAND(0xFFFFF).cast("int"))
    sides = pairs.select(F.inline(F.array(F.struct(other.alias("word"), word.alias("other"), F.lit(0).alias("after"), "n"), F.struct(word.alias("word"), other.alias("other"), F.lit(1).alias("after"), "n"))))
    sides = write_stage(sides.where(F.col("word") < clustered).repartition(8, "word"), "lm-sides")
    cells = counted()
    for _ in range(EXCHANGES):
        moved = sides.repartition(8, "word").mapInArrow(_exchange(spark.sparkContext.broadcast(of), spark.sparkContext.broadcast(cells)), "word int, class int").collect()
        for r in moved:
            of[r["word"]] = r["class"]
        cells = counted()
    return of, cells


def _scored(model):
    """A row per document with its sums, and a row per distinct word whose count the task does not hold."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, flow, emit, base = model.value
        schema = pa.schema([("rid", pa.string()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("key", pa.int64()), ("shape", pa.int32()), ("n", pa.int64())])
        for frame in batches_of(frames, 500):
            out: list[list] = [[] for _ in schema]
            columns = (frame.column(c).to_pylist() for c in ("rid", "doc_id", "rare", "shapes"))
            for (ids, own), rid, doc_id, rare, shapes in zip(_told(frame, table, CLASSES + 1), *columns, strict=True):
                line = np.full(len(ids) + 2, CLASSES, dtype=np.int64)
                line[1:-1] = own
                held = ids[ids >= 0]
                score = float(flow[line[:-1], line[1:]].sum() + emit[held].sum())
                for column, value in zip(out, (rid, doc_id, len(ids) + 1, len(held) + 1, float(base[held].sum()), score, None, None, None), strict=True):
                    column.append(value)
                k = len(rare)
                n = np.bincount(-1 - ids[ids < 0], minlength=k).tolist()
                for column, values in zip(out, ([rid] * k, *[[None] * k] * 5, rare, list(shapes), n), strict=True):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return run


def score(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs (doc_id, text)``.

    Counts cover all texts that are not held out. Every word seen ``LEAST`` times or more is
    clustered: the most frequent ones by exchange, then each other one by its counts beside
    their classes, gathered and compared in partitions by word. Rarer and unseen words
    belong to the class of their shape. ``score`` is the log10
    probability of a text: of each class after the one before, smoothed with the class
    frequencies, times that of the word in its class. In a shape class the words seen once
    tell how much goes to unseen words; seen words share the rest by their counts. Counts
    of words that are not held by every task are joined, so no count is left out.

    Classes of words that are not held are joined like their counts.

    Defined results: null text is empty and scores its end alone; a null ``doc_id`` is not
    held out; repeated rows score alike and all count; with no training text nothing is
    known and the priors score; an empty table gives an empty result; further columns are
    ignored. Words are told apart by 64-bit keys.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("train", ~held_out(F.col("doc_id")))
    train = docs.where("train").select("text")
    words = train.mapInArrow(_counted, "key long, shape int, n long").groupBy("key").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))
    words = write_stage(words, "lm-words")
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("shape") < 0, F.col("n"))).alias("ends"), F.count(F.when((F.col("shape") >= 0) & (F.col("n") >= LEAST), 1)).alias("often")).first()
    tokens, types = sums["n"] or 0, sums["v"]
    # frequency levels in eighths of a doubling, a few hundred at most, tell from which level on words are held;
    # of the level that fits in part the most frequent words are, ties by key
    level, left, lowest, border = F.floor(F.log2("n") * 8), HELD, None, None
    for r in sorted(words.where("shape >= 0").groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        if r["count"] > left:
            border = r["level"]
            break
        left -= r["count"]
        lowest = r["level"]
    known = words.where("shape >= 0")
    top = known.where(F.lit(False) if lowest is None else level >= lowest)
    if border is not None and left:
        top = top.union(known.where(level == border).orderBy(F.desc("n"), "key").limit(left))
    top = top.toArrow()
    keys, shapes, counts = (top.column(c).to_numpy().astype(np.int64) for c in ("key", "shape", "n"))
    order = np.lexsort((keys, -counts))
    keys, shapes, counts = keys[order].view(np.uint64), shapes[order], counts[order]
    del top
    order = np.argsort(keys)
    keys, ranks = keys[order], order.astype(np.int64)

    share_out = spark.sparkContext.broadcast
    numbered = "rid string, doc_id long, train boolean, ids binary, rare array<long>, shapes binary"
    rows = write_stage(docs.mapInArrow(_numbered(share_out((keys, ranks))), numbered), "lm-ids")
    rows = rows.withColumn("far", F.lit(None).cast("array<struct<j:int,class:int>>"))
    clustered = int((counts >= LEAST).sum())
    first, far = min(CLUSTERED, clustered), sums["often"] > clustered
    # tables over ranks have one entry more, so that they also serve where no word is held
    numbers = np.append(CLUSTERED + 1 + shapes, 0)
    numbers[:first] = np.arange(first)
    pairs = rows.where("train").mapInArrow(_pairs(share_out(numbers)), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of, cells = cluster(write_stage(pairs, "lm-pairs"), first)

    table = np.append(CLASSES + 1 + shapes, 0)
    table[:first] = of[:first]
    ranked = np.zeros(len(counts) + 1, dtype=np.uint64)
    ranked[ranks] = keys
    beside = rows.where("train").mapInArrow(_contexts(share_out((ranked, table)), first, clustered, far), "key long, rank int, cell int, n long")
    beside = beside.repartition("key")
    if far:
        near = F.col("rank") >= 0
        often = words.where((F.col("shape") >= 0) & (F.col("n") >= LEAST)).select("key")
        beside = beside.where(near).unionByName(beside.where(~near).join(often, "key", "left_semi").select(beside.columns)).repartition("key")
    others = beside.sortWithinPartitions("key").mapInArrow(_assigned(share_out(cells)), "key long, rank int, class int")
    others = write_stage(others, "lm-classes")
    table = table.copy()
    found = others.where("rank >= 0").select("rank", "class").toArrow()
    table[found.column("rank").to_numpy()] = found.column("class").to_numpy()
    del found
    beyond = others.where("rank < 0").select("key", "class")
    if far:
        own = rows.select("rid", F.posexplode("rare").alias("j", "key")).join(beyond, "key")
        own = own.groupBy("rid").agg(F.collect_list(F.struct("j", "class")).alias("far"))
        rows = write_stage(rows.drop("far").join(own, "rid", "left"), "lm-classed")
    cells = _matrix(rows.where("train").mapInArrow(_flows(share_out(table)), "cell long, n long"))

    share = (cells.sum(axis=0) + 0.5) / (cells.sum() + 0.5 * len(cells))
    flow = np.log10((cells + PRIOR * share) / (cells.sum(axis=1, keepdims=True) + PRIOR))
    # words of shape classes: all tokens, and words seen once
    total, once = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in words.where((F.col("shape") >= 0) & (F.col("n") < LEAST)).groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 1, 1)).alias("once")).collect():
        total[r["shape"]], once[r["shape"]] = r["n"], r["once"]
    unseen = (once + 0.5) / (total + 1.0)
    seen = np.log10((1 - unseen) / np.maximum(total, 1.0))

    # tokens of a class are those that follow anything
    inside = np.log10(np.maximum(cells.sum(axis=0)[:CLASSES], 1))
    emit = seen[shapes] + np.log10(np.maximum(counts, 1))
    emit[:clustered] = np.log10(counts[:clustered]) - inside[table[:clustered]]
    scale = float(np.log10(tokens + types + 1))
    base = np.log10(counts + 1.0) - scale
    rows = rows.mapInArrow(_scored(share_out((table, flow, emit, base))), "rid string, doc_id long, n_tokens long, n_known long, base_score double, score double, key long, shape int, n long")
    rows = write_stage(rows, "lm-rows")
    rare = rows.where("key is not null").select("rid", "key", "shape", "n").join(words.select("key", F.col("n").alias("c")), "key", "left")
    rare = rare.join(beyond, "key", "left") if far else rare.withColumn("class", F.lit(None).cast("int"))
    c = F.coalesce(F.col("c"), F.lit(0))
    of_shape = [F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("shape")) for values in (seen, np.log10(unseen))]
    of_class = F.get(F.array(*[F.lit(float(x)) for x in inside]), F.col("class"))
    own = F.when(F.col("class").isNotNull(), F.log10(c) - of_class).when(c > 0, of_shape[0] + F.log10(c)).otherwise(of_shape[1])
    rare = rare.groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("n"))).alias("known"),
        F.sum(F.col("n") * (F.log10(c + 1) - scale)).alias("base"),
        F.sum(F.col("n") * own).alias("own"),
    )
    ends = float(np.log10((sums["ends"] or 0) + 1) - scale)
    none = F.lit(0.0)
    return rows.where("key is null").join(rare, "rid", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") - (0 if sums["ends"] else 1) + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", none) + ends).alias("base_score"),
        (F.col("score") + F.coalesce("own", none)).alias("score"),
    )
