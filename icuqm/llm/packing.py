"""Best-fit packing by a configuration linear program over the length histogram."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from icuqm.llm.text import batches_of
from icuqm.session import write_stage

ROOM = 4096
END_ID = 1
#: Words whose ids a task remembers; beyond it the memory starts anew.
MEMORY = 400_000
#: New words that are split at once, and bytes of texts that are split at once, unless one text is longer.
TOGETHER = 4096
HELD = 1 << 23
#: Multiplicative weights: the gap between cover and bound at which they end, the most rounds at first and for what is left, how far weights move,
#: what a round's excess counts at most, how near the dearest pattern others are used.
GAP = 0.005
ROUNDS = 30
LATER = 3
RATE = 0.5
WIDTH = 2.0
NEAR = 0.002
#: Shares of the cover that rounding tries, and the share of pieces that makes solving once more worth while.
SHARES = (1.0, 0.95, 0.9, 0.8, 0.65, 0.5, 0.35, 0.2, 0.1, 0.05)
FEW = 0.03
#: Rows of one length that one task numbers.
PER_TASK = 250_000


#: Words of printable ASCII and precomposed Latin letters, and how the vocabulary splits them.
SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
SIMPLES = re.compile("[\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\na-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def shown_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where printable, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


SHOWN = shown_bytes()


class WordIds:
    """Ids of whole texts, word by word.

    The vocabulary's normalizer and splitter never join across ASCII white space, so a
    text's ids are those of its words one after another, and a word's are remembered. The
    new words of several texts are split and looked up together.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[bytes, bytes] = {b"": b""}
        self.parts: dict[str, bytes] = {}

        self.tokens = self.library.model.tokenize

    def _part(self, part: str) -> bytes:
        # printable ASCII stands for itself
        shown = part if part.isascii() else "".join([SHOWN[b] for b in part.encode()])
        ids = [t.id for t in self.tokens(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[bytes]) -> None:
        known, parts = self.known, self.parts
        texts = b"\n".join(words).decode("utf-8", "replace")
        if not SIMPLES.fullmatch(texts) or "<|" in texts:
            plain = []
            for word, text in zip(words, texts.split("\n"), strict=True):
                if SIMPLE.fullmatch(text) and "<|" not in text:
                    plain.append(word)
                else:
                    known[word] = self._whole(text)
            words, texts = plain, b"\n".join(plain).decode()
        if not words:
            return
        # such words are unchanged by the normalizer but for their case, and split by SPLIT
        lower = texts.lower()
        if len(parts) > MEMORY:
            parts.clear()
        for part in set(SPLIT.findall(lower)).difference(parts):
            parts[part] = self._part(part)
        own = parts.__getitem__
        for word, text in zip(words, lower.split("\n"), strict=True):
            # a part alone is split no further
            known[word] = parts[text] if text in parts else b"".join(map(own, SPLIT.findall(text)))

    def of_all(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """Little-endian unsigned 32-bit ids of all texts, one after another, and the byte at which each begins."""
        known = self.known
        # white space in ASCII is what bytes.split() cuts at; ends of a text may give empty words
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.binary()), b"").view(pa.string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.view(pa.binary()).to_pylist()
        if len(known) > MEMORY:
            known.clear()
            known[b""] = b""
        new = [w for w in distinct if w not in known]
        for start in range(0, len(new), TOGETHER):
            self._learn(new[start : start + TOGETHER])
        ids = pa.array([known[w] for w in distinct], pa.large_binary()).take(coded.indices)
        _, starts, data = ids.buffers()
        places = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
        starts = np.frombuffer(starts, dtype=np.int64)[ids.offset :] if len(ids) else np.zeros(1, dtype=np.int64)
        return memoryview(data or b""), starts[places]

    def of(self, data: bytes) -> bytes:
        ids, starts = self.of_all(pa.array([data], pa.binary()))
        return bytes(ids[starts[0] : starts[1]])


def _shares(frame: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in order, as many at once as ``HELD`` bytes of text take, one at least."""
    sizes = pc.fill_null(pc.binary_length(frame.column("text")), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + HELD, "right")))
        yield frame.slice(start, end - start)
        start = end


def _pieces(path: str, room: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds(path).of_all
        end = struct.pack("<I", END_ID)
        for frame in chain.from_iterable(map(_shares, batches_of(frames))):
            out: list[list] = [[], [], [], [], []]
            coded, starts = encode(frame.column("text"))
            for doc_id, first, last in zip(frame.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                ids = bytes(coded[first:last]) + end
                for piece, start in enumerate(range(0, len(ids) // 4, room)):
                    part = ids[4 * start : 4 * (start + room)]
                    for column, value in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


Pattern = dict[int, int]


def knapsack(prices: np.ndarray, lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity the greatest price of a pattern within it and the last length taken, -1 for none: an unbounded knapsack."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1, dtype=np.int64)
    fits = np.searchsorted(lengths, np.arange(room + 1), "right")
    for c in range(int(lengths[0]), room + 1):
        worth = best[c - lengths[: fits[c]]] + prices[: fits[c]]
        k = int(worth.argmax())
        if worth[k] > best[c - 1]:
            best[c], choice[c] = worth[k], k
        else:
            best[c] = best[c - 1]
    return best, choice


class Pricing:
    """Patterns that are dear under the prices of one round, taken from the knapsack's table."""

    def __init__(self, prices: np.ndarray, lengths: np.ndarray, room: int):
        self.prices, self.lengths, self.room = prices, lengths, room
        self.best, self.choice = knapsack(prices, lengths, room)
        self.fits = np.searchsorted(lengths, np.arange(room + 1), "right")
        self.dearest = self.best[room]

    def pattern_with(self, first: int, lack: np.ndarray) -> tuple[dict[int, int], bool]:
        """A pattern, by places, that holds ``first``, and whether it is near the dearest.

        Each next piece is, of those that keep the pattern near the dearest one with
        ``first``, the one of which most tokens are still to be covered.
        """
        pattern, c = {first: 1}, self.room - int(self.lengths[first])
        loss = self.dearest - self.prices[first] - self.best[c]
        near = loss <= NEAR * self.dearest
        slack = NEAR * self.dearest - (loss if near else 0.0)
        while c > 0:
            k = int(self.fits[c])
            if k and self.best[c] > 0:
                below = self.best[c] - (self.best[c - self.lengths[:k]] + self.prices[:k])
                tokens = np.where(below <= slack, lack[:k] * self.lengths[:k], -1.0)
                i = int(tokens.argmax())
                if tokens[i] <= 0:
                    i = int(below.argmin())
                if below[i] > slack:
                    break
                slack -= max(below[i], 0.0)
                pattern[i] = pattern.get(i, 0) + 1
                c -= int(self.lengths[i])
            else:
                break
        return pattern, near

    def cover(self, need: np.ndarray) -> tuple[list[tuple[dict[int, int], float]], np.ndarray]:
        """Patterns with weights that hold every length at least as often as needed, and how often those near the dearest hold each."""
        lack, used, held = need.copy(), [], np.zeros(len(need))
        for i in range(len(need) - 1, -1, -1):
            while lack[i] > 1e-9:
                pattern, near = self.pattern_with(i, lack)
                weight = min(lack[k] / a for k, a in pattern.items() if lack[k] > 1e-9)
                used.append((pattern, weight))
                for k, a in pattern.items():
                    lack[k] = max(lack[k] - a * weight, 0.0)
                    held[k] += a * weight * near
        return used, held


def covering(counts: Pattern, room: int, gap: float = GAP, rounds: int = ROUNDS) -> tuple[list[tuple[Pattern, float]], float]:
    """Patterns with weights that together cover every piece of ``counts``, and a lower bound of their sum.

    The program: least sum of weights such that the patterns hold each length at least as
    often as it occurs. Multiplicative weights: each length has a weight, its price is the
    weight by count. A knapsack under the prices tells the dearest patterns; a round covers
    all lengths with patterns near these as far as there are any. Weights then fall where
    near patterns cover more than needed and rise where they cover less. Prices divided by
    the dearest pattern's are a solution of the dual, hence the bound. It ends when the
    best cover is within ``gap`` of the best bound; ``rounds`` only bounds the work, as every
    round's cover is whole.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    need = np.array([counts[int(x)] for x in lengths], dtype=np.float64)
    weights, bound, least, found = need * lengths, 0.0, np.inf, []
    for _ in range(rounds):
        weights = weights / weights.sum()
        pricing = Pricing(weights / need, lengths, room)
        bound = max(bound, 1.0 / pricing.dearest)
        used, held = pricing.cover(need)
        total = sum(w for _, w in used)
        if total < least:
            least, found = total, used
        if least <= (1 + gap) * bound:
            break
        weights = weights * np.exp(-RATE * np.minimum(held / need - 1, WIDTH))
    return [({int(lengths[k]): a for k, a in pattern.items()}, w) for pattern, w in found], bound


def best_fit(counts: Pattern, room: int, opened: list[tuple[Pattern, int]] = ()) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on a histogram: alike pieces meet alike gaps in one step. ``opened`` sequences are filled up too."""
    gaps: dict[int, list] = {}
    for pattern, many in opened:
        gaps.setdefault(room - sum(x * a for x, a in pattern.items()), []).append((pattern, many))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fit = min((g for g in gaps if g >= length), default=None)
            if fit is None:
                each = room // length
                for pattern, many in (({length: each}, left // each), ({length: left % each}, 1 if left % each else 0)):
                    if many:
                        gaps.setdefault(room - sum(x * a for x, a in pattern.items()), []).append((pattern, many))
                break
            pattern, many = gaps[fit].pop()
            if not gaps[fit]:
                del gaps[fit]
            each = fit // length
            take = min(many, left // each) or 1
            each = min(each, left)
            filled = pattern | {length: pattern.get(length, 0) + each}
            left -= each * take
            gaps.setdefault(fit - each * length, []).append((filled, take))
            if many > take:
                gaps.setdefault(fit, []).append((pattern, many - take))
    return [x for own in gaps.values() for x in own]


def rounded(patterns: list[tuple[Pattern, float]], counts: Pattern) -> tuple[list[tuple[Pattern, int]], Pattern]:
    """Whole numbers of the patterns within ``counts``, in their order, and what they leave. Fractions pass on to the next pattern."""
    left, chosen, owed = dict(counts), [], 0.0
    for pattern, weight in patterns:
        owed += weight
        many = min(int(owed + 1e-9), *(left[x] // a for x, a in pattern.items()))
        if many > 0:
            owed -= many
            chosen.append((pattern, many))
            for x, a in pattern.items():
                left[x] -= a * many
    return chosen, {x: n for x, n in left.items() if n}


def _sequences(plan: list[tuple[Pattern, int]]) -> int:
    return sum(many for _, many in plan)


def program(counts: Pattern, room: int = ROOM) -> tuple[list[tuple[Pattern, int]], Pattern, float]:
    """Whole patterns from the program, the pieces they leave, and the program's lower bound of sequences.

    The cover is rounded in shares, fullest patterns first, and what a share leaves is
    packed by best fit. The greatest share that needs no more sequences than were found so
    far, best fit alone being the first, is kept, and the program is solved again for what
    it leaves, until that keeps few pieces more.
    """
    left, chosen, bound = {x: n for x, n in counts.items() if n}, [], 0.0
    fewest = _sequences(best_fit(left, room))
    while left:
        patterns, least = covering(left, room, rounds=ROUNDS if not bound else LATER)
        bound = bound or least
        patterns.sort(key=lambda p: (-sum(x * a for x, a in p[0].items()), -p[1]))
        tried = []
        for share in SHARES:
            more, rest = rounded(patterns[: math.ceil(len(patterns) * share)], left)
            tried.append((_sequences(best_fit(rest, room, chosen + more)), sum(rest.values()), more, rest))
        total, pieces, more, rest = min(tried, key=lambda t: t[:2])
        if total > fewest:
            break
        before, fewest = sum(left.values()), total
        chosen, left = chosen + more, rest
        if before - pieces < FEW * before:
            break
    return chosen, left, bound


def plan(counts: Pattern, room: int = ROOM) -> list[tuple[Pattern, int]]:
    """Patterns with how many sequences follow each; together they hold every piece exactly once.

    The pieces that the program leaves fill its patterns' gaps and further sequences by best fit.
    """
    chosen, left, _ = program(counts, room)
    return best_fit(left, room, chosen)


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length the runs of places: first rank, pattern's first sequence, places in each, offset of the first."""
    runs: dict[int, list] = {}
    taken: dict[int, int] = {}
    first = 0
    for pattern, many in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            each = pattern[length]
            runs.setdefault(length, []).append((taken.get(length, 0), first, each, offset))
            taken[length] = taken.get(length, 0) + each * many
            offset += each * length
        first += many
    return {x: np.array(r, dtype=np.int64) for x, r in runs.items()}


def _place(slots):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for frame in frames:
            lengths, ranks = (frame.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(ranks), dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                runs = table[int(length)]
                own = runs[np.searchsorted(runs[:, 0], ranks[at], "right") - 1]
                k = ranks[at] - own[:, 0]
                sequence[at], offset[at] = own[:, 1] + k // own[:, 2], own[:, 3] + (k % own[:, 2]) * length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(frame.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, room: int = ROOM) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece of ``docs (doc_id, text)``.

    A document is its ids and the end id; one longer than ``room`` is cut into pieces. The
    histogram of piece lengths, at most ``room`` numbers whatever the corpus, gives the
    plan. Pieces are then numbered within their length, in salted parts whose counts are
    summed, and a number's place in the plan is its sequence and offset. The plan also is a
    table over lengths, so both broadcasts are bounded by ``room`` and the rounds.

    Defined results: null text is empty and gives the end id alone; a very long text is cut
    into as many pieces as it takes; a null ``doc_id`` and repeated rows are packed like any;
    an empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = write_stage(docs.mapInArrow(_pieces(tokenizer, room), "doc_id long, piece int, start long, length long, ids_crc32 long"), "packing-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(counts, room)))
    parts = 1 + max(counts.values(), default=0) // PER_TASK
    salted = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = salted.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn("first", before).drop("n")
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("own", own).join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("own"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(_place(slots), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
