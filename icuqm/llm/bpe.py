"""Byte-pair encoding by contiguous rank arrays, and its inverse."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.llm.packing import SHOWN
from icuqm.llm.text import batches_of, byte_texts

#: The splitting pattern of the vocabulary (fixed value), and the same for texts of ASCII only.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|[^\S]+(?!\S)|\s+"
#: Longest word, in bytes, whose ranks are scanned; the minimum of a longer one comes from a heap.
SHORT = 256
#: Words whose ids a task remembers; beyond it the memory starts anew.
MEMORY = 500_000
NEVER = 1 << 62
ID_BITS = 20


class ByteBpe:
    """The encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        byte_of = {c: b for b, c in enumerate(SHOWN)}
        vocab = told["model"]["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.byte_ids = [vocab[c] for c in SHOWN]
        # for two neighbouring ids: rank of their merge above, id of the result below
        self.merges = {}
        for rank, pair in enumerate(told["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[(vocab[a] << ID_BITS) | vocab[b]] = (rank << ID_BITS) | vocab[a + b]
        special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        self.special = {t: struct.pack("<I", i) for t, i in special.items()}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        self.wide, self.narrow = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: each byte is a part; while a neighbouring pair has a rank, the lowest is merged."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        get = self.merges.get
        ranks = [get((a << ID_BITS) | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i, new = ranks.index(least), least & ((1 << ID_BITS) - 1)
            # the boundary between parts i and i + 1 goes, and both neighbours are ranked anew
            ids[i] = new
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((new << ID_BITS) | ids[i + 1], NEVER)
            if i:
                ranks[i - 1] = get((ids[i - 1] << ID_BITS) | new, NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, so that long words cost n log n."""
        get, n = self.merges.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r >> ID_BITS, i, r) for i in range(n - 1) if (r := get((ids[i] << ID_BITS) | ids[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            _, i, rank = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or get((ids[i] << ID_BITS) | ids[j], NEVER) != rank:
                continue
            ids[i], ids[j] = rank & ((1 << ID_BITS) - 1), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < n and (r := get((ids[left] << ID_BITS) | ids[right], NEVER)) != NEVER:
                    heapq.heappush(heap, (r >> ID_BITS, left, r))
        return [i for i in ids if i >= 0]

    def _plain(self, text: str) -> bytes:
        words, known = (self.narrow if text.isascii() else self.wide).findall(text), self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > MEMORY:
                known.clear()
            for w in words:
                if w not in known:
                    ids = self.merge(w.encode())
                    known[w] = struct.pack(f"<{len(ids)}I", *ids)
            return b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers. Special strings have ids of their own."""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        return b"".join(self.special.get(part) or self._plain(part) for part in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def _digests(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for frame in batches_of(frames, 500):
            sizes, shas, back = [], [], []
            for data in byte_texts(frame.column("text")):
                ids = bpe.encode(data.decode())
                sizes.append(len(ids) // 4)
                shas.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for frame in batches_of(frames, 500):
            ids = [np.frombuffer(bpe.encode(d.decode()), dtype="<u4").astype(np.int32) for d in byte_texts(frame.column("text"))]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _texts(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for frame in batches_of(frames, 500):
            texts = [bpe.decode(np.asarray(x or [], dtype="<u4").tobytes()) for x in frame.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` for each row of ``docs (doc_id, text)``; null text has no ids.

    Rows are encoded one by one without a shuffle: repeats get equal ids, a null ``doc_id``
    stays null, an empty table gives an empty result, further columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_ids(path), "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` for each row of ``(doc_id, ids)``; null ids give an empty text."""
    return rows.select("doc_id", "ids").mapInArrow(_texts(path), "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Counts and digests of ids and of the text decoded from them, in one pass; cases as in ``encode``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
