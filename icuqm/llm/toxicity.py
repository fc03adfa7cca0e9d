"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.llm.text import batches_of, byte_texts

#: The most labelled documents that one fit takes, chosen by a hash of their id.
TRAIN_ROWS = 8_000
#: A word is a feature if so many training documents hold it.
MIN_DOCS = 6
#: Besides whole words, their beginnings of so many bytes are features; they catch inflected forms.
BEGINNINGS = (4, 6, 8)
#: Features that enter the fit: those whose share differs most between the two labels.
MOST_FEATURES = 3_000
EPOCHS = 120
SPARSITY = 2e-4
THRESHOLD = 0.3
LIMIT = math.log(THRESHOLD / (1 - THRESHOLD))
#: Byte for byte: A-Z in lower case, sentence ends to line breaks, other ASCII marks to blanks.
SHAPED = bytes(
    10 if chr(b) in ".!?\n" else b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def sentences(data: bytes) -> list[bytes]:
    """Sentences of a text as bytes of equal length; a text without any has one empty sentence."""
    return data.translate(SHAPED).split(b"\n")


def features(sentence: bytes) -> set[bytes]:
    """Words and, marked by a hyphen, beginnings of longer words."""
    words = set(sentence.split())
    return words.union(*({w[:k] + b"-" for w in words if len(w) > k} for k in BEGINNINGS))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(texts: list[bytes], labels: np.ndarray) -> tuple[dict[bytes, float], float]:
    """Word weights and bias, from document labels alone.

    A document is toxic with 1 - prod(1 - s) over its sentences' logistic scores s. The
    negative log likelihood falls by Adam steps, and a soft threshold takes words that tell
    nothing back to 0.
    """
    y = labels.astype(np.float64)
    seen: dict[bytes, int] = {}
    toxic: dict[bytes, int] = {}
    for text, label in zip(texts, labels, strict=True):
        for f in features(text.translate(SHAPED)):
            seen[f] = seen.get(f, 0) + 1
            if label:
                toxic[f] = toxic.get(f, 0) + 1
    ones = max(y.sum(), 1.0)
    zeros = max(len(y) - ones, 1.0)

    def told(f: bytes) -> float:
        """How many standard errors the feature's share among toxic documents lies from that among others."""
        n, t = seen[f], toxic.get(f, 0)
        share = n / (ones + zeros)
        return abs(t / ones - (n - t) / zeros) / max((share * (1 - share) * (1 / ones + 1 / zeros)) ** 0.5, 1e-9)

    ranked = sorted((f for f, n in seen.items() if n >= MIN_DOCS), key=lambda f: (-told(f), f))[:MOST_FEATURES]
    vocab = {f: i for i, f in enumerate(ranked)}
    del seen, toxic
    word, owner, doc_of = [], [], []
    for d, text in enumerate(texts):
        for k, s in enumerate(sentences(text)):
            ids = sorted(vocab[f] for f in features(s) if f in vocab)
            # a sentence without features counts once for its document
            if ids or k == 0:
                word.extend(ids)
                owner.extend([len(doc_of)] * len(ids))
                doc_of.append(d)
    word, owner, doc_of = (np.array(x, dtype=np.int64) for x in (word, owner, doc_of))
    theta, first, second = np.zeros(len(vocab) + 1), np.zeros(len(vocab) + 1), np.zeros(len(vocab) + 1)
    theta[-1] = -5.0
    for step in range(1, EPOCHS + 1):
        z = theta[-1] + np.bincount(owner, weights=theta[word], minlength=len(doc_of))
        total = np.bincount(doc_of, weights=np.logaddexp(0, z), minlength=len(y))
        slope = (1 - y) - y / np.expm1(np.clip(total, 1e-9, 50))
        push = slope[doc_of] / (1 + np.exp(-z)) / max(len(y), 1)
        grad = np.append(np.bincount(word, weights=push[owner], minlength=len(vocab)), push.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        rate = 0.3 if step < EPOCHS * 2 // 3 else 0.08
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        shrink = rate * SPARSITY / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - shrink[:-1], 0)
    return {w: float(theta[i]) for w, i in vocab.items() if abs(theta[i]) > 0.05}, float(theta[-1])


def score(data: bytes, weights: dict[bytes, float], bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """Noisy-or over the first sentence and all that hold a feature, and the byte ranges of sentences that alone reach the threshold."""
    total, at, found = 0.0, 0, []
    for k, s in enumerate(sentences(data)):
        z = bias + sum([weights[f] for f in features(s) if f in weights]) if s else bias
        if k == 0 or z != bias:
            total += float(np.logaddexp(0, z))
            if z >= LIMIT:
                found.append((at, at + len(s), 1 / (1 + math.exp(-z))))
        at += len(s) + 1
    return float(-np.expm1(-total)), found


def _score(model):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        spans = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
        for frame in batches_of(frames, 500):
            scores, offending = [], []
            for data in byte_texts(frame.column("text")):
                p, found = score(data, weights, bias)
                scores.append(p)
                chars = [(len(data[:a].decode("utf-8", "ignore")), len(data[a:b].decode("utf-8", "ignore")), s) for a, b, s in found]
                offending.append([{"start": a, "length": n, "score": s} for a, n, s in chars])
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(scores), pa.array(offending, spans)], ["doc_id", "score", "offending"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[dict[bytes, float], float]:
    """Weights and bias from at most ``rows`` labelled documents that are not held out."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    # a share of the hashes somewhat larger than needed, so that few rows meet in the last step
    share = min(1.0, 1.2 * rows / max(known.count(), 1))
    chosen = known.where(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(order, "doc_id").limit(rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic").collect()
    sample.sort()
    return fit([r["text"].encode() for r in sample], np.array([r["toxic"] for r in sample], dtype=np.int64))


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted, offending)`` for each row of ``docs (doc_id, text)``.

    ``offending`` lists the sentences that alone reach the threshold: start and length in
    characters, and score. The fit takes a bounded sample of labelled rows; every row is
    scored by its text alone.

    Defined results: null text is empty and scores as one empty sentence; a null ``doc_id``
    is not held out and keeps its row; repeated rows score alike; without labels every
    document scores by the starting bias; an empty table gives an empty result; further
    columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows))
    scored = docs.mapInArrow(_score(model), "doc_id long, score double, offending array<struct<start: int, length: int, score: double>>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
