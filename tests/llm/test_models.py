import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from icuqm.llm import bpe, class_lm, packing, toxicity
from icuqm.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
TEXTS = ["", "  a  b \n\n c ", "a<|endoftext|> b<|startoftext|>", "don't I'LL we've", "日本語 テスト 🎉🎉", "ab" * 600 + " " * 300, "é ½ ² ٣ 12ab ß ſ", "x\x1cy\x85z\x00", "thé" * 200, "naïve İ ΣΑΣ"]


def test_byte_ids_equal_the_library(spark, odd, nothing):
    path = vocabulary("byte_bpe_50k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bpe.ByteBpe(path)
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)
    assert own._merge_long([own.byte_ids[b] for b in b"the same words" * 9]) == own.merge(b"the same words" * 9)
    rows = bpe.digests(odd, path).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (4, 5):
            assert (r["n_tokens"], r["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())
    back = bpe.decode(bpe.encode(odd, path), path).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert bpe.digests(nothing, path).count() == 0


def test_word_ids_equal_the_library():
    path = vocabulary("word_bpe_49k.json")
    library, own = tokenizers.Tokenizer.from_file(path), packing.WordIds(path)
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.of(text.encode()) == struct.pack(f"<{len(ids)}I", *ids)


def test_words_of_many_texts_are_looked_up_once_and_together(monkeypatch):
    path, learned = vocabulary("word_bpe_49k.json"), []
    library = tokenizers.Tokenizer.from_file(path)
    learn = packing.WordIds._learn
    monkeypatch.setattr(packing.WordIds, "_learn", lambda self, words: (learned.append(len(words)), learn(self, words))[1])
    texts = [*TEXTS, None, "", " \t", *(f" one two\nthree word{i % 40} <|x|> '{i % 7}ll\x0bStra\u00dfe \u65e5\u672c " for i in range(300))]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    want = [[*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
    want = [(i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for i, ids in enumerate(want)]
    for held, together, memory in ((1 << 23, 4096, 400_000), (500, 3, 10)):
        monkeypatch.setattr(packing, "HELD", held)
        monkeypatch.setattr(packing, "TOGETHER", together)
        monkeypatch.setattr(packing, "MEMORY", memory)
        got = [r for b in packing._pieces(path, 1 << 20)(iter([rows.slice(1), rows.slice(0, 1)])) for r in b.to_pylist()]
        assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in got) == want
        if together == 4096:
            words = {w for t in texts for w in (t or "").encode().split()}
            assert sum(learned) == len(words) and len(learned) <= 2


THIRDS = {1200 + 7 * k % 300: 1 + k % 50 for k in range(200)}
HISTOGRAMS = [{}, {4096: 5}, {3000: 7, 1096: 3}, {1: 9000}, {2049: 4}, {k: k % 5 + 1 for k in range(1, 4097, 7)}, THIRDS, {64: 8000, 3584: 1000}]


@pytest.mark.parametrize("counts", HISTOGRAMS)
def test_plan_holds_every_piece_once(counts):
    patterns = packing.plan(counts)
    held = Counter()
    for pattern, many in patterns:
        assert many > 0 and sum(x * a for x, a in pattern.items()) <= 4096
        for x, a in pattern.items():
            held[x] += a * many
    assert held == Counter(counts)
    alone = sum(m for _, m in packing.best_fit(counts, 4096))
    assert sum(m for _, m in patterns) <= alone
    if counts is THIRDS:
        # three pieces a sequence at most; best fit alone is far from it
        assert sum(m for _, m in patterns) <= 1.02 * math.ceil(sum(counts.values()) / 3) < alone
    if 3584 in counts:
        assert sum(m for _, m in patterns) == 1000


@pytest.mark.parametrize("counts", [c for c in HISTOGRAMS if c])
def test_program_covers_every_length_above_its_bound(counts):
    patterns, bound = packing.covering(counts, 4096)
    held = Counter()
    for pattern, weight in patterns:
        assert weight > 0 and sum(x * a for x, a in pattern.items()) <= 4096
        for x, a in pattern.items():
            held[x] += a * weight
    assert all(held[x] >= n - 1e-6 for x, n in counts.items())
    total = sum(w for _, w in patterns)
    assert sum(x * n for x, n in counts.items()) / 4096 - 1e-6 <= bound <= total + 1e-6
    assert bound <= sum(m for _, m in packing.best_fit(counts, 4096)) + 1e-6


def least_sequences(pieces, room):
    """Fewest sequences for a few pieces, by trying all ways."""
    def place(k, gaps):
        if k == len(pieces):
            return len(gaps)
        ways = [place(k + 1, [*gaps, room - pieces[k]])]
        for i, gap in enumerate(gaps):
            if gap >= pieces[k] and gap not in gaps[:i]:
                ways.append(place(k + 1, [*gaps[:i], gap - pieces[k], *gaps[i + 1 :]]))
        return min(ways)

    return place(0, [])


def test_plans_of_few_pieces_are_least_or_next_to_it():
    draw, more = random.Random(3), 0
    for _ in range(40):
        pieces = sorted((draw.randint(3, 14) for _ in range(8)), reverse=True)
        more += sum(m for _, m in packing.plan(Counter(pieces), 20)) - least_sequences(pieces, 20)
    assert more <= 1


def test_most_pieces_of_the_documents_are_placed_by_the_program(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    cut = docs.mapInArrow(packing._pieces(vocabulary("word_bpe_49k.json"), 4096), "doc_id long, piece int, start long, length long, ids_crc32 long")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    chosen, left, bound = packing.program(counts)
    share = 1 - sum(left.values()) / sum(counts.values())
    patterns, _ = packing.covering(counts, 4096)
    print(f"placed by the program: {share:.0%}; cover {sum(w for _, w in patterns):.1f}, bound {bound:.1f}")
    assert share > 0.5 and sum(w for _, w in patterns) <= 1.005 * bound
    assert sum(m for _, m in packing.best_fit(left, 4096, chosen)) <= bound + 1


def test_packed_sequences_have_no_gap(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(packing, "PER_TASK", 2)
    path = vocabulary("word_bpe_49k.json")
    rows = packing.pack(odd, path).collect()
    library, want = tokenizers.Tokenizer.from_file(path), []
    for r in odd.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((str(r["doc_id"]), k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
    own = defaultdict(list)
    for r in rows:
        own[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in own.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(nothing, path).count() == 0


def words(text):
    return (text or "").encode().lower().split()


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, odd, sf):
    for docs in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = [(r["doc_id"], words(r["text"])) for r in docs.collect()]
        out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
        seen = Counter()
        for i, ws in rows:
            if not out[i]:
                seen.update([*ws, None])
        n, v = sum(seen.values()), len(seen)
        want = sorted((str(i), out[i], len(ws) + 1, sum(seen[w] > 0 for w in [*ws, None]), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in [*ws, None]), 6)) for i, ws in rows)
        got = class_lm.score(docs).collect()
        assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == want
        assert all(r["score"] <= 0 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scoring_without_rows(nothing):
    assert class_lm.score(nothing).count() == 0


def test_rare_counts_are_joined(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    want = {r["doc_id"]: r["base_score"] for r in class_lm.score(docs).collect()}
    monkeypatch.setattr(class_lm, "HELD", 50)
    monkeypatch.setattr(class_lm, "CLUSTERED", 40)
    got = {r["doc_id"]: r["base_score"] for r in class_lm.score(docs).collect()}
    assert all(abs(got[i] - want[i]) < 1e-6 * abs(want[i]) for i in want)


def test_a_level_that_fits_in_part_is_held_in_part(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CLUSTERED", 40)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    draw = random.Random(5)
    texts = []
    for _ in range(12):
        draw.shuffle(words)
        texts.append(" ".join(words))
    # every word as often as any other, so all are of one level
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r["doc_id"]: r["score"] for r in class_lm.score(docs).collect()}
    for held in (250, 41):
        monkeypatch.setattr(class_lm, "HELD", held)
        got = {r["doc_id"]: r["score"] for r in class_lm.score(docs).collect()}
        assert all(abs(got[i] - want[i]) < 1e-6 * abs(want[i]) for i in want)


def test_words_beyond_the_first_clustered_learn_their_contexts(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CLUSTERED", 40)
    # words of one look: kinds a and b alternate, low numbers are frequent, and only those are clustered first
    draw = random.Random(3).random
    kinds = [[f"w{chr(97 + i // 26)}{chr(97 + i % 26)}{k}x" for i in range(200)] for k in "ab"]
    texts = [" ".join(kinds[j % 2][int(200 * draw() ** 2)] for j in range(120)) for _ in range(100)]
    probes = [(1000, " ".join(kinds[j % 2][150 + j] for j in range(40))), (1001, " ".join(kinds[j // 20][150 + j] for j in range(40)))]
    docs = spark.createDataFrame([*enumerate(texts), *probes], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in class_lm.score(docs).collect()}
    assert got[1000] > got[1001] + 5
    # what the tasks hold steers cost alone
    monkeypatch.setattr(class_lm, "HELD", 50)
    again = {r["doc_id"]: r["score"] for r in class_lm.score(docs).collect()}
    assert all(abs(got[i] - again[i]) < 1e-6 * abs(got[i]) for i in got)


def test_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.judge(docs, labels)
    assert got.count() == docs.count()
    seen = got.join(labels, "doc_id").where("held_out").collect()
    both = sum(r["predicted"] and r["toxic"] for r in seen)
    found, toxic = sum(r["predicted"] for r in seen), sum(r["toxic"] for r in seen)
    # calling nothing toxic would be right for most documents and find none
    assert both >= 0.8 * toxic and both >= 0.8 * found and toxic >= 10
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got.where("size(offending) > 0").limit(20).collect():
        for s in r["offending"]:
            part = text[r["doc_id"]][s["start"] : s["start"] + s["length"]]
            assert part and not re.search(r"[.!?\n]", part)


def test_toxicity_of_odd_documents(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1), (3, 0, 1), (None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.judge(odd, labels)
    assert got.count() == odd.count() and got.where("score between 0 and 1").count() == odd.count()
    assert toxicity.judge(odd, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.judge(nothing, labels).count() == 0
    assert got.where("doc_id is null and held_out").count() == 0
    want = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(1, 14)}
    assert all(r["held_out"] == want[r["doc_id"]] for r in got.where(F.col("doc_id").isNotNull()).collect())
