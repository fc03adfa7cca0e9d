import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuqm.llm import divergence, line_dedup, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, part int, entry string, error long, code string"


def vector_rows(spark, own):
    return spark.createDataFrame([(i, v, x, 1, "e", 5, "c") for i, v, x in own], VECTORS).repartition(3)


def coded_by_hand(own, size):
    """Codes, errors and the codebook by plain loops over Python integers."""
    ok = [(i, v, x) for i, v, x in own if v and len(v) == size and all(c is not None and math.isfinite(c) and abs(c) < 2**50 for c in v)]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = size // 16
    points = [[tuple(math.floor(256 * float(np.float32(c))) for c in v[p * width : (p + 1) * width]) for p in range(16)] for _, v, _ in ok]
    book = [[list(x[p]) for x in points[:64]] for p in range(16)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)), e) for e, entry in enumerate(book[p]))

    for _ in range(2):
        got = defaultdict(list)
        for x in points:
            for p in range(16):
                got[p, nearest(x[p], p)[1]].append(x[p])
        for (p, e), members in got.items():
            book[p][e] = [sum(m[j] for m in members) // len(members) for j in range(width)]
    found = [[nearest(x[p], p) for p in range(16)] for x in points]
    errors = [sum(d for d, _ in f) for f in found]
    total = Counter()
    for (_, _, x), e in zip(ok, errors, strict=True):
        total[x] += e
    digest = hashlib.sha256(",".join(str(c) for part in book for e in part for c in e).encode()).hexdigest()
    rows = [(i, x, "".join(f"{e:02x}" for _, e in f), own, total[x], digest) for (i, _, x), f, own in zip(ok, found, errors, strict=True)]
    return sorted([tuple(None if isinstance(c, int) and c >= 2**63 else c for c in r) for r in rows], key=str)


@pytest.mark.parametrize("many", [0, 3, 200])
def test_codes_equal_plain_loops(spark, many):
    draw = random.Random(many)
    own = [(i, [draw.gauss(0, 0.2) for _ in range(32)], draw.choice([1, 1, 1, 2, None])) for i in range(many)]
    if many:
        own += [(900, None, 1), (901, [], 1), (902, [1.0, None] * 16, 1), (903, [math.nan] * 32, 1), (904, [math.inf] * 32, 1), (905, [0.5] * 16, 1), (906, [0.5] * 31, 1)]
        # ties, repeated rows and ids, a null id
        own += [(907, [0.0] * 32, 3), (907, [0.0] * 32, 3), (907, [0.25] * 32, None), (None, [0.125] * 32, 2)]
    got = vector_codes.compress(vector_rows(spark, own)).collect()
    assert sorted([tuple(r) for r in got], key=str) == coded_by_hand(own, 32)


def test_codes_of_numbers_beyond_64_bits(spark):
    draw = random.Random(7)
    own = [(i, [draw.uniform(-1, 1) * 2.0 ** (45 if i % 9 == 4 else 20) for _ in range(16)], 1) for i in range(90)]
    got = vector_codes.compress(vector_rows(spark, own)).collect()
    assert sorted([tuple(r) for r in got], key=str)[0][2] == coded_by_hand(own, 16)[0][2]
    assert {(r[0], r[2], r[3]) for r in got} == {(r[0], r[2], r[3]) for r in coded_by_hand(own, 16)}


def test_cells_exclude_entries_and_lose_none(monkeypatch):
    draw = np.random.default_rng(1)
    entries, points = draw.integers(-90, 90, (64, 4)), draw.integers(-120, 120, (3000, 4))
    far = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for held in (1 << 14, 50):
        grid = vector_codes.GridCells(entries, 20, held)
        for part in np.split(points, 6):
            code, error = grid.nearest(part)
            own = ((part[:, None, :] - entries[None]) ** 2).sum(axis=2)
            assert (code == own.argmin(axis=1)).all() and (error == own.min(axis=1)).all()
        assert grid.open.mean() < 0.5 and (held > 50 or len(grid.hashes) <= 500)
    # cells that share a hash are evaluated in full
    monkeypatch.setattr(vector_codes, "mixed", lambda x: x * np.uint64(0))
    code, _ = vector_codes.GridCells(entries, 20).nearest(points)
    assert (code == far.argmin(axis=1)).all()


def lines_by_hand(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(-1 if i is None else i)
    want = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == (-1 if i is None else i)]
        want.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(want, key=str)


SHARED = "A line that is long enough to count"
TEXTS = [
    (1, f"{SHARED}\nown one\n{SHARED.upper()}\n\n"), (2, f"\t{SHARED} \x0b\n \n{SHARED}"), (3, f"x\n{SHARED}\ny\n{SHARED}"), (4, None), (5, ""), (6, "\n\n"),
    (7, "exactly twenty chars"), (8, "Exactly twenty chars"), (9, "exactly twenty charS "), (10, "nineteen characters"), (11, "nineteen characters"), (12, "nineteen characters"),
    (13, f"{SHARED}\nother"), (13, f"before\n{SHARED}"), (13, f"{SHARED}\nother"), (None, f"{SHARED}\nno id"), (None, "exactly twenty chars"),
    (14, "ÄÖÜ sind keine kleinen Buchstaben"), (15, "äöü sind keine kleinen Buchstaben"), (16, "ÄÖÜ SIND keine kleinen Buchstaben"), (17, "ÄÖÜ sind Keine kleinen Buchstaben"),
    (18, "\n".join(f"line number {i} of a long text" for i in range(30_000))), (19, "\n".join(f"line number {i} of a long text" for i in range(0, 30_000, 2))),
    (20, "\n".join(f"Line number {i} of a long text" for i in range(0, 30_000, 3))), (21, " exactly twenty chars"),
]


@pytest.mark.parametrize("per_task", [100_000, 2])
def test_dropped_lines_equal_brute_force(spark, per_task):
    schema = "doc_id long, text string, h1 long, copy long, pos string, keep int, lines string, gone int"
    docs = spark.createDataFrame([(i, t, 1, 2, "p", 3, "l", 4) for i, t in TEXTS], schema).repartition(4)
    rows = line_dedup.thin_lines(docs, per_task=per_task)
    got = rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256)).collect()
    assert sorted([tuple(r) for r in got], key=str) == lines_by_hand(TEXTS)


def test_bitmaps_are_runs_of_kept_lines(spark, odd, nothing):
    docs = spark.createDataFrame([(i, f"own {i}\n{SHARED}\n{SHARED}\nlast {i}\n{SHARED}") for i in range(4)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup.keep_bitmaps(docs).collect()}
    assert sorted(rows) == [0, 1, 2]
    assert [tuple(x) for x in rows[1]["keep"]] == [(0, 1), (3, 1)] and rows[1]["n_lines"] == 5 and rows[1]["n_dropped"] == 3
    assert line_dedup.digests(nothing).count() == 0
    own = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted([tuple(r) for r in line_dedup.digests(odd).collect()], key=str) == lines_by_hand(own)


def test_lines_meet_in_one_range_exchange(spark, sf):
    plan = line_dedup.dropped_lines(line_dedup.write_stage(line_dedup.line_keys(spark.read.parquet(f"{sf}/documents.parquet")), "test"))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange") == 1 and "rangepartitioning(h1" in shown


def audit_by_hand(rows, common):
    def words(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]

    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        counts[lang, source].update(words(text))
        docs[lang].update(set(words(text)))
    want = []
    for lang in {g[0] for g in counts}:
        kept = sorted((t for t, n in docs[lang].items() if n >= common), key=lambda t: t.encode())
        groups = {g: {t: n[t] for t in kept} for (x, g), n in counts.items() if x == lang}

        def shares(n, kept=kept):
            return {t: 1 + 10**9 * (n[t] + 2) // (sum(n.values()) + 2 * len(kept)) for t in kept}

        whole = shares({t: sum(n[t] for n in groups.values()) for t in kept})
        p = {g: shares(n) for g, n in groups.items()}
        for g in groups:
            def f(t, q, g=g):
                return (p[g][t] - q[t]) ** 2 // (p[g][t] + q[t])

            pairs = sorted(((sum(f(t, p[h]) for t in kept), h) for h in groups if h != g), key=lambda r: (-r[0], r[1].encode()))
            terms = sorted(((f(t, whole), t) for t in kept if groups[g][t] and p[g][t] > whole[t]), key=lambda r: (-r[0], r[1].encode()))
            want += [(lang, g, part, item, value, rank) for part, found in (("pair", pairs), ("term", terms[:10])) for rank, (value, item) in enumerate(found, 1)]
    return sorted(want)


@pytest.mark.parametrize(("groups", "terms", "held"), [(16, 4096, 500_000), (2, 7, 30), (1, 1, 1)])
def test_audit_equals_brute_force(spark, groups, terms, held):
    draw = random.Random(groups)
    pool = [f"Word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Ünïcode", "ünïcode", "x_y", "a1b", "日本語", "\x7f", "é è"]
    rows = [(" ".join(draw.choices(pool[k % 5 :], k=draw.randint(0, 60))), draw.choice(["en", "en", "de", None]), draw.choice(["a", "b", "B", "ä", "", None, "z9"])) for k in range(150)]
    rows += [(None, "en", "empty"), ("", "fr", "only"), ("rare words", "fr", "few"), ("!!! 123", "it", None), ("one two", "it", ""), *[("long " * 30_000, "en", "a")] * 2]
    schema = "text string, lang string, source string, term string, p long, block int, zero int, value string"
    docs = spark.createDataFrame([(*r, "t", 1, 2, 3, "v") for r in rows], schema).repartition(5)
    got = divergence.audit(docs, common=6, groups=groups, terms=terms, held=held).collect()
    assert sorted(tuple(r) for r in got) == audit_by_hand(rows, 6)


def test_no_documents_no_divergence(spark, odd, nothing):
    assert divergence.audit(nothing).count() == 0
    own = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in divergence.audit(odd, common=2).collect()) == audit_by_hand(own, 2)


def test_shares_are_exact_for_great_counts(spark):
    great = [(10**12 + 7, 3 * 10**12 + 1, 10**6), (0, 10**15, 5), (10**15, 10**15, 1), (3, 3, 0)]
    rows = spark.createDataFrame(great, "n long, total long, terms long").select("n", "total", "terms", divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    for r in rows.collect():
        assert r["p"] == (1 + 10**9 * (r["n"] + 2) // (r["total"] + 2 * r["terms"]) if r["terms"] else 0)
