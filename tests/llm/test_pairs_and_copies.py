import hashlib
import re
from collections import defaultdict

import numpy as np
import zstandard
from pyspark.sql import functions as F

from icuqm.llm import exact_dedup, ngram_join
from icuqm.llm.components import components


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Smallest reachable id per id, over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def check_groups(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    got = ngram_join.ngram_groups(docs).collect()
    assert len(got) == len(rows)
    assert sorted((str(i), len(shingles(t)), str(want.get(i))) for i, t in rows) == sorted((str(r[0]), r[1], str(r[2])) for r in got)


def test_groups_of_odd_documents(odd):
    check_groups(odd)


def test_groups_equal_brute_force(spark, sf):
    check_groups(spark.read.parquet(f"{sf}/documents.parquet"))


def test_family_around_the_threshold(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.choice(120, size=i % 9, replace=False):
            words[k] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    check_groups(spark.createDataFrame(rows, "doc_id long, text string"))


def edited_family(spark, size, words, edits):
    """Copies of one text with runs of changed words, from barely over to well under the limit."""
    rng = np.random.default_rng(size)
    rows = []
    for i in range(size):
        own = [f"w{k}" for k in range(words)]
        for k in rng.choice(words, size=int(rng.integers(0, edits)), replace=False):
            own[k] = f"new{i}x{k}"
        rows.append((i, " ".join(own)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(8)


def test_great_family_of_edited_copies(spark):
    docs = edited_family(spark, 2000, 150, 9)
    sets = [(r["doc_id"], {hash(x) for x in shingles(r["text"])}) for r in docs.collect()]
    by_token = defaultdict(list)
    for place, (_, s) in enumerate(sets):
        for t in s:
            by_token[t].append(place)
    by_token, sizes, root = {t: np.array(p) for t, p in by_token.items()}, np.array([len(s) for _, s in sets]), {}
    links = {}
    for place, (i, s) in enumerate(sets):
        both = np.bincount(np.concatenate([by_token[t] for t in s]), minlength=len(sets))
        links[i] = [sets[j][0] for j in np.flatnonzero(100 * both >= 75 * (sizes[place] + sizes - both))]
    for i in sorted(links):
        if i not in root:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in root:
                    root[k] = i
                    todo += links[k]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_groups(docs).collect()}
    assert got == root and 1 < len(set(root.values())) < 1900


def test_parts_of_a_group_and_salted_queries_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TOKENS", 2000)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "QUERIES", 3)
    check_groups(edited_family(spark, 120, 90, 10))
    # links that only the step over all parts finds
    monkeypatch.setattr(ngram_join, "pivots", lambda members: members.where("false").select("grp", "sub", "id"))
    check_groups(edited_family(spark, 80, 90, 10))


def test_documents_link_across_groups(spark, monkeypatch):
    chain = [" ".join(f"w{k}" for k in range(i * 10, i * 10 + 120)) for i in range(30)]
    docs = spark.createDataFrame([(97 * i % 31, t) for i, t in enumerate(chain)], "doc_id long, text string")
    check_groups(docs)
    # every document a group of its own: all links come from queries
    monkeypatch.setattr(ngram_join, "components", lambda edges, name: components(edges if name != "ngram-groups" else edges.where("false"), name))
    check_groups(docs)
    check_groups(edited_family(spark, 40, 90, 10))


def counted_stages(monkeypatch):
    """Rows of each stage that a call writes."""
    rows, write = defaultdict(list), ngram_join.write_stage

    def counted(df, name):
        out = write(df, name)
        rows[name].append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "write_stage", counted)
    return rows


def test_family_in_many_groups_is_merged(spark, monkeypatch):
    rows = counted_stages(monkeypatch)
    # every document a group of its own: some 60 * 59 / 2 meetings unless groups are merged
    monkeypatch.setattr(ngram_join, "components", lambda edges, name: components(edges if name != "ngram-groups" else edges.where("false"), name))
    check_groups(edited_family(spark, 60, 90, 4))
    assert sum(rows["ngram-near"]) <= 60
    # and without merging all links come from queries, as before
    monkeypatch.setattr(ngram_join, "SPARE", 1 << 40)
    check_groups(edited_family(spark, 40, 90, 10))


def test_small_groups_ask_the_great_one(spark, monkeypatch):
    rows = counted_stages(monkeypatch)
    # the family but its last three documents is one group
    monkeypatch.setattr(ngram_join, "components", lambda edges, name: components(edges if name != "ngram-groups" else edges.where("a < 57 and b < 57"), name))
    monkeypatch.setattr(ngram_join, "SPARE", 1 << 40)
    check_groups(edited_family(spark, 60, 90, 4))
    assert 0 < sum(rows["ngram-near"]) < 12


def test_prefix_tokens_are_exchanged_packed(spark):
    docs = edited_family(spark, 400, 150, 9)
    levels = spark.sparkContext.broadcast(np.zeros(1 << 16, dtype=np.uint8))
    got = docs.mapInArrow(ngram_join._prefixes(levels, 16, 75, 5, 4), "part int, id long, head long, packed binary").collect()
    rows = [ngram_join._unpacked_rows(r["packed"], zstandard.ZstdDecompressor()) for r in got if r["head"] is None]
    n_rows = sum(len(tokens) for tokens, _, _ in rows)
    copied = {r["id"] for r in got if r["head"] is not None}
    assert {int(i) for _, ids, _ in rows for i in ids} | copied == set(range(400)) and n_rows > 40 * (400 - len(copied))
    # a row per task and part, not per token
    assert len(rows) <= 8 * 4 and sum(len(r["packed"]) for r in got if r["packed"]) < 12 * n_rows
    parts = [{int(t) for t in tokens} for tokens, _, _ in rows]
    of = defaultdict(set)
    for r, tokens in zip([r for r in got if r["head"] is None], parts, strict=True):
        for t in tokens:
            of[t].add(r["part"])
    assert all(len(x) == 1 for x in of.values())


def test_packed_rows_keep_every_number():
    tokens = np.array([0, -1, 2**63 - 1, -(2**63), 5], dtype=np.int64)
    ids = np.array([-(2**63), 2**63 - 1, 0, -1, -1], dtype=np.int64)
    sizes = np.array([1, 2**31 - 1, 300, 7, 7], dtype=np.int32)
    back = ngram_join._unpacked_rows(ngram_join._packed_rows(tokens, ids, sizes, zstandard.ZstdCompressor(level=1)), zstandard.ZstdDecompressor())
    assert all((x == y).all() for x, y in zip((tokens, ids, sizes), back, strict=True))


def test_packing_in_many_pieces_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PACKED", 100)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 1000)
    check_groups(edited_family(spark, 40, 90, 10))


def test_salted_tokens_and_leaders_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PER_TASK", 2)
    rows = [(i, " ".join(f"w{k}" for k in range(40)) + f" tail{i}") for i in range(30)]
    check_groups(spark.createDataFrame(rows, "doc_id long, text string"))


def test_only_torn_tokens_are_listed_for_the_exchange(spark, monkeypatch):
    index = spark.createDataFrame([(i, 3, [i, -7, 1 << 60], [i, 2, 3], None) for i in range(1000)], "id long, n int, tokens array<long>, leaders array<long>, leader long")
    asked = spark.createDataFrame([(-7,), (3,)], "id long")
    mask = ngram_join.filter_over(asked, 16)
    got = index.select("id", "n", "tokens").mapInArrow(ngram_join._listed(mask, 16), "id long, n int, token long").collect()
    assert {tuple(r) for r in got} >= {(i, 3, -7) for i in range(1000)} | {(3, 3, 3)} and len(got) < 1100
    kept = [r["id"] for r in index.mapInArrow(ngram_join._among(mask, 16), index.schema).collect()]
    assert 3 in kept and len(kept) < 50
    # filters that let nothing out change no result
    monkeypatch.setattr(ngram_join, "filter_bits", lambda n: 3)
    check_groups(edited_family(spark, 40, 90, 10))


def test_no_documents(nothing):
    assert ngram_join.ngram_groups(nothing).count() == 0
    assert ngram_join.drop_near_copies(nothing).count() == 0
    assert exact_dedup.exact_groups(nothing, exact_dedup.newer_half(nothing)).count() == 0
    assert exact_dedup.drop_copies(nothing).count() == 0


def test_one_of_each_group_stays(odd):
    kept = ngram_join.drop_near_copies(odd)
    assert kept.columns == odd.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 12, 13, 13]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def expected_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            kept = i == top and first
            first = first and not kept
            out.append((str(i), str(top), len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_exact_groups(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for part in (exact_dedup.newer_half(odd), F.lit(True), F.lit(False), F.col("doc_id") % 2 == 0):
        got = exact_dedup.exact_groups(odd, part).collect()
        assert sorted((str(r[0]), str(r[1]), r[2], r[3], r[4]) for r in got) == expected_copies(rows)


def test_bytes_are_checked_behind_equal_digests(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.where("doc_id <> 13").collect()]
    got = exact_dedup.exact_groups(odd.where("doc_id <> 13"), F.col("doc_id") > 5, digest=lambda t: (F.length(t) % 3).cast("string")).collect()
    want = expected_copies([r for r in rows if r[0] is not None])
    assert sorted((str(r[0]), str(r[1]), r[2], r[3], r[4]) for r in got if r[0] is not None) == want


def test_copies_go_and_columns_stay(odd):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["11", "12", "3", "6", "7", "8", "9", "10", "13", "13"])


def test_fuse_filter_denies_no_key():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 1000, 60_000):
        keys = rng.integers(0, 2**63, size=n, dtype=np.uint64)
        own = exact_dedup.FuseFilter.build(np.concatenate([keys, keys]))
        assert own.holds(keys).all()
        if n > 100:
            assert own.holds(rng.integers(0, 2**63, size=50_000, dtype=np.uint64)).mean() < 0.01
