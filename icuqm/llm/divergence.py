"""Divergence between the sources of a language, by a three-dimensional cube of group and term blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from icuqm.llm.text import byte_texts
from icuqm.session import write_stage

#: Documents of a language that make a term count, and terms told for each group.
COMMON = 10
TOLD = 10
UNIT = 1_000_000_000
#: Groups and terms of one block, on average.
GROUPS = 16
TERMS = 4096
#: Distinct terms that a task counts before it passes them on.
HELD = 500_000
#: ASCII letters lower-cased, other ASCII as blanks, bytes of further characters unchanged.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z lower-cased."""
    return data.translate(_LETTERS).split()


def _counted(held: int):
    """Per task the occurrences and documents of every term in each group; a group itself has a row without term."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows():
            for (lang, source), (n, docs) in groups.items():
                size = len(n) + 1
                terms = list(n)
                columns = [pa.array([lang] * size), pa.array([source] * size), pa.array([None, *terms], pa.binary())]
                columns += [pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in terms)], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for frame in frames:
            own = zip(frame.column("lang").to_pylist(), frame.column("source").to_pylist(), byte_texts(frame.column("text")), strict=True)
            for lang, source, data in own:
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                terms = terms_of(data)
                n.update(terms)
                docs.update(set(terms))
            if sum(len(n) for n, _ in groups.values()) > held:
                yield from rows()
                groups.clear()
        yield from rows()

    return run


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 * (n + 2) / (total + 2 * terms))``, exactly; 0 where the language has no term."""
    above = (n + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    whole = F.call_function("div", above, (total + 2 * F.when(terms > 0, terms)).cast("decimal(20,0)"))
    return F.when(terms > 0, 1 + whole).otherwise(0).cast("long")


def apart(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; 0 where both are."""
    return F.coalesce(F.call_function("div", (p - q) * (p - q), F.nullif(p + q, F.lit(0))), F.lit(0)).cast("long")


def term_shares(docs: DataFrame, common: int = COMMON, held: int = HELD) -> DataFrame:
    """``(lang, source, term, n, p, q, zero, terms)``: stored shares of each group's terms.

    ``p`` is the share in the group, ``q`` in the language and ``zero`` the group's share of
    a term that it lacks. ``terms`` counts the terms that the language keeps. Every group
    also has one row without term.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = plain.mapInArrow(_counted(held), "lang string, source string, term binary, n long, docs long")
    # one exchange serves the counts of groups and of languages
    counted = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    counted = counted.withColumns({"in_lang": F.sum("n").over(own), "in_docs": F.sum("docs").over(own), "first": (F.min("source").over(own) == F.col("source")) & F.col("term").isNotNull()})
    kept = write_stage(counted.where((F.col("in_docs") >= common) | F.col("term").isNull()).select("lang", "source", "term", "n", "in_lang", "first"), "audit-counts")
    groups = write_stage(kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"), F.count("*").alias("held")), "audit-groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("terms"), F.count("*").alias("sources"))
    told = kept.join(groups.join(langs, "lang"), ["lang", "source"])
    shares = told.select(
        "lang", "source", "term", "n", "terms", "sources",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"),
        share(F.lit(0), F.col("total"), F.col("terms")).alias("zero"),
    )
    return write_stage(shares, "audit-shares")


def _cell(lang: str, diagonal: bool, frame: pa.Table) -> pa.RecordBatch:
    """Partial divergences of the pairs of one cell over the terms of its block."""
    sources, blocks = frame.column("source").combine_chunks().dictionary_encode(), frame.column("block").to_numpy()
    at, names = sources.indices.to_numpy(), sources.dictionary.to_pylist()
    zero, block = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
    zero[at], block[at] = frame.column("zero").to_numpy(), blocks
    worded = frame.column("term").is_valid().to_numpy()
    terms = frame.column("term").combine_chunks().filter(pa.array(worded)).dictionary_encode()
    shares = np.repeat(zero[:, None], len(terms.dictionary), axis=1)
    shares[at[worded], terms.indices.to_numpy()] = frame.column("p").to_numpy()[worded]
    first, second, value = [], [], []
    for g in range(len(names)):
        others = np.arange(g + 1, len(names)) if diagonal else np.flatnonzero(block > block[g])
        if len(others):
            gap, both = shares[others] - shares[g], shares[others] + shares[g]
            value.append((gap * gap // np.maximum(both, 1)).sum(axis=1, dtype=np.int64))
            first.append(np.full(len(others), g))
            second.append(others)
    first, second, value = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (first, second, value))
    names, count = pa.array(names, pa.string()), len(first)
    columns = [pa.array([lang] * count, pa.string()), names.take(pa.array(first)), names.take(pa.array(second)), pa.array(value, pa.int64())]
    columns += [pa.array(np.full(count, x, dtype=np.int64)) for x in (len(terms.dictionary), frame.column("terms")[0].as_py())]
    columns += [pa.array(zero[first]), pa.array(zero[second])]
    return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value", "seen", "terms", "zero_a", "zero_b"])


CELL = ["lang", "low", "high", "slab"]


def _cells(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of a partition, which is sorted by cell, one after another."""
    now, held = None, []
    for frame in frames:
        keys = list(zip(*(frame.column(c).to_pylist() for c in CELL), strict=True))
        start = 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            if keys[start] != now:
                if held:
                    yield _cell(now[0], now[1] == now[2], pa.Table.from_batches(held))
                now, held = keys[start], []
            held.append(frame.slice(start, end - start))
            start = end
    if held:
        yield _cell(now[0], now[1] == now[2], pa.Table.from_batches(held))


def pair_divergences(shares: DataFrame, groups: int = GROUPS, terms: int = TERMS) -> DataFrame:
    """``(lang, source, other, value)``, both ways, from stored ``shares``.

    Groups and terms of a language fall into blocks by hash, as many as its sizes ask for.
    A cell is a pair of group blocks and a term block. Each slice (group block, term block)
    is copied to the cells that need it; a cell adds up its pairs over its own terms, and
    the cells of a pair are added up along the term axis. Terms that no cell of a pair has
    seen are those that both sides lack.
    """
    blocks, slabs = F.ceil(F.col("sources") / groups), F.greatest(F.ceil(F.col("terms") / terms), F.lit(1))
    block = F.pmod(F.xxhash64("source"), blocks).cast("int")
    own = F.pmod(F.xxhash64("term"), slabs).cast("int")
    # the row without term goes to every slab, so that each cell knows all groups of its blocks
    slab = F.when(F.col("term").isNull(), F.sequence(F.lit(0), slabs.cast("int") - 1)).otherwise(F.array(own))
    slices = shares.select("lang", "source", "term", "p", "zero", "terms", block.alias("block"), F.explode(slab).alias("slab"), blocks.alias("blocks"))
    copies = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    copies = copies.select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "slab", "block", "source", "term", "p", "zero", "terms")
    cells = copies.repartition(*CELL).sortWithinPartitions(*CELL)
    partial = cells.mapInArrow(_cells, "lang string, a string, b string, value long, seen long, terms long, zero_a long, zero_b long")
    same = [F.max(c).alias(c) for c in ("terms", "zero_a", "zero_b")]
    # blocks follow hashes, so a pair's order is the same in all of its cells only by name
    named = partial.select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value", "seen", "terms",
        F.when(F.col("a") <= F.col("b"), F.col("zero_a")).otherwise(F.col("zero_b")).alias("zero_a"),
        F.when(F.col("a") <= F.col("b"), F.col("zero_b")).otherwise(F.col("zero_a")).alias("zero_b"),
    )
    pairs = named.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"), *same)
    value = F.col("value") + (F.col("terms") - F.col("seen")) * apart(F.col("zero_a"), F.col("zero_b"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("other")), F.struct(F.col("b").alias("source"), F.col("a").alias("other")))
    return pairs.select("lang", F.inline(both), value.alias("value"))


def audit(docs: DataFrame, common: int = COMMON, told: int = TOLD, groups: int = GROUPS, terms: int = TERMS, held: int = HELD) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for ``docs (text, lang, source)``.

    Part ``pair`` ranks the other sources of the language by their divergence from the
    source, part ``term`` the ``told`` terms that set it apart most from its language.

    Defined results: null text, language and source are empty ones. Every row is a document,
    repeated ones too. A group without terms has shares of 0 occurrences; in a language
    that keeps no term every divergence is 0. Ties are broken by the item's bytes. Texts of
    any length are read whole. An empty table gives an empty result; further columns are
    ignored.
    """
    shares = term_shares(docs, common, held)
    pairs = pair_divergences(shares, groups, terms).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ordered))
    marked = shares.where((F.col("n") > 0) & (F.col("p") > F.col("q")))
    marked = marked.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    return pairs.union(marked.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= told))
