"""Lines that many documents share, dropped but in one document; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from icuqm.session import write_stage

#: Code points of the shortest key that counts, and documents that make a key common.
SHORTEST = 20
COMMON = 3
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lines of one key that one task takes; keys beyond it are counted by partial aggregates instead.
PER_TASK = 100_000
#: Counters of the sketch that finds such keys. It steers cost alone.
SKETCHED = 10_000
MOST_HOT = 1000


def lowered(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(docs: DataFrame) -> DataFrame:
    """``(doc_id, copy, text)``; ``copy`` tells rows of one id apart by their texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def line_keys(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``(h1, h2, doc_id, copy, pos, n_lines)`` per line whose key counts; a key is known by 128 hashed bits."""
    lines = _plain(docs).select("doc_id", "copy", text_lines(lowered(F.col("text"))).alias("lines"))
    lines = lines.select("doc_id", "copy", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    lines = lines.select("doc_id", "copy", "n_lines", "pos", F.btrim("line", F.lit(BLANKS)).alias("key")).where(F.length("key") >= shortest)
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "copy", "pos", "n_lines")


def dropped_lines(lines: DataFrame, common: int = COMMON, per_task: int = PER_TASK) -> DataFrame:
    """Those of stored ``lines`` that go.

    Hashes are range-partitioned and sorted by hash, document from the largest, and
    position. Each run of a hash is then read once: its first document stays, the place of
    a document in the run tells whether it goes. A key with more lines than ``per_task``
    does not enter that sort; its documents are counted by partial aggregates, and at most
    1000 results are sent to all tasks.
    """
    top = lines.agg(F.expr(f"approx_top_k(h1, {MOST_HOT}, {SKETCHED})").alias("top")).first()["top"] or []
    hot = [r["item"] for r in top if r["item"] is not None and r["count"] > per_task]
    few = lines.where(~F.col("h1").isin(hot)) if hot else lines
    key = Window.partitionBy("h1", "h2")
    ranged = few.repartitionByRange("h1", "h2").withColumn("place", F.dense_rank().over(key.orderBy(F.desc_nulls_last("doc_id"))))
    gone = ranged.withColumn("docs", F.max("place").over(key)).where((F.col("docs") >= common) & (F.col("place") > 1))
    columns = ["doc_id", "copy", "pos", "n_lines"]
    gone = gone.select(columns)
    if not hot:
        return gone
    many = lines.where(F.col("h1").isin(hot))
    kept = many.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.max("doc_id").alias("kept"), F.count("*").alias("docs"))
    # other keys that share the first hash of a frequent one are few; they come along
    kept = kept.where(F.col("docs") >= common).drop("docs")
    others = many.join(kept, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("kept")))
    return gone.union(others.select(columns))


def keep_bitmaps(docs: DataFrame, shortest: int = SHORTEST, common: int = COMMON, per_task: int = PER_TASK) -> DataFrame:
    """``(doc_id, copy, n_lines, n_dropped, keep)`` for documents that lose lines.

    ``keep`` is the document's bitmap of kept lines, compressed to its runs of ones:
    ``array<struct<start, length>>`` with starts from 0.
    """
    lines = write_stage(line_keys(docs, shortest), "lines-keys")
    places = F.array_sort(F.collect_set("pos"))
    own = dropped_lines(lines, common, per_task).groupBy("doc_id", "copy").agg(F.first("n_lines").alias("n_lines"), places.alias("gone"))
    gone, n = F.col("gone"), F.col("n_lines")

    def run(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
        end = F.when(i == F.size(gone), n).otherwise(F.get(gone, i))
        return F.struct(start.alias("start"), (end - start).alias("length"))

    keep = F.filter(F.transform(F.sequence(F.lit(0), F.size(gone)), run), lambda r: r["length"] > 0)
    return own.select("doc_id", "copy", "n_lines", F.size(gone).alias("n_dropped"), keep.alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines under a bitmap, joined again."""
    lines = text_lines(text)
    return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")


def thin_lines(docs: DataFrame, shortest: int = SHORTEST, common: int = COMMON, per_task: int = PER_TASK) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped, kept_text)`` per row of ``docs (doc_id, text)``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least
    ``shortest`` code points that ``common`` or more documents hold lose all their lines
    but those in the largest ``doc_id`` that holds them.

    Defined results: null and empty texts are one empty line, which stays. Rows that repeat
    an id are one document, each judged by its own text; rows without id are one document,
    smaller than any. Lines of a very long text spread over the tasks; only its runs come
    together. Keys are told apart by 128 hashed bits. An empty table gives an empty result;
    further columns are ignored.
    """
    bitmaps = write_stage(keep_bitmaps(docs, shortest, common, per_task), "lines-bitmaps")
    own = bitmaps.select(F.col("doc_id").alias("own"), F.col("copy").alias("own_copy"), "n_dropped", "keep")
    rows = _plain(docs)
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("copy") == F.col("own_copy"))
    rows = rows.join(own, same, "left")
    kept = F.when(F.col("keep").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("keep")))
    n_lines = F.size(text_lines(F.col("text"))).cast("long")
    return rows.select("doc_id", "text", n_lines.alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` per row."""
    return thin_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
