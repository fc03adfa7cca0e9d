"""Product codes of vectors; the nearest codebook entry is found through memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuqm.llm.text import SPREAD, batches_of, mixed
from icuqm.session import write_stage

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Cells that a task remembers for one position; beyond it the memory starts anew.
CELLS_HELD = 1 << 14
ROWS = 4096
#: A label with more than this share of all rows is joined by broadcast; there are at most as many such labels.
HOT_SHARE = 1000
WIDEST = 2**62


class GridCells:
    """Nearest entries of one codebook by the cell of a grid in which a point lies.

    A cell holds the points whose components, divided by ``width`` and rounded down, are
    alike. On its first visit every entry's least and greatest squared distance to the
    cell's box is taken. An entry whose least distance exceeds another's greatest one is
    dominated everywhere in the box; the others are remembered under the cell's 64-bit
    hash. Only those are evaluated for a point, exactly, and ties go to the lower index. A
    cell that shares its hash with another one is evaluated in full.
    """

    def __init__(self, entries: np.ndarray, width: int, held: int = CELLS_HELD):
        self.entries, self.width, self.held = entries, width, held
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)
        self.cells = np.empty((0, self.entries.shape[1]), dtype=np.int64)
        self.open = np.empty((0, len(self.entries)), dtype=bool)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell and entry whether the entry can be nearest to some point of the cell."""
        low = cells.astype(self.entries.dtype)[:, None, :] * self.width
        high, entries = low + (self.width - 1), self.entries[None, :, :]
        inside = np.maximum(np.maximum(low - entries, entries - high), 0)
        least = (inside * inside).sum(axis=2)
        far = np.maximum(abs(entries - low), abs(entries - high))
        most = (far * far).sum(axis=2)
        return (least <= most.min(axis=1, keepdims=True)).astype(bool)

    def _candidates(self, points: np.ndarray) -> np.ndarray:
        cells = (points // self.width).astype(np.int64)
        hashes = np.zeros(len(cells), dtype=np.uint64)
        for column in cells.T:
            hashes = mixed(hashes * SPREAD + column.view(np.uint64))
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        fresh = first[~np.isin(keys, self.hashes)]
        if len(fresh):
            if len(self.hashes) + len(fresh) > self.held:
                self._forget()
                fresh = first
            order = np.argsort(np.concatenate([self.hashes, hashes[fresh]]))
            self.cells = np.concatenate([self.cells, cells[fresh]])[order]
            self.open = np.concatenate([self.open, self.undominated(cells[fresh])])[order]
            self.hashes = np.concatenate([self.hashes, hashes[fresh]])[order]
        at = np.searchsorted(self.hashes, keys)[back]
        return self.open[at] | (self.cells[at] != cells).any(axis=1)[:, None]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance, per point."""
        rows, entry = np.nonzero(self._candidates(points))
        gap = points[rows] - self.entries[entry]
        order = (gap * gap).sum(axis=1) * len(self.entries) + entry
        best = np.minimum.reduceat(order, np.searchsorted(rows, np.arange(len(points))))
        return (best % len(self.entries)).astype(np.int64), best // len(self.entries)


def scaled(vectors: pa.Array, size: int) -> np.ndarray:
    """``floor(256 * x)`` of every component, a row per vector, as floats without loss."""
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).reshape(-1, size)


def exact(values: np.ndarray, reach: float) -> np.ndarray:
    """Whole numbers of 64 bits while squared distances within ``reach`` fit, else of any size."""
    if reach < WIDEST:
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def cell_width(entries: np.ndarray) -> int:
    """A little below the typical spread of a component over the entries, so that cells recur and still exclude."""
    spread = np.std(entries.astype(np.float64), axis=0).mean() if len(entries) else 0.0
    return max(1, int(spread * 0.75))


class Coder:
    """Codes of whole vectors under one codebook ``[part][entry][component]`` of Python integers."""

    def __init__(self, book: list[list[list[int]]]):
        self.book, self.size = book, len(book) * len(book[0][0])
        self.most = max(abs(x) for part in book for entry in part for x in entry)
        self.grids: dict[type, list[GridCells]] = {}

    def _own(self, kind: type) -> list[GridCells]:
        if kind not in self.grids:
            # numbers of any size are rare, so only the common kind is kept small
            self.grids[kind] = [GridCells(e, cell_width(e)) for e in (np.array(part, dtype=kind) for part in self.book)]
        return self.grids[kind]

    def encode(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points, entry per part and the sum of squared distances per vector."""
        width = self.size // len(self.book)
        # cell borders lie up to a cell beyond the points
        reach = (4.0 * max(float(abs(values).max(initial=0)), float(self.most)) + 4) ** 2 * width * max(len(self.book[0]), len(self.book))
        points = exact(values, reach)
        codes = np.empty((len(points), len(self.book)), dtype=np.int64)
        error = np.zeros(len(points), dtype=points.dtype)
        for p, grid in enumerate(self._own(points.dtype.type if points.dtype != object else object)):
            codes[:, p], part = grid.nearest(points[:, p * width : (p + 1) * width])
            error = error + part
        return points, codes, error


def _sums(book):
    """Per task the count and component sums of every used entry."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(book.value)
        parts, entries, width = len(book.value), len(book.value[0]), len(book.value[0][0])
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=object)
        for frame in batches_of(frames, ROWS):
            if frame.num_rows == 0:
                continue
            points, codes, _ = coder.encode(scaled(frame.column(0), coder.size))
            for p in range(parts):
                own = codes[:, p]
                counts[p] += np.bincount(own, minlength=entries)
                order = np.argsort(own, kind="stable")
                used, starts = np.unique(own[order], return_index=True)
                sums[p, used] += np.add.reduceat(points[order, p * width : (p + 1) * width], starts, axis=0).astype(object)
        at = [(p, e, j) for p in range(parts) for e in range(entries) if counts[p, e] for j in range(width)]
        columns = [pa.array([a[k] for a in at], pa.int32()) for k in range(3)]
        columns.append(pa.array([int(counts[p, e]) for p, e, _ in at], pa.int64()))
        columns.append(pa.array([Decimal(int(sums[a])) for a in at], pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "component", "n", "total"])

    return run


def _codes(book):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(book.value)
        for frame in batches_of(frames, ROWS):
            if frame.num_rows == 0:
                continue
            _, codes, error = coder.encode(scaled(frame.column(2), coder.size))
            text = [bytes(row).hex() for row in codes.astype(np.uint8)]
            error = [int(x) if x < 2**63 else None for x in error.tolist()]
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(text), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def usable(vector: Column) -> Column:
    """Vectors of finite components below 2^50 that can be cut into equal parts."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(2**50))))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0) & whole


def train(rows: DataFrame, rounds: int = ROUNDS) -> list[list[list[int]]] | None:
    """The codebook from ``rows (vec_id, label, vector)`` of one size; None without rows.

    It starts from the rows with the smallest ids. Tasks return sums per part, entry and
    component, which are added up by Spark; what reaches the driver is as large as the
    codebook whatever the rows.
    """
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    if not first:
        return None
    start = np.floor(np.array([r["vector"] for r in first], dtype=np.float64) * SCALE)
    width = start.shape[1] // PARTS
    book = [[[int(x) for x in row[p * width : (p + 1) * width]] for row in start] for p in range(PARTS)]
    for _ in range(rounds):
        held = rows.sparkSession.sparkContext.broadcast(book)
        parted = rows.select("vector").mapInArrow(_sums(held), "part int, entry int, component int, n long, total decimal(38,0)")
        for r in parted.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            book[r["part"]][r["entry"]][r["component"]] = int(r["total"]) // r["n"]
        held.unpersist()
    return book


def book_digest(book: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for part in book for entry in part for x in entry).encode()).hexdigest()


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the errors of its label summed. Labels of very many rows are joined apart, so that no task takes one whole."""
    totals = write_stage(coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"), F.count("*").alias("n")), "codes-labels")
    hot = F.col("n") * HOT_SHARE > coded.count()
    many = totals.where(hot).select(F.col("label").alias("own"), F.col("label_error").alias("many_error"), F.lit(True).alias("many"))
    told = coded.join(F.broadcast(many), F.col("label").eqNullSafe(F.col("own")), "left").drop("own")
    few = totals.where(~hot).select(F.col("label").alias("own"), "label_error")
    rest = told.where("many is null").join(few, F.col("label").eqNullSafe(F.col("own")))
    columns = ["vec_id", "label", "code", "error", "label_error"]
    return told.where("many").withColumn("label_error", F.col("many_error")).select(columns).union(rest.select(columns))


def compress(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)`` per usable row of ``table``.

    Components become ``floor(256 * x)``; vectors are cut into 16 parts, each with a
    codebook of up to 64 entries, improved in two rounds over all rows. All arithmetic is
    exact.

    Defined results: rows whose vector is null or empty, holds null or non-finite
    components or ones of 2^50 and more, cannot be cut into 16 equal parts or differs in
    size from the row of the smallest id are dropped. A null id counts as the largest; equal
    ids follow the order of their vectors, and repeated rows each give a row. With fewer
    than 64 rows the codebooks are smaller. Sums beyond 64 bits are null. Null labels are
    one label. An empty table gives an empty result; further columns are ignored.
    """
    spark = table.sparkSession
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select(F.size("vector").alias("size")).limit(1).collect()
    if first:
        rows = rows.where(F.size("vector") == first[0]["size"])
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    book = train(rows)
    if book is None:
        return spark.createDataFrame([], schema + ", label_error long, codebooks_sha256 string")
    coded = write_stage(rows.mapInArrow(_codes(spark.sparkContext.broadcast(book)), schema), "codes-rows")
    return _with_label_error(coded).withColumn("codebooks_sha256", F.lit(book_digest(book)))
