"""Near-duplicate vectors through an inverted multi-index.

The vectors' halves have codebooks of their own, fitted by k-means on a bounded sample; their product is a grid of cells, and
every vector lies in one cell. Each vector visits cells in order of growing distance (multi-sequence traversal over the two
sorted lists of half distances) until the target recall, and is compared with all vectors of those cells by cosine in
double precision.

The distance of a cell is that of the vector to the planes between its own code words and the cell's, squared and summed over
the halves; a partner closer than this can't lie there. The stop is set by recall: sampled vectors are moved in random
directions to exactly the threshold, and the stop is the distance that covers ``recall`` of these hardest partners.

Equal vectors are one node with a count. A cell of many vectors is cut into blocks of bounded size on both sides; a
block sends counts and a spanning forest of its links, never all pairs.

Defined results: a null, empty or zero vector, one with null or non-finite components, or one of a dimension other than the
commonest, links with nothing and is kept; a row without vec_id likewise, with a null component; repeated rows count as
vectors; extra columns don't matter; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanforge.llm.common import Scratch
from scanforge.llm.components import components
from scanforge.plans.joins import lookup_join

# Rows that fit the codebooks and the stop: those of least hash. The index itself holds every row.
SAMPLE = 20_000
# Code words for each half: this times the fourth root of the number of vectors, since finer grids have more cells within the stop.
WORDS = 2.4
MAX_WORDS = 1024
BLOCK = 1024
RECALL = 0.999


def scaled(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(-1, keepdims=True)
    return x / np.sqrt((x * x).sum(-1, keepdims=True))


def canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim, digest and doubles of each vector; null digests where a vector can't link."""
    for batch in batches:
        vectors, dims, digests, data = batch.column("embedding").to_pylist(), [], [], []
        for v in vectors:
            x = None
            if v and None not in v:
                x = np.array(v, "<f8") + 0.0
                x = x if np.isfinite(x).all() and x.any() else None
            dims.append(None if x is None else len(x))
            data.append(None if x is None else x.tobytes())
            digests.append(None if x is None else blake2b(data[-1], digest_size=16).digest())
        columns = [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "digest", "data"])


def fit_codebook(rows: np.ndarray, words: int, turns: int = 10, seed: int = 3) -> np.ndarray:
    book = rows[np.random.default_rng(seed).permutation(len(rows))[:words]].copy()
    for _ in range(turns):
        own = squared(rows, book).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        counts = np.bincount(own, minlength=len(book))
        book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return book


def squared(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows to code words."""
    return (rows * rows).sum(1)[:, None] + (book * book).sum(1)[None] - 2 * rows @ book.T


class Grid:
    """Two codebooks and the distances of rows to their product's cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.cut = first.shape[1]
        self.gaps = []
        for book in self.books:
            gap = np.sqrt(np.maximum(squared(book, book), 0))
            gap[gap < 1e-9] = np.inf  # equal code words: no plane between them
            self.gaps.append(gap)

    def halves(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: own word, and squared distance to the plane before each other word."""
        out = []
        for x, book, gap in zip((rows[:, : self.cut], rows[:, self.cut :]), self.books, self.gaps):
            d = squared(x, book)
            own = d.argmin(1)
            planes = (d - d.min(1)[:, None]) / (2 * gap[own])
            planes[np.arange(len(x)), own] = 0
            out.append((own, np.maximum(planes, 0) ** 2))
        return out

    def cells(self, rows: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self.halves(rows)
        return a * len(self.books[1]) + b

    def visits(self, rows: np.ndarray, stop: float) -> list[list[int]]:
        """Cells of each row in order of distance, up to ``stop``."""
        (_, first), (_, second) = self.halves(rows)
        width, out = len(self.books[1]), []
        for x, y in zip(first, second):
            i_order, j_order = np.argsort(x, kind="stable"), np.argsort(y, kind="stable")
            xs, ys = x[i_order].tolist(), y[j_order].tolist()
            heap, found = [(xs[0] + ys[0], 0, 0)], []
            while heap and heap[0][0] <= stop:
                _, i, j = heappop(heap)
                found.append(int(i_order[i]) * width + int(j_order[j]))
                if j + 1 < len(ys):
                    heappush(heap, (xs[i] + ys[j + 1], i, j + 1))
                if j == 0 and i + 1 < len(xs):
                    heappush(heap, (xs[i + 1] + ys[0], i + 1, 0))
            out.append(found)
        return out


def stop_for(grid: Grid, rows: np.ndarray, threshold: float, recall: float, seed: int = 5) -> float:
    """Distance within which ``recall`` of partners at exactly the threshold have their cell."""
    draw = np.random.default_rng(seed)
    away = draw.normal(size=rows.shape)
    away -= (away * rows).sum(1)[:, None] * rows
    norm = np.sqrt((away * away).sum(1))
    partner = threshold * rows + np.sqrt(1 - threshold**2) * away / np.maximum(norm, 1e-300)[:, None]
    needed = np.zeros(len(rows))
    for (_, planes), (own, _) in zip(grid.halves(rows), grid.halves(partner)):
        needed += planes[np.arange(len(rows)), own]
    return float(np.quantile(needed, recall)) + 1e-9


def fit_grid(sample: np.ndarray, words: int, threshold: float, recall: float) -> tuple[Grid, float]:
    cut = sample.shape[1] // 2
    words = max(1, min(words, len(sample)))
    grid = Grid(fit_codebook(sample[:, :cut], words), fit_codebook(sample[:, cut:], words))
    return grid, stop_for(grid, sample, threshold, recall)


def coder(grid: Grid, stop: float):
    """node, n, data with the own cell and the visited cells."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = scaled(np.stack([np.frombuffer(x, "<f8") for x in batch.column("data").to_pylist()]))
            visits = pa.array(grid.visits(rows, stop), pa.list_(pa.int64()))
            columns = [batch.column("node"), batch.column("n"), batch.column("data"), pa.array(grid.cells(rows), pa.int64()), visits]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "data", "cell", "visits"])

    return coded


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) links that connect what ``linked`` connects, at most one for each row and column."""
    rows_left, cols_left, found = linked.any(1), linked.any(0), []
    while rows_left.any():
        new_rows = np.array([rows_left.argmax()])
        rows_left[new_rows] = False
        while len(new_rows):
            reach = linked[new_rows] & cols_left
            new_cols = np.flatnonzero(reach.any(0))
            found += zip(new_rows[reach[:, new_cols].argmax(0)].tolist(), new_cols.tolist())
            cols_left[new_cols] = False
            reach = linked[:, new_cols] & rows_left[:, None]
            new_rows = np.flatnonzero(reach.any(1))
            found += zip(new_rows.tolist(), new_cols[reach[new_rows].argmax(1)].tolist()) if len(new_cols) else []
            rows_left[new_rows] = False
    return found


def block_comparer(threshold: float):
    """Counts of linked vectors by query node, and links enough to connect them, for one pair of blocks."""

    def compare(items: pa.Table, queries: pa.Table) -> pa.Table:
        a, b, n = [], [], []
        if items.num_rows and queries.num_rows:
            x, y = (scaled(np.stack([np.frombuffer(v, "<f8") for v in t["data"].to_pylist()])) for t in (queries, items))
            q, i, weight = queries["node"].to_numpy(), items["node"].to_numpy(), items["n"].to_numpy()
            linked = (x @ y.T >= threshold) & (q[:, None] != i[None])
            counts = linked @ weight
            hit = np.flatnonzero(counts)
            a, n = q[hit].tolist(), counts[hit].tolist()
            b = [None] * len(a)
            for r, c in forest(linked):
                a.append(int(q[r]))
                b.append(int(i[c]))
                n.append(0)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return compare


def blocked(rows: DataFrame, cells: DataFrame, own: str, other: str) -> DataFrame:
    """Each row of a cell once for every block of the other side; cells of one block aren't listed in ``cells``."""
    joined = lookup_join(rows, cells, ["cell"], F.col("node"), "left")
    mine = F.pmod(F.xxhash64("node", F.lit(11)), F.coalesce(own, F.lit(1))).cast("int")
    theirs = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
    i, q = ("own", "theirs") if own == "item_blocks" else ("theirs", "own")
    return joined.withColumn("own", mine).withColumn("theirs", theirs).select("cell", F.col(i).alias("i"), F.col(q).alias("q"), "node", "n", "data")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, recall: float = RECALL, scratch: Scratch | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    rows = vectors.select("vec_id", "embedding").mapInArrow(canonical, "vec_id bigint, dim int, digest binary, data binary")
    rows = scratch.save(rows, "vectors")
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("digest").isNotNull())
    common = usable.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    nodes = usable.where(F.col("dim") == dim).groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("data").alias("data"))
    nodes = scratch.save(nodes, "nodes")

    sample = nodes.orderBy(F.xxhash64("node"), "node").select("data").limit(SAMPLE).collect()
    if sample:
        sample = scaled(np.stack([np.frombuffer(r["data"], "<f8") for r in sample]))
        words = min(MAX_WORDS, max(1, round(WORDS * nodes.count() ** 0.25)))
        grid, stop = fit_grid(sample, words, threshold, recall)
        coded = nodes.select("node", "n", "data").mapInArrow(coder(grid, stop), "node bigint, n bigint, data binary, cell bigint, visits array<bigint>")
        coded = scratch.save(coded, "coded")
        visits = coded.select("node", "n", "data", F.explode("visits").alias("cell"))
        many = coded.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("item_blocks")).where("item_blocks > 1")
        asked = visits.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks")).where("query_blocks > 1")
        cells = scratch.save(many.join(asked, "cell", "full_outer"), "large_cells")
        key = ["cell", "i", "q"]
        columns = [*key, "node", "n", "data"]
        # New column ids by toDF, since both sides come from one table.
        items = blocked(coded.select("node", "n", "data", "cell"), cells, "item_blocks", "query_blocks").toDF(*columns)
        queries = blocked(visits, cells, "query_blocks", "item_blocks").toDF(*columns)
        found = items.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(block_comparer(threshold), "a bigint, b bigint, n bigint")
        found = scratch.save(found, "found")
    else:
        found = spark.createDataFrame([], "a bigint, b bigint, n bigint")

    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    labels = components(found.where("b is not null").select("a", "b"), scratch)
    classes = nodes.select("digest", "node", "n").join(counts, "node", "left").join(labels, "node", "left")
    classes = classes.select(
        "digest", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    classes = scratch.save(classes, "classes")
    result = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(classes, "digest", "left")
    result = result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    result = scratch.save(result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "result")
    scratch.drop("vectors", "nodes", "coded", "large_cells", "found", "classes")
    return result
