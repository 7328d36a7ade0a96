"""Exact top-k inner products over a pivot-distance index.

Vectors x get one more component sqrt(R^2 - |x|^2), R the largest norm, and queries a zero. Then the
squared distance of query and vector is |q|^2 + R^2 - 2 q.x: the nearest vectors are those of the highest
products, and distances obey the triangle inequality.

Index: pivots are fitted to a bounded sample (``SAMPLE`` rows of the smallest id hash); every vector is
keyed by its nearest pivot and its distance to it, and the distances of a pivot are cut into ``ANNULI``
annuli at the sample's quantiles. A cell (pivot, annulus) knows its least and greatest distance.

Search: a query first scans the annulus it lies in at its nearest pivot, and expands from there to further
annuli of that pivot until it has k candidates. With its k-th best score as a bound, a cell is scanned only
if |d(q, pivot) - d(x, pivot)| can be as small as that score's distance for an x of the cell; all others
are ruled out by the triangle inequality. So the result is exact, whatever the pivots.

Scale: cells are cut into chunks of about ``CHUNK`` vectors and queries into blocks of about ``BLOCK``;
a task compares one chunk with the queries of one block that need it, and returns k rows per query.
Equal vectors: a query's k best hold no more than the k + 1 smallest ids of one vector, so the index
keeps just these; which also bounds a vector that a third of all rows share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlens.llm.store import written

PIVOTS = 24
ANNULI = 8
SAMPLE = 4096
CHUNK = 4096
BLOCK = 2048
#: query_id numbers a query row, own is its vec_id.
RESULT_SCHEMA = "query_id bigint, own bigint, vec_id bigint, score bigint"


def quantized(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v, n): floor(scale * x) of each component as bytes of doubles, without the rows that take no part.

    Those are vectors that are null or hold a null or a component that is not finite, and rows without an
    id. ``n`` counts the rows equal in both. Shorter vectors count as if filled up with zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, row in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
                if i is None or row is None or any(x is None for x in row):
                    continue
                x = np.floor(scale * np.asarray(row, np.float64))
                if np.isfinite(x).all():
                    ids.append(i)
                    out.append((x + 0.0).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id bigint, v binary").groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))


def matrix(rows, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x = np.frombuffer(r, "<f8")
        out[i, : len(x)] = x
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond the exact range of doubles by Python integers, held to 64 bits."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = np.array([[int(c) for c in r] for r in q], object) @ np.array([[int(c) for c in r] for r in x], object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


@dataclass
class Pivots:
    dim: int
    norm2: float  # of the longest vector
    centers: np.ndarray  # (pivots, dim + 1)
    edges: np.ndarray  # (pivots, annuli - 1): inner bounds of the annuli

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))
        return np.concatenate([x, last[:, None]], 1)

    def distances(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        y = self.lifted(x, query)
        square = (y * y).sum(1)[:, None] + (self.centers**2).sum(1) - 2 * y @ self.centers.T
        return np.sqrt(np.maximum(square, 0))

    def cells(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row and its distance to the pivot."""
        pivot = distances.argmin(1)
        d = distances[np.arange(len(distances)), pivot]
        return pivot * (self.edges.shape[1] + 1) + (self.edges[pivot] <= d[:, None]).sum(1), d

    @classmethod
    def fit(cls, sample: np.ndarray, norm2: float, pivots: int, annuli: int) -> Pivots:
        """Farthest-first centres, moved by a few rounds of means; quantiles of the distances."""
        own = cls(sample.shape[1], norm2, np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 0)))
        y = own.lifted(sample, False)
        centers, near = [y[0]], ((y - y[0]) ** 2).sum(1)
        while len(centers) < min(pivots, len(y)) and near.max() > 0:
            centers.append(y[near.argmax()])
            near = np.minimum(near, ((y - centers[-1]) ** 2).sum(1))
        own.centers = np.array(centers)
        for _ in range(5):
            of = own.distances(sample).argmin(1)
            own.centers = np.array([y[of == i].mean(0) if (of == i).any() else c for i, c in enumerate(own.centers)])
        d = own.distances(sample)
        of, d = d.argmin(1), d.min(1)
        cuts = np.linspace(0, 1, annuli + 1)[1:-1]
        own.edges = np.array([np.quantile(d[of == i], cuts) if (of == i).any() else np.zeros(len(cuts)) for i in range(len(own.centers))])
        return own


def _indexed(rows: DataFrame, shared, query: bool) -> DataFrame:
    """``rows(vec_id, v)`` with their cell and distance; for queries also the distances to all pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            d = p.distances(matrix(batch.column("v").to_pylist(), p.dim), query)
            cell, own = p.cells(d) if len(d) else (np.zeros(0, np.int64), np.zeros(0))
            columns = [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32))]
            columns.append(pa.array(list(d), pa.list_(pa.float64())) if query else pa.array(own))
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "d"])

    return rows.select("vec_id", "v").mapInArrow(run, f"vec_id bigint, v binary, cell int, d {'array<double>' if query else 'double'}")


def _each(rows: DataFrame, k: int) -> DataFrame:
    """``rows(vec_id, v, n)`` one by one; of equal rows ``k`` at most, as no ranking of k takes more."""
    return rows.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))).alias("_copy"))


def _best(k: int, dim: int):
    def run(key: tuple, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "own": [], "vec_id": [], "score": []}).astype("int64")
        rows, q_ids, x_ids = (f[c].to_numpy(np.int64) for f, c in ((queries, "query_id"), (queries, "own"), (vectors, "vec_id")))
        s = products(matrix(queries["q"], dim), matrix(vectors["v"], dim))
        other = q_ids[:, None] != x_ids
        if len(x_ids) > k:  # what falls below the k-th best besides the query's own rows is out
            floor = np.partition(np.where(other, s, np.iinfo(np.int64).min), -k, axis=1)[:, -k]
            other &= s >= floor[:, None]
        a, b = np.nonzero(other)
        score = s[a, b]
        order = np.lexsort((x_ids[b], -score.astype(np.float64) if abs(score).max(initial=0) < 2**53 else ~score, a))
        a, b, score = a[order], b[order], score[order]
        first = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=len(q_ids)))])
        keep = np.arange(len(a)) - first[a] < k
        return pd.DataFrame({"query_id": rows[a[keep]], "own": q_ids[a[keep]], "vec_id": x_ids[b[keep]], "score": score[keep]})

    return run


def _scan(visits: DataFrame, index: DataFrame, chunks: DataFrame, blocks: int, k: int, dim: int) -> DataFrame:
    """The k best of every (query, chunk) that ``visits(query_id, own, q, cell)`` asks for."""
    dealt = visits.join(F.broadcast(chunks), "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).select("query_id", "own", "q", "cell", "chunk", "block")
    wanted = dealt.select("cell", "chunk", "block").distinct()
    copies = index.join(F.broadcast(chunks), "cell").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), "chunks").cast("int"))
    copies = copies.join(wanted, ["cell", "chunk"]).select("vec_id", "v", *[F.col(c).alias(f"x_{c}") for c in ("cell", "chunk", "block")])
    asking = dealt.groupBy("cell", "chunk", "block")
    return asking.cogroup(copies.groupBy("x_cell", "x_chunk", "x_block")).applyInPandas(_best(k, dim), RESULT_SCHEMA)


def _ranked(found: DataFrame, k: int, of: str = "query_id") -> DataFrame:
    order = Window.partitionBy(of).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int = PIVOTS, annuli: int = ANNULI,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest products of each row of ``vectors(vec_id, embedding)``
    that ``is_query`` (a condition on vec_id) names, with all rows of other ids; ties go to the smaller vec_id.

    Every row counts: one id may have several vectors, each a candidate, and equal rows are as many candidates.
    An id that several query rows bear has one ranking, of the products of all of them.

    Fewer candidates give fewer rows. Which rows take no part is said at ``quantized``; an empty table or
    one without queries gives no rows, other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = written(quantized(vectors, scale), "vectors")
    queries = _each(rows.filter(is_query), k).select(F.monotonically_increasing_id().alias("query_id"), F.col("vec_id").alias("own"), F.col("v").alias("q"))
    queries = written(queries, "queries")
    # of the ids of one vector the k + 1 smallest: without a query's own id, k are left
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = _each(rows.withColumn("_nth", F.row_number().over(copies)).filter(F.col("_nth") <= k + 1), k)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, top = 0, 0.0
        for batch in batches:
            for v in batch.column("v").to_pylist():
                x = np.frombuffer(v, "<f8")
                dim, top = max(dim, len(x)), max(top, float(x @ x))
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([top])], names=["dim", "top"])

    dim, norm2 = rows.mapInArrow(norms, "dim int, top double").agg(F.max("dim"), F.max("top")).first()
    sample = [bytes(r[0]) for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").select("v").limit(SAMPLE).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    fitted = Pivots.fit(matrix(sample, dim), norm2, pivots, annuli)
    shared = spark.sparkContext.broadcast(fitted)
    index = written(_indexed(kept, shared, False), "pivot-index")
    placed = _indexed(queries.select(F.col("query_id").alias("vec_id"), F.col("q").alias("v")), shared, True)
    placed = placed.withColumnRenamed("vec_id", "query_id").withColumnRenamed("v", "q")
    asked = written(placed.join(queries.select("query_id", "own"), "query_id"), "pivot-queries")
    # one row per cell: at most pivots * annuli
    cells = {r["cell"]: r for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    chunks = spark.createDataFrame([(c, -(-r["n"] // CHUNK)) for c, r in cells.items()], "cell int, chunks int")
    blocks = max(1, -(-asked.count() // BLOCK))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From the query's own annulus outwards at its nearest pivot, until the cells hold k candidates."""
        for batch in batches:
            ids, owns, qs, at = [], [], [], []
            for i, own, q, cell, d in zip(*(batch.column(c).to_pylist() for c in ("query_id", "own", "q", "cell", "d"))):
                pivot, here = cell // annuli, d[cell // annuli]
                near = [c for c in range(pivot * annuli, (pivot + 1) * annuli) if c in cells]
                near.sort(key=lambda c: (max(cells[c]["lo"] - here, here - cells[c]["hi"], 0.0), c))
                n = 0
                for c in near:
                    ids.append(i), owns.append(own), qs.append(q), at.append(c)
                    n += cells[c]["n"]
                    if n > k:  # one of them can be the query itself
                        break
            yield visits(ids, owns, qs, at)

    visit_schema = "query_id bigint, own bigint, q binary, cell int"

    def visits(ids: list, owns: list, qs: list, cells: list) -> pa.RecordBatch:
        columns = [pa.array(ids, pa.int64()), pa.array(owns, pa.int64()), pa.array(qs, pa.binary()), pa.array(cells, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "own", "q", "cell"])

    first_visits = written(asked.mapInArrow(home, visit_schema), "first-visits")
    first = written(_ranked(_scan(first_visits, index, chunks, blocks, k, dim), k), "first-found")
    bound = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    seen = first_visits.groupBy("query_id").agg(F.collect_list("cell").alias("seen"))  # at most annuli cells
    rest_of = asked.join(bound, "query_id", "left").join(seen, "query_id", "left")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The unseen cells that the triangle inequality does not rule out."""
        at = np.array(sorted(cells), np.int64)
        lo, hi = (np.array([cells[c][b] for c in at.tolist()]) for b in ("lo", "hi"))
        for batch in batches:
            ids, owns, qs, to = [], [], [], []
            for i, own, q, d, n, worst, seen in zip(*(batch.column(c).to_pylist() for c in ("query_id", "own", "q", "d", "n", "worst", "seen"))):
                x = np.frombuffer(q, "<f8")
                reach = np.inf
                if n is not None and n >= k:
                    reach = np.sqrt(max(float(x @ x) + norm2 - 2.0 * worst, 0.0))
                slack = 1e-6 * (1 + np.sqrt(norm2) + np.sqrt(float(x @ x)))  # over the rounding of distances
                here = np.asarray(d)[at // annuli]
                need = (here >= lo - reach - slack) & (here <= hi + reach + slack) & ~np.isin(at, seen or [])
                to += at[need].tolist()
                ids += [i] * int(need.sum())
                owns += [own] * int(need.sum())
                qs += [q] * int(need.sum())
            yield visits(ids, owns, qs, to)

    more = _scan(rest_of.select("query_id", "own", "q", "d", "n", "worst", "seen").mapInArrow(rest, visit_schema), index, chunks, blocks, k, dim)
    both = _ranked(first.select("own", "vec_id", "score").unionByName(more.select("own", "vec_id", "score")), k, "own")
    return both.select(F.col("own").alias("query_id"), "rank", "vec_id", "score")
