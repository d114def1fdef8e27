"""Approximate nearest neighbours by inner product, with collision-counting hashing.

Vectors are cut by hash into blocks of about ``BLOCK`` rows. A block's index is one sorted array of projections for
each of ``LINES`` random lines. A query opens a window around its own projection on every line; virtual rehashing widens
all windows by the factor ``WIDEN`` until enough is found, beginning near the usual distance of a few sampled vectors. A vector that lies in at least ``LEAST`` of the windows is
verified with its exact inner product. A search ends when its k-th best vector is nearer than the distance that the
windows are made for, or when every vector of the block is verified, so a vector is left out by distance, never by count.

Inner products become distances by one more coordinate: with M the largest norm, x gets sqrt(M^2 - |x|^2) and a query,
scaled to norm M, gets 0; the nearest points are those of the largest inner product.

Every row is indexed; nothing is fitted but M. Each query meets each block, in blocks of queries: the query set is a
twentieth of the table, as stated, and a task holds one block of either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK = 8_192, 4_096
LINES, WIDEN, REACH, LEAST, SEED = 240, 1.15, 1.1, 0.7, 5
#: Queries whose windows are counted together.
TOGETHER = 64
#: Vectors of a block whose k-th neighbour tells where its searches begin.
PROBES = 16
_FOUND = "query_id long, query string, vec_id long, score double, copies long"


def _stack(rows: pd.Series, width: int) -> np.ndarray:
    """The vectors as rows; components that a shorter one lacks are zero."""
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


class Block:
    """Collision-counting index of one block of vectors.

    The index is built on vectors divided by ``scale``, a power of two that brings the largest component of the table
    below 1, so that no norm overflows; ``top`` is the largest norm of those. Scores come from the original vectors.
    """

    def __init__(self, ids: np.ndarray, given: np.ndarray, copies: np.ndarray, top: float, scale: float = 1.0, lines: int = LINES):
        vectors = given / scale
        self.ids, self.given, self.copies, self.vectors, self.top = ids, given, copies, vectors, top
        n, d = vectors.shape
        more = np.sqrt(np.maximum(top**2 - (vectors**2).sum(axis=1), 0))
        self.lines = np.random.default_rng(SEED).normal(size=(d + 1, lines))
        spots = vectors @ self.lines[:d] + more[:, None] * self.lines[d]
        self.sorted = np.sort(spots, axis=0).T.copy()
        order = np.argsort(spots, axis=0, kind="stable")
        # A vector's place on each line, in 256 steps of as many vectors each: a byte is counted fast.
        self.places = np.empty((lines, n), dtype=np.uint8)
        np.put_along_axis(self.places, order.T, (np.arange(n) * 256 // n).astype(np.uint8)[None, :], axis=1)
        self.least = int(np.ceil(LEAST * lines))
        self.starts: dict[int, float] = {}
        self.searched = self.verified = 0  # searches, and vectors verified in them

    def _start(self, k: int) -> float:
        """Nine tenths of the median distance at which sampled vectors have their ``k``-th neighbour in the block."""
        if k not in self.starts:
            probes = self.vectors[:: max(1, len(self.ids) // PROBES)]
            scaled = probes * (self.top / np.maximum(np.linalg.norm(probes, axis=1, keepdims=True), 1e-300))
            best = np.partition(scaled @ self.vectors.T, len(self.ids) - k, axis=1)[:, -k]
            self.starts[k] = max(0.05 * self.top, 0.9 * float(np.median(np.sqrt(np.maximum(2 * self.top**2 - 2 * best, 0)))))
        return self.starts[k]

    def _collisions(self, spots: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """For each query (a row of ``spots``) in how many of its windows each vector lies."""
        n = len(self.ids)
        counts = np.zeros((len(spots), n), dtype=np.uint8)
        for line, spot, places in zip(self.sorted, spots.T, self.places, strict=True):
            low, high = np.searchsorted(line, spot - halves), np.searchsorted(line, spot + halves)
            first, last = low * 256 // n, -(-high * 256 // n)
            inside = (places[None, :] - first.astype(np.uint8)[:, None]) < np.minimum(last - first, 255).astype(np.uint8)[:, None]
            inside[last - first > 255] = True
            inside[high <= low] = False
            counts += inside
        return counts

    def nearest(self, ids: np.ndarray, asked: np.ndarray, k: int) -> list[list[tuple[int, float, int]]]:
        """For each query id, score and copies of the ``k`` nearest found, nearest first, equal scores by id; its own row does not count."""
        out = []
        for at in range(0, len(ids), TOGETHER):
            out += self._nearest(ids[at : at + TOGETHER], asked[at : at + TOGETHER], k)
        return out

    def _nearest(self, ids: np.ndarray, asked: np.ndarray, k: int) -> list[list[tuple[int, float, int]]]:
        peaks = np.frexp(np.abs(asked).max(axis=1))[1]
        queries = asked / (2.0 ** np.clip(peaks, -1000, 1000))[:, None]  # a query's length does not change what is near
        norms = np.sqrt((queries**2).sum(axis=1))
        spots = (queries * (self.top / norms)[:, None]) @ self.lines[: queries.shape[1]]
        left = np.stack([self.copies - ((self.ids == i) & (self.given == q).all(axis=1)) for i, q in zip(ids, asked, strict=True)])
        todo, scores = left > 0, np.full(left.shape, -np.inf)
        wanted = np.minimum(k, todo.sum(axis=1))
        radius = np.array([self._start(int(w)) if w else 0.0 for w in wanted])
        active = np.flatnonzero(wanted)
        while len(active):
            near = self._collisions(spots[active], REACH * radius[active]) >= self.least
            done = np.zeros(len(active), dtype=bool)
            for row, q in enumerate(active):
                new = np.flatnonzero(todo[q] & near[row])
                scores[q, new] = self.vectors[new] @ queries[q]
                todo[q, new] = False
                best = np.partition(scores[q], len(self.ids) - wanted[q])[-wanted[q]]
                # Squared distance of the k-th best, from its inner product with the scaled query.
                done[row] = best > -np.inf and 2 * self.top**2 - 2 * best * self.top / norms[q] <= radius[q] ** 2 or not todo[q].any()
            active = active[~done]
            radius[active] *= WIDEN
        self.searched, self.verified = self.searched + len(ids), self.verified + int((scores > -np.inf).sum())
        return [self._exact(scores[q], asked[q], norms[q], left[q], int(wanted[q])) for q in range(len(ids))]

    def _exact(self, scores: np.ndarray, asked: np.ndarray, norm: float, left: np.ndarray, wanted: int) -> list[tuple[int, float, int]]:
        if not wanted:
            return []
        close = np.flatnonzero(scores >= np.partition(scores, len(scores) - wanted)[-wanted] - 1e-9 * self.top * norm)
        with np.errstate(over="ignore", invalid="ignore"):
            exact = (self.given[close] * asked).sum(axis=1)  # the same for equal vectors, wherever they lie
        order = np.lexsort((self.ids[close], np.where(np.isnan(exact), np.inf, -exact)))[:wanted]
        return [(int(self.ids[close[i]]), None if np.isnan(exact[i]) else float(exact[i]), int(left[close[i]])) for i in order]


def _search(top: float, scale: float, k: int, width: int):
    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(queries):
            block = Block(data["vec_id"].to_numpy(), _stack(data["vector"], width), data["copies"].to_numpy(), top, scale)
            asked = queries["vec_id"].to_numpy(), queries["query"].tolist()
            for query_id, name, rows in zip(asked[0].tolist(), asked[1], block.nearest(asked[0], _stack(queries["vector"], width), k), strict=True):
                found += [(query_id, name, *row) for row in rows]
        return pd.DataFrame(found, columns=["query_id", "query", "vec_id", "score", "copies"])

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``is_query`` (on the id) holds, its ``k`` nearest others.

    Nearness is the inner product in double precision; ties go to the smaller id. Vectors that are null, zero or hold a
    null or non-finite component take no part, nor do rows with a null id; components that a shorter vector lacks are
    zero. Rows that repeat an id are candidates each, also for one another; rows that repeat id and vector are one query,
    of which all but one are its candidates. Finite components of any size are searched (the index is scaled); a score
    beyond the range of doubles is infinite, one that is no number (infinities that cancel) is null and comes last. Vectors whose
    components are all below the largest component by 2^-500 or more count as zeros in the index, and are found by
    verification alone. With fewer candidates than ``k`` all are returned; an empty table gives an empty result; extra
    columns of any name are ignored.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where("vec_id is not null and vector is not null")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(sound).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    peak = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(peak).alias("peak"), F.max(F.size("vector")).alias("width"), F.count_if(is_query).alias("q")).first()
    if not facts["n"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scale, width = float(2.0 ** min(1023, max(-1022, int(np.frexp(facts["peak"])[1])))), facts["width"]
    top = rows.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale))))).first()[0]
    size = max(1, BLOCK * 64 // max(64, width))  # blocks of long vectors have fewer
    blocks, query_blocks = -(-facts["n"] // size), max(1, -(-facts["q"] // QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    data = rows.select("vec_id", "vector", "copies", deal(blocks).alias("block"), every(query_blocks).alias("query_block"))
    name = F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256)
    asked = rows.where(is_query).select("vec_id", "vector", name.alias("query"), every(blocks).alias("block"), deal(query_blocks).alias("query_block"))
    keys = ("block", "query_block")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search(float(top), scale, k, width), _FOUND)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc_nulls_last("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
