"""Exact top-k search by inner product on an impact-ordered index, score at a time.

A vector component becomes the integer floor(1024 x). The index of a block of vectors holds, for every dimension, the
block's postings sorted by value and cut into segments of like value. For a query, a segment's *impact* is the most
that it adds to a score or takes from it. Segments of all dimensions are processed by descending quantised impact: each
adds its middle value to the accumulators of its vectors, together with what it leaves open. What a vector's unread
components can still add or take is bounded by the lengths of the unread parts of both vectors (Cauchy and Schwarz).
After every level the k-th best score that is certain is held against what the other vectors can still reach. A search
stops early only on that proof, when the possible members that are left are cheaper to score than the rest is to read;
they are then scored exactly in integers, so results are exact whatever the quantisation.

Blocks of vectors meet blocks of queries (the stated query set), each pair in a task of its own; per query and block at
most k rows leave it.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
#: Components of a block of vectors and of a block of queries; segments of a dimension; levels of impact.
BLOCK_VALUES, QUERY_VALUES = 1 << 19, 1 << 18
SEGMENTS, LEVELS = 128, 48
_FOUND = "query_id long, query string, vec_id long, score decimal(38,0), copies long"
_MOST = 10**38 - 1


def _stack(rows: pd.Series, width: int) -> np.ndarray:
    """The vectors as rows of integers; missing components of shorter ones are zero."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


class ImpactIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, d = vectors.shape
        self.peaks = np.abs(vectors.astype(np.float64)).max(axis=0) if n else np.zeros(d)
        self.scale = max(float(self.peaks.max(initial=0)), 1.0)
        values = vectors / self.scale
        self.squares = (values**2).sum(axis=1)
        order = np.argsort(values, axis=0, kind="stable")
        ranked = np.take_along_axis(values, order, axis=0).T
        self.postings = order.T.astype(np.int32).ravel()  # dimension by dimension, by value
        least, most = ranked[:, :1], ranked[:, -1:]
        codes = np.minimum((ranked - least) * (SEGMENTS / np.where(most > least, most - least, 1)), SEGMENTS - 1).astype(np.int32)
        starts = np.concatenate([np.ones((d, 1), dtype=bool), codes[:, 1:] != codes[:, :-1]], axis=1)
        self.dim, start = np.nonzero(starts)
        self.start = self.dim * n + start
        self.length = np.diff(self.start, append=n * d)
        self.low, self.high = ranked.ravel()[self.start], ranked.ravel()[self.start + self.length - 1]
        self.least_square = np.where((self.low < 0) & (self.high > 0), 0, np.minimum(self.low**2, self.high**2))
        self.read = self.scored = self.searched = 0  # postings read, vectors scored exactly, searches

    def _possible(self, query: np.ndarray, k: int) -> np.ndarray:
        """Positions of all vectors that may be among the ``k`` best; all others are proved not to be."""
        n, d = self.vectors.shape
        q = query / max(float(np.abs(query.astype(np.float64)).max()), 1.0)
        ends = np.sort([q[self.dim] * self.low, q[self.dim] * self.high], axis=0)
        middle, half, impact = ends.mean(axis=0), (ends[1] - ends[0]) / 2, np.abs(ends).max(axis=0)
        top = impact.max(initial=0)
        if n <= k or top <= 0:
            return np.arange(n)
        level = np.minimum((impact * (LEVELS / top)).astype(np.int32), LEVELS - 1)
        order = np.argsort(-level, kind="stable")
        cuts = np.flatnonzero(np.diff(level[order], prepend=LEVELS, append=-1))
        certain, square, asked = np.zeros(n), self.squares.copy(), np.full(n, (q**2).sum())
        slack, unread = np.zeros(d), n * d
        close = 1e-9 * (d + 1)  # more than what rounding can do to sums of d products of at most 1
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = order[a:b]
            length = self.length[now]
            places = np.arange(length.sum()) + np.repeat(self.start[now] - np.cumsum(length) + length, length)
            docs = self.postings[places]
            certain += np.bincount(docs, np.repeat(middle[now], length), n)
            square -= np.bincount(docs, np.repeat(self.least_square[now], length), n)
            asked -= np.bincount(docs, np.repeat(q[self.dim[now]] ** 2, length), n)
            np.maximum.at(slack, self.dim[now], half[now])
            unread -= len(docs)
            # What a vector's unread components add is at most the product of both unread lengths.
            spread = np.sqrt(np.maximum(square + close, 0) * np.maximum(asked + close, 0)) if unread else np.zeros(n)
            spread += slack.sum() + close
            possible = certain + spread >= np.partition(certain - spread, n - k)[n - k]
            if possible.sum() * d <= unread:
                break
        self.read += n * d - unread
        return np.flatnonzero(possible)

    def search(self, query_id: int, query: np.ndarray, k: int, copies: np.ndarray) -> list[tuple[int, int, int]]:
        """``(vec_id, score, copies)`` of the ``k`` best, equal scores by id; the query's own row does not count."""
        own = (self.ids == query_id) & (self.vectors == query).all(axis=1)
        left = copies - own
        possible = self._possible(query, k + 1)
        self.searched, self.scored = self.searched + 1, self.scored + len(possible)
        possible = possible[left[possible] > 0]
        safe = float((self.peaks * np.abs(query.astype(np.float64))).sum()) < 2**62
        rows = self.vectors[possible]
        scores = rows @ query if safe else np.array([sum(int(x) * int(y) for x, y in zip(r, query, strict=True)) for r in rows], dtype=object)
        if safe and len(scores) > k:
            best = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            possible, scores = possible[best], scores[best]
        order = sorted(range(len(possible)), key=lambda i: (-scores[i], self.ids[possible[i]]))[:k]
        return [(int(self.ids[possible[i]]), int(scores[i]), int(left[possible[i]])) for i in order]


def _search(k: int, width: int):
    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(queries):
            index, copies = ImpactIndex(data["vec_id"].to_numpy(), _stack(data["vector"], width)), data["copies"].to_numpy()
            for query_id, name, vector in zip(queries["vec_id"].tolist(), queries["query"], _stack(queries["vector"], width), strict=True):
                found += [(query_id, name, i, Decimal(max(-_MOST, min(_MOST, s))), n) for i, s, n in index.search(query_id, vector, k, copies)]
        return pd.DataFrame(found, columns=["query_id", "query", "vec_id", "score", "copies"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_values: int = BLOCK_VALUES, query_values: int = QUERY_VALUES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``is_query`` (on the id) holds, its ``k`` best others, exactly.

    Ties go to the smaller id; with fewer candidates than ``k`` all are returned. Vectors that are null or hold a null or
    non-finite component take no part, nor do rows with a null id. Vectors of zeros take part, also as queries; an empty
    vector is one of zeros, and components that a shorter vector lacks are zero. Rows that repeat an id are candidates
    each, also for one another; rows that repeat id and vector are one query, of which all but one are its candidates.
    Components beyond 64 bits are held at their ends, as are scores beyond 38 digits while they are ranked and beyond 64
    bits in the result. An empty table gives an empty result; extra columns of any name are ignored.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where("vec_id is not null and vector is not null").where(sound)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * SCALE).cast("long")))
    rows = rows.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.count_if(is_query).alias("q")).first()
    width = max(1, facts["width"] or 0)
    blocks, query_blocks = max(1, -(-facts["n"] * width // block_values)), max(1, -(-facts["q"] * width // query_values))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    data = rows.select("vec_id", "vector", "copies", deal(blocks).alias("block"), every(query_blocks).alias("query_block"))
    name = F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256)
    asked = rows.where(is_query).select("vec_id", "vector", name.alias("query"), every(blocks).alias("block"), deal(query_blocks).alias("query_block"))
    keys = ("block", "query_block")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search(k, width), _FOUND)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ends = [F.lit(x).cast("decimal(38,0)") for x in (-(1 << 63), (1 << 63) - 1)]
    return best.select("query_id", "rank", "vec_id", F.greatest(ends[0], F.least(ends[1], "score")).cast("long").alias("score"))
