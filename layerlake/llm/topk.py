"""Exact top-k by inner product with the threshold algorithm over sorted lists per dimension.

Rows are dealt into blocks of bounded size. A block's sorted lists run along its
axes of largest variance; all queries of a lot read them together, from both
ends and to the same depth. Every vector met is scored in full, for all queries
that still read. What has not been met can score no more than the values at that
depth would together, and the rest of the vector by its length; once a query's
kth score is above that bound, it stops. The depth doubles from round to round,
up to the end of the lists. Scores equal to the bound are read on for, so ties
are settled.

Vectors that are null, or hold a null or a value that is not finite, take no
part, nor do empty ones or rows without an id. Vectors of
different lengths do not meet. Scores are exact
integers; scores and components that do not fit a long are the nearest long. Repeated rows are candidates each; a query row excludes
rows with its own id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K = 10
SCALE = 1024
BLOCK = 16_384
QUERIES = 2_048
DEPTH = 64
SHARE = 0.9
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, scale: int = SCALE, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """vec_id and v: floor(scale * x) of each component as long; vectors that cannot take part are left out."""
    x = F.transform(F.col(f"`{vec_col}`"), lambda e: e.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL")
    fit = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.where((F.size("x") > 0) & F.coalesce(fit, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))


class Exact:
    """Rows made ready once for exact inner products: in doubles while those are exact, else in longs, else as integers."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.most = rows, _largest(rows)
        self.doubles = rows.astype(np.float64)

    def scores(self, queries: np.ndarray, which) -> np.ndarray:
        reach = _largest(queries) * self.most * self.rows.shape[1]
        if reach < 2**53:
            return (queries.astype(np.float64) @ self.doubles[which].T).astype(np.int64)
        if reach < 2**63:
            return queries @ self.rows[which].T
        whole = queries.astype(object) @ self.rows[which].astype(object).T
        return np.minimum(np.maximum(whole, -LONG - 1), LONG).astype(np.int64)


def _largest(rows: np.ndarray) -> int:
    return max(int(rows.max()), -int(rows.min())) if rows.size else 0


class Lists:
    """Sorted lists of a block of vectors, along the axes on which they differ most.

    Inner products do not change under a rotation, so the lists may run along
    any orthogonal axes; those of largest variance, as many as hold ``share`` of
    it, come first and get a list each. What is left of a vector beyond them
    counts with its length. Scores come from the whole vectors, exactly; only
    the bound uses these doubles, with a little added for their rounding.
    """

    def __init__(self, block: np.ndarray, share: float = SHARE):
        x = block.astype(np.float64)
        spread, axes = np.linalg.eigh(x.T @ x)
        spread, axes = np.maximum(spread[::-1], 0), axes[:, ::-1]
        held = np.cumsum(spread) >= share * spread.sum()
        self.axes = axes[:, : int(np.argmax(held)) + 1]
        along = x @ self.axes
        self.rest = float(np.sqrt(np.maximum((x * x).sum(1) - (along * along).sum(1), 0).max()))
        self.length = float(np.sqrt((x * x).sum(1).max()))
        self.order = np.argsort(along, axis=0, kind="stable")
        self.sorted = np.take_along_axis(along, self.order, axis=0)

    def read(self, start: int, depth: int) -> np.ndarray:
        """The rows at these depths from both ends of every list; an end that no query favours costs little."""
        n = len(self.order)
        return np.unique(np.concatenate((self.order[n - depth : n - start].ravel(), self.order[start:depth].ravel())))

    def bounds(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """What a row not yet met can score at most, for each query."""
        q = queries.astype(np.float64)
        along, size = q @ self.axes, np.sqrt((q * q).sum(1))
        rest = np.sqrt(np.maximum(size * size - (along * along).sum(1), 0))
        top, low = self.sorted[len(self.sorted) - depth], self.sorted[depth - 1]
        bound = np.maximum(along, 0) @ top + np.minimum(along, 0) @ low + rest * self.rest
        return bound + 1e-9 * size * self.length + 1


def block_top(ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, stops: list | None = None):
    """(query number, id, score) of the k best of a block for each query, ties to the smaller id.

    ``stops``, if given, gets the depth at which each query stopped and how many rows had been met by then.
    """
    lists, exact, n = Lists(block), Exact(block), len(block)
    active, met = np.arange(len(queries)), np.zeros(n, bool)
    best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)  # (scores, ids) so far
    depth, start = min(DEPTH, n), 0
    while len(active):
        new = lists.read(start, depth)
        new = new[~met[new]]
        met[new] = True
        scores = exact.scores(queries[active], new)
        bound = lists.bounds(queries[active], depth)
        left = []
        for row, qi in enumerate(active):
            s, i = scores[row], ids[new]
            own = i != query_ids[qi]
            s, i = np.concatenate((best[qi][0], s[own])), np.concatenate((best[qi][1], i[own]))
            if len(s) > k:  # what is below the kth score is out; ties with it stay
                stay = s >= np.partition(s, -k)[-k]
                s, i = s[stay], i[stay]
                first = np.lexsort((i, ~s))[:k]
                s, i = s[first], i[first]
            best[qi] = s, i
            if met.all() or (len(s) >= k and s.min() > bound[row]):
                if stops is not None:
                    stops.append((depth, int(met.sum())))
            else:
                left.append(qi)
        active = np.array(left, np.int64)
        start, depth = depth, min(2 * depth, n)
    out = [(np.full(len(s), qi), i[o], s[o]) for qi, (s, i) in enumerate(best) for o in [np.lexsort((i, ~s))[:k]]]
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def top_k(
    vectors: DataFrame, query_filter: str = "vec_id % 100 = 0", k: int = K, scale: int = SCALE,
    id_col="vec_id", vec_col="embedding", block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows. Queries are the rows that meet ``query_filter``."""
    rows = stored(whole_vectors(vectors, scale, id_col, vec_col).withColumn("d", F.size("v")))
    n, m = rows.agg(F.count("*"), F.count_if(F.expr(query_filter))).first()
    blocks, lots = max(1, -(-n // block)), max(1, -(-m // QUERIES))
    deal = lambda to, salt: F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id(), F.lit(salt)), F.lit(to)).cast("int")
    data = rows.withColumn("block", deal(blocks, 1)).withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    asked = rows.where(query_filter).withColumn("lot", deal(lots, 2))
    asked = asked.withColumn("row", F.monotonically_increasing_id())  # tells repeated query rows
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(key, own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []}).astype("int64")
        if own.empty or queries.empty:
            return empty
        ids, qids = own["vec_id"].to_numpy(np.int64), queries["vec_id"].to_numpy(np.int64)
        qi, vec, score = block_top(ids, np.stack(own["v"].to_list()), qids, np.stack(queries["v"].to_list()), k)
        return pd.DataFrame({"query_id": qids[qi], "row": queries["row"].to_numpy()[qi], "vec_id": vec, "score": score})

    keys = ["d", "block", "lot"]
    part = data.select(*keys, "vec_id", "v").groupBy(*keys).cogroup(asked.select(*keys, "vec_id", "v", "row").groupBy(*keys))
    best = part.applyInPandas(search, "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
