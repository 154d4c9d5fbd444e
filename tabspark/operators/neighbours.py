"""k-nearest-neighbour search and classification as a blocked join, exact or through an index.

Training rows are cut into cells around sampled pivots.  Cell radii bound every
distance, so a query row visits only the cells that can hold one of its k
neighbours.  A crowded cell is split into blocks of bounded size and the queries
of a block into chunks, so one task never holds a whole cell; each task keeps its
k best per query and the merge sees k rows per visited block.  Where radii rule out
little, blocks are joined into units, so a query row is sent and merged once per
unit.  A task works in tiles: a matrix product leaves the few pairs that can be among
the k best, and these get their distance from the differences.

Wide vectors are about equally far from each other, so radii rule out little. For
them ``CellIndex`` puts every row into the cell of its nearest fitted centre, and a
query visits only as many cells as a wanted share of the true neighbours needs. That
number is measured against the exact search, not set.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from tabspark.functions.scalar import HASH_RANGE, hash32, ident
from tabspark.operators.small import small_table

BLOCK_ROWS = 4_096
MAX_PIVOTS = 1_024
#: Blocks in a unit, numbers in its vectors, and units at least, where a query visits more than DENSE of all blocks.
UNIT_BLOCKS, UNIT_CELLS, UNITS, DENSE = 16, 1 << 22, 5, 0.5
#: Rows of a tile by queries and by training rows, and pairs whose differences are held at once.
TILE, TILE_ROWS, TILE_PAIRS = 1_024, 4_096, 1 << 15
#: Rows that the centres of an index are fitted on, and rows whose neighbours set the cells a query visits.
CENTRE_ROWS = 65_536
MEASURED_ROWS = 1_000


@dataclass(frozen=True)
class CellIndex:
    """Centres of cells in the coordinates of ``metric`` and the number of cells that a query visits."""

    centres: np.ndarray
    probes: int
    metric: str = "minkowski"


def _embed(metric: str):
    """Coordinates whose Euclidean order is the metric's order, and the distance map."""
    if metric in ("minkowski", "euclidean"):
        return (lambda a: a), (lambda d: d)
    if metric == "cosine":
        def unit(a):
            n = np.linalg.norm(a, axis=1, keepdims=True)
            return a / np.where(n == 0, 1.0, n)
        return unit, (lambda d: d * d / 2)
    if metric == "haversine":
        def sphere(a):
            if len(a) and a.shape[1] != 2:
                raise ValueError(f"haversine takes latitude and longitude, not {a.shape[1]} columns")
            lat, lon = a[:, 0], a[:, 1]
            return np.column_stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])
        return sphere, (lambda d: 2 * np.arcsin(np.clip(d / 2, 0, 1)))
    raise ValueError(f"unknown metric {metric!r}")


def _matrix(s: pd.Series, width: int = 0) -> np.ndarray:
    return np.stack(s.to_numpy()).astype(float, copy=False) if len(s) else np.zeros((0, width))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.clip(d, 0, None))


def _sliced(f, s: pd.Series, width: int, *more):
    """Parts of ``f`` over slices of a batch: a batch against all centres at once is ten times a tile."""
    a = _matrix(s, width)
    return [f(a[i:i + TILE], *[m[i:i + TILE] for m in more]) for i in range(0, max(len(a), 1), TILE)]


def _best_of_unit(q: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, training row, distance rounded to 9 digits) of the k nearest of every query; ties go to the lower row."""
    q2, t2 = (np.einsum("ij,ij->i", m, m) for m in (q, t))
    # rounding of the product's distances, which lose digits where two vectors are close
    slack = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (q2 + np.nanmax(t2, initial=0.0))
    parts = []
    for i in range(0, len(q), TILE):
        own = np.arange(i, min(i + TILE, len(q)))
        left = np.column_stack([-2.0 * q[own], np.ones(len(own))])
        rows, cols, dist = np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
        limit = np.full(len(own), np.inf)
        for j in range(0, len(t), TILE_ROWS):
            near = left @ np.column_stack([t[j:j + TILE_ROWS], t2[j:j + TILE_ROWS]]).T
            bound = limit
            if near.shape[1] > k and np.isinf(limit).any():
                bound = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1] + 2 * slack[own])
            # with the distances that round to that of the k-th
            reach = np.sqrt(np.clip(bound + q2[own], 0, None)) + 2e-9
            hit = np.flatnonzero(near <= (reach * reach - q2[own] + slack[own])[:, None])
            if not len(hit):
                continue
            r, c = np.divmod(hit, near.shape[1])
            d = np.empty(len(r))
            for a in range(0, len(r), TILE_PAIRS):
                gap = q[own[r[a:a + TILE_PAIRS]]] - t[j + c[a:a + TILE_PAIRS]]
                d[a:a + TILE_PAIRS] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            rows, cols, dist = np.concatenate([rows, r]), np.concatenate([cols, j + c]), np.concatenate([dist, np.round(d, 9)])
            order = np.lexsort((cols, dist, rows))
            rows, cols, dist = rows[order], cols[order], dist[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, cols, dist, place = (v[place < k] for v in (rows, cols, dist, place))
            full = place == k - 1
            limit[rows[full]] = dist[full] ** 2 - q2[own[rows[full]]]
        parts.append((own[rows], cols, dist))
    return tuple(np.concatenate(v) for v in zip(*parts))


def _coords(metric: str):
    """Coordinates of a vector column; Euclidean ones are the vectors themselves, without a Python worker of their own."""
    embed, _ = _embed(metric)
    if metric in ("minkowski", "euclidean"):
        return lambda c: c

    @F.pandas_udf("array<double>")
    def coords(s: pd.Series) -> pd.Series:
        return pd.Series(list(embed(_matrix(s)))) if len(s) else pd.Series([], dtype=object)

    return coords


def nearest_neighbours(train: DataFrame, query: DataFrame, k: int, metric: str = "minkowski",
                       key: str = "row_id", x: str = "x", label: str = "label", seed: int = 42,
                       block_rows: int = BLOCK_ROWS, index: CellIndex | None = None) -> DataFrame:
    """(key, neighbour, label, distance, rank): the k nearest training rows of every query row.

    With an ``index`` a query visits the cells of its nearest centres, and more of them until they hold
    k rows; distances are exact, and the share of the true neighbours is that of ``fit_index``.
    An empty training table gives no rows.
    """
    if index is not None and index.metric != metric:
        raise ValueError(f"the index is for {index.metric!r}, not {metric!r}")
    _, back = _embed(metric)
    coords = _coords(metric)
    arr = lambda: coords(F.col(ident(x)).cast("array<double>"))
    t = train.select(F.col(ident(key)).alias("tid"), F.col(ident(label)).alias("label"), arr().alias("tx"))
    q = query.select(F.col(ident(key)).alias("qid"), arr().alias("qx"))

    if index is None:
        n = t.count()
        cells = max(1, min(MAX_PIVOTS, math.ceil(n / block_rows)))
        pool = t.withColumn("h", hash32(F.col("tid"), f"pivot{seed}"))
        if n > 100 * cells:
            pool = pool.filter(F.col("h") < F.lit(int(20.0 * cells / n * HASH_RANGE)))
        pivots = np.array([r["tx"] for r in pool.orderBy("h").limit(cells).collect()], dtype=float)
    else:
        pivots = index.centres
    if not len(pivots):
        types = dict(t.dtypes)
        return small_table(train.sparkSession, [], f"{ident(key)} {dict(q.dtypes)['qid']}, neighbour {types['tid']}, "
                           f"label {types['label']}, distance double, rank int")

    assign = _assign(pivots)
    t = t.withColumn("a", assign("tx")).select("tid", "label", "tx", F.col("a.cell").alias("cell"),
                                               F.col("a.d").alias("d"))
    stats = {r["cell"]: r for r in t.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()}
    count = np.array([stats[c]["n"] if c in stats else 0 for c in range(len(pivots))])
    radius = np.array([stats[c]["r"] if c in stats else 0.0 for c in range(len(pivots))])
    blocks = np.ceil(count / block_rows).astype(int)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype(int)

    def visited(d: np.ndarray, per: int) -> list[np.ndarray]:
        """The units that rows with these distances to the pivots visit."""
        out = []
        for row in d:
            if index is not None:
                near = np.argsort(row, kind="stable")
                near = near[count[near] > 0]
                need = max(index.probes, int(np.searchsorted(np.cumsum(count[near]), k)) + 1)
                hit = near[:need]
            else:
                upper = row + radius
                order = np.argsort(upper)
                reach = np.cumsum(count[order])
                kth = upper[order][min(np.searchsorted(reach, k), len(order) - 1)]
                hit = np.flatnonzero((count > 0) & (row - radius <= kth * (1 + 1e-9) + 1e-9))
            ids = np.concatenate([np.arange(first[c], first[c] + blocks[c]) for c in hit])
            out.append((ids if per == 1 else np.unique(ids // per)).astype("int32"))
        return out

    # The pivots as queries tell whether radii rule out anything.
    per = 1
    if index is None and np.mean([len(u) for u in visited(_distances(pivots, pivots), 1)]) > DENSE * blocks.sum():
        per = max(1, min(UNIT_BLOCKS, UNIT_CELLS // max(1, block_rows * pivots.shape[1]), int(blocks.sum()) // UNITS))

    @F.pandas_udf("array<int>")
    def candidates(s: pd.Series) -> pd.Series:
        return pd.Series([u for part in _sliced(lambda a: visited(_distances(a, pivots), per), s, pivots.shape[1]) for u in part])

    # Block id of a training row: its cell's first block plus a hash salt.
    lookup = F.array(*[F.struct(F.lit(int(f)).alias("f"), F.lit(int(b)).alias("b"))
                       for f, b in zip(first, np.maximum(blocks, 1))])
    t = t.withColumn("c", F.get(lookup, F.col("cell"))).withColumn(
        "block", F.floor((F.col("c.f") + F.pmod(F.xxhash64("tid"), F.col("c.b"))) / F.lit(per)).cast("int"))
    q = q.select("qid", "qx", F.explode(candidates("qx")).alias("block")).persist()
    # Chunks bound the queries of one task; a block is copied once per chunk.
    load = q.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows * per)).cast("int").alias("chunks"))
    q = q.join(load, "block").withColumn("chunk", F.pmod(F.xxhash64("qid"), F.col("chunks")).cast("int"))
    t = t.join(load, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "tid", "label", "tx")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "tid": [], "label": [], "distance": []})
        right = right.sort_values("tid", kind="stable")
        rows, cols, d = _best_of_unit(_matrix(left["qx"]), _matrix(right["tx"]), k)
        return pd.DataFrame({"qid": left["qid"].to_numpy()[rows], "tid": right["tid"].to_numpy()[cols],
                             "label": right["label"].to_numpy()[cols], "distance": back(d)})

    ltype = dict(t.dtypes)["label"]
    idt = dict(t.dtypes)["tid"]
    found = q.groupBy("block", "chunk").cogroup(t.groupBy("block", "chunk")).applyInPandas(
        best, f"qid {idt}, tid {idt}, label {ltype}, distance double")
    w = Window.partitionBy("qid").orderBy("distance", "tid")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("qid").alias(key), F.col("tid").alias("neighbour"), "label", "distance", "rank"))


def _assign(centres: np.ndarray):
    """The nearest centre of a row and the distance to it."""
    @F.pandas_udf("struct<cell int, d double>")
    def assign(s: pd.Series) -> pd.DataFrame:
        def nearest(a):
            d = _distances(a, centres)
            c = d.argmin(1) if len(d) else np.zeros(0, dtype=int)
            return c.astype("int32"), d[np.arange(len(d)), c]

        cell, d = (np.concatenate(v) for v in zip(*_sliced(nearest, s, centres.shape[1])))
        return pd.DataFrame({"cell": cell, "d": d})

    return assign


def _rank_of(centres: np.ndarray):
    """Which place a cell has among the cells of a query, by the distance of the centres; the nearest is 1."""
    @F.pandas_udf("int")
    def rank_of(s: pd.Series, cell: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype="int32")
        place = lambda a, c: (np.argsort(_distances(a, centres), axis=1, kind="stable") == c[:, None]).argmax(1).astype("int32") + 1
        return pd.Series(np.concatenate(_sliced(place, s, centres.shape[1], cell.to_numpy())))

    return rank_of


def _sampled(df: DataFrame, key: str, rows: int, n: int, name: str) -> DataFrame:
    """About ``rows`` rows by a seeded hash of the key, at most that many."""
    h = hash32(F.col(ident(key)), name)
    return df if n <= rows else df.filter(h < F.lit(int(1.1 * rows / n * HASH_RANGE))).orderBy(h).limit(rows)


def fit_index(train: DataFrame, k: int, metric: str = "minkowski", recall: float = 0.95, key: str = "row_id",
              x: str = "x", label: str = "label", cells: int | None = None, centre_rows: int = CENTRE_ROWS,
              measured_rows: int = MEASURED_ROWS, seed: int = 42, block_rows: int = BLOCK_ROWS) -> CellIndex:
    """Centres by k-means on at most ``centre_rows`` rows, and the cells to visit for the wanted recall.

    The k nearest other rows of at most ``measured_rows`` training rows are found exactly; the index
    visits the least number of cells that hold the share ``recall`` of them. Every training row is in a
    cell when the index is used. Ids are unique.
    """
    coords = _coords(metric)
    n = train.count()
    if not n:
        return CellIndex(np.zeros((0, 0)), 1, metric)
    cells = min(n, cells or max(1, min(MAX_PIVOTS, round(math.sqrt(n)))))
    point = coords(F.col(ident(x)).cast("array<double>"))
    sample = _sampled(train, key, max(centre_rows, cells), n, f"centres{seed}").select(
        array_to_vector(F.transform(point, lambda v: F.coalesce(v, F.lit(math.nan)))).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=20).fit(sample)
    centres = np.array(model.clusterCenters(), dtype=float)

    asked = _sampled(train, key, measured_rows, n, f"measured{seed}").persist()
    true = nearest_neighbours(train, asked, k + 1, metric, key, x, label, seed, block_rows)
    true = true.filter(F.col(ident(key)) != F.col("neighbour")).withColumn(
        "place", F.row_number().over(Window.partitionBy(ident(key)).orderBy("rank"))).filter(F.col("place") <= k)
    own = train.select(F.col(ident(key)).alias("neighbour"), _assign(centres)(point).alias("a")).select("neighbour", "a.cell")
    pairs = true.select(F.col(ident(key)).alias("qid"), "neighbour").join(own, "neighbour").join(
        asked.select(F.col(ident(key)).alias("qid"), point.alias("qx")), "qid")
    found = pairs.groupBy(_rank_of(centres)("qx", "cell").alias("r")).count().collect()
    asked.unpersist()
    hits = np.zeros(len(centres) + 1)
    for r in found:
        hits[r["r"]] = r["count"]
    reach = np.cumsum(hits)
    return CellIndex(centres, max(1, int(np.searchsorted(reach, recall * reach[-1] - 1e-9))), metric)


def index_report(train: DataFrame, query: DataFrame, k: int, index: CellIndex, key: str = "row_id", x: str = "x",
                 label: str = "label", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (queries, neighbours, found, recall, cells, probes, visited): the index against the exact search.

    ``visited`` is the mean share of the training rows in the ``probes`` nearest cells of a query.
    """
    take = lambda i: nearest_neighbours(train, query, k, index.metric, key, x, label, block_rows=block_rows, index=i).select(
        F.col(ident(key)).alias("qid"), "neighbour")
    exact, mine = take(None), take(index).withColumn("hit", F.lit(1))
    both = exact.join(mine, ["qid", "neighbour"], "left").agg(
        F.count_distinct("qid").alias("queries"), F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found"))
    point = _coords(index.metric)(F.col(ident(x)).cast("array<double>"))
    held = {r["cell"]: r["n"] for r in train.select(_assign(index.centres)(point).alias("a")).groupBy("a.cell").agg(
        F.count(F.lit(1)).alias("n")).collect()} if len(index.centres) else {}
    count = np.array([held.get(c, 0) for c in range(len(index.centres))], dtype=float)
    probes, centres = index.probes, index.centres

    @F.pandas_udf("double")
    def share(s: pd.Series) -> pd.Series:
        def held(a):
            near = np.argsort(_distances(a, centres), axis=1, kind="stable")
            return [count[row[count[row] > 0][:probes]].sum() / max(count.sum(), 1.0) for row in near]

        return pd.Series(sum(_sliced(held, s, centres.shape[1]), []), dtype="float64")

    seen = query.agg(F.avg(share(point))).first()[0] if len(centres) and count.sum() else 0.0
    return both.select("queries", "neighbours", "found", (F.col("found") / F.col("neighbours")).alias("recall"),
                       F.lit(len(centres)).alias("cells"), F.lit(probes).alias("probes"), F.lit(seen).alias("visited"))


def knn_classify(train: DataFrame, query: DataFrame, k: int = 5, weights: str = "uniform",
                 key: str = "row_id", **options) -> DataFrame:
    """Majority (or inverse-distance) vote; ties go to the smallest label."""
    nn = nearest_neighbours(train, query, k, key=key, **options)
    if weights == "uniform":
        w = F.lit(1.0)
    elif weights == "distance":
        # An exact match outvotes every other neighbour.
        w = F.when(F.col("distance") == 0, 1e12).otherwise(1.0 / F.col("distance"))
    else:
        raise ValueError(f"unknown weights {weights!r}")
    votes = nn.groupBy(ident(key), "label").agg(F.sum(w).alias("v"))
    return votes.groupBy(ident(key)).agg(
        F.min_by("label", F.struct(-F.col("v"), F.col("label"))).alias("prediction"))
