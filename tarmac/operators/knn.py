"""Exact k nearest neighbours by Euclidean distance.

A base that is proven small is broadcast. A larger base is cut into parts by a tree of pivots: a node that holds more
keys than a part may is split among pivots drawn from it, level by level. Queries meet whole parts in tasks: each first
the part it falls into, and then, with the distance of its k-th key there as a bound, the parts whose box lies within it.
Inside a part, as inside a broadcast base, points lie in leaves of ``tile_rows`` keys cut at medians; a query
visits its nearest leaf, and then those within the bound in the order of their distance, the bound tightened between
visits. Copies of one point collapse to the few keys that can appear in an answer. Distance ties go to the smaller key.
A point with a missing or undefined number is nobody's neighbour and has none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import require_columns
from tarmac.functions.expr import hash_key
from tarmac.session import materialize

#: Numbers (rows x dimensions) a broadcast base may hold: 16 MB of doubles.
BROADCAST_CELLS = 2_000_000
#: Keys of a leaf.
TILE_ROWS = 1024
#: Pivots of a node, one hexadecimal digit of its children's names.
FANOUT = 16
#: Keys and numbers of a part, and queries and their numbers that meet one copy of it.
PART_KEYS, PART_CELLS = 65_536, 2_000_000
#: Numbers of a table that a task holds beside its input.
BLOCK_CELLS = 2_000_000
#: Dimensions from which blocks are screened in single precision.
SINGLE_FROM = 16


def vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Add an array of doubles made of the given columns."""
    require_columns(df, columns)
    return df.withColumn(output, F.array(*[F.col(c).cast("double") for c in columns]))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in series]) if len(series) else np.empty((0, 0))


def kd_leaves(points: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Number of each point's leaf; leaves of more than one point weigh ``most`` at most, cut at medians of the widest side."""
    leaf = np.zeros(len(points), np.int64)
    count, waiting = 0, [np.arange(len(points))] if len(points) else []
    while waiting:
        rows = waiting.pop()
        if len(rows) == 1 or weights[rows].sum() <= most:
            leaf[rows] = count
            count += 1
            continue
        here = points[rows]
        rows = rows[np.argsort(here[:, np.ptp(here, axis=0).argmax()], kind="stable")]
        upto = np.cumsum(weights[rows])
        middle = min(max(int(np.searchsorted(upto, upto[-1] / 2, side="right")), 1), len(rows) - 1)
        waiting += [rows[middle:], rows[:middle]]
    return leaf


class Leaves:
    """Points in leaves, searched from the nearest leaf on. ``keys`` are compared for ties by their order only."""

    def __init__(self, points: np.ndarray, keys: np.ndarray, leaf: np.ndarray):
        by_key = pd.Series(keys).sort_values(kind="stable", na_position="first").index.to_numpy()
        self.keys = np.asarray(keys)[by_key]
        order = by_key.argsort()  # place of each key in that order
        rows = np.argsort(leaf, kind="stable")
        self.points, self.order = points[rows], order[rows]
        self.names, first = np.unique(leaf[rows], return_index=True)
        self.first = np.append(first, len(rows))
        self.low, self.high = np.minimum.reduceat(self.points, first), np.maximum.reduceat(self.points, first)
        self.middle = self.low / 2 + self.high / 2
        around = self.points - np.repeat(self.middle, np.diff(self.first), axis=0)
        # screening is in single precision where products cost more than all else
        self.single = points.shape[1] >= SINGLE_FROM and np.abs(around).max() < 1e15
        self.around = around.astype("float32") if self.single else around
        self.norms = (around * around).sum(axis=1)
        self.most = np.maximum.reduceat(self.norms, first)
        self.error = 1.5e-7 * (points.shape[1] + 8) if self.single else 1e-9

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Distance of each query from each leaf's box."""
        total = np.zeros((len(queries), len(self.low)))
        for d in range(queries.shape[1]):
            x = queries[:, d, None]
            gap = np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0.0)
            gap *= gap
            total += gap
        return np.sqrt(total, out=total)

    def search(
        self, queries: np.ndarray, k: int, theta: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For blocks of queries: row of the query, key and distance of its k nearest points within ``theta`` in order, and
        row of the query and leaf of each visit."""
        theta = np.full(len(queries), np.inf) if theta is None else theta
        step = max(1, BLOCK_CELLS // max(len(self.low), queries.shape[1] if queries.ndim > 1 else 1))
        nearest = [self.bounds(queries[i : i + step]).argmin(axis=1) for i in range(0, len(queries), step)]
        # neighbouring queries visit the same leaves
        rows = np.argsort(np.concatenate(nearest), kind="stable") if nearest else np.zeros(0, np.int64)
        for start in range(0, len(rows), step):
            block = rows[start : start + step]
            q, place, dist, vq, leaf = self._block(queries[block], k, theta[block].astype(float))
            yield block[q], self.keys[place], dist, block[vq], self.names[leaf]

    def _block(self, queries: np.ndarray, k: int, theta: np.ndarray):
        bound = self.bounds(queries)
        at, limit = bound.argmin(axis=1), theta.copy()
        everyone = np.arange(len(queries))
        near = bound[everyone, at] <= limit * (1 + 1e-9) + 1e-12
        visits = [(everyone[near], at[near])]
        best = self._visit(queries, k, limit, *visits[0], None)
        bound[everyone, at] = np.inf
        q, leaf = np.nonzero((bound <= (limit * (1 + 1e-9) + 1e-12)[:, None]) & (bound < np.inf))
        bound = bound[q, leaf]
        order = np.lexsort((bound, q))
        q, leaf, bound = q[order], leaf[order], bound[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        done, more = 0, 1
        while len(q):
            now = place < done + more
            near = now & (bound <= limit[q] * (1 + 1e-9) + 1e-12)
            visits.append((q[near], leaf[near]))
            best = self._visit(queries, k, limit, q[near], leaf[near], best)
            rest = ~now & (bound <= limit[q] * (1 + 1e-9) + 1e-12)
            q, leaf, bound, place = q[rest], leaf[rest], bound[rest], place[rest]
            done, more = done + more, 2 * more
        return *best, *(np.concatenate(x) for x in zip(*visits))

    def _visit(self, queries: np.ndarray, k: int, limit: np.ndarray, q: np.ndarray, leaf: np.ndarray, best):
        """The k best of ``best`` and the points of some leaves; tightens ``limit``."""
        found = [best] if best is not None else []
        order = np.argsort(leaf, kind="stable")
        q, leaf = q[order], leaf[order]
        ends = np.append(np.flatnonzero(np.diff(leaf)) + 1, len(leaf)) if len(leaf) else []
        start = 0
        for end in ends:
            number, mine = leaf[start], q[start:end]
            size = self.first[number + 1] - self.first[number]
            part = max(1, BLOCK_CELLS // size)
            found += [self._compare(queries, k, limit, mine[i : i + part], number) for i in range(0, len(mine), part)]
            start = end
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, place, dist = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, dist, q))
        q, place, dist = q[order], place[order], dist[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        keep = nth < k
        q, place, dist, nth = q[keep], place[keep], dist[keep], nth[keep]
        last = nth == k - 1
        limit[q[last]] = np.minimum(limit[q[last]], dist[last])
        return q, place, dist

    def _compare(self, queries: np.ndarray, k: int, limit: np.ndarray, mine: np.ndarray, number: int):
        """A matrix product screens the leaf; only rows within its rounding error of the bound are measured exactly."""
        here = slice(self.first[number], self.first[number + 1])
        asked = queries[mine]
        gap = asked - self.middle[number]
        own = (gap * gap).sum(axis=1)
        if self.single and not own.max() < 1e30:
            rough = own[:, None] + self.norms[here] - 2.0 * (gap @ self.around[here].T.astype(float))
        else:
            rough = (gap.astype(self.around.dtype) * -2) @ self.around[here].T
            rough += self.norms[here].astype(rough.dtype)
            rough += own[:, None].astype(rough.dtype)
        slack = self.error * (own + self.most[number]) + 1e-12
        hit = rough <= (limit[mine] ** 2 * (1 + 2e-9) + slack).astype(rough.dtype)[:, None]
        size = rough.shape[1]
        if size > k:
            many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 2 * k)
            if len(many):
                kth = np.partition(rough[many], k - 1, axis=1)[:, k - 1]
                hit[many] &= rough[many] <= (kth + 2 * slack[many])[:, None]
        i, b = np.nonzero(hit)
        gap = asked[i] - self.points[here][b]
        dist = np.sqrt((gap * gap).sum(axis=1))
        return mine[i], self.order[here][b], dist


def _key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    query_key: str,
    base_key: str,
    features: str = "features",
    exclude_self: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(query_key, neighbor, rank, dist)`` with rank 1 the nearest.

    Keys must be unique and integers or strings. ``exclude_self`` leaves out the base row whose key
    equals the query's. A base of more than ``broadcast_cells`` numbers goes into a pivot tree with leaves of
    ``tile_rows`` keys.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    want = k + 1 if exclude_self else k
    whole = F.coalesce(~F.exists("v", lambda x: x.isNull() | F.isnan(x)), F.lit(True))
    q = queries.select(F.col(query_key).alias("qk"), F.col(features).alias("v")).where(whole).withColumnRenamed("v", "qv")
    b = base.select(F.col(base_key).alias("bk"), F.col(features).alias("v")).where(whole).withColumnRenamed("v", "bv")
    # of identical points only the smallest keys can be answers
    copies = Window.partitionBy("bv").orderBy("bk")
    b = b.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= want).drop("copy")
    shape = b.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("bv")).alias("dim"), F.count_if(F.col("bv").isNull()).alias("none")
    ).first()
    n, dim = shape["n"], shape["dim"] or 0
    if shape["none"]:
        raise ValueError("base rows without features")
    schema = f"qk {_key_type(q, 'qk')}, bk {_key_type(b, 'bk')}, dist double"
    if n == 0:
        found = q.sparkSession.createDataFrame([], schema)
    elif n * dim <= broadcast_cells:
        found = _against_broadcast(q, b, want, schema, tile_rows)
    else:
        found = PivotTree.build(b, dim, tile_rows, broadcast_cells).nearest(q, want, schema)
    if exclude_self:
        found = found.where(F.col("qk") != F.col("bk"))
    order = Window.partitionBy("qk").orderBy("dist", "bk")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("qk").alias(query_key), F.col("bk").alias("neighbor"), "rank", "dist")
    )


def _against_broadcast(q: DataFrame, b: DataFrame, k: int, schema: str, tile_rows: int) -> DataFrame:
    # as arrays, which take a small part of the memory of Python's rows
    rows = b.toArrow().combine_chunks()
    keys = rows["bk"].to_pandas().to_numpy()
    points = rows["bv"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(keys), -1)
    shared = q.sparkSession.sparkContext.broadcast(vars(Leaves(points, keys, kd_leaves(points, np.ones(len(keys)), tile_rows))))

    def search(batches):
        base = Leaves.__new__(Leaves)
        vars(base).update(shared.value)
        for pdf in _larger(batches):
            asked = pdf["qk"].to_numpy()
            for i, found, dist, _, _ in base.search(_matrix(pdf["qv"]), k):
                yield pd.DataFrame({"qk": asked[i], "bk": found, "dist": dist})

    # a fixed number of tasks: each query row costs far more than its bytes tell
    tasks = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return q.repartition(tasks, "qk").mapInPandas(search, schema)


def _larger(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together to about ``BLOCK_CELLS`` numbers, so that there are neighbours among their queries."""
    held, cells = [], 0
    for pdf in batches:
        if len(pdf):
            held.append(pdf)
            cells += len(pdf) * (len(pdf["qv"].iloc[0]) + 8)
        if cells >= BLOCK_CELLS // 2:
            yield pd.concat(held, ignore_index=True)
            held, cells = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _squares(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


@dataclass
class PivotTree:
    """Base points in parts, which are the ends of a tree of pivots, and in leaves inside them.

    points: ``door`` (name of the part), ``leaf``, ``bv``, ``bks`` (keys of the point in order). nodes: ``node`` (one
    hexadecimal digit for each level, the root's name is empty), ``n`` (keys), ``low`` and ``high`` (box).
    """

    points: DataFrame
    nodes: DataFrame
    dim: int

    @classmethod
    def build(cls, b: DataFrame, dim: int, tile_rows: int, broadcast_cells: int) -> PivotTree:
        """Split nodes of more keys than a part may have until there are none, a level in each round.

        The boxes of all nodes are broadcast; parts are the larger, the fewer numbers ``broadcast_cells`` allows for that.
        Pivots are drawn by a digest of the points, a few times as many as are taken, so no node is ranked whole. A round
        reads the rows of nodes still to be split only."""
        points = b.groupBy("bv").agg(F.array_sort(F.collect_list("bk")).alias("bks"))
        open_ = materialize(points.withColumn("door", F.lit("")))
        settled = None
        level, most = 0, None
        while True:
            sizes = open_.groupBy("door").agg(F.sum(F.size("bks")).alias("n"), F.count(F.lit(1)).alias("points"))
            sizes = materialize(sizes)
            if most is None:
                n = sizes.agg(F.sum("n")).first()[0]
                most = max(tile_rows, min(PART_KEYS, PART_CELLS // dim), -(-8 * n * dim // max(broadcast_cells, 1)))
            large = (F.col("n") > most) & (F.col("points") > 1)
            small = open_.join(sizes.where(~large).select("door"), "door", "left_semi")
            settled = small if settled is None else settled.unionByName(small)
            if sizes.where(large).isEmpty():
                break
            # two pivots for each part that a node could fill
            fan = F.least(F.lit(FANOUT), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / most))).cast("int")
            rows = open_.join(sizes.where(large).select("door", "points", fan.alias("fan")), "door")
            draw = hash_key([F.col("bv").cast("string")], level)
            share = F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
            first = Window.partitionBy("door").orderBy("draw", "bv")
            drawn = rows.where(share * F.col("points") < 4 * FANOUT).select("door", "fan", "bv", draw.alias("draw"))
            pivots = (
                drawn.withColumn("place", F.row_number().over(first))
                .where(F.col("place") <= F.col("fan"))
                .groupBy("door")
                .agg(F.sort_array(F.collect_list("bv")).alias("pivots"))
            )
            pivots = materialize(pivots)
            if pivots.count() * FANOUT * dim <= broadcast_cells:
                pivots = F.broadcast(pivots)
            near = F.transform("pivots", lambda p, i: F.struct(_squares(p, F.col("bv")).alias("d"), i.alias("i")))
            child = F.concat("door", F.lower(F.hex(F.array_min(near)["i"])))
            # a node of which nothing was drawn is tried again in the next round, with other digests
            open_ = materialize(
                rows.drop("points", "fan").join(pivots, "door", "left")
                .select("bv", "bks", F.coalesce(child, "door").alias("door"))
            )
            level += 1

        def leaves(part: pd.DataFrame) -> pd.DataFrame:
            leaf = kd_leaves(_matrix(part["bv"]), part["bks"].str.len().to_numpy(), tile_rows)
            return part.assign(leaf=part["door"] + "." + pd.Series(leaf, part.index).astype(str))

        kinds = dict(settled.dtypes)
        settled = materialize(
            settled.groupBy("door").applyInPandas(leaves, f"bv {kinds['bv']}, bks {kinds['bks']}, door string, leaf string")
        )
        box = [*[F.min(F.col("bv")[i]).alias(f"l{i}") for i in range(dim)], *[F.max(F.col("bv")[i]).alias(f"h{i}") for i in range(dim)]]
        doors = settled.groupBy("door").agg(F.sum(F.size("bks")).alias("n"), *box)
        above = doors.withColumn("node", F.explode(F.expr("transform(sequence(0, length(door)), i -> substring(door, 1, i))")))
        nodes = above.groupBy("node").agg(
            F.sum("n").alias("n"),
            F.array(*[F.min(f"l{i}") for i in range(dim)]).alias("low"),
            F.array(*[F.max(f"h{i}") for i in range(dim)]).alias("high"),
        )
        return cls(settled, materialize(nodes), dim)

    def nearest(self, q: DataFrame, k: int, schema: str) -> DataFrame:
        """``(qk, bk, dist)``: the k nearest."""
        found, _ = self.search(q, k, schema)
        return found

    def search(self, q: DataFrame, k: int, schema: str) -> tuple[DataFrame, list[DataFrame]]:
        """The answer, and the ``(qk, leaf)`` visits of each round."""
        key, base_key = dict(q.dtypes)["qk"], self.points.schema["bks"].dataType.elementType.simpleString()
        nodes = self.nodes.toPandas()
        shared = q.sparkSession.sparkContext.broadcast(
            (nodes["node"].tolist(), _matrix(nodes["low"]), _matrix(nodes["high"]), nodes["n"].to_numpy())
        )

        def entered(batches):
            tree = _Nodes(*shared.value)
            for pdf in batches:
                if len(pdf):
                    points = _matrix(pdf["qv"])
                    theta, at = tree.reach(points, k)
                    yield pdf.assign(theta=theta, door=tree.names[tree.end(points, at)])

        def onward(batches):
            tree = _Nodes(*shared.value)
            for pdf in batches:
                step = max(1, BLOCK_CELLS // (len(tree.names) * tree.low.shape[1]))
                for start in range(0, len(pdf), step):
                    part = pdf.iloc[start : start + step]
                    i, node = tree.within(_matrix(part["qv"]), part["theta"].to_numpy())
                    there = tree.names[node]
                    other = there != part["door"].to_numpy()[i]
                    yield part.iloc[i[other]].assign(door=there[other])

        asked = f"qk {key}, qv array<double>, theta double, door string"
        first = q.mapInPandas(entered, asked)
        known = materialize(
            self._probe(first, k, f"{asked}, bks array<{base_key}>, dists array<double>", _answered)
        )
        more = known.select("qk", "qv", "theta", "door").mapInPandas(onward, asked)
        new = self._probe(more, k, schema, _listed)
        found = known.select("qk", F.explode(F.arrays_zip("bks", "dists")).alias("x"))
        best = found.select("qk", F.col("x.bks").alias("bk"), F.col("x.dists").alias("dist")).unionByName(new)
        order = Window.partitionBy("qk").orderBy("dist", "bk")
        best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
        return best, [self._probe(x, k, f"qk {key}, leaf string", _visited) for x in (first, more)]

    def _probe(self, asked: DataFrame, k: int, schema: str, report) -> DataFrame:
        """Queries searched in the part of their ``door``, in blocks that each meet a copy of it."""

        def search(qs: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            if not len(qs) or not len(part):
                return pd.DataFrame()
            times = part["bks"].str.len().to_numpy()
            leaf, names = pd.factorize(part["leaf"])
            base = Leaves(
                np.repeat(_matrix(part["bv"]), times, axis=0),
                pd.Series(np.concatenate(part["bks"].to_list())).to_numpy(), np.repeat(leaf, times),
            )
            found = base.search(_matrix(qs["qv"]), k, qs["theta"].to_numpy())
            return report(qs, [np.concatenate(x) for x in zip(*found)], k, names)

        queries, parts = _in_blocks(asked, self.points, "door", max(1, min(PART_KEYS, PART_CELLS // self.dim) // 2))
        return queries.cogroup(parts).applyInPandas(search, schema)


def _listed(qs: pd.DataFrame, found: list[np.ndarray], k: int, names) -> pd.DataFrame:
    q, key, dist, _, _ = found
    return pd.DataFrame({"qk": qs["qk"].to_numpy()[q], "bk": key, "dist": dist})


def _visited(qs: pd.DataFrame, found: list[np.ndarray], k: int, names) -> pd.DataFrame:
    return pd.DataFrame({"qk": qs["qk"].to_numpy()[found[3]], "leaf": np.asarray(names)[found[4]]})


def _answered(qs: pd.DataFrame, found: list[np.ndarray], k: int, names) -> pd.DataFrame:
    """A row for each query, with ``theta`` brought down to the distance of the k-th key."""
    q, key, dist, _, _ = found
    order = np.argsort(q, kind="stable")
    q, key, dist = q[order], key[order], dist[order]
    ends = np.searchsorted(q, np.arange(len(qs) + 1))
    full = np.flatnonzero(np.diff(ends) >= k)
    theta = qs["theta"].to_numpy(copy=True)
    theta[full] = np.minimum(theta[full], dist[ends[full] + k - 1])
    lists = [pd.Series(np.split(x, ends[1:-1]), qs.index, dtype=object) for x in (key, dist)]
    return qs[["qk", "qv", "door"]].assign(theta=theta, bks=lists[0], dists=lists[1])[["qk", "qv", "theta", "door", "bks", "dists"]]


class _Nodes:
    """Nodes of a tree as arrays in the order of levels; children stand side by side."""

    def __init__(self, names: list[str], low: np.ndarray, high: np.ndarray, n: np.ndarray):
        rows = np.array(sorted(range(len(names)), key=lambda i: (len(names[i]), names[i])), np.int64)
        names = [names[i] for i in rows]
        self.names = np.array(names, dtype=object)
        self.low, self.high, self.n = low[rows], high[rows], n[rows]
        at = {name: i for i, name in enumerate(names)}
        self.first, self.count = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for i, name in enumerate(names):
            above = at.get(name[:-1]) if i else None
            if above is not None:
                self.first[above] = i if not self.count[above] else self.first[above]
                self.count[above] += 1

    def bound(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low[nodes] - points, points - self.high[nodes]), 0.0)
        return np.sqrt((gap * gap).sum(axis=-1))

    def reach(self, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A distance within which each point has k keys or all there are, and the node that says so."""
        at = np.zeros(len(points), np.int64)
        moving = np.arange(len(points))
        while len(moving):
            mine = moving[self.count[at[moving]] > 0]
            pair, child = self._children(at[mine])
            bound = np.where(self.n[child] >= k, self.bound(points[mine[pair]], child), np.inf)
            order = np.lexsort((child, bound, pair))
            best = order[np.unique(pair[order], return_index=True)[1]]
            best = best[bound[best] < np.inf]
            moving = mine[pair[best]]
            at[moving] = child[best]
        far = np.maximum(np.abs(points - self.low[at]), np.abs(points - self.high[at]))
        return np.where(self.n[at] >= k, np.sqrt((far * far).sum(axis=1)), np.inf), at

    def _children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many = self.count[nodes]
        pair = np.repeat(np.arange(len(nodes)), many)
        return pair, self.first[nodes][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)

    def end(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """An end of the tree for each point, by the nearest child from node ``at`` on."""
        at, moving = at.copy(), np.arange(len(points))
        while len(moving := moving[self.count[at[moving]] > 0]):
            pair, child = self._children(at[moving])
            order = np.lexsort((child, self.bound(points[moving[pair]], child), pair))
            at[moving] = child[order[np.unique(pair[order], return_index=True)[1]]]
        return at

    def within(self, points: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Point and node of all ends of the tree whose box lies within the points' distances."""
        limit = theta * (1 + 1e-9) + 1e-12
        out = []
        i, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        bound = self.bound(points, node)
        while len(i):
            end = self.count[node] == 0
            out.append((i[end], node[end]))
            pair, child = self._children(node[~end])
            i = i[~end][pair]
            bound = self.bound(points[i], child)
            near = bound <= limit[i]
            i, node, bound = i[near], child[near], bound[near]
        return tuple(np.concatenate(x) for x in zip(*out))


def _in_blocks(asked: DataFrame, points: DataFrame, at: str, block: int):
    """Both sides grouped by ``at``, queries in blocks of about ``block`` that each meet a copy of the other side."""
    sizes = asked.groupBy(at).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    sizes = materialize(sizes)
    left = asked.join(sizes, at).withColumn("block", F.pmod(F.xxhash64("qk"), F.col("blocks")).cast("int"))
    right = points.join(sizes, at).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    return left.drop("blocks").groupBy(at, "block"), right.drop("blocks").groupBy(at, "block")


def knn_graph(
    df: DataFrame, columns: Sequence[str], key: str, k: int = 15, **options
) -> DataFrame:
    """Neighbour edges ``(src, dst, rank, dist)`` over z-scored columns; incomplete rows are left out."""
    from tarmac.operators.scale import apply_scaler, fit_scaler

    complete = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    scaled = vector(apply_scaler(complete, fit_scaler(complete, columns)), columns)
    edges = knn_join(scaled, scaled, k, key, key, exclude_self=True, **options)
    return edges.select(F.col(key).alias("src"), F.col("neighbor").alias("dst"), "rank", "dist")


def knn_classify(
    train: DataFrame,
    test: DataFrame,
    key: str,
    label: str,
    k: int = 5,
    features: str = "features",
    **options,
) -> DataFrame:
    """``(key, prediction)``: majority label of the k nearest training rows, ties to the smaller label."""
    neighbors = knn_join(test, train, k, key, key, features, **options)
    labels = train.select(F.col(key).alias("neighbor"), F.col(label).alias("prediction"))
    votes = neighbors.join(labels, "neighbor").groupBy(key, "prediction").agg(F.count(F.lit(1)).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("votes"), F.col("prediction").alias("prediction")))
    return votes.groupBy(key).agg(best.alias("b")).select(key, F.col("b.prediction").alias("prediction"))
