"""Exact top-k inner-product search by dual-tree traversal of cover trees.

Vectors become integers floor(1024 x). Candidates and queries are dealt to cells of space by the nearest of some pivots (a
bounded sample's, each farthest from those before), cells with more than a block's rows to several blocks, so that no
block holds more, however many vectors are alike. A query block and a candidate block meet if the bound of their balls, from
the centres' product and both covering radii, can beat the worst kth score that the queries have from their own
cell. There both are indexed by a cover tree, each built once a meeting, and node pairs are walked best bound first; a pair is
dropped when its bound cannot beat the worst kth score of the query node; leaf pairs are scored by one exact matrix
product. Each meeting returns at most k rows a query and a final two-phase top k merges them.

Defined cases: null vectors and those holding null or non-finite components take no part, nor do rows with a null id;
a query meets only vectors of its own length; rows sharing the query's id are its own; repeated ids are one candidate
row each; scores beyond 64 bits count as the greatest or least number that fits, ties among them going to the smaller
id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.base import map_batches, materialize, table

K, SCALE, QUERY_STEP = 10, 1024, 100
#: Rows of a block of candidates and of queries, cells of space at most, sampled vectors a cell.
CANDIDATE_BLOCK, QUERY_BLOCK, MAX_CELLS, PER_CELL = 16384, 4096, 4096, 4
#: Rows that a node is not split below, how much the radius shrinks from level to level, centres of a level at most.
LEAF, BASE, MAX_NET = 128, 1.6, 64
MOST = 2**63 - 1


class Node:
    """A centre (one of the points), the rows that it covers, and how far the farthest of them is."""

    __slots__ = ("centre", "radius", "norm", "rows", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: np.ndarray, distance: np.ndarray):
        self.rows, self.children, self.centre = rows, [], centre
        self.radius = float(distance.max())
        self.norm = float(np.sqrt((centre**2).sum()))


def cover_tree(points: np.ndarray) -> Node:
    """The tree over all points.

    Covering: a node's rows lie within its radius of its centre, its children's centres are rows of it, and each row goes to
    the nearest of them, within radius / BASE. Separation: the children's centres are more than radius / BASE apart. Where
    that takes more than MAX_NET centres (directions too many to tell the rows apart) the node stays a leaf.
    """
    first = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    apart = lambda rows, c: np.sqrt(((points[rows] - points[c]) ** 2).sum(1))
    every = np.arange(len(points))
    root = Node(points, every, points[first], apart(every, first))
    todo = [(root, first)]
    while todo:
        node, centre = todo.pop()
        if len(node.rows) <= LEAF or node.radius <= 1e-9:
            continue
        # a net: the own centre, then always the row farthest from all centres so far
        nearest, owner, centres = apart(node.rows, centre), np.zeros(len(node.rows), int), [centre]
        while len(centres) <= MAX_NET and nearest[far := int(nearest.argmax())] > node.radius / BASE:
            centres.append(int(node.rows[far]))
            distance = apart(node.rows, centres[-1])
            closer = distance < nearest
            nearest[closer], owner[closer] = distance[closer], len(centres) - 1
        if len(centres) > MAX_NET or len(centres) < 2:
            continue
        for c, at in enumerate(centres):
            mine = owner == c
            node.children.append(Node(points, node.rows[mine], points[at], nearest[mine]))
            todo.append((node.children[-1], at))
    return root


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as integers: by floats where all partial sums fit 53 bits, by Python integers where not."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return (a.astype(object) @ b.astype(object).T)


def dual_tree(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int, least: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best; least: scores that a query has k of elsewhere already.

    Ties go to the smaller vec_id; scores beyond 64 bits are the greatest or least that fit.
    """
    qt, vt = cover_tree(q.astype(np.float64)), cover_tree(v.astype(np.float64))
    best: list[list] = [[] for _ in qid]  # heaps of (score, -vec_id)
    worst = np.full(len(qid), -np.inf) if least is None else least.astype(np.float64)

    def bound(a: Node, b: Node) -> float:
        top = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        return top + 1e-9 * (a.norm + a.radius) * (b.norm + b.radius) + 1e-6

    heap, turn = [(-bound(qt, vt), 0, qt, vt)], 0
    while heap:
        top, _, a, b = heapq.heappop(heap)
        if -top < worst[a.rows].min():
            continue
        if not a.children and not b.children:
            rows = a.rows[worst[a.rows] <= -top]
            score = exact_products(q[rows], v[b.rows])
            if score.dtype == object:
                score = np.clip(score, -MOST - 1, MOST).astype(np.int64)
            for i, r in enumerate(rows):
                s, ids = score[i], vid[b.rows]
                ok = (ids != qid[r]) & (s >= worst[r])
                s, ids = s[ok], ids[ok]
                if len(s) > k:
                    cut = np.partition(s, len(s) - k)[len(s) - k]
                    s, ids = s[s >= cut], ids[s >= cut]
                    order = np.lexsort((ids, ~s))[:k]
                    s, ids = s[order], ids[order]
                for x, y in zip(s.tolist(), ids.tolist(), strict=True):
                    if len(best[r]) < k:
                        heapq.heappush(best[r], (x, -y))
                    elif (x, -y) > best[r][0]:
                        heapq.heapreplace(best[r], (x, -y))
                if len(best[r]) == k:
                    worst[r] = max(worst[r], best[r][0][0])
            continue
        split_a = a.children and (not b.children or a.radius >= b.radius)
        for x, y in [(c, b) for c in a.children] if split_a else [(a, c) for c in b.children]:
            limit = bound(x, y)
            if limit >= worst[x.rows].min():
                turn += 1
                heapq.heappush(heap, (-limit, turn, x, y))
    return [(int(qid[r]), -y, x) for r in range(len(qid)) for x, y in best[r]]


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    whole = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('Infinity'))"
    return embeddings.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(f"transform(embedding, x -> cast(floor({SCALE} * cast(x as double)) as bigint))").alias("v"))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists are equally long."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def cells(vecs: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots of space by length of vector: up to count / CANDIDATE_BLOCK of a bounded sample, each farthest from those before."""
    wanted = min(MAX_CELLS, -(-count // CANDIDATE_BLOCK))
    if wanted < 2:
        return {}
    some = vecs.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", "v").limit(PER_CELL * wanted).select("v").collect()
    found = {}
    for d in {len(r.v) for r in some}:
        points = np.array([r.v for r in some if len(r.v) == d], float)
        nearest, picked = ((points - points[0]) ** 2).sum(1), [0]
        while len(picked) < wanted and nearest.max() > 0:
            picked.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((points - points[picked[-1]]) ** 2).sum(1))
        found[d] = points[picked]
    return found


def placed(vecs: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vecs with cell (its length and nearest pivot) and a row number."""

    def nearest(column: pa.Array) -> dict[str, pa.Array]:
        out = np.zeros(len(column), np.int64)
        lengths = np.diff(column.offsets.to_numpy())
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            out[at] = int(d) << 32
            if int(d) in pivots:
                points = matrix(column.take(pa.array(at))).astype(float)
                out[at] += ((pivots[int(d)] ** 2).sum(1)[None, :] - 2 * points @ pivots[int(d)].T).argmin(1)
        return {"cell": pa.array(out)}

    return map_batches(vecs, nearest, "cell long", ["vec_id", "v"], ["v"]).withColumn("row", F.monotonically_increasing_id())


def dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """rows with a block of about size rows of one cell; a cell with more is dealt by row number."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("parts"))
    return rows.join(parts, "cell").withColumn(name, F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts", "row")


def balls(rows: DataFrame, key: str) -> DataFrame:
    """(cell, key, centre, radius, norm) of each block."""

    def ball(t: pa.Table) -> pa.Table:
        points = matrix(t.column("v")).astype(float)
        centre = points.mean(0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(1).max()))
        return pa.table({"cell": t.column("cell")[:1], key: t.column(key)[:1], "centre": pa.array([centre.tolist()]), "radius": [radius], "norm": [float(np.sqrt((centre**2).sum()))]})

    return rows.groupBy("cell", key).applyInArrow(ball, f"cell long, {key} long, centre array<double>, radius double, norm double")


def meetings(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the dual-tree results of pairs (qcell, q, cell, c) of blocks.

    All query blocks of a candidate block come to its task, QUERY_BLOCK rows or one block a group, so that its tree is built once for them.
    """
    sizes = queries.groupBy(F.col("cell").alias("qcell"), "q").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("cell", "c").orderBy("qcell", "q").rowsBetween(Window.unboundedPreceding, -1)
    turns = materialize(pairs.join(sizes, ["qcell", "q"]).withColumn("turn", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / QUERY_BLOCK)).drop("rows"), "turns")
    key = lambda side: F.concat_ws("/", "cell", "c", "turn").alias(side)
    left = queries.withColumnRenamed("cell", "qcell").join(turns, ["qcell", "q"]).select(key("x"), "vec_id", "v", "least")
    right = candidates.join(turns.select("cell", "c", "turn").distinct(), ["cell", "c"]).select(key("y"), "vec_id", "v")

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if x.num_rows and y.num_rows:
            least = x.column("least").to_numpy()
            found = dual_tree(x.column("vec_id").to_numpy(), matrix(x.column("v")), y.column("vec_id").to_numpy(), matrix(y.column("v")), k, least)
        return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    return left.groupBy("x").cogroup(right.groupBy("y")).applyInArrow(meet, "query_id long, vec_id long, score long")


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of found by query; Spark limits the rows of a query before and after the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vecs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k best rows of vecs; both have (vec_id, v).

    First every query meets one block of its own cell, which gives it a kth score; then the pairs of query and candidate
    blocks whose bound can reach the least kth score of the queries' block.
    """
    pivots = cells(vecs, vecs.count())
    own = materialize(dealt(placed(vecs, pivots), CANDIDATE_BLOCK, "c"), "candidates")
    asked = materialize(dealt(placed(queries, pivots), QUERY_BLOCK // 4, "q").withColumn("least", F.lit(float("-inf"))), "queries")
    blocks = materialize(balls(own, "c"), "blocks")
    home = asked.select(F.col("cell").alias("qcell"), "q").distinct().join(blocks.where("c = 0").select(F.col("cell").alias("qcell"), "cell", "c"), "qcell")
    first = materialize(meetings(asked, own, home, k), "first")
    kth = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("kth"))
    # an id with several query rows has the results of all of them; its scores bound none of them alone
    single = asked.groupBy("vec_id").agg(F.count("*").alias("rows")).where("rows = 1").select(F.col("vec_id").alias("query_id"))
    asked = materialize(asked.drop("least").join(kth.join(single, "query_id").withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("cell", "vec_id", "v", "q", F.coalesce("kth", F.lit(float("-inf"))).alias("least")), "asked")
    groups = balls(asked, "q").join(asked.groupBy("cell", "q").agg(F.min("least").alias("least")), ["cell", "q"])
    groups = materialize(groups.select(F.col("cell").alias("qcell"), "q", "least", F.col("centre").alias("qcentre"), F.col("radius").alias("qradius"), F.col("norm").alias("qnorm")), "groups")
    dot = F.aggregate(F.zip_with("centre", "qcentre", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    bound = dot + F.expr("norm * qradius + qnorm * radius + radius * qradius") + F.expr("1e-9 * (norm + radius) * (qnorm + qradius) + 1e-6")
    length = lambda c: F.shiftright(c, 32)
    rest = groups.join(blocks, length("qcell") == length("cell")).where((bound >= F.col("least")) & ~((F.col("qcell") == F.col("cell")) & (F.col("c") == 0)))
    found = first.unionByName(meetings(asked, own, rest.select("qcell", "q", "cell", "c"), k))
    return top(found, k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return search(vecs, vecs.where(F.col("vec_id") % QUERY_STEP == 0))


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""
