"""Approximate nearest neighbours by adaptive dimension scan.

Largest inner product becomes smallest distance by one more coordinate, sqrt(M^2 - |x|^2)
for a vector and 0 for a query, with M the largest norm. Vectors are dealt into inverted
lists around centroids; a query probes its nearest lists. Within a list, vectors are
rotated at random and read in blocks of columns: after d of D coordinates the partial
distance, scaled by D / d, is an estimate whose error has a known law, so a candidate is
abandoned when it lies beyond the query's current k-th distance by more than that law
allows (``EPSILON``). The k-th distance starts from the ``SPARE`` x k-th in the sample, whose
vectors are rows of the table, and falls as a list is scanned: each ``CHUNK`` of its vectors is
tested against the k nearest so far. A query that finds fewer than k that way searches all lists
without a start. Survivors get the exact inner product of the original vectors in
double precision.

Centroids are fitted on at most ``SAMPLE`` vectors; every vector is indexed. How many
lists a query probes is measured on that sample: the smallest share of lists that holds
``COVERAGE`` of the true neighbours of ``TRIAL`` of its vectors. Where vectors form
clusters that is a few lists; where they have no structure no index can skip much.
A list has about ``PER_LIST`` vectors, as long as the sample has eight for each centroid; beyond
that lists grow and are dealt in parts of about ``PART`` rows, and a query goes to each part of its
lists. Of equal vectors only the ``k + 1`` smallest ids can be among the nearest, so only they are
candidates, which is exact; equal queries are searched once. So copies make no list, part or query hot.

Defined results: vectors that are null, zero, of a length other than the table's most
common one, or that hold a null or non-finite component take no part, nor do rows of null vec_id;
ties go to the smaller vec_id; of repeated vec_ids all rows count; with fewer than k candidates
all come; vectors of any length are read whole; an empty table gives an empty result; extra
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_schema, cut

SAMPLE = 20_000
PER_LIST = 1024
COVERAGE = 0.97
TRIAL = 500
SPARE = 3
#: Rows of a list that one task scans at once.
PART = 8192
#: Rows of a part after which the k-th distance is taken anew.
CHUNK = 2048
#: Columns of a block, and the tolerance of the test that abandons candidates.
BLOCK = 16
EPSILON = 2.1
LISTED = "list int, id bigint, floor double, vec array<double>"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), width)


class Index:
    """Centroids and rotation; what every task holds."""

    def __init__(self, sample: np.ndarray, lists: int, top: float, k: int = 20, coverage: float = COVERAGE, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        self.top, self.width, self.distinct = top, sample.shape[1], np.unique(sample, axis=0)
        self.rotation = np.linalg.qr(draw.standard_normal((self.width + 1, self.width + 1)))[0]
        points = self.rotate(sample)
        centers = points[draw.permutation(len(points))[:lists]]
        for _ in range(8):
            near = self._nearest(points, centers, 1)[:, 0]
            sums = np.zeros_like(centers)
            np.add.at(sums, near, points)
            sizes = np.bincount(near, minlength=len(centers))
            centers = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centers)
        self.centers = centers
        trial = sample[draw.permutation(len(sample))[:TRIAL]]
        own, way = self.lists_of(sample, 1, False)[:, 0], self.lists_of(trial, lists, True)
        place = np.argsort(way, 1)  # place[i, l]: how near list l is to trial vector i
        true = np.argsort(-(trial @ sample.T), 1, kind="stable")[:, 1 : k + 1]
        needed = np.sort(np.take_along_axis(place, own[true], 1).ravel())
        self.probes = int(needed[min(len(needed) - 1, int(coverage * len(needed)))]) + 1 if len(needed) else 1

    def floor(self, queries: np.ndarray, k: int) -> np.ndarray:
        """A score that at least k different vectors of the table reach, for each query."""
        if len(self.distinct) < k:
            return np.full(len(queries), -np.inf)
        scores = queries @ self.distinct.T
        return np.partition(scores, -k, 1)[:, -k] - 1e-9 * np.abs(scores).max(1)

    def rotate(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.top - (vectors**2).sum(1), 0))
        return np.concatenate([vectors, more[:, None]], 1) @ self.rotation

    @staticmethod
    def _nearest(points: np.ndarray, centers: np.ndarray, n: int) -> np.ndarray:
        out = []
        for at in range(0, len(points), 2048):
            far = (centers**2).sum(1) - 2 * points[at : at + 2048] @ centers.T
            out.append(np.argsort(far, 1, kind="stable")[:, :n] if n > 1 else far.argmin(1)[:, None])
        return np.concatenate(out) if out else np.zeros((0, n), np.int64)

    def lists_of(self, vectors: np.ndarray, n: int, query: bool) -> np.ndarray:
        return self._nearest(self.rotate(vectors, query), self.centers, min(n, len(self.centers)))


def scan(index: Index, queries: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK, epsilon: float = EPSILON, work: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of the k nearest that survive, for each query; ``work`` is told the numbers of multiplied coordinates.

    The first block of columns is multiplied for all; then each query goes on with its own
    candidates, block by block, and leaves those whose partial distance lies beyond its limit.
    """
    a, b = index.rotate(queries, True), index.rotate(vectors)
    width, done = a.shape[1], 0
    edges = [*range(0, width, block), width]
    cuts = [slice(x, y) for x, y in zip(edges, edges[1:], strict=False)]
    slack = [((1 + epsilon / np.sqrt(c.stop)) ** 2 if c.stop < width else 1 + 1e-9) * c.stop / width for c in cuts]
    columns = [np.ascontiguousarray(b[:, c]) for c in cuts]
    norms, own = [(x**2).sum(1) for x in columns], [(a[:, c] ** 2).sum(1) for c in cuts]
    # largest distance, squared, that can still count
    limit = (a**2).sum(1) + index.top - 2 * floor
    names, found, scores = [], [], []
    near = np.full((len(a), k), np.inf)
    for at in range(0, len(b), CHUNK):
        rows = slice(at, min(at + CHUNK, len(b)))
        head = own[0][:, None] + norms[0][rows][None] - 2 * a[:, cuts[0]] @ columns[0][rows].T
        done += head.size * (cuts[0].stop - cuts[0].start)
        keep = head <= limit[:, None] * slack[0]
        for q in np.flatnonzero(keep.any(1)):
            alive = np.flatnonzero(keep[q])
            far = head[q, alive]
            alive += at
            for c, x, n, o, more in zip(cuts[1:], columns[1:], norms[1:], own[1:], slack[1:], strict=True):
                far = far + (n[alive] + o[q] - 2 * (x[alive] @ a[q, c]))
                done += len(alive) * (c.stop - c.start)
                stay = far <= limit[q] * more
                alive, far = alive[stay], far[stay]
                if not len(alive):
                    break
            if len(alive):
                names.append(np.full(len(alive), q))
                found.append(alive)
                far = np.r_[near[q], far]
                near[q] = np.partition(far, k - 1)[:k]
                limit[q] = min(limit[q], near[q].max() + 1e-9 * index.top)
    if work is not None:
        work.append(done)
    if not names:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, v = np.concatenate(names), np.concatenate(found)
    score = np.einsum("ij,ij->i", queries[q], vectors[v])
    enough = score >= floor[q]
    q, v, score = q[enough], v[enough], score[enough]
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], ids[v[rank < k]], score[rank < k]


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vec`` of the rows that take part."""
    vec = embeddings["embedding"].cast("array<double>")
    rows = embeddings.select(embeddings["vec_id"].cast("bigint").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null and size(vec) > 0")
    rows = rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["w"] if sizes else 0))


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, coverage: float = COVERAGE, per_list: int = PER_LIST, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every row whose vec_id ``every`` divides."""
    spark = embeddings.sparkSession
    rows = cut(usable(embeddings), "vectors")
    n, top = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    few = np.array([r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").collect()])  # at most `sample` rows
    width = few.shape[1]
    lists = int(max(1, min(len(few) // 8 + 1, -(-n // per_list))))
    index = spark.sparkContext.broadcast(Index(few, lists, top, k, coverage))  # bounded by the sample
    # of equal vectors, only the k + 1 smallest ids; first within salts, so many copies don't meet in one task
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    same = lambda *more: Window.partitionBy(F.xxhash64("vec"), "vec", *more).orderBy("vec_id")
    some = rows.withColumn("nth", F.row_number().over(same(salt))).where(F.col("nth") <= k + 1)
    some = some.withColumn("nth", F.row_number().over(same())).where(F.col("nth") <= k + 1).drop("nth")
    asked = rows.where(F.col("vec_id") % every == 0)
    one_each = asked.groupBy("vec").agg(F.min("vec_id").alias("qrep"))

    def assign(probes: int, query: bool, bounded: bool = False):
        target = arrow_schema(LISTED)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    own = _matrix(part.column(1), width)
                    found = index.value.lists_of(own, probes, query)
                    # once for each query, however many lists it probes
                    floor = index.value.floor(own, SPARE * (k + 1)) if bounded else np.full(len(own), -np.inf)
                    take = np.repeat(np.arange(part.num_rows), found.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(found.ravel(), pa.int32()), part.column(0).take(pa.array(take)), pa.array(floor[take]), part.column(1).take(pa.array(take))], schema=target)

        return run

    vectors = cut(some.select("vec_id", "vec").mapInArrow(assign(1, False), LISTED).drop("floor"), "lists")
    sizes = vectors.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    parts = cut(sizes, "parts").withColumnRenamed("list", "l")  # a row per list: Spark broadcasts it while small
    dealt = vectors.join(parts, F.col("list") == F.col("l")).select("list", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "vec")

    def hits(queries: DataFrame, probes: int, bounded: bool) -> DataFrame:
        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [], [], []
            if left.num_rows and right.num_rows:
                vecs, ids, names = _matrix(left.column("vec"), width), left.column("id").to_numpy(), right.column("id").to_numpy()
                asks, floor = _matrix(right.column("vec"), width), right.column("floor").to_numpy()
                for at in range(0, len(asks), 1024):
                    q, i, s = scan(index.value, asks[at : at + 1024], floor[at : at + 1024], vecs, ids, min(k + 1, len(ids)))
                    for held, x in zip(out, (names[at + q], i, s), strict=True):
                        held.append(x)
            cols = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, (np.int64, np.int64, np.float64), strict=True)]
            return pa.table(dict(zip(("qrep", "vec_id", "score"), map(pa.array, cols), strict=True)))

        asking = queries.select("qrep", "vec").mapInArrow(assign(probes, True, bounded), LISTED)
        asking = asking.join(parts, F.col("list") == F.col("l")).select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "floor", "vec")
        found = dealt.groupBy("list", "part").cogroup(asking.groupBy("list", "part")).applyInArrow(search, "qrep bigint, vec_id bigint, score double")
        best = Window.partitionBy("qrep").orderBy(F.desc("score"), "vec_id")
        return cut(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "hits")

    first = hits(one_each, index.value.probes, True)
    full = first.groupBy(F.col("qrep").alias("full")).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > k)
    short = cut(one_each.join(full, F.col("qrep") == F.col("full"), "left_anti"), "short")
    if not short.isEmpty():
        second = hits(short, lists, False)
        first = first.join(short.select(F.col("qrep").alias("again")), F.col("qrep") == F.col("again"), "left_anti").unionByName(second)
    hits = first
    who = asked.join(one_each.withColumnRenamed("vec", "v"), F.col("vec") == F.col("v")).select(F.col("vec_id").alias("query_id"), F.col("qrep").alias("q"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = who.join(hits, F.col("q") == F.col("qrep")).where("vec_id != query_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
