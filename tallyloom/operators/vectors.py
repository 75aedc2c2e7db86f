"""Nearest vectors by cosine through an inverted file with product-quantised residuals.

Vectors are normalised and dealt into cells around centroids. Within its cell a
vector is stored as one byte per part of its residual (the code of the nearest
codeword there) and the length of what the codes leave out. Cells are folders, so
a search reads the cells it probes and no others.

With q the query, x a vector, y its reconstruction and e the length of x - y, q.x lies
within e of q.y. So the codes alone give every vector a lower and an upper bound,
only those whose upper bound reaches the k-th lower one of their block are compared,
and true cosines decide: inside the probed cells the result is exact. Vectors lie in
the block beside their codes, so a block passes on its best of each query and a search
whose bounds exclude little sends no more rows on than one whose bounds exclude much. ``exact=True`` goes on
to the cells that by their radius could still hold a better vector than the k-th
found, and so gives what a scan of all vectors gives. Without it the result is that
of the ``probes`` nearest cells.

Centroids and codewords are fitted on at most ``SAMPLE`` vectors, chosen by a hash of
their keys; every vector is indexed. There are at most ``LARGEST`` cells, whose
centroids and codewords are all that is sent to every task. Queries meet cells in
blocks, and codes are stored in blocks of a cell, so that a large cell is many rows.

Null and zero vectors, and vectors of another length than the first cell's
centroid, are not indexed and not asked for. Equal similarities, rounded to six
digits, are ordered by key. An empty table finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.functions.numbers import rounded
from tallyloom.functions.text import cosine

SAMPLE, LARGEST = 8000, 4096
PARTS, WORDS, ROUNDS = 16, 256, 8
CHUNK, BLOCK = 256, 256  # vectors in a block of a cell, queries in a block
SLACK = 2e-6  # similarities that round alike are told apart by their keys


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))


def _units(rows: DataFrame, size: int) -> DataFrame:
    """Rows (name, vector) of that length with ``unit``, the vector at unit length; others and zero vectors go."""

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = _matrix(part.column(1)).astype(np.float64)
                norm = np.linalg.norm(x, axis=1)
                keep = np.flatnonzero(norm > 0)
                part = part.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(x[keep] / norm[keep, None])], names=[*part.schema.names, "unit"])

    name, vector = rows.columns
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    return rows.where(F.col(name).isNotNull() & (F.size(vector) == size)).mapInArrow(each, f"{kinds}, unit array<double>")


def _hashes(rows: DataFrame, size: int) -> DataFrame:
    """The hash ``h`` of the name of each row that ``_units`` keeps; no vector goes on."""

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                norm = np.linalg.norm(_matrix(part.column(1)).astype(np.float64), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(norm > 0))], names=["h"])

    name, vector = rows.columns
    return rows.where(F.col(name).isNotNull() & (F.size(vector) == size)).select(F.xxhash64(name).alias("h"), vector).mapInArrow(each, "h long")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant of each row of x."""
    return (y * y).sum(axis=1) - 2 * x @ y.T


def _codewords(x: np.ndarray) -> np.ndarray:
    """Lloyd's algorithm on one part of the sample's residuals, from evenly spaced rows."""
    words = x[np.linspace(0, len(x) - 1, min(WORDS, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        own = _distances(x, words).argmin(axis=1)
        n = np.bincount(own, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        words[n > 0] = sums[n > 0] / n[n > 0, None]
    return words


class Quantiser:
    """Centroids and, per part, the codewords of residuals."""

    def __init__(self, centroids: np.ndarray, books: list[np.ndarray]):
        self.centroids, self.books = centroids, books
        edges = np.linspace(0, centroids.shape[1], len(books) + 1).astype(int) if len(books) else np.zeros(1, int)
        self.parts = list(zip(edges, edges[1:]))
        norms = np.linalg.norm(centroids, axis=1, keepdims=True)
        self.directions = np.divide(centroids, norms, out=np.zeros_like(centroids), where=norms > 0)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, angle to the cell's direction, codes and length of what they leave out, of each row."""
        cell = _distances(x, self.centroids).argmin(axis=1)
        rest = x - self.centroids[cell]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        for p, (book, (lo, hi)) in enumerate(zip(self.books, self.parts)):
            codes[:, p] = _distances(rest[:, lo:hi], book).argmin(axis=1)
            rest[:, lo:hi] -= book[codes[:, p]]
        angle = np.arccos(np.clip((x * self.directions[cell]).sum(axis=1), -1, 1))
        return cell, angle, codes, np.linalg.norm(rest, axis=1)

    def estimates(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """q.y of every query and coded vector of a cell."""
        out = np.repeat(queries @ self.centroids[cell][:, None], len(codes), axis=1)
        for p, (book, (lo, hi)) in enumerate(zip(self.books, self.parts)):
            out += (queries[:, lo:hi] @ book.T)[:, codes[:, p]]
        return out


def _fit_books(sample: DataFrame, centroids: np.ndarray, parts: int) -> list[np.ndarray]:
    """Codewords of every part, each fitted in a task of its own."""
    bare = Quantiser(centroids, [])
    edges = np.linspace(0, centroids.shape[1], parts + 1).astype(int)

    def residuals(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            rest = x - bare.centroids[_distances(x, bare.centroids).argmin(axis=1)]
            for p, (lo, hi) in enumerate(zip(edges, edges[1:])):
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(x), pa.int32()), _lists(np.ascontiguousarray(rest[:, lo:hi]))], names=["part", "x"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["x"].to_numpy())
        words = _codewords(x[np.lexsort(x.T[::-1])])
        return pd.DataFrame({"part": rows["part"].iloc[0], "words": [words.tolist()]})

    fitted = sample.select("unit").mapInArrow(residuals, "part int, x array<double>").groupBy("part").applyInPandas(fit, "part int, words array<array<double>>")
    books = {r.part: np.array(r.words) for r in fitted.collect()}  # PARTS * WORDS codewords
    return [books[p] for p in sorted(books)]


def build(vectors: DataFrame, path: str, key: str, vector: str, cells: int | None = None, parts: int = PARTS) -> None:
    """Store the index of ``vectors`` under ``path``; by default as many cells as the root of their number, LARGEST at most."""
    spark, first = vectors.sparkSession, vectors.where(F.size(vector) > 0).select(F.size(vector)).first()
    size = first[0] if first else 0
    named = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    rows = _units(named, size)
    # the sample is the vectors of the least hashes: these are found without the vectors, so no task sorts more than the sample
    _hashes(named, size).write.parquet(f"{path}/hashes")
    hashes = spark.read.parquet(f"{path}/hashes")
    n, edge = hashes.count(), hashes.orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    if n:
        least = _units(named.where(F.xxhash64("key") <= edge), size).orderBy(F.xxhash64("key")).limit(SAMPLE)
        least.select("unit").write.parquet(f"{path}/sample")
        sample = spark.read.parquet(f"{path}/sample").coalesce(1)
        wanted = cells or min(LARGEST, int(np.ceil(np.sqrt(n))))
        model = KMeans(k=max(2, wanted), seed=1, maxIter=10, featuresCol="x").fit(sample.select(array_to_vector("unit").alias("x")))
        centroids = np.array([c.tolist() for c in model.clusterCenters()])
        quantiser = Quantiser(centroids, _fit_books(sample, centroids, min(parts, size)))
    else:
        quantiser = Quantiser(np.zeros((0, 0)), [])

    def encode(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                unit = _matrix(part.column(2))
                cell, angle, codes, error = quantiser.encode(unit)
                packed, held = (pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (codes, unit))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cell.astype(np.int32)), pa.array(angle), packed, pa.array(error), held], names=["key", "vector", "cell", "angle", "code", "error", "unit"])

    kind = {c: rows.schema[c].dataType.simpleString() for c in ("key", "vector")}
    coded = rows.select("key", "vector", "unit").mapInArrow(encode, f"key {kind['key']}, vector {kind['vector']}, cell int, angle double, code binary, error double, unit binary")
    coded.write.parquet(f"{path}/coded")
    coded = spark.read.parquet(f"{path}/coded")
    held = coded.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
    held.write.parquet(f"{path}/cells")
    chunked = coded.join(spark.read.parquet(f"{path}/cells").select("cell", "n"), "cell")
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / CHUNK)).cast("int"))
    entry = F.struct("key", "code", "error", "unit")
    chunked.groupBy("cell", "chunk").agg(F.collect_list(entry).alias("entries")).write.partitionBy("cell").parquet(f"{path}/codes")
    chunked.repartition("cell", "chunk").select("cell", "key", "vector").write.partitionBy("cell").parquet(f"{path}/vectors")
    model_rows = [("centroid", i, [c]) for i, c in enumerate(quantiser.centroids.tolist())] + [("book", i, b.tolist()) for i, b in enumerate(quantiser.books)]
    spark.createDataFrame(model_rows, "kind string, place int, rows array<array<double>>").write.parquet(f"{path}/model")


def _read_quantiser(spark: SparkSession, path: str) -> Quantiser:
    rows = sorted(spark.read.parquet(f"{path}/model").collect(), key=lambda r: r.place)
    centroids = [r.rows[0] for r in rows if r.kind == "centroid"]
    return Quantiser(np.array(centroids) if centroids else np.zeros((0, 0)), [np.array(r.rows) for r in rows if r.kind == "book"])


def _places(queries: DataFrame, quantiser: Quantiser, radii: dict[int, float]) -> DataFrame:
    """(query, cell, place, reach): the cells by nearness to each query, and the best similarity that each can hold."""
    filled = np.array(sorted(radii), dtype=int)
    radius = np.array([radii[c] for c in filled])

    def each(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                x = _matrix(part.column(1))
                angle = np.arccos(np.clip(x @ quantiser.directions[filled].T, -1, 1))
                near = np.argsort(np.argsort(_distances(x, quantiser.centroids[filled]), axis=1, kind="stable"), axis=1)
                reach = np.cos(np.maximum(0, angle - radius))
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(x)), len(filled))))
                columns = [keys, pa.array(np.tile(filled.astype(np.int32), len(x))), pa.array(near.ravel().astype(np.int32)), pa.array(reach.ravel())]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "cell", "place", "reach"])

    return queries.select("query", "unit").mapInArrow(each, f"query {queries.schema['query'].dataType.simpleString()}, cell int, place int, reach double")


def _contenders(sims: np.ndarray, x: np.ndarray, keys: np.ndarray, places: np.ndarray, k: int, floor: float) -> np.ndarray:
    """Which of ``places`` may be among a query's best k of a block: none surely better than k of them; of equal vectors the k least keys."""
    bound = np.partition(sims, -k)[-k] if len(sims) >= k else -2.0
    left = np.flatnonzero(sims >= max(bound, floor) - SLACK)
    if len(left) <= k:
        return left
    seen, kept = {}, []
    for i in left[np.argsort(keys[places[left]], kind="stable")]:
        same = x[places[i]].tobytes()
        seen[same] = seen.get(same, 0) + 1
        if seen[same] <= k:
            kept.append(i)
    return np.array(kept)


def _candidates(spark: SparkSession, path: str, quantiser: Quantiser, queries: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, cell, key, low, high) of the vectors that may be among the best k of (query, cell, floor).

    A block of a cell's codes holds the vectors too: those that the bounds of the codes leave are
    compared there, and only the block's best of each query go on.
    """

    def each(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                cell, entries = row.column(0)[0].as_py(), row.column(1).flatten()
                n = len(entries)
                codes = np.frombuffer(b"".join(entries.field("code").to_pylist()), np.uint8).reshape(n, -1)
                x = np.frombuffer(b"".join(entries.field("unit").to_pylist()), np.float64).reshape(n, -1)
                error = entries.field("error").to_numpy(zero_copy_only=False)
                keys = np.array(entries.field("key").to_pylist(), dtype=object)
                members = row.column(3).flatten()
                place = {q: i for i, q in enumerate(members.field("query").to_pylist())}
                wanted = row.column(2)[0].as_py()
                units = _matrix(members.field("unit"))[[place[a["query"]] for a in wanted]]
                middle = quantiser.estimates(units, cell, codes)
                low, high = middle - error, middle + error
                bound = np.partition(low, -k, axis=1)[:, -k] if n >= k else np.full(len(units), -2.0)
                open_ = high >= np.maximum(bound, [a["floor"] for a in wanted])[:, None] - SLACK
                some = np.flatnonzero(open_.any(axis=0))  # fetched for at least one query
                true = units @ x[some].T
                out = {c: [] for c in types}
                for a, sims, mine in zip(wanted, true, open_[:, some]):
                    mine = np.flatnonzero(mine)
                    for i in _contenders(sims[mine], x, keys, some[mine], k, a["floor"]):
                        out["query"].append(a["query"])
                        out["cell"].append(cell)
                        out["key"].append(keys[some[mine[i]]])
                        out["low"].append(sims[mine[i]])
                        out["high"].append(sims[mine[i]])
                if out["key"]:
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    codes = spark.read.parquet(f"{path}/codes")
    types = {"query": asked.schema["query"].dataType.simpleString(), "cell": "int", "key": codes.schema["entries"].dataType.elementType["key"].dataType.simpleString(), "low": "double", "high": "double"}
    schema = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items())).schema
    arrow = to_arrow_schema(schema)
    cells = [r.cell for r in asked.select("cell").distinct().collect()]  # LARGEST at most; the read prunes to their folders
    # queries with a vector come in blocks; a block meets the cells that any of it asks for
    block = F.pmod(F.xxhash64("query"), F.lit(-(-queries.count() // BLOCK) or 1)).alias("block")
    members = queries.groupBy(block).agg(F.collect_list(F.struct("query", "unit")).alias("members"))
    blocks = asked.groupBy("cell", block).agg(F.collect_list(F.struct("query", "floor")).alias("asked"))
    met = codes.where(F.col("cell").isin(cells)).join(blocks, "cell").join(members, "block").select("cell", "entries", "asked", "members")
    return met.mapInArrow(each, schema)


def _reranked(spark: SparkSession, path: str, queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """(query, key, similarity) of candidates whose upper bound reaches the k-th lower bound of their query."""
    best = found.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("low")))).where(F.col("_r") <= k)
    bound = best.groupBy("query").agg(F.when(F.count("*") >= k, F.min("low")).otherwise(-2.0).alias("bound"))
    left = found.join(bound, "query").where(F.col("high") >= F.col("bound") - SLACK).select("query", "cell", "key")
    vectors = spark.read.parquet(f"{path}/vectors")
    fetched = left.join(vectors, ["cell", "key"]).join(queries.select("query", F.col("vector").alias("_q")), "query")
    return fetched.select("query", "key", rounded(cosine(F.col("_q"), F.col("vector")), 6).alias("similarity"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "key")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(queries: DataFrame, path: str, query_key: str, vector: str, store, k: int = 5, probes: int | None = None, exact: bool = True) -> DataFrame:
    """query, key, similarity, rank: the ``k`` nearest vectors of every query.

    ``probes`` cells are read for each query first (by default an eighth of them);
    ``store(frame, name)`` writes a frame once and reads it back. With ``exact``
    every cell that can still hold a better vector is read after that.
    """
    spark = queries.sparkSession
    quantiser = _read_quantiser(spark, path)
    if not len(quantiser.centroids):
        return queries.select(query_key, F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("double").alias("similarity"), F.lit(None).cast("int").alias("rank")).limit(0)
    radii = {r.cell: r.radius for r in spark.read.parquet(f"{path}/cells").select("cell", "radius").collect()}
    rows = store(_units(queries.select(F.col(query_key).alias("query"), F.col(vector).alias("vector")), quantiser.centroids.shape[1]), "queries")
    places = store(_places(rows, quantiser, radii), "places")
    probes = probes or -(-len(radii) // 8)
    first = places.where(F.col("place") < probes).select("query", "cell", F.lit(-2.0).alias("floor"))
    found = store(_best(_reranked(spark, path, rows, store(_candidates(spark, path, quantiser, rows, first, k), "bounds"), k), k), "nearest")
    if exact:
        floor = found.groupBy("query").agg(F.when(F.count("*") >= k, F.min("similarity")).otherwise(-2.0).alias("floor"))
        rest = places.where(F.col("place") >= probes).join(floor, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
        rest = store(rest.where(F.col("reach") >= F.col("floor") - SLACK).select("query", "cell", "floor"), "further")
        more = _reranked(spark, path, rows, store(_candidates(spark, path, quantiser, rows, rest, k), "bounds"), k)
        found = _best(found.drop("rank").unionByName(more), k)
    return found.select(F.col("query").alias(query_key), "key", "similarity", "rank")


def cells_read(queries: DataFrame, path: str, query_key: str, vector: str, probes: int | None = None) -> DataFrame:
    """Per query, the share of vectors that its probed cells hold."""
    spark = queries.sparkSession
    quantiser, cells = _read_quantiser(spark, path), spark.read.parquet(f"{path}/cells")
    radii = {r.cell: r.radius for r in cells.select("cell", "radius").collect()}
    rows = _units(queries.select(F.col(query_key).alias("query"), F.col(vector).alias("vector")), quantiser.centroids.shape[1])
    near = _places(rows, quantiser, radii).where(F.col("place") < (probes or -(-len(radii) // 8)))
    total = cells.agg(F.sum("n")).first()[0]
    return near.join(cells, "cell").groupBy("query").agg((F.sum("n") / F.lit(total)).alias("share")).withColumnRenamed("query", query_key)
