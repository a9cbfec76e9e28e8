"""An inverted-file index of vectors: lists around centroids, searched by probing a few of them.

Centroids come from k-means on a bounded sample of the rows. Every row is stored under the list
of its nearest centroid, a partition column, so a search reads the files of the lists it
probes and no others; the candidates are ranked by their exact score. How many lists have to
be probed depends on the data: ``build`` measures it on a bounded sample of stored rows, whose
exact neighbours it finds, and keeps the smallest number that reaches ``target`` of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.cells import distances, matrix, with_cell
from feedloom.operators.nearest import batch_in_lists, knn, knn_batch

# Rows that train the centroids and rows that measure the number of probes, about.
TRAIN_ROWS = 100_000
MEASURED_ROWS = 200
MAX_LISTS = 1024
TARGET_RECALL = 0.95
NEIGHBOURS = 10
SEED = 7
META = "key STRING, dim INT, probes INT, recall DOUBLE, rows STRING"


def bounded_sample(rows: DataFrame, key: str, total: int, wanted: int, salt: str) -> DataFrame:
    """About ``wanted`` rows, chosen by a hash of the key."""
    share = min(1.0, wanted / max(1, total))
    return rows.where(F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def nearest_lists(queries: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` lists nearest to each query, nearest first."""
    return np.argsort(distances(queries, centroids), axis=1, kind="stable")[:, :n]


class VectorLists:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        meta = spark.read.schema(META).json(f"{self.path}/meta").first()
        self.key, self.dim, self.probes, self.recall = meta["key"], meta["dim"], meta["probes"], meta["recall"]
        self.rows = np.array(json.loads(meta["rows"]), dtype=np.int64)
        stored = spark.read.parquet(f"{self.path}/centroids").orderBy("list").toArrow()  # MAX_LISTS rows at most
        self.centroids = matrix(stored.column("embedding"), self.dim)

    @classmethod
    def build(
        cls,
        vectors: DataFrame,
        path: str,
        *,
        key: str = "doc_id",
        lists: int | None = None,
        target: float = TARGET_RECALL,
        neighbours: int = NEIGHBOURS,
    ) -> VectorLists:
        """Store ``vectors`` (``key``, ``embedding``) under ``path``. Rows without a vector of the
        common length are not stored; without any row there is no index (``ValueError``)."""
        spark = vectors.sparkSession
        found = vectors.where(F.size("embedding") > 0).groupBy(F.size("embedding").alias("dim")).count()
        common = found.orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
        if not common:
            raise ValueError("no vectors to index")
        dim, total = common[0]["dim"], common[0]["count"]
        usable = vectors.select(key, "embedding").where(F.size("embedding") == dim)
        wanted = min(MAX_LISTS, total, lists or int(np.ceil(np.sqrt(total))))
        centroids = _train(bounded_sample(usable, key, total, TRAIN_ROWS, "train"), key, wanted)

        placed = with_cell(usable, centroids, name="list", others=(key,))
        # Rows of a list lie together, and a list with very many rows is split over several files.
        placed.hint("rebalance", "list").write.partitionBy("list").parquet(f"{path}/lists")
        stored = spark.read.parquet(f"{path}/lists")
        rows = np.zeros(len(centroids), dtype=np.int64)
        for r in stored.groupBy("list").count().collect():  # a row a list
            rows[r["list"]] = r["count"]
        sample = bounded_sample(stored, key, total, MEASURED_ROWS, "measure")
        probes, recall = _measure(stored, sample, centroids, key, dim, neighbours, target)

        numbered = [(k, c.tolist()) for k, c in enumerate(centroids)]
        spark.createDataFrame(numbered, "list INT, embedding ARRAY<DOUBLE>").write.parquet(f"{path}/centroids")
        meta = [(key, int(dim), probes, recall, json.dumps(rows.tolist()))]
        spark.createDataFrame(meta, META).coalesce(1).write.json(f"{path}/meta")  # last: a half built index does not open
        return cls(spark, path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    def search(self, vector: Sequence[float], k: int, probes: int | None = None) -> DataFrame:
        """The ``k`` best rows of the probed lists; only their partitions are read."""
        lists = nearest_lists(np.asarray(vector, dtype=np.float64)[None, :], self.centroids, probes or self.probes)[0]
        candidates = self.read().where(F.col("list").isin([int(x) for x in lists])).drop("list")
        return knn(candidates, vector, k, self.key)

    def search_batch(
        self, queries: DataFrame, k: int, probes: int | None = None, *, query_key: str = "query_id", **limits
    ) -> DataFrame:
        """The ``k`` best rows of every query's probed lists: query key, key, score, rank."""
        usable = queries.select(query_key, "embedding").where(F.size("embedding") == self.dim)
        centroids, dim, n = self.centroids, self.dim, min(probes or self.probes, len(self.centroids))

        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = nearest_lists(matrix(batch.column(1), dim), centroids, n)
                ends = np.arange(len(lists) + 1) * lists.shape[1]
                cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lists.reshape(-1), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[query_key, "embedding", "cells"])

        schema = T.StructType([*usable.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
        return batch_in_lists(
            self.read().withColumnRenamed("list", "cell"),
            usable.mapInArrow(routed, schema),
            self.rows,
            k,
            dim,
            key=self.key,
            query_key=query_key,
            **limits,
        )


def _train(sample: DataFrame, key: str, lists: int) -> np.ndarray:
    """Centroids of a bounded sample, in a fixed order."""
    rows = sample.orderBy(key).select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=max(2, lists), seed=SEED, maxIter=15, initMode="random").fit(rows)
    return np.unique(np.array(model.clusterCenters()), axis=0)


def _measure(
    stored: DataFrame, sample: DataFrame, centroids: np.ndarray, key: str, dim: int, k: int, target: float
) -> tuple[int, float]:
    """The number of probes that finds ``target`` of the sample's exact neighbours, and what it finds."""
    asked = sample.select(F.col(key).alias("query_id"), "embedding")
    truth = knn_batch(stored, asked, k, dim, key=key).select("query_id", key)
    of_row = truth.join(stored.select(key, "list"), key).select("query_id", "list").toArrow().to_pandas()
    vectors = asked.toArrow()  # MEASURED_ROWS, about
    order = nearest_lists(matrix(vectors.column("embedding"), dim), centroids, len(centroids))
    place = np.argsort(order, axis=1)  # how many lists a query probes before it comes to a list
    row = {query: i for i, query in enumerate(vectors.column("query_id").to_pylist())}
    needed = np.sort([place[row[q], c] for q, c in zip(of_row["query_id"], of_row["list"], strict=True)])
    if not len(needed):
        return len(centroids), 1.0
    probes = int(needed[int(np.ceil(target * len(needed))) - 1]) + 1
    return probes, float((needed < probes).mean())
