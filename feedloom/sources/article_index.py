"""The article index: two bucketed Parquet tables and a log of commits.

``base`` holds the bulk of the documents, ``delta`` what changed since base was written.
Both are bucketed and sorted by ``doc_id`` with the same bucket count, so the
join that a read or a merge needs runs bucket by bucket without an exchange. A batch is
exchanged once, by bucket; its repeated ids are settled there, and held against the stored
documents' place among all writes, so a batch that lands late does not replace what was
fetched after it. An upsert rewrites only the delta; once that has grown past a share of the base, both are
written as a new base. Data folders are never changed after they are written, and a
commit row naming them is appended last: readers see either the old or the new state,
and a job that dies half way leaves the index as it was. One writer at a time.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.fixed_values import DEFAULT_DIMENSION
from feedloom.functions.vectors import check_dimension
from feedloom.operators.upsert import ORDER, WRITTEN, later, latest_per_key, upsert, without_heavy_copies
from feedloom.session import materialize

LOG = logging.getLogger(__name__)

COMMITS = (
    "version BIGINT, batch_id STRING, dim INT, buckets INT, base STRING, delta STRING,"
    " base_rows BIGINT, delta_rows BIGINT, committed_at TIMESTAMP"
)


# Lookups of a few ids skip all row groups that do not hold them; the filters fit their size to the data.
BLOOM = {"parquet.bloom.filter.enabled#doc_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: str | None
    dim: int
    buckets: int
    base: str
    delta: str | None
    base_rows: int
    delta_rows: int


class ArticleIndex:
    def __init__(self, spark: SparkSession, path: str, *, rewrite_share: float = 0.1):
        self.spark = spark
        self.path = path.rstrip("/")
        self.rewrite_share = rewrite_share

    # -- commits -----------------------------------------------------------------

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], COMMITS)
            raise

    def commit(self, version: int | None = None) -> Commit | None:
        rows = self.commits()
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        row = rows.orderBy(F.desc("version")).drop("committed_at").limit(1).collect()
        return Commit(**row[0].asDict()) if row else None

    def commit_of_batch(self, batch_id: str) -> Commit | None:
        rows = self.commits().filter(F.col("batch_id") == batch_id)
        row = rows.orderBy(F.desc("version")).drop("committed_at").limit(1).collect()
        return Commit(**row[0].asDict()) if row else None

    def _append(self, commit: Commit) -> Commit:
        row = self.spark.createDataFrame(
            [tuple(vars(commit).values())], COMMITS.replace(", committed_at TIMESTAMP", "")
        )
        stamped = row.withColumn("committed_at", F.current_timestamp())
        stamped.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return commit

    # -- tables --------------------------------------------------------------------

    def _table(self, location: str, buckets: int) -> DataFrame:
        name = "feedloom_" + hashlib.md5(location.encode()).hexdigest()
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.STORED_DOCUMENT.fields)
            quoted = location.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (doc_id)"
                f" SORTED BY (doc_id) INTO {buckets} BUCKETS LOCATION '{quoted}'"
            )
        return self.spark.table(name)

    def _write(self, documents: DataFrame, kind: str, buckets: int) -> tuple[str, int]:
        # Not repartitioned here: rows that come from a bucketed table already lie bucket by
        # bucket in their tasks, and a new batch was dealt out by ``_dealt``.
        location = f"{self.path}/data/{kind}-{uuid.uuid4().hex}"
        name = "feedloom_" + hashlib.md5(location.encode()).hexdigest()
        (
            documents.select(*schemas.STORED_DOCUMENT.names)
            .write.option("path", location)
            .bucketBy(buckets, "doc_id")
            .sortBy("doc_id")
            .options(**BLOOM)
            .format("parquet")
            .saveAsTable(name)
        )
        return location, self.spark.table(name).count()

    # -- operations ------------------------------------------------------------------

    def create(
        self, dim: int = DEFAULT_DIMENSION, *, recreate: bool = False, buckets: int = 256
    ) -> Commit:
        """An empty index for vectors of ``dim``. An existing one is left alone unless ``recreate``."""
        check_dimension(dim)
        current = self.commit()
        if current is not None and not recreate:
            LOG.info("Index %s already exists; nothing to do", self.path)
            return current
        empty = self.spark.createDataFrame([], schemas.STORED_DOCUMENT)
        base, _ = self._write(empty, "base", buckets)
        version = current.version + 1 if current else 1
        return self._append(Commit(version, None, dim, buckets, base, None, 0, 0))

    def read(self, version: int | None = None) -> DataFrame:
        """All documents (columns are pruned by what the caller selects)."""
        commit = self.commit(version)
        if commit is None:
            raise ValueError(f"No index at {self.path}")
        return self._documents(commit).select(*schemas.INDEX_DOCUMENT.names)

    def read_writes(self, version: int | None = None) -> DataFrame:
        """Every stored id with the time and run of its last write."""
        commit = self.commit(version)
        if commit is None:
            raise ValueError(f"No index at {self.path}")
        return self._documents(commit).select("doc_id", *WRITTEN)

    def _documents(self, commit: Commit) -> DataFrame:
        base = self._table(commit.base, commit.buckets)
        if commit.delta is None:
            return base
        delta = self._table(commit.delta, commit.buckets)
        return base.join(delta.select("doc_id"), "doc_id", "left_anti").unionByName(delta)

    def count(self) -> int:
        commit = self.commit()
        if commit is not None and commit.delta is None:
            return commit.base_rows
        return self.read().select("doc_id").count()

    def _dealt(self, documents: DataFrame, commit: Commit, stored: bool) -> DataFrame:
        """The last write of every id of a batch, dealt out by bucket: the one exchange of whole
        documents. Writes older than what the base holds are ``stale``."""
        optional = {"written_at": "timestamp", "written_run": "string", "source_ord": "int", "response_no": "int", "pos": "int"}
        missing = {c: F.lit(None).cast(kind) for c, kind in optional.items() if c not in documents.columns}
        batch = documents.withColumns(missing)
        if not stored or "row" not in documents.columns:
            batch = materialize(batch.withColumn("row", F.monotonically_increasing_id()), "batch")
        wrong = (F.size("embedding") != commit.dim) | F.col("embedding").isNull()
        refused = F.raise_error(F.lit(f"embedding dimension differs from {commit.dim}"))
        checked = without_heavy_copies(batch).withColumn("embedding", F.when(wrong, refused).otherwise(F.col("embedding")))
        dealt = checked.repartition(commit.buckets, "doc_id")
        last = latest_per_key(dealt, order=(*WRITTEN, *ORDER, "row")).select(*schemas.STORED_DOCUMENT.names)
        if not commit.base_rows:
            return last.withColumn("stale", F.lit(False))
        base = self._table(commit.base, commit.buckets).select("doc_id", *WRITTEN)
        met = last.alias("new").join(base.alias("old"), F.col("new.doc_id") == F.col("old.doc_id"), "left")
        return met.select("new.*", (F.col("old.doc_id").isNotNull() & later("old", "new")).alias("stale"))

    def changed(self, documents: DataFrame, commit: Commit, stored: bool = False) -> DataFrame:
        """What an upsert of ``documents`` writes: the first base, or the next delta."""
        dealt = self._dealt(documents, commit, stored)
        if commit.delta is None:
            return dealt.where("NOT stale").drop("stale")
        return upsert(self._table(commit.delta, commit.buckets), dealt)

    def upsert(self, documents: DataFrame, batch_id: str | None = None, *, stored: bool = False) -> Commit:
        """Merge documents and return the new commit.

        ``documents`` may tell their place among all writes: ``written_at`` and ``written_run``,
        and ``source_ord``, ``response_no`` and ``pos`` inside a run. Of several writes of an id
        the last by that order holds, in a batch and across batches, in whatever order batches
        land. A write without a time replaces what is there and is replaced by any later call. A
        batch is written to the scratch folder first, unless it is ``stored`` already, or as
        good as that, and its rows are numbered in ``row``. A batch id that was committed before is not written again.
        """
        if batch_id is not None and (done := self.commit_of_batch(batch_id)) is not None:
            return done
        commit = self.commit() or self.create()
        changed = self.changed(documents, commit, stored)
        if commit.base_rows == 0 and commit.delta is None:
            base, base_rows = self._write(changed, "base", commit.buckets)
            return self._append(Commit(commit.version + 1, batch_id, commit.dim, commit.buckets, base, None, base_rows, 0))
        delta, delta_rows = self._write(changed, "delta", commit.buckets)
        next_commit = Commit(
            commit.version + 1, batch_id, commit.dim, commit.buckets, commit.base, delta, commit.base_rows, delta_rows
        )
        if delta_rows > self.rewrite_share * commit.base_rows:
            next_commit = self._rewritten(next_commit, commit.buckets)
        return self._append(next_commit)

    def _rewritten(self, commit: Commit, buckets: int) -> Commit:
        """``commit`` with one base in place of its layers, not yet appended."""
        documents = self._documents(commit)
        if buckets != commit.buckets:
            documents = documents.repartition(buckets, "doc_id")
        base, base_rows = self._write(documents, "base", buckets)
        return replace(commit, buckets=buckets, base=base, base_rows=base_rows, delta=None, delta_rows=0)

    def rewrite(self, buckets: int | None = None) -> Commit:
        """Write base and delta as a new base, in another number of buckets if the index has grown."""
        commit = self.commit()
        if commit is None:
            raise ValueError(f"No index at {self.path}")
        return self._append(replace(self._rewritten(commit, buckets or commit.buckets), version=commit.version + 1, batch_id=None))
