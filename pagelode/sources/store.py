"""Index tables in a folder of Parquet files.

Two parts: the base tables, which every batch appends to, and the search
tables, which are built from them as a whole. Each build of the search tables is
a version, a folder of its own. A version counts from the moment its last table
is complete, so a reader sees a whole version and a failed build leaves the one
before it in use. A build keeps the version before its own, for those who read
it, and removes older ones.

Base tables are partitioned by the batch that wrote them. A batch reads only
batches before it and overwrites only its own partition, so running it again
after a failure gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode import schema
from pagelode.operators import index as ix
from pagelode.operators import match
from pagelode.operators import search as se

# A search reads whole buckets: a few million rows are a few files.
POSTINGS_PER_BUCKET = 5_000_000
MAX_BUCKETS = 4096


class IndexStore:
    """Index tables under ``path``, a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # Base tables

    def write_batch(self, name: str, rows: DataFrame, batch_id: int) -> None:
        target = f"{self.path}/base/{name}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(target)

    def base(self, name: str, before: int | None = None) -> DataFrame:
        """A base table with its ``batch_id``; with ``before``, earlier batches only."""
        columns = schema.BASE[name]
        folder = f"{self.path}/base/{name}"
        if not self._exists(folder):
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).parquet(folder)
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def link(self, before: int | None = None) -> DataFrame:
        """link with ``indexed_at``, the time of the last batch that met the page."""
        last = (
            self.base("touched", before)
            .groupBy("link_id")
            .agg(F.max_by("indexed_at", "batch_id").alias("indexed_at"))
        )
        return self.base("link", before).join(last, "link_id", "left")

    def tables(self, latest_only: bool = False) -> ix.IndexTables:
        """The base tables; ``latest_only`` keeps each page's last version.

        By default stored rows never leave: a batch adds the keys it finds new.
        With ``latest_only`` the batches must have been written in replace
        mode, in which each holds whole pages.
        """
        links, postings, edges = (
            self.base(t) for t in ("link", "wordrelation", "backlinks")
        )
        if latest_only:
            current = (
                self.base("touched").groupBy("link_id").agg(F.max("batch_id").alias("batch_id"))
            )
            links = links.join(current, ["link_id", "batch_id"], "left_semi")
            postings = postings.join(current, ["link_id", "batch_id"], "left_semi")
            sources = current.withColumnRenamed("link_id", "link_id_from")
            edges = edges.join(sources, ["link_id_from", "batch_id"], "left_semi")
        return ix.IndexTables(
            links.drop("batch_id"), postings.drop("batch_id"), edges.drop("batch_id")
        )

    # Search tables

    def write_search(self, tables: ix.IndexTables, buckets: int | None = None) -> se.SearchIndex:
        """Build the search tables. Each is sorted and split by range, so a word
        on a third of all pages fills many files and tasks, not one.

        Without a number of ``buckets`` it follows the number of postings.
        """
        version = 1 + max(self._versions(), default=-1)
        target = f"{self.path}/search/v={version}"
        stats = se.corpus_stats(tables.postings, tables.edges).first()
        if buckets is None:
            buckets = min(MAX_BUCKETS, 1 + stats.pairs // POSTINGS_PER_BUCKET)

        def clustered(df: DataFrame, name: str, key: str, *then: str) -> DataFrame:
            order = ["bucket", key, *then]
            (
                df.withColumn("bucket", se.bucket_of(F.col(key), buckets))
                .repartitionByRange(*order)
                .sortWithinPartitions(*order)
                .write.mode("overwrite")
                .partitionBy("bucket")
                .parquet(f"{target}/{name}")
            )
            return self._search(name, version)

        lazy = se.search_index(tables)
        links = clustered(lazy.links, "links", "link_id")
        scored = links.select("link_id", "language", "page_length", "inlinks", "url")
        postings = clustered(
            tables.postings.join(scored, "link_id").select(
                "word", "link_id", "weight", "language", "page_length", "inlinks", "url"
            ),
            "postings",
            "word",
            "link_id",
        )
        ix.dictionary(postings).write.mode("overwrite").parquet(f"{target}/words")
        grams = clustered(match.word_grams(self._search("words", version)), "grams", "gram", "word")
        match.gram_counts(grams).write.mode("overwrite").parquet(f"{target}/gram_counts")
        self.spark.createDataFrame(
            [(stats.pairs, stats.max_inlinks, buckets)], schema.SEARCH["stats"]
        ).coalesce(1).write.mode("overwrite").parquet(f"{target}/stats")
        for old in self._versions():
            if old < version - 1:
                self._remove(f"{self.path}/search/v={old}")
        return self.search_index()

    def search_index(self) -> se.SearchIndex:
        """The newest complete version of the search tables."""
        version = self.current_version()
        if version is None:
            raise ValueError(f"no search tables under {self.path}")
        stats = self._search("stats", version).first()
        return se.SearchIndex(
            links=self._search("links", version),
            postings=self._search("postings", version),
            words=self._search("words", version),
            grams=self._search("grams", version),
            gram_counts=self._search("gram_counts", version),
            pairs=F.lit(stats.pairs),
            max_inlinks=F.lit(stats.max_inlinks),
            buckets=stats.buckets,
        )

    def current_version(self) -> int | None:
        """The newest version whose last table is complete."""
        complete = [
            v for v in self._versions() if self._exists(f"{self.path}/search/v={v}/stats/_SUCCESS")
        ]
        return max(complete, default=None)

    def _versions(self) -> list[int]:
        folder = f"{self.path}/search"
        if not self._exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files(folder).listStatus(self._place(folder))]
        return [int(n[2:]) for n in names if n.startswith("v=")]

    def _search(self, name: str, version: int) -> DataFrame:
        return self.spark.read.schema(schema.SEARCH[name]).parquet(
            f"{self.path}/search/v={version}/{name}"
        )

    def _place(self, folder: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)

    def _files(self, folder: str):
        return self._place(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, folder: str) -> bool:
        return self._files(folder).exists(self._place(folder))

    def _remove(self, folder: str) -> None:
        self._files(folder).delete(self._place(folder), True)
