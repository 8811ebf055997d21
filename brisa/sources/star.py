"""Co-bucketed star tables: facts and dimensions that meet without a shuffle.

A fact that joins two dimensions is kept once by each key.  Every copy, and the
dimension it meets, is written in the same number of buckets by that key, sorted
in the bucket; Spark's bucketed scan then feeds a sort-merge join directly, with
no exchange on either side and, for aggregations by the key, none after it.
The buckets are written once per load and pay back in each of the joins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from brisa.session import scratch_path


@dataclass
class Star:
    """Bucketed tables by name; ``drop`` takes them out of the catalogue."""

    spark: SparkSession
    buckets: int
    tables: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, df: DataFrame, key: str, folder: str | None = None) -> Star:
        """Write ``df`` in buckets of ``key``, as the table ``name``.

        The rows are dealt by the key before the write, so each bucket is one file, whatever the number
        of tasks that made the rows.
        """
        table = f"star_{name}_{uuid.uuid4().hex[:12]}"
        (df.repartition(self.buckets, key).write.format("parquet").option("path", folder or scratch_path(self.spark, table))
           .bucketBy(self.buckets, key).sortBy(key).mode("overwrite").saveAsTable(table))
        self.tables[name] = table
        return self

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])

    def meet(self, left: str, right: str, key: str, how: str = "inner", columns: tuple[str, ...] | None = None) -> DataFrame:
        """Two tables joined on the key they are bucketed by; ``columns`` of the right one besides the key."""
        other = self[right]
        if columns is not None:
            other = other.select(key, *columns)
        return self[left].join(other.hint("merge"), key, how)

    def drop(self) -> None:
        """Forget the tables; the files stay in their folders."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()


#: Rows of the largest fact that a bucket holds, about: a task sorts one bucket.
BUCKET_ROWS = 1 << 20


def star(spark: SparkSession, buckets: int | None = None, rows: int = 0) -> Star:
    """An empty star; buckets default to the shuffle partitions, so bucketed and shuffled sides fit together.

    With ``rows``, the number of rows of its largest table, there are as many more buckets as keep each small.
    """
    least = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Star(spark, max(least, -(-rows // BUCKET_ROWS)))


def review_star(spark: SparkSession, reviews: DataFrame, business: DataFrame, users: DataFrame, buckets: int | None = None) -> Star:
    """The review star: ``reviews_by_business`` with ``business``, ``reviews_by_user`` with ``users``."""
    return (star(spark, buckets).add("reviews_by_business", reviews, "business_id").add("business", business, "business_id")
            .add("reviews_by_user", reviews, "user_id").add("users", users, "user_id"))
