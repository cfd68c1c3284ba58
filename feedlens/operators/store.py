"""A table of paid answers and a ledger of what they cost, both safe to resume.

Answers lie in folders ``prefix=<first hex digits of the request id>/batch=<name>``.  A lookup for some requests reads only the
folders of their prefixes.  A batch is written with dynamic partition overwrite: it is committed when its job
ends, and writing it again replaces it.

The ledger has one folder per batch with one row, its total, taken from the answers stored under the batch's name; it
is written after the answers.  So a run that was killed at any point can be started again: answers that were stored
are found and not paid for again, a batch whose total is missing gets it from the stored answers, and no batch is
counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_DIGITS = 3
TOTALS = "batch string, n long, input_tokens long, output_tokens long"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class CompletionStore:
    """Answers and ledger under ``path``, on any file system that Spark writes."""

    def __init__(self, spark: SparkSession, path: str, digits: int = PREFIX_DIGITS):
        self.spark, self.digits = spark, digits
        self.answers_path, self.ledger_path = f"{path.rstrip('/')}/answers", f"{path.rstrip('/')}/ledger"

    def _prefix(self):
        return F.substring("request_id", 1, self.digits)

    def answers(self) -> DataFrame:
        """Every stored answer, one row per request id."""
        from feedlens.operators.completion import COMPLETION_SCHEMA
        if not _exists(self.spark, self.answers_path):
            return self.spark.createDataFrame([], T.StructType([*COMPLETION_SCHEMA, T.StructField("prefix", T.StringType()),
                                                                T.StructField("batch", T.StringType())]))
        schema = T.StructType([*COMPLETION_SCHEMA, T.StructField("prefix", T.StringType()), T.StructField("batch", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.answers_path)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """The stored answers of ``requests``; only folders of their prefixes are read (at most 16 ** digits names)."""
        names = [r[0] for r in requests.select(self._prefix().alias("p")).distinct().collect()]
        found = self.answers().where(F.col("prefix").isin(names)).join(requests.select("request_id").distinct(), "request_id", "left_semi")
        return found.drop("prefix", "batch").dropDuplicates(["request_id"])

    def pending(self, requests: DataFrame) -> DataFrame:
        """The requests that have no stored answer."""
        return requests.join(self.lookup(requests).select("request_id"), "request_id", "left_anti")

    def add(self, batch: str, answers: DataFrame) -> None:
        """Store the answers of a batch; the same batch again replaces what it wrote in the same folders.

        The answers of a prefix meet in one task, so a batch has one file per prefix, whatever the number of tasks.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # named, as files take time however little they hold
        (answers.withColumn("prefix", self._prefix()).repartition(tasks, "prefix").withColumn("batch", F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("prefix", "batch").parquet(self.answers_path))

    def close(self, batch: str) -> tuple[int, int]:
        """Write the batch's total to the ledger, once; returns its tokens."""
        n, tin, tout = self.answers().where(F.col("batch") == batch).agg(
            F.count("*"), F.coalesce(F.sum("input_tokens"), F.lit(0)), F.coalesce(F.sum("output_tokens"), F.lit(0))).first()
        row = self.spark.createDataFrame([(batch, n, tin, tout)], TOTALS).coalesce(1)
        row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.ledger_path)
        return tin, tout

    def ledger(self) -> DataFrame:
        """(batch, n, input_tokens, output_tokens): one row per closed batch."""
        if not _exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(self.ledger_path).select("batch", "n", "input_tokens", "output_tokens")
