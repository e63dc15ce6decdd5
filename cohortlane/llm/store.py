"""Tables that an operator writes between its steps.

They lie below the folder that the session names in spark.checkpoint.dir, or below the warehouse
where that is unset: both are shared by all executors, so a lost executor costs nothing that is
written. Nothing is kept in a machine-local folder.
"""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_llm_steps"


#: What Python workers get at once. Spark's default of 64 MB, held as Arrow data, as Python texts and as
#: result by several workers, is much of a small executor's memory.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table to run an operator on, with the session's Arrow batches bounded by BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Steps:
    """Tables of one run of an operator, in a folder of its own; drop() removes one no longer read."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{operator}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it again: later steps start from the files."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class Shared:
    """A value that every task gets through a broadcast, with the code of its class."""

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._here: list = []

    def __getstate__(self) -> dict:
        return {"_sent": self._sent, "_here": []}

    @property
    def value(self):
        if not self._here:
            self._here.append(pickle.loads(self._sent.value))
        return self._here[0]
