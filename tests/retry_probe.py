"""Run by test_task_retries: every task's first attempt dies mid-way; the
retried tasks must leave exactly the right files and outcome rows."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tributary.operators import fetch as B7  # noqa: E402
from tributary.sources import messages as C  # noqa: E402


def main(out: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]")  # up to 3 attempts per task
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.range(200).select(F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("n"),
                                   F.encode(F.col("id").cast("string"), "UTF-8").alias("c"))

    def dies_once(batches):
        ctx = TaskContext.get()
        for i, pdf in enumerate(batches):
            yield pdf
            if ctx.attemptNumber() == 0 and i == 0:
                raise RuntimeError("executor lost")

    flaky_rows = rows.repartition(4).mapInPandas(dies_once, rows.schema)
    n, _ = C.write_files(flaky_rows, out + "/files", "n", "c")

    def fetcher(url):
        return 200, "OK", url.encode()

    manifest = spark.range(100).select(F.col("id").cast("string").alias("url"),
                                       F.concat(F.lit(out + "/dl/"), F.col("id").cast("string")).alias("t"))
    res = B7.fetch_to_folder(manifest.repartition(4).mapInPandas(dies_once, manifest.schema),
                             fetcher, "url", "t").agg(F.count(F.lit(1)), F.sum("length")).first()
    files = sorted(os.listdir(out + "/files"))
    print(n, len(files), res[0], res[1], len(os.listdir(out + "/dl")))


if __name__ == "__main__":
    main(sys.argv[1])
