"""Run the flagship packing with failures injected into first task attempts; print whether the
result equals a run without failures. Started in its own process (task retries need a
`local[N,F]` master)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from corpusprep.plans.pretrain import pretrain_blocks  # noqa: E402


@F.udf(BooleanType())
def fail_first_attempt(_x):
    tc = TaskContext.get()
    if tc is not None and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def blocks(df):
    return sorted((r.split, r.batch_id, r.block_no, tuple(r.input_ids)) for r in df.collect())


def main():
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from corpusprep.operators.batching import collate_batches
    from corpusprep.functions.tokens import codepoint_ids
    docs = spark.read.parquet(sys.argv[1]).select("doc_id", "text")
    flaky_scan = docs.where(fail_first_attempt(F.col("doc_id")))           # fails in the map stage
    results = []
    for strategy in ("two_shuffle", "one_shuffle"):
        clean = blocks(pretrain_blocks(docs, ["doc_id"], block_size=256, rows_per_batch=20, strategy=strategy))
        packed = pretrain_blocks(flaky_scan, ["doc_id"], block_size=256, rows_per_batch=20, strategy=strategy)
        flaky_out = packed.where(fail_first_attempt(F.col("block_no")))    # fails after the shuffles
        results.append(blocks(flaky_out) == clean and bool(clean))

    def collated(frame):
        ex = frame.select("doc_id", codepoint_ids("text").alias("input_ids"))
        return sorted((r.batch_no, r.pos, tuple(r.input_ids))
                      for r in collate_batches(ex, 8, 42, "doc_id", on_ragged="pad").collect())
    results.append(collated(flaky_scan) == collated(docs))

    from corpusprep.operators.runlog import completed_steps
    from corpusprep.plans.derived import train_log
    events = spark.read.parquet(sys.argv[1].replace("documents.parquet", "events.parquet"))

    def steps(frame):
        return sorted(tuple(r) for r in completed_steps(train_log(frame)).collect())
    results.append(steps(events.where(fail_first_attempt(F.col("event_id")))) == steps(events))
    print("EQUAL" if all(results) else f"DIFFERENT {results}")


if __name__ == "__main__":
    main()
