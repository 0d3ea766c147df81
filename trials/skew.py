"""Times a join in which one key owns a third of the rows: ``python trials/skew.py [rows] [cores]``.

Calls are made with ``spark.range``; the plain join relies on adaptive execution, the salted one counts keys first.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from callspark.operators.skew import lookup_join  # noqa: E402
from callspark.session import local_session  # noqa: E402


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 9_000_000
    spark = local_session(sys.argv[2] if len(sys.argv) > 2 else "8", shuffle_partitions=32)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100_000)
    calls = spark.range(rows).select(key.alias("account"), F.col("id").alias("call"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    accounts = spark.range(100_000).select(F.col("id").alias("account"), (F.col("id") * 2).alias("weight"))
    for name, options in (("plain", {}), ("salted", {"rows_per_task": rows // 64})):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            begin = time.perf_counter()
            joined = lookup_join(calls, accounts, ["account"], **options)
            work = F.length(F.sha2(F.concat("note", F.col("weight").cast("string")), 512))
            joined.agg(F.sum(work)).collect()
            print(f"{name}, adaptive execution {'on' if adaptive == 'true' else 'off'}: {time.perf_counter() - begin:.1f} s", flush=True)


if __name__ == "__main__":
    main()
