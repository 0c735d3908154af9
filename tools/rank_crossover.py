"""Where the distributed rank overtakes the single-task window.

    python tools/rank_crossover.py [/root/testdata/sf0.1] [10 40]

Ranks ``lineitem`` by extended price with every row repeated k times (each
value then has k ties), for each k given; prints the best of two runs of
both forms. Nothing here is part of the library.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators.rank import global_rank, rank_window  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies_list = [int(c) for c in sys.argv[2:]] or [1, 10, 40]
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "20g"})
    base = spark.read.parquet(f"{sf_dir}/lineitem.parquet") \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    for copies in copies_list:
        df = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")) \
            .repartition(64).checkpoint()
        rows = df.count()
        for name, build in (("window", lambda: rank_window(df, "l_extendedprice", "r")),
                            ("distributed", lambda: global_rank(df, "l_extendedprice", "r"))):
            best = float("inf")
            for _ in range(2):
                start = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            print(f"rows={rows} {name} {best:.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
