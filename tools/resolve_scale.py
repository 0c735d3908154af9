"""Grouped against shuffle-free code resolution at growing size.

    python tools/resolve_scale.py [/root/testdata/sf0.1] [1 10]

Repeats every order k times with unique ids (each k given), derives the raw
catalogue rows and times both resolution forms (best of two). Nothing here
is part of the library.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators import resolve_codes, resolve_codes_by_position  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources import DriverTables  # noqa: E402
from strata.sources.fixtures import raw_catalog  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies_list = [int(c) for c in sys.argv[2:]] or [1, 10]
    spark = build_session("local[8]", 16, extra={"spark.driver.memory": "20g"})
    t = DriverTables(spark, sf_dir)
    codes = t.code_dictionary()
    for copies in copies_list:
        orders = t.orders.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c")) \
            .withColumn("o_orderkey", F.col("o_orderkey") * copies + F.col("_c")).drop("_c")
        raw = raw_catalog(orders).repartition(32).checkpoint()
        rows = raw.count()
        for name, resolve in (("grouped", resolve_codes), ("by_position", resolve_codes_by_position)):
            best = float("inf")
            for _ in range(2):
                start = time.perf_counter()
                resolve(raw, codes).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            print(f"rows={rows} {name} {best:.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
