"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheafworks.plans import catalog  # noqa: E402
from sheafworks.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = build_session(
        f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first scan starts the session and the file listing; it is not part of any query.
    spark.read.parquet(f"{folder}/documents.parquet").count()
    times: dict[str, float] = {}
    for name, query in catalog.queries().items():
        if only and name not in only:
            continue
        began = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
