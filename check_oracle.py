"""Compare every query with its SQL: ``python check_oracle.py [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import tempfile
import time

from catchframe import get_session
from catchframe.checks.compare import compare
from catchframe.checks.oracle import ORACLE
from catchframe.checks.queries import QUERIES


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session(
        "check", master="local[8]",
        **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, sf, QUERIES[name], ORACLE.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None and not problem.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
