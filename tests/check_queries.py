"""Compare registered queries with their SQL twins: python tests/check_queries.py [sf] [name ...]"""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    from laminae.plans import catalog
    from laminae.session import build_session
    from oracle import connect, run_pair

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(catalog.QUERIES)
    names = [n for n in catalog.QUERIES if any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in names)]
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "check",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con = connect(folder)
    failed = 0
    for name in names:
        began = time.time()
        try:
            problem = run_pair(spark, name, catalog.QUERIES[name], catalog.ORACLES.get(name), folder, con)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        kind = "" if name in catalog.ORACLES else "(rows only) "
        if problem or "-v" in os.environ.get("CHECK", ""):
            print(f"{'FAIL' if problem else 'ok  '} {name} {kind}{time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
