"""Command line: ``python -m tests.run_checks [folder] [name prefix ...]``."""

import sys
import time

from flowlake.registry import ORACLES, QUERIES
from flowlake.session import build_session
from tests.compare import connect, difference


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(
        "checks", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                found = difference(df, con, ORACLES[name])
                verdict = "same" if found is None else f"DIFFERS {found[:600]}"
            else:
                verdict = f"{len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            found = verdict = f"FAILED {type(error).__name__}: {str(error)[:700]}"
        bad += verdict.startswith(("DIFFERS", "FAILED"))
        print(f"{name:34s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
