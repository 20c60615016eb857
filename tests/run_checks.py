"""Compare registered queries with their checks: python tests/run_checks.py [sf_dir] [name part ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as entry  # noqa: E402
from checking import compare, connect  # noqa: E402

from commonspulse.session import build_session  # noqa: E402


def main(sf_dir: str, parts: list[str]) -> int:
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if name == "pipeline" and parts != ["pipeline"]:
            continue
        if parts and not any(p in name for p in parts):
            continue
        begin = time.time()
        try:
            if name in oracles:
                problems = compare(function(spark, sf_dir), oracles[name], connection)
            else:
                problems = [] if function(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - begin:.2f}s", *[p[:1200] for p in problems],
              sep="\n     " if problems else " ", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
