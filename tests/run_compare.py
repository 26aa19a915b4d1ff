"""Command line: python tests/run_compare.py FOLDER [key prefix ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from plantline.session import build_session  # noqa: E402
from tests.compare import differences, open_duck  # noqa: E402

folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
spark = build_session("compare", "local[8]", **{
    "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
})
spark.sparkContext.setLogLevel("ERROR")
duck = open_duck(folder)
oracles = oracle_sql()
bad = 0
for key, query in queries().items():
    if prefixes and not key.startswith(prefixes):
        continue
    began = time.time()
    try:
        got = query(spark, folder).toPandas()
        spent = time.time() - began
        if key not in oracles:
            print(f"rows  {key} {len(got)} {spent:.1f}s", flush=True)
            continue
        issues = differences(got, duck.execute(oracles[key]).df())
    except Exception as problem:  # noqa: BLE001
        issues, spent, got = [f"{type(problem).__name__}: {str(problem)[:1500]}"], time.time() - began, ()
    bad += bool(issues)
    print(f"{'FAIL' if issues else 'ok'}  {key} rows={len(got)} {spent:.1f}s", *issues, sep="\n      " if issues else " ", flush=True)
print("failed:", bad)
