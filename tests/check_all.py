"""python tests/check_all.py [folder] [names...]: every query against its twin."""

import sys
import time

sys.path[:0] = [".", "tests"]

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from compare import compare, connect

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(entry.queries())
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "12g")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con, sqls, bad = connect(folder), entry.oracle_sql(), []
for name in names:
    start = time.time()
    try:
        frame = entry.queries()[name](spark, folder)
        if name in sqls:
            problem = compare(frame, con, sqls[name])
        else:
            problem = None if frame.count() >= 0 else "no rows"
    except Exception as error:  # report and go on
        problem = f"{type(error).__name__}: {str(error)[:700]}"
    print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    if problem:
        bad.append(name)
print(len(names), "queries,", len(bad), "bad:", bad)
