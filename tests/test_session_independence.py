"""Results do not depend on the session time zone or ANSI mode: a separate
process (own JVM) runs time-sensitive queries with a New York, non-ANSI
session and compares them with the oracle."""

import os
import subprocess
import sys

SCRIPT = r'''
import sys
sys.path[:0] = [{repo!r}, {repo!r} + "/tests"]
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "America/New_York").config("spark.sql.ansi.enabled", "false")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
from verify import compare, duckdb_connection
sf = "/root/testdata/sf0.001"
con = duckdb_connection(sf)
bad = []
for n in ("since_installation", "period_label", "first_date", "utc_text", "file_names", "sampling_stats"):
    r = compare(E.queries()[n](spark, sf).toPandas(), con.execute(E.oracle_sql()[n]).fetchdf())
    if not r["ok"]:
        bad.append(n)
print("BAD=" + ",".join(bad))
'''


def test_results_independent_of_session_zone_and_ansi():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], capture_output=True, text=True, timeout=900
    )
    line = [x for x in out.stdout.splitlines() if x.startswith("BAD=")]
    assert line, out.stderr[-2000:]
    assert line[0] == "BAD=", line[0]
