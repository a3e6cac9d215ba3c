"""What the tasks of a partitioned write hold and how its rows are dealt out."""

import json
import os
import pathlib
import subprocess
import sys

from pyspark.sql import functions as F

from tallyloom.sources import publish

ROOT = pathlib.Path(__file__).resolve().parent.parent

# in a session of its own, for the event log
WRITE = """
import sys
from pyspark.sql import functions as F
from tallyloom.session import build_session
from tallyloom.sources.publish import publish

root = sys.argv[1]
spark = build_session("sinks", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
    spark__eventLog__enabled="true", spark__eventLog__dir="file://" + root + "/log", spark__eventLog__compress="false",
    spark__eventLog__rolling__enabled="false")
rows = spark.range(400_000).withColumn("kind", F.col("id") % 5).repartition(4)
done = publish(rows, root + "/kinds", partition_by=["kind"], verify=False)
assert done.files == 5, done
spark.stop()
"""


def test_partitioned_publish_sorts_no_rows(tmp_path):
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", WRITE, str(tmp_path)], check=True, env=os.environ | {"PYTHONPATH": str(ROOT)}, timeout=300)
    events = [json.loads(line) for path in (tmp_path / "log").iterdir() for line in path.open()]
    ended = [e for e in events if e["Event"] == "SparkListenerTaskEnd"]
    written = [e["Task Metrics"] for e in ended if e["Task Metrics"]["Output Metrics"]["Records Written"]]
    assert sum(m["Output Metrics"]["Records Written"] for m in written) == 400_000
    # 400,000 rows that are sorted take 20 MB or more
    assert max(m["Peak Execution Memory"] for m in written) < 1_000_000


def test_more_values_than_open_files(spark, tmp_path):
    kinds = 3 * publish.OPEN_VALUES
    rows = spark.range(12_000).withColumn("kind", F.col("id") % kinds).repartition(8)
    done = publish.publish(rows, str(tmp_path / "kinds"), partition_by=["kind"])
    assert done.rows_read == 12_000
    back = spark.read.parquet(str(tmp_path / "kinds"))
    assert back.exceptAll(rows.select("id", F.col("kind").cast("int"))).isEmpty()
    assert {f.name for f in (tmp_path / "kinds").glob("kind=*")} == {f"kind={k}" for k in range(kinds)}


def test_values_go_to_tasks_of_their_own(spark, tmp_path):
    rows = spark.range(100_000).select("id", (F.col("id") % 8).alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    done = publish.publish(rows.repartition(6), str(tmp_path / "kinds"), partition_by=["kind"])
    assert (done.files, done.rows_read) == (8, 100_000)
    tasks = {f.name.split("-")[1] for f in (tmp_path / "kinds").glob("kind=*/part-*")}
    assert len(tasks) > 1
