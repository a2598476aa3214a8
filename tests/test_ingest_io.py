"""What an ingest run reads: each landed byte once, counted from the tasks' own metrics."""

import glob
import gzip
import json
import os
import subprocess
import sys
import tempfile

from conftest import ROOT, booking_row

from ridemart.sources import files
from ridemart.sources.schemas import BOOKING_RAW_COLUMNS

RUN = """
import sys
sys.path.insert(0, {root!r})
from ridemart.session import get_spark
from ridemart.streaming import ingest
from ridemart.sources.schemas import BOOKING_RAW_COLUMNS
spark = get_spark(master="local[2]", shuffle_partitions=2, extra_conf={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false"}})
for want in {want!r}:
    got = ingest.ingest_available(ingest.bronze_stream(spark, {land!r}, BOOKING_RAW_COLUMNS), {out!r}, {ckpt!r})
    assert got == want, (got, want)
spark.stop()
"""


def _land(path, name, columns, n, first=0):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(",".join(columns) + "\n")
        for i in range(n):
            row = dict(zip(BOOKING_RAW_COLUMNS, booking_row(**{"Booking ID": f"B{first + i}"})))
            f.write(",".join(str(row.get(c, "note")) for c in columns) + "\n")


def test_an_ingest_run_reads_each_landed_byte_once(spark):
    d = tempfile.mkdtemp(prefix="ridemart-test-", dir="/tmp")
    os.makedirs(f"{d}/log")
    _land(f"{d}/land", "a.csv", BOOKING_RAW_COLUMNS, 20_000)
    _land(f"{d}/land", "b.csv", [*reversed(BOOKING_RAW_COLUMNS), "Driver Notes"], 15_000, 20_000)
    landed = sum(os.path.getsize(f) for f in glob.glob(f"{d}/land/*.csv"))
    code = RUN.format(root=ROOT, log=f"file://{d}/log", land=f"{d}/land", out=f"{d}/bronze", ckpt=f"{d}/ckpt", want=[35_000, 0])
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    read = 0
    for log in glob.glob(f"{d}/log/*"):
        for line in open(log):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event.get("Task Metrics", {}).get("Input Metrics", {}).get("Bytes Read", 0)
    assert landed <= read <= 1.02 * landed, (read, landed)
    assert spark.read.parquet(f"{d}/bronze").count() == 35_000


def test_headers_come_from_file_starts(spark):
    d = tempfile.mkdtemp(prefix="ridemart test-", dir="/tmp")  # a space in the path
    _land(d, "a.csv", BOOKING_RAW_COLUMNS, 3)
    _land(d, "b%20.csv", ["x", "y"], 2)
    open(f"{d}/empty.csv", "w").close()
    with gzip.open(f"{d}/c.csv.gz", "wt") as f:
        f.write(open(f"{d}/a.csv").read())
    found = files.file_headers(spark, files.landed_files(spark, d))
    names = {h: sorted(os.path.basename(f) for f in fs) for h, fs in found.items()}
    assert names == {",".join(BOOKING_RAW_COLUMNS): ["a.csv", "c.csv.gz"], "x,y": ["b%20.csv"]}
    assert [os.path.basename(f) for f in files.landed_files(spark, d, "*.gz")] == ["c.csv.gz"]
    out = tempfile.mkdtemp(prefix="ridemart-test-", dir="/tmp")
    files.overwrite(files.read_csv(spark, d, BOOKING_RAW_COLUMNS), out)
    good, bad = files.split_malformed(spark.read.parquet(out))
    assert good.count() == 6 and bad.count() == 2


def test_a_listing_prunes_the_content(spark):
    d = tempfile.mkdtemp(prefix="ridemart-test-", dir="/tmp")
    _land(d, "a.csv", BOOKING_RAW_COLUMNS, 3)
    plan = spark.read.format("binaryFile").load(d).select("_metadata.file_path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
