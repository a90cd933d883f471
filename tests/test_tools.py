"""The helper tools: bench table rendering and event-log shuffle parsing."""

from __future__ import annotations

import json
import os
import tempfile

import zstandard

from tools.bench_table import table
from tools.shuffle_report import shuffle_by_group


def test_bench_table_renders_known_keys_and_gaps():
    out = table({"queries": {"q1_hourly_mean_pickup": 0.5, "q1_hourly_mean_pickup_csv": 0.75}})
    row = next(line for line in out.splitlines() if line.startswith("| Q1 "))
    assert "| 0.50 | 0.75 | – |" in row
    assert out.splitlines()[0].startswith("| query | Parquet | CSV | raw text |")


def test_shuffle_by_group_sums_task_writes_per_job_group():
    events = [
        {"Event": "SparkListenerJobStart", "Stage IDs": [1, 2],
         "Properties": {"spark.jobGroup.id": "q_a"}},
        {"Event": "SparkListenerJobStart", "Stage IDs": [3], "Properties": {}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 100, "Shuffle Records Written": 4}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 2, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 50, "Shuffle Records Written": 1}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 3, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 999, "Shuffle Records Written": 9}}},
    ]
    root = tempfile.mkdtemp(prefix="hackney-evlog-")
    os.makedirs(f"{root}/eventlog_v2_app")
    data = "\n".join(json.dumps(e) for e in events).encode() + b"\n"
    with open(f"{root}/eventlog_v2_app/events_1_app.zstd", "wb") as fh:
        fh.write(zstandard.ZstdCompressor().compress(data))
    assert shuffle_by_group(root) == {"q_a": (150, 5)}     # ungrouped stage 3 ignored
