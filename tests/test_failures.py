"""Queries give identical results when a task dies and is retried."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile


def test_results_survive_a_failed_task():
    script = os.path.join(os.path.dirname(__file__), "failure_run.py")
    scratch = tempfile.mkdtemp(prefix="hackney-fail-")
    out = subprocess.run([sys.executable, script, scratch], capture_output=True, text=True,
                         timeout=600)
    assert out.stdout.strip().endswith("OK"), out.stdout[-2000:] + out.stderr[-2000:]
