"""Observed metrics stay exact when a task of the observed stage is retried."""

import json
import os
import subprocess
import sys


def test_observed_metrics_survive_a_task_retry():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    done = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "injected task failure" in done.stderr  # the first attempt did fail
    result = json.loads(done.stdout.strip().splitlines()[-1])
    assert result["observed"] == result["truth"]
    assert result["truth"]["total_records"] == 5000
