"""What Python workers run must load where the package is not installed."""

import subprocess
import sys

from pyspark import cloudpickle

from shelfwise.sources.pages import page_facts
from shelfwise.streaming.events import Liveness


def test_worker_code_travels_by_value(tmp_path):
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps((page_facts, Liveness(5))))
    code = (
        "import pickle; f, l = pickle.load(open('f.pkl', 'rb')); "
        "print(f('<title>a</title><p class=price>5</p>'), l.silence_ms)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "('a', '5', '') 5000", done.stderr
