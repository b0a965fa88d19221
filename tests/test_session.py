import os
import subprocess
import sys
import time

from millrace.session import scratch_dir


def test_scratch_paths_are_fresh(spark):
    one, two = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert one != two
    assert os.path.dirname(one) == os.path.dirname(two)
    assert not os.path.exists(one)


def test_scratch_goes_when_the_driver_ends(tmp_path):
    code = f"""
from millrace.session import build_session, scratch_dir
spark = build_session("scratch", "local[1]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}}})
path = scratch_dir(spark, "kept")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
    # the JVM cleans up while it ends, a little after Python
    for _ in range(100):
        if not list((tmp_path / "millrace").iterdir()):
            return
        time.sleep(0.2)
    raise AssertionError(list((tmp_path / "millrace").iterdir()))
