import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("canopy-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from canopy.session import ensure_checkpoint_dir
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="canopy-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def have_data():
    if not os.path.exists(SF0001):
        pytest.skip("test tables not present")
    return True
