import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("starweave-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: give the staging helpers a folder when the session names none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starweave-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the checkpoint root for table tests."""
    import uuid
    from starweave.sources.tables import checkpoint_root
    return f"{checkpoint_root(spark)}/test-{uuid.uuid4().hex}"
