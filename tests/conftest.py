import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="warcloom-"))
        # Columns are built faster without recording where in Python they come from.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scan(spark, tmp_path):
    """Write files and read them as records, in file and record order."""
    import warcloom as w

    def run(files, profile="commoncrawl", **options):
        if isinstance(files, bytes):
            files = {"a.warc": files}
        for name, data in files.items():
            (tmp_path / name).write_bytes(data)
        rows = w.read_warc(spark, str(tmp_path), profile, **options)
        return rows.orderBy("source_file", "record_seq").collect()

    return run
