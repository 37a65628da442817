import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from quayside.session import configure, shared_dir
    configure(session)
    shared_dir(session)  # sets a checkpoint folder only when none is configured
    yield session


@pytest.fixture
def landing(tmp_path):
    """Write landing documents: landing({"20240101/a.json": obj_or_text, ...}) -> root."""
    root = tmp_path / "landing"

    def write(files, dataset="feed"):
        for rel, content in files.items():
            p = root / dataset / rel
            p.parent.mkdir(parents=True, exist_ok=True)
            if isinstance(content, (dict, list)):
                content = json.dumps(content, indent=2)
            if content is None:
                p.mkdir(parents=True, exist_ok=True)
            else:
                p.write_text(content)
        return str(root)

    return write
