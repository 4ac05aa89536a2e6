import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from captide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "captide-tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "2",
            # Compiling a plan costs more than running it on a handful of rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
