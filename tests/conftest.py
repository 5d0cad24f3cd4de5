import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from framelake.session import build, share_code  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    s = build(4, "4g", 4, **{"spark.checkpoint.dir": f"file://{folder}/checkpoints", "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    share_code(s)
    yield s
    s.stop()
