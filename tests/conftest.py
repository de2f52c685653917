import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from polysift.session import local_session  # noqa: E402


from pyspark import cloudpickle  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def ship_helpers(request):
    """Helpers of test modules reach the Python workers by value."""
    cloudpickle.register_pickle_by_value(request.module)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, 4, **{
            "spark.sql.codegen.wholeStage": "false",  # most of a small query is compiling it
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        }
    )
    yield session
    session.stop()
