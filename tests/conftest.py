from __future__ import annotations

import pytest

from quarrystone.session import session


@pytest.fixture(scope="session")
def spark():
    return session("local[4]", 4, "tests", **{"spark.driver.memory": "4g", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"})
