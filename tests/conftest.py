import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from memberlens.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ml-test-ckpt-")})
    yield s
    s.stop()


# The reference's 6-unit x 3-season panel (members, leak_rate).
FIXTURE_PANEL = {
    1: [(2023, 45, 0.0), (2024, 25, 44.44), (2025, 12, 52.0)],
    2: [(2023, 40, 0.0), (2024, 18, 55.0), (2025, 25, 0.0)],
    3: [(2023, 24, 0.0), (2024, 16, 33.33), (2025, 12, 25.0)],
    4: [(2023, 34, 0.0), (2024, 18, 47.06), (2025, 20, 0.0)],
    5: [(2023, 12, 0.0), (2024, 10, 16.67), (2025, 8, 20.0)],
    6: [(2023, 8, 0.0), (2024, 10, 0.0), (2025, 6, 40.0)],
}


@pytest.fixture(scope="session")
def fixture_panel(spark):
    rows = []
    for unit, series in FIXTURE_PANEL.items():
        prev = 0
        for period, members, leak in series:
            rows.append((unit, period, members, prev, leak))
            prev = members
    return spark.createDataFrame(rows, "unit int, period int, members bigint, members_prev bigint, leak_rate double")
