"""Where intermediate tables may go."""

import pytest

from harvestline import session


@pytest.mark.parametrize(
    "master, alone",
    [
        ("local", True),
        ("local[8]", True),
        ("local[*]", True),
        ("local-cluster[3,2,1024]", False),
        ("yarn", False),
        ("spark://host:7077", False),
    ],
)
def test_only_a_local_master_is_one_process(master, alone):
    assert session.one_process(master) is alone


def test_every_scratch_path_is_another_one(spark):
    root = spark.conf.get(session.CHECKPOINT_CONF).rstrip("/")
    first, second = (session.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(f"{root}/x-")
