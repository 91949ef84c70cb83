from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabletally.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, shuffle_partitions=8, checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


def write_table(spark, root: str, name: str, rows: list[tuple], ddl: str, files: int = 2) -> str:
    path = os.path.join(root, name)
    spark.createDataFrame(rows, ddl).repartition(files).write.mode("overwrite").parquet(path)
    return path
