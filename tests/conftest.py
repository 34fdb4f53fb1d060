from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acervo.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def namespace(spark, request):
    """A fresh catalog schema per test."""
    name = "t_" + "".join(ch if ch.isalnum() else "_" for ch in request.node.name.lower())[:60]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows(df, *columns):
    """Rows as sorted tuples."""
    frame = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    return SF
