import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from opdiag.session import build_session

    place = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        cores=8,
        **{
            "spark.sql.warehouse.dir": f"file:{place}/warehouse",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    name = "db_" + request.node.name.replace("[", "_").replace("]", "").lower()
    spark.sql(f"create database {name}")
    yield name
    spark.sql(f"drop database {name} cascade")


def rows(frame, *columns):
    """Rows as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=str)
