import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))  # legacy.py


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session

    s = build_session("local[*]", conf={"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
