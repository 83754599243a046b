import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers


@pytest.fixture(scope="session")
def spark():
    from loomlake.session import session

    more = {"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false", "spark__driver__memory": "6g"}
    found = session("local[4]", **more)
    found.sparkContext.setLogLevel("ERROR")
    return found
