"""Sessions on executors that are processes of their own, under a master that is not called local."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

START = """
from stridebase.session import build_session
spark = build_session("t", "local-cluster[2,2,1024]", **{settings!r})
spark.sparkContext.master = "spark://host:7077"  # as a cluster's context would say
spark.sparkContext.setLogLevel("OFF")
"""


def run_on_cluster(place, code: str, timeout: int, **settings: str) -> subprocess.CompletedProcess:
    """Run ``code`` with a session ``spark`` of two executors. They and the driver have each a working directory of their own."""
    place = Path(place)
    home, driver = place / "home", place / "driver"
    for folder in (home / "work", driver, place / "local"):
        folder.mkdir(parents=True)
    for part in Path(pyspark.__file__).parent.iterdir():  # executors work in Spark's home
        if part.name not in ("work", "conf"):
            (home / part.name).symlink_to(part)
    given = {name.replace("_", "."): value for name, value in settings.items()}
    given |= {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "2",
        "spark.sql.codegen.wholeStage": "false",  # few rows, many plans
        "spark.sql.warehouse.dir": given.get("spark.sql.warehouse.dir", f"{driver}/spark-warehouse"),
    }
    env = os.environ | {
        "SPARK_HOME": str(home),
        "SPARK_SCALA_VERSION": "2.13",
        "SPARK_LOCAL_IP": "127.0.0.1",
        "SPARK_LOCAL_DIRS": str(place / "local"),
        "PYSPARK_PYTHON": sys.executable,
        "PYTHONPATH": os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep),
    }
    return subprocess.run(
        [sys.executable, "-c", START.format(settings=given) + code], capture_output=True, text=True, timeout=timeout, cwd=driver, env=env
    )
