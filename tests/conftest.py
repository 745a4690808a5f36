from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


#: Columns that postings do not have; their names are ones that operators use inside.
EXTRA = {"site": "x", "key": "k", "value": "v", "host": "h", "shard": 3, "n": 9, "lang": "xx", "text": "t", "term": "t", "mark": "m", "leaf": "l", "name": "n", "org": "o", "_r": 1, "start": 5}


@pytest.fixture
def postings(spark):
    """Makes a table of postings from dicts; what is not given is null. ``extra`` adds columns with clashing names."""

    def make(rows, extra: bool = False):
        names = "companyname companyurl jobtitle joblocation jobdescription joburl".split()
        schema = "jobid bigint, " + ", ".join(f"{c} string" for c in names) + ", published timestamp_ntz, seenlast timestamp_ntz, isactive boolean"
        cols = ["jobid", *names, "published", "seenlast", "isactive"]
        df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({k: F.lit(v) for k, v in EXTRA.items()})
        return df

    return make
