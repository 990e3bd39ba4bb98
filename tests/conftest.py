from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.model import MOVEMENTS, Cut  # noqa: E402
from tidemark.operators import keys, normalize  # noqa: E402
from tidemark.session import local_session  # noqa: E402

T = Cut("T", "t", date(2024, 11, 1))
T1 = Cut("T1", "t1", date(2024, 11, 2))
T2 = Cut("T2", "t2", date(2024, 11, 3))
T3 = Cut("T3", "t3", date(2024, 11, 5))
CUTS = [T, T1, T2, T3]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def row(client="C1", day="2024-01-01", product="ETF", kind="entrada", fund="F1",
        amount=100.0, description="d", name="n"):
    return (client, day, product, kind, fund, amount, description, name)


def raw(spark, rows, cut=T):
    """Landed rows of one cut."""
    numbered = [(*r, n) for n, r in enumerate(rows, start=1)]
    schema = MOVEMENTS.source.simpleString()[7:-1].replace(":", " ") + ", _row_num bigint"
    return spark.createDataFrame(numbered, schema).select(
        *MOVEMENTS.source_columns, F.lit("f.parquet").alias("_source_file"),
        F.lit(cut.label).alias("_cut_label"), F.lit(cut.cut_date).alias("_cut_date"),
        "_row_num", F.current_timestamp().alias("_load_ts"))


def normalized(spark, rows, cut=T):
    return normalize.normalize(raw(spark, rows, cut), MOVEMENTS)


def valid(spark, rows, cut=T):
    return normalize.split(normalized(spark, rows, cut), MOVEMENTS)[0]


def staged(spark, rows, cut=T, **options):
    return keys.assign_keys(valid(spark, rows, cut), MOVEMENTS, **options)


def write_cut(spark, folder, rows, cut):
    """The cut as a source would deliver it; returns the cut pointing at the file."""
    path = f"{folder}/{cut.label}-{len(rows)}-{abs(hash(tuple(rows)))}.parquet"
    raw(spark, rows, cut).select(*MOVEMENTS.source_columns).coalesce(1).write.mode(
        "overwrite").parquet(path)
    return Cut(cut.label, path, cut.cut_date)


def compared(df):
    """Rows of a history without what differs from run to run."""
    cols = sorted(c for c in df.columns if c not in ("load_ts", "source_file", "version_id",
                                                     "opened", "part"))
    return sorted(map(str, df.select(*cols).collect()))
