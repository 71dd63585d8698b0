"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from railstream.plans.catalog import CHECKS, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def db(tiny):
    with duckdb.connect() as connection:
        for name in TABLES:
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM '{tiny}/{name}.parquet'")
        yield connection


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    def text(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return ""
        if hasattr(value, "year"):
            return str(pd.Timestamp(value))
        return str(float(value)) if isinstance(value, (int, float)) else str(value)
    return sorted(tuple(map(text, r)) for r in frame.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tiny, db, name):
    ours = driver.queries()[name](spark, tiny).toPandas()
    assert len(ours) > 0
    theirs = db.execute(driver.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize("name", ["archive_status", "archive_status_tally"])
def test_days_in_several_archives(spark, tiny, db, name):
    """Small batches split each day over several archives, as larger tables do."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100")
    try:
        ours = driver.queries()[name](spark, tiny).toPandas()
    finally:
        spark.conf.set(setting, before)
    assert rows_of(ours) == rows_of(db.execute(driver.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", ["archive_status", "archive_status_tally"])
def test_archives_of_no_events(spark, tiny, tmp_path, name):
    """The tally has its row also when there is nothing to count."""
    file = tmp_path / "events.parquet"
    with duckdb.connect() as nothing:
        nothing.execute(f"COPY (SELECT * FROM '{tiny}/events.parquet' WHERE false) TO '{file}'")
        nothing.execute(f"CREATE VIEW events AS SELECT * FROM '{file}'")
        theirs = nothing.execute(driver.oracle_sql()[name]).fetchall()
    assert [tuple(r) for r in driver.queries()[name](spark, str(tmp_path)).collect()] == theirs


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(CHECKS) and set(QUERIES) <= set(driver.queries())
    assert set(CHECKS) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize(("name", "order"), [
    ("idle_time_by_station", "avg_idle_time_m_s DESC, stop_name"),
    ("headway_by_station", "average_min_difference_between_trains DESC, stop_name"),
    ("busiest_stations_top10", "total_arrivals DESC, stop_name"),
    *((f"{split}_split_read", "trip_date, trip_uid, target_sequence")
      for split in ("train", "val", "test"))])
def test_order_of_ordered_queries(spark, tiny, db, name, order):
    ours = driver.queries()[name](spark, tiny)
    rows = ours.collect()
    inner = CHECKS[name] if "split" in name else f"SELECT * FROM ({CHECKS[name]})"
    theirs = db.execute(f"{inner} ORDER BY {order}").df()[ours.columns].astype(object)
    assert len(rows) == len(theirs)
    for mine, other in zip(rows, theirs.itertuples(index=False)):
        for a, b in zip(mine, other):
            missing = b is None or b != b
            assert (a is None) if missing else (a == pytest.approx(b) if isinstance(a, float) else a == b)
