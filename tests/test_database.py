"""The relational sink with stand-in connections: no database is started."""

import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from tallymark.sources import database as db


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Failure(Exception):
    def __init__(self, sqlstate):
        self.sqlstate = sqlstate


class Connection:
    """Records statements; fails the first ``failures`` attempts."""

    log: list = []
    failures: list = []
    applied: set = set()

    def cursor(self):
        return self

    def execute(self, statement, values):
        self.log.append((statement.split()[0], statement, values))
        self.rowcount = 1
        if "_applied" in statement:
            self.rowcount = int(values not in self.applied)
            self.applied.add(values)

    def executemany(self, statement, rows):
        if self.failures:
            raise Failure(self.failures.pop(0))
        self.log.append(("STAGE", statement, rows))

    def commit(self):
        self.log.append(("COMMIT",))

    def rollback(self):
        self.log.append(("ROLLBACK",))

    def close(self):
        self.log.append(("CLOSE",))


@pytest.fixture
def connection(monkeypatch):
    monkeypatch.setattr(Connection, "log", [])
    monkeypatch.setattr(Connection, "failures", [])
    monkeypatch.setattr(Connection, "applied", set())
    return Connection


@pytest.mark.parametrize("code, want", [("40001", True), ("40P01", True), ("57P01", True), ("53300", True), ("08006", True), ("23505", False), (None, False)])
def test_retriable_codes(code, want):
    assert db.is_retriable(Failure(code)) is want


def test_retry_schedule():
    waits, attempts = [], []

    def attempt():
        attempts.append(1)
        raise Failure("40001")

    with pytest.raises(Failure):
        db.with_retries(attempt, sleep=waits.append)
    assert waits == [1, 3, 5] and len(attempts) == 4
    attempts.clear()
    with pytest.raises(ZeroDivisionError):
        db.with_retries(lambda: attempts.append(1) or 1 / 0, sleep=waits.append)
    assert len(attempts) == 1
    assert db.with_retries(lambda: 7, sleep=waits.append) == 7


def test_staging_writes_chunks_and_repeats_lost_ones(connection, monkeypatch):
    connection.failures = ["40001"]
    rows = [SimpleNamespace(id=f"i{n}", name=f"n{n}", type="counter", value=None, delta=n) for n in range(2500)]
    slept, retry = [], db.with_retries
    monkeypatch.setattr(db, "with_retries", lambda attempt: retry(attempt, sleep=slept.append))
    db.stage_rows(iter(rows), connection, "metric", 4, "%s")
    staged = [e for e in connection.log if e[0] == "STAGE"]
    assert [len(e[2]) for e in staged] == [1000, 1000, 500] and slept == [1]
    assert staged[0][2][1] == (4, "i1", "n1", "counter", None, 1)
    assert "DO NOTHING" in staged[0][1] and [e[0] for e in connection.log[:2]] == ["ROLLBACK", "CLOSE"]


def test_an_epoch_is_merged_once(spark, connection):
    none = spark.createDataFrame([], "id string, type string, name string, value double, delta bigint")
    for _ in range(2):
        db.upsert_table(none, connection, 3)
    merges = [e for e in connection.log if e[1:] and "SELECT" in e[1]]
    assert len(merges) == 1 and "metric.counter_value + EXCLUDED.counter_value" in merges[0][1]
    assert connection.log.count(("COMMIT",)) == 2
    assert "= EXCLUDED.counter_value" in db.merge_statement("metric", "%s", add_counters=False)
