"""The JDBC load's statements, on a store that only remembers what it was told."""

import pytest
from pyspark.sql import types as T

from weekmart.sinks.jdbc import JdbcSink

TARGET = T.StructType([T.StructField("Name", T.StringType(), False), T.StructField("qty", T.LongType()),
                       T.StructField("year_num", T.LongType()), T.StructField("week_num", T.LongType())])


class Result:
    def __init__(self, rows):
        self.rows, self.at = rows, -1

    def next(self):
        self.at += 1
        return self.at < len(self.rows)

    def getMetaData(self):
        return self

    def getColumnCount(self):
        return len(self.rows[0])

    def getLong(self, i):
        return self.rows[self.at][i - 1]


class Store:
    """A connection: logs statements, answers counts and periods, fails where told."""

    def __init__(self, count, periods=(), fail=None):
        self.log, self.count, self.periods, self.fail = [], count, list(periods), fail

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def prepareStatement(self, sql):
        self.sql = sql
        return self

    def execute(self):
        if self.fail and self.fail in self.sql:
            raise RuntimeError("refused")
        self.log.append(self.sql)

    def executeQuery(self):
        return Result([(self.count,)] if "COUNT" in self.sql else self.periods)

    def close(self):
        pass


def loaded(spark, store, dialect="postgresql", sent=2):
    sink = JdbcSink(spark, "jdbc:none", "mart.t", dialect)
    got = []
    sink._connection = lambda: store
    sink._schema = TARGET
    sink.setup = lambda df: None
    sink._write_rows = lambda df, table: (got.append((df.schema, [tuple(r) for r in df.collect()], table)), sent)[1]
    frame = spark.createDataFrame([(None, "7", 2000, 1), ("b", "x", 2000, 2)],
                                  "NAME string, Qty string, year_num int, week_num int")
    return sink, frame, got


def test_periods_are_replaced_in_one_transaction(spark):
    store = Store(2)
    sink, frame, got = loaded(spark, store)
    assert sink.upsert(frame) == 2
    schema, rows, staging = got[0]
    assert schema.fieldNames() == ["Name", "qty", "year_num", "week_num"]
    assert sorted(rows) == [("", 7, 2000, 1), ("b", None, 2000, 2)]      # the target's types and nulls
    assert staging.startswith("mart.t__stage_")
    create, auto, delete, insert, commit, drop = store.log
    assert create.startswith(f"CREATE TABLE IF NOT EXISTS {staging}") and '"qty" BIGINT' in create
    assert auto == "autocommit False" and commit == "commit" and drop == f"DROP TABLE {staging}"
    assert delete == (f'DELETE FROM mart.t WHERE EXISTS (SELECT 1 FROM {staging} s WHERE '
                      's."year_num" = mart.t."year_num" AND s."week_num" = mart.t."week_num")')
    assert insert == (f'INSERT INTO mart.t ("Name", "qty", "year_num", "week_num") '
                      f'SELECT "Name", "qty", "year_num", "week_num" FROM {staging}')


@pytest.mark.parametrize("fail", ["DELETE", "INSERT"])
def test_a_failed_load_is_undone_and_the_staging_table_goes(spark, fail):
    store = Store(2, fail=fail)
    sink, frame, got = loaded(spark, store)
    with pytest.raises(RuntimeError, match="refused"):
        sink.upsert(frame)
    assert "rollback" in store.log and "commit" not in store.log
    assert store.log[-1] == f"DROP TABLE {got[0][2]}"


def test_rows_staged_twice_never_reach_the_target(spark):
    store = Store(3)
    sink, frame, _ = loaded(spark, store)
    with pytest.raises(RuntimeError, match="holds 3 rows, but 2 were sent"):
        sink.upsert(frame)
    assert not [x for x in store.log if x.startswith(("DELETE", "INSERT"))] and store.log[-1].startswith("DROP")


def test_a_failed_write_never_reaches_the_target(spark):
    store = Store(2)
    sink, frame, _ = loaded(spark, store)

    def lost(df, table):
        raise ConnectionError("gone")

    sink._write_rows = lost
    with pytest.raises(ConnectionError):
        sink.upsert(frame)
    assert [x.split()[0] for x in store.log] == ["CREATE", "DROP"]


def test_a_store_without_transactions_goes_week_by_week(spark):
    store = Store(2, [(2000, 1), (2000, 2)])
    sink, frame, got = loaded(spark, store, "clickhouse")
    sink.upsert(frame)
    verbs = [x.split()[0] for x in store.log]
    assert verbs == ["CREATE", "autocommit", "DELETE", "INSERT", "autocommit", "DELETE", "INSERT", "DROP"]
    assert "WHERE `year_num` = 2000 AND `week_num` = 1" in store.log[2] and "`week_num` = 1" in store.log[3]
    failing = Store(2, [(2000, 1), (2000, 2)], fail=f"`week_num` = 2")
    sink, frame, _ = loaded(spark, failing, "clickhouse")
    with pytest.raises(RuntimeError):
        sink.upsert(frame)
    assert [x.split()[0] for x in failing.log] == ["CREATE", "autocommit", "DELETE", "INSERT", "autocommit", "DROP"]


def test_insert_adds_without_deleting(spark):
    store = Store(2)
    sink, frame, _ = loaded(spark, store)
    assert sink.insert(frame) == 2
    assert not [x for x in store.log if x.startswith("DELETE")]
