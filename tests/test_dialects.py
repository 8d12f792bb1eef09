from pyspark.sql import types as T

from weekmart.sinks.dialects import column_type, create_table_sql
from weekmart.sinks.jdbc import delete_period_sql


def test_type_map_case():
    # int64 -> BIGINT, text -> TEXT (PostgreSQL)
    assert column_type(T.LongType(), "postgresql") == "BIGINT"
    assert column_type(T.StringType(), "postgresql") == "TEXT"
    assert column_type(T.DoubleType(), "clickhouse") == "Float64"
    assert column_type(T.StringType(), "clickhouse") == "Nullable(String)"
    assert column_type(T.BooleanType(), "duckdb") == "BOOLEAN"


def test_clickhouse_ddl_orders_by_period():
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("year_num", T.IntegerType()),
                      T.StructField("week_num", T.IntegerType())])
    sql = create_table_sql("db.t", s, "clickhouse")
    assert "ENGINE = MergeTree() ORDER BY (`year_num`, `week_num`)" in sql
    assert "ORDER BY (tuple())" in create_table_sql("db.t", T.StructType([s.fields[0]]), "clickhouse")


def test_delete_statement_is_parameterised_and_quoted():
    assert delete_period_sql('"s"."t"', "postgresql") == \
        'DELETE FROM "s"."t" WHERE "year_num" = ? AND "week_num" = ?'


class _FakeStatement:
    def __init__(self, log, fail):
        self.log, self.fail, self.params = log, fail, {}

    def setObject(self, i, v):
        self.params[i] = v

    def addBatch(self):
        self.log.append(("batch", tuple(self.params[i] for i in sorted(self.params))))

    def executeBatch(self):
        if self.fail:
            raise RuntimeError("refused")
        self.log.append(("execute",))

    def close(self):
        self.log.append(("close-statement",))


class _FakeConnection:
    def __init__(self, log, fail):
        self.log, self.fail = log, fail

    def setAutoCommit(self, v):
        self.log.append(("autocommit", v))

    def prepareStatement(self, sql):
        self.log.append(("prepare", sql))
        return _FakeStatement(self.log, self.fail)

    def commit(self):
        self.log.append(("commit",))

    def rollback(self):
        self.log.append(("rollback",))

    def close(self):
        self.log.append(("close",))


def _sink(log, fail=False):
    from weekmart.sinks.jdbc import JdbcSink
    sink = JdbcSink.__new__(JdbcSink)
    sink._connection = lambda: (log.append(("connect",)), _FakeConnection(log, fail))[1]
    return sink


def test_period_deletes_go_in_one_batch_and_transaction():
    log = []
    _sink(log)._execute_batch("DELETE ?", [(2000, 1), (2000, 2), (2000, 3)])
    assert log.count(("connect",)) == 1
    assert [e for e in log if e[0] == "batch"] == [("batch", (2000, 1)), ("batch", (2000, 2)),
                                                   ("batch", (2000, 3))]
    assert ("autocommit", False) in log and ("commit",) in log and ("rollback",) not in log
    assert log[-1] == ("close",)


def test_failed_delete_batch_rolls_back_and_closes():
    log = []
    try:
        _sink(log, fail=True)._execute_batch("DELETE ?", [(2000, 1)])
        raise AssertionError("expected the failure to propagate")
    except RuntimeError:
        pass
    assert ("rollback",) in log and ("commit",) not in log and log[-1] == ("close",)
    empty = []
    _sink(empty)._execute_batch("DELETE ?", [])
    assert empty == []
