"""Delivery of period data to a store that accepts Parquet uploads.

A Python Data Source writer: tasks receive rows clustered and sorted by period,
stream them into Parquet payloads of bounded size, one period each, and hand the
payloads to a transport with retries -- network errors, 5xx and 429 are sent
again after 1 s, 2 s, ...; any other 4xx fails at once.

A delivery replaces the periods it holds, in two phases.  Payloads are first stored
where the target does not show them, each attempt under a token of its own.  The
tasks that Spark accepts report the tokens that were acknowledged, and the driver's
commit makes just these the periods' content: an attempt whose answer was lost, or
a task that ran twice, leaves payloads that nothing names.  The commit may be sent
again, as it gives the same result each time.
"""

from __future__ import annotations

import base64
import io
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from weekmart.functions.values import DATE_TEXT_PATTERN
from weekmart.sinks.dialects import column_ddl, column_type, quote

# Attempts per payload and the status codes worth retrying.
RETRIES = 3
RETRY_STATUS = {429}  # plus every 5xx
PAYLOAD_BYTES = 64 << 20  # Arrow bytes after which a payload is closed


def _filesystem(location: str):
    """(pyarrow filesystem, path) for a local path, file: URI or remote URI."""
    from pyarrow import fs as pafs
    if "://" in location:
        return pafs.FileSystem.from_uri(location)
    return pafs.LocalFileSystem(), location.removeprefix("file:")


class TransportError(Exception):
    def __init__(self, status: int | None, message: str):
        super().__init__(f"HTTP {status}: {message}" if status else message)
        self.status = status


def retryable(e: Exception) -> bool:
    if isinstance(e, TransportError):
        return e.status is None or e.status >= 500 or e.status in RETRY_STATUS
    return isinstance(e, (OSError, ConnectionError, TimeoutError))


def pauses(retries: int = RETRIES, backoff: float = 1.0) -> Iterator[float]:
    """Seconds to wait before each further attempt: backoff, twice it, ..."""
    return (backoff * 2 ** i for i in range(max(0, retries - 1)))


def with_retry(call, retries: int = RETRIES, backoff: float = 1.0) -> tuple:
    """Returns (what ``call()`` gave, attempts used)."""
    waits = pauses(retries, backoff)
    attempts = 0
    while True:
        attempts += 1
        try:
            return call(), attempts
        except Exception as e:
            wait = next(waits, None) if retryable(e) else None
            if wait is None:
                raise
            time.sleep(wait)


def send_with_retry(transport, key: str, payload: bytes, retries: int = RETRIES,
                    backoff: float = 1.0) -> tuple[int, int]:
    """Returns (rows acknowledged, attempts used)."""
    return with_retry(lambda: transport.send(key, payload), retries, backoff)


def period_of(key: str) -> tuple[int, int]:
    """(year, week) of a payload key ``<year>-<week>/<part>``."""
    year, _, week = key.split("/")[0].rpartition("-")
    return int(year), int(week)


class DirectoryTransport:
    """Parquet files in a folder, through a pyarrow filesystem (local, HDFS or object store):

        <dir>/<year>-<week>/<run>/<part>-<attempt>.parquet
        <dir>/_manifest/00000001.json, 00000002.json, ...

    A manifest lists the files of every period; the one with the highest number is the
    delivered state (:func:`delivered_files`), so a commit takes effect at once and as a
    whole.  Files that it no longer names are then removed.  A crash before that
    leaves files that no manifest names, which ``vacuum`` removes.  One delivery at a time
    may commit to a folder."""

    def __init__(self, directory: str, run: str = "run"):
        self.directory, self.run = directory.rstrip("/"), run
        self.tokens: dict[str, str] = {}

    def begin(self, schema: T.StructType) -> None:
        pass

    def send(self, key: str, payload: bytes) -> int:
        import pyarrow.parquet as pq
        fs, base = _filesystem(self.directory)
        period, _, part = key.rpartition("/")
        token = f"{period}/{self.run}/{part}-{uuid.uuid4().hex[:12]}.parquet"
        _put(fs, f"{base}/{token}", payload)
        self.tokens[key] = token
        return pq.read_metadata(io.BytesIO(payload)).num_rows

    def token(self, key: str) -> str:
        """Under which name the acknowledged payload of ``key`` is stored."""
        return self.tokens[key]

    def publish(self, schema: T.StructType, receipts: list[dict]) -> None:
        """Make the receipts' payloads the content of their periods."""
        fs, base = _filesystem(self.directory)
        number, old = _manifest(fs, base)
        new = {p: files for p, files in old.items()}
        for period in {r["key"].split("/")[0] for r in receipts}:
            new[period] = sorted(r["token"] for r in receipts if r["key"].startswith(f"{period}/"))
        self._commit(fs, base, number, old, new)
        self._sweep(fs, base, self.run, {f for files in new.values() for f in files})

    def _commit(self, fs, base: str, number: int, old: dict, new: dict) -> None:
        if new == old:
            return
        _put(fs, f"{base}/_manifest/{number + 1:08d}.json", json.dumps(new, sort_keys=True).encode())
        named = {f for files in new.values() for f in files}
        for path in (f for files in old.values() for f in files if f not in named):
            _remove(fs, f"{base}/{path}")

    def _sweep(self, fs, base: str, run: str | None, named: set[str]) -> int:
        """Remove the files (of one run, or of all) that are not named."""
        from pyarrow import fs as pafs
        removed = 0
        for info in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
            path = info.path.removeprefix(base).lstrip("/")
            parts = path.split("/")
            ours = len(parts) == 3 and parts[0] != "_manifest" and run in (None, parts[1])
            if info.type == pafs.FileType.File and ours and path not in named:
                removed += _remove(fs, info.path)
        return removed

    def discard(self) -> None:
        fs, base = _filesystem(self.directory)
        _, now = _manifest(fs, base)
        self._sweep(fs, base, self.run, {f for files in now.values() for f in files})

    def vacuum(self) -> int:
        """Remove what no manifest names; not to be run beside a delivery."""
        fs, base = _filesystem(self.directory)
        _, now = _manifest(fs, base)
        return self._sweep(fs, base, None, {f for files in now.values() for f in files})

    def delete_period(self, year: int, week: int) -> None:
        fs, base = _filesystem(self.directory)
        number, old = _manifest(fs, base)
        gone = f"{year}-{week:02d}"
        self._commit(fs, base, number, old, {p: files for p, files in old.items() if p != gone})


def _put(fs, path: str, content: bytes) -> None:
    """Write a file under a hidden name, then move it into place, so that a
    half-written one is never taken for whole."""
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(content)
    fs.move(draft, path)


def _remove(fs, path: str) -> int:
    from pyarrow import fs as pafs
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return 0
    fs.delete_file(path)
    return 1


def _manifest(fs, base: str) -> tuple[int, dict[str, list[str]]]:
    """(number, files of each period) of the newest manifest."""
    from pyarrow import fs as pafs
    found = fs.get_file_info(pafs.FileSelector(f"{base}/_manifest", allow_not_found=True))
    names = [i.path for i in found if i.path.rsplit("/", 1)[-1].split(".")[0].isdigit()]
    if not names:
        return 0, {}
    newest = max(names, key=lambda p: int(p.rsplit("/", 1)[-1].split(".")[0]))
    with fs.open_input_stream(newest) as f:
        return int(newest.rsplit("/", 1)[-1].split(".")[0]), json.loads(f.read())


def delivered_files(directory: str) -> dict[str, list[str]]:
    """The files of each delivered period of a folder, as the newest manifest names them."""
    fs, base = _filesystem(directory.rstrip("/"))
    return {p: [f"{directory.rstrip('/')}/{f}" for f in files]
            for p, files in _manifest(fs, base)[1].items()}


def read_delivered(spark, directory: str) -> DataFrame:
    """The rows that a folder's newest manifest names."""
    from weekmart.session import _qualified
    where = _qualified(spark, directory)[0].toString()
    paths = [f for files in delivered_files(where).values() for f in files]
    if not paths:
        raise ValueError(f"{directory} holds no delivery")
    return spark.read.parquet(*paths)


TOKEN = "delivery_token"  # column of the staging table that names the attempt
TOKENS_PER_INSERT = 1000


def schema_changes(table: str, have: dict[str, str], want: T.StructType, text: set[str]) -> list[str]:
    """Statements that turn a table of columns ``have`` (lower-cased name -> type) into
    one that can take ``want``: absent columns are added, whole numbers that meet text
    become text."""
    target = quote(table, "duckdb")

    def change(f: T.StructField) -> str | None:
        column, held = quote(f.name, "duckdb"), have.get(f.name.lower())
        if held is None:
            return f"ADD COLUMN IF NOT EXISTS {column} {column_type(f.dataType, 'duckdb')}"
        return f"ALTER COLUMN {column} TYPE VARCHAR" if held == "BIGINT" and f.name in text else None

    return [f"ALTER TABLE {target} {c}" for c in map(change, want.fields) if c]


def fitted_value(f: T.StructField, held: str | None, text: set[str]) -> str:
    """SQL of a staged column as the target's column holds it: date text is a serial day
    in a column of whole numbers, and a value that does not convert is null."""
    column, own = quote(f.name, "duckdb"), column_type(f.dataType, "duckdb")
    if held in (None, own) or (held == "BIGINT" and f.name in text):
        return column
    if held == "BIGINT" and own == "VARCHAR":
        return f"date_diff('day', DATE '1899-12-30', TRY_CAST({column} AS DATE))"
    return f"TRY_CAST({column} AS {held})"


class HttpTransport:
    """A store reached by HTTP: ``POST <url>/upload`` takes multipart/form-data
    ``file`` + ``table`` + ``mode=append`` and answers ``total_rows``; ``/execute``
    takes ``{"statements": [...]}`` and ``/query`` ``{"sql": ...}``.

    Payloads are appended to a staging table of the run, every row with its attempt's
    token.  The commit deletes the run's periods and inserts the rows of the
    acknowledged tokens in one transaction, then drops the staging table."""

    def __init__(self, url: str, table: str, api_key: str | None = None, timeout: float = 120,
                 run: str = "run"):
        self.url, self.table, self.api_key, self.timeout = url.rstrip("/"), table, api_key, timeout
        self.run = run
        self.tokens: dict[str, str] = {}

    @property
    def staging(self) -> str:
        return f"{self.table}__{self.run}"

    def _post(self, path: str, body: bytes, kind: str) -> dict:
        req = urllib.request.Request(f"{self.url}/{path}", data=body, method="POST")
        req.add_header("Content-Type", kind)
        if self.api_key:
            req.add_header("X-API-Key", self.api_key)
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                return json.loads(resp.read() or b"{}")
        except urllib.error.HTTPError as e:
            raise TransportError(e.code, e.read().decode("utf-8", "replace")) from e

    def execute(self, statements: list[str]) -> dict:
        return self._post("execute", json.dumps({"statements": statements}).encode(), "application/json")

    def query(self, sql: str) -> dict:
        return self._post("query", json.dumps({"sql": sql}).encode(), "application/json")

    def begin(self, schema: T.StructType) -> None:
        staged = T.StructType([*schema.fields, T.StructField(TOKEN, T.StringType())])
        self.execute([f"CREATE TABLE IF NOT EXISTS {quote(self.staging, 'duckdb')} "
                      f"({column_ddl(staged, 'duckdb')})"])

    def send(self, key: str, payload: bytes) -> int:
        import pyarrow as pa
        import pyarrow.parquet as pq
        token = f"{key}#{uuid.uuid4().hex}"
        rows = pq.read_table(io.BytesIO(payload))
        stamped = io.BytesIO()
        pq.write_table(rows.append_column(TOKEN, pa.array([token] * rows.num_rows, pa.string())), stamped)
        boundary = uuid.uuid4().hex
        fields = [('name="table"', "", self.staging.encode()), ('name="mode"', "", b"append"),
                  (f'name="file"; filename="{key.replace("/", "_")}.parquet"',
                   "Content-Type: application/octet-stream\r\n", stamped.getvalue())]
        body = b"".join(f"--{boundary}\r\nContent-Disposition: form-data; {what}\r\n{extra}\r\n".encode()
                        + value + b"\r\n" for what, extra, value in fields)
        answer = self._post("upload", body + f"--{boundary}--\r\n".encode(),
                            f"multipart/form-data; boundary={boundary}")
        self.tokens[key] = token
        return int(answer.get("total_rows", 0))

    def token(self, key: str) -> str:
        """The stamp of the acknowledged attempt of ``key``."""
        return self.tokens[key]

    def columns(self) -> dict[str, str]:
        """Type of each column (lower-cased name) of the target."""
        told = self.query(f"DESCRIBE {quote(self.table, 'duckdb')}")
        rows = (dict(zip(told["columns"], row)) for row in told["rows"])
        return {r["column_name"].lower(): r["column_type"] for r in rows}

    def publish(self, schema: T.StructType, receipts: list[dict]) -> None:
        """The commit.  Sent again it gives the same rows: what it deletes first is
        what it inserts, and the staging table goes last."""
        target, staged = quote(self.table, "duckdb"), quote(self.staging, "duckdb")
        text = {c for r in receipts for c in r.get("text", ())}
        self.execute([f"CREATE TABLE IF NOT EXISTS {target} ({column_ddl(schema, 'duckdb')})"])
        have = self.columns()
        changes = schema_changes(self.table, have, schema, text)
        if changes:
            self.execute(changes)
        names = ", ".join(quote(f.name, "duckdb") for f in schema.fields)
        values = ", ".join(fitted_value(f, have.get(f.name.lower()), text) for f in schema.fields)
        tokens = sorted(r["token"].replace("'", "''") for r in receipts)
        swap = [f"DELETE FROM {target} WHERE year_num = {y} AND week_num = {w}"
                for y, w in sorted({period_of(r["key"]) for r in receipts})]
        for at in range(0, len(tokens), TOKENS_PER_INSERT):
            some = ", ".join(f"'{t}'" for t in tokens[at:at + TOKENS_PER_INSERT])
            swap.append(f"INSERT INTO {target} ({names}) SELECT {values} FROM {staged} WHERE {TOKEN} IN ({some})")
        if swap:
            try:
                self.execute(["BEGIN TRANSACTION", *swap, "COMMIT"])
            except Exception:
                try:
                    self.execute(["ROLLBACK"])
                except Exception:  # noqa: BLE001 - nothing was open
                    pass
                raise
        self.discard()

    def discard(self) -> None:
        self.execute([f"DROP TABLE IF EXISTS {quote(self.staging, 'duckdb')}"])

    def delete_period(self, year: int, week: int) -> None:
        self.execute([f"DELETE FROM {quote(self.table, 'duckdb')} WHERE year_num = {int(year)} "
                      f"AND week_num = {int(week)}"])


def make_transport(options: dict):
    if "transport_object" in options:
        made = cloudpickle.loads(base64.b64decode(options["transport_object"]))
        made.run = options.get("run", "run")
        return made
    kind = options.get("transport", "directory")
    if kind == "directory":
        return DirectoryTransport(options["path"], options.get("run", "run"))
    if kind == "http":
        return HttpTransport(options["url"], options["table"], options.get("api_key"),
                             run=options.get("run", "run"))
    raise ValueError(f"unknown transport {kind!r}")


class DeliveryCommit(WriterCommitMessage):
    def __init__(self, receipts: list[dict]):
        self.receipts = receipts


def period_runs(batch) -> Iterator[tuple[int, object]]:
    """(period key, slice) of each stretch of equal periods in an Arrow batch."""
    import numpy as np
    import pyarrow as pa
    keys = (np.asarray(batch.column("year_num").cast(pa.int64())) * 100
            + np.asarray(batch.column("week_num").cast(pa.int64())))
    cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(keys[a]), batch.slice(a, b - a)


def text_columns(table) -> list[str]:
    """The string columns of an Arrow table with a value that is not a date."""
    import pyarrow as pa
    import pyarrow.compute as pc
    strings = [f.name for f in table.schema if pa.types.is_string(f.type) or pa.types.is_large_string(f.type)]
    return [c for c in strings
            if pc.any(pc.invert(pc.match_substring_regex(table[c], DATE_TEXT_PATTERN))).as_py()]


class DeliveryWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema = dict(options), schema

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        transport = make_transport(self.options)
        retries = int(self.options.get("retries", RETRIES))
        backoff = float(self.options.get("backoff", 1.0))
        receipts: list[dict] = []
        held: list = []
        period, size = None, 0

        def flush():
            nonlocal held, size
            if held:
                buf = io.BytesIO()
                rows_held = pa.Table.from_batches(held)
                pq.write_table(rows_held, buf)
                key = f"{period // 100}-{period % 100:02d}/part-{part:05d}-{len(receipts):05d}"
                rows, attempts = send_with_retry(transport, key, buf.getvalue(), retries, backoff)
                receipts.append({"key": key, "rows": rows, "attempts": attempts,
                                 "token": transport.token(key), "text": text_columns(rows_held)})
            held, size = [], 0

        for batch in iterator:
            for key, rows in period_runs(batch):
                if key != period or size >= PAYLOAD_BYTES:
                    flush()
                period = key
                held.append(rows)
                size += rows.nbytes
        flush()
        return DeliveryCommit(receipts)

    def commit(self, messages):
        receipts = [r for m in messages if m is not None for r in m.receipts]
        transport = make_transport(self.options)
        with_retry(lambda: transport.publish(self.schema, receipts),
                   int(self.options.get("retries", RETRIES)), float(self.options.get("backoff", 1.0)))
        log = self.options.get("receipts")
        if log:
            fs, path = _filesystem(log)
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(path) as out:
                out.write(json.dumps(receipts).encode())

    def abort(self, messages):
        make_transport(self.options).discard()


class DeliveryDataSource(DataSource):
    @classmethod
    def name(cls):
        return "weekmart_delivery"

    def schema(self):
        return "year_num int, week_num int"

    def writer(self, schema, overwrite):
        return DeliveryWriter(self.options, schema)


class DeliverySink:
    """Sink over the delivery data source.  ``transport`` is ``directory`` (with
    ``path``), ``http`` (with ``url``, ``table``) or a transport object; further
    options: ``retries``, ``backoff`` (seconds before the first retry) and
    ``receipts`` (a file for the list of what was sent)."""

    def __init__(self, spark, name: str = "delivery", transport="directory", **options):
        from weekmart.session import _qualified
        self.spark, self.name = spark, name
        self.options = {k: str(v) for k, v in options.items()}
        # A path without a scheme belongs to the default file system, on every executor.
        for k in {"path", "receipts"} & set(self.options):
            self.options[k] = _qualified(spark, self.options[k])[0].toString()
        if isinstance(transport, str):
            self.options["transport"] = transport
        else:
            if hasattr(transport, "directory"):
                transport.directory = _qualified(spark, transport.directory)[0].toString()
            self.options["transport_object"] = base64.b64encode(cloudpickle.dumps(transport)).decode()
        spark.dataSource.register(DeliveryDataSource)

    def setup(self, df: DataFrame) -> None:
        """Make the target ready for ``df``'s columns; no rows change."""
        make_transport(self.options).publish(df.schema, [])

    def delete_period(self, year: int, week: int) -> None:
        make_transport(self.options).delete_period(year, week)

    def insert(self, df: DataFrame) -> int:
        """Deliver ``df``; each period it holds replaces that period.  The rows are
        computed once: what the store must be told of them comes with the receipts."""
        from weekmart.sinks.base import counted, observed_rows
        options = {**self.options, "run": uuid.uuid4().hex}
        make_transport(options).begin(df.schema)
        # AQE-sized task inputs, periods together: a task holds one payload at a time.
        dealt = df.hint("rebalance", "year_num", "week_num").sortWithinPartitions("year_num", "week_num")
        out, obs = counted(dealt)
        out.write.format("weekmart_delivery").mode("append").options(**options).save()
        return observed_rows(obs)

    upsert = insert

    def receipts(self) -> list[dict]:
        log = self.options.get("receipts")
        if not log:
            return []
        fs, path = _filesystem(log)
        with fs.open_input_stream(path) as fh:
            return json.loads(fh.read())

    def close(self) -> None:
        pass
