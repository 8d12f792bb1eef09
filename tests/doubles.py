"""Sinks and transports that fail on purpose."""

import json
import os
import re
import sys
import uuid

from pyspark import cloudpickle

from weekmart.sinks.deliver import DirectoryTransport, HttpTransport, TransportError

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FlakyTransport(DirectoryTransport):
    """Answers each payload key with the given status codes first."""

    def __init__(self, directory: str, codes: list[int]):
        super().__init__(directory)
        self.codes = list(codes)
        self.calls: dict[str, int] = {}

    def send(self, key: str, payload: bytes) -> int:
        n = self.calls.get(key, 0)
        self.calls[key] = n + 1
        if n < len(self.codes):
            raise TransportError(self.codes[n], "scripted failure")
        return super().send(key, payload)


class FailingSink:
    """Always fails."""

    def __init__(self, name: str = "failing", message: str = "target unavailable"):
        self.name, self.message = name, message

    def upsert(self, df):
        raise ConnectionError(self.message)


class FolderStore(HttpTransport):
    """An upload store kept in a folder, so that all tasks share it: uploads are files,
    statements a log.  It loses the answer of the first upload of each payload after
    storing it, and the answer of the first ``lost_commits`` transactions after running them."""

    def __init__(self, folder: str, table: str, columns: dict[str, str], lost_commits: int = 0):
        super().__init__("http://store", table)
        self.folder, self.known, self.lost_commits = folder, columns, lost_commits
        self.asked: set[str] = set()

    def _post(self, path, body, kind):
        os.makedirs(self.folder, exist_ok=True)
        if path == "upload":
            content = body[body.index(b"PAR1"):body.rindex(b"PAR1") + 4]
            with open(f"{self.folder}/{uuid.uuid4().hex}.parquet", "wb") as f:
                f.write(content)
            name = re.search(rb'filename="([^"]+)"', body).group(1).decode()
            if name not in self.asked:
                self.asked.add(name)
                raise TransportError(None, "answer lost")
            return {"total_rows": 0}
        told = json.loads(body)
        if path == "query":
            return {"columns": ["column_name", "column_type"], "rows": [list(x) for x in self.known.items()]}
        with open(f"{self.folder}/log.jsonl", "a") as f:
            f.write(json.dumps(told["statements"]) + "\n")
        if told["statements"][0].startswith("BEGIN") and self.lost_commits:
            self.lost_commits -= 1
            raise TransportError(503, "answer lost")
        return {}

    def statements(self) -> list[list[str]]:
        with open(f"{self.folder}/log.jsonl") as f:
            return [json.loads(line) for line in f]

    def rows(self) -> list[dict]:
        """The target after all transactions, and nothing but what they insert."""
        import pyarrow.parquet as pq
        staged = [r for name in sorted(os.listdir(self.folder)) if name.endswith(".parquet")
                  for r in pq.read_table(f"{self.folder}/{name}").to_pylist()]
        held: list[dict] = []
        for group in self.statements():
            for s in group:
                if m := re.match(r"DELETE FROM .* year_num = (\d+) AND week_num = (\d+)", s):
                    held = [r for r in held if (r["year_num"], r["week_num"]) != (int(m[1]), int(m[2]))]
                elif s.startswith("INSERT"):
                    wanted = set(re.findall(r"'([^']+#[0-9a-f]{32})'", s))
                    held += [r for r in staged if r["delivery_token"] in wanted]
        return held
