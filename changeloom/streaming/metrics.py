"""Counters and the replication lag, in text form for scrapers."""

from __future__ import annotations

import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

PREFIX = "mysql_clickhouse_sink_"
#: Counter names and what they count.
COUNTERS = {
    "delivered_rows": "Rows written to destination tables",
    "enqueued_rows": "Rows taken from the change feed or a snapshot",
    "processed_rows": "Rows whose fate has been decided",
    "skipped_row_level_duplicates": "Updates that change no replicated column",
    "skipped_persisted_duplicates": "Changes that were stored already",
    "skipped_column_mismatch": "Rows of another width than the current source schema",
    "skipped_dump_duplicates": "Snapshot rows whose key was stored already",
    "skipped_unknown_actions": "Rows that are no insert, update, delete or snapshot",
}
LAG = "replication_delay"


class Stats:
    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._counts: Counter = Counter()
        self.lag_seconds: float | None = None

    def add(self, name: str, n: int) -> None:
        if name not in COUNTERS or n < 0:
            raise ValueError(f"no such counter, or a negative step: {name} {n}")
        with self._lock:
            self._counts[name] += n

    def see(self, newest_event: float | None, now: float | None = None) -> None:
        """The lag behind the newest event (seconds since 1970), at least 0."""
        if newest_event is not None:
            self.lag_seconds = max(0.0, (time.time() if now is None else now) - newest_event)

    def __getitem__(self, name: str) -> int:
        return self._counts[name]

    def snapshot(self) -> dict[str, int]:
        with self._lock:
            return {name: self._counts[name] for name in COUNTERS}

    def exposition(self) -> str:
        lines = []
        for name, value in self.snapshot().items():
            lines += [f"# HELP {PREFIX}{name} {COUNTERS[name]}", f"# TYPE {PREFIX}{name} counter", f"{PREFIX}{name} {value}"]
        if self.lag_seconds is not None:
            lines += [f"# TYPE {PREFIX}{LAG} gauge", f"{PREFIX}{LAG} {self.lag_seconds:g}"]
        return "\n".join(lines) + "\n"

    def report(self) -> str:
        return ", ".join(f"{name}: {value}" for name, value in self.snapshot().items())


def serve(stats: Stats, port: int = 3003) -> ThreadingHTTPServer:
    """Answers /metrics on a thread of its own; the caller shuts it down."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            body = stats.exposition().encode() if self.path == "/metrics" else b""
            self.send_response(200 if body else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_: object) -> None:
            pass

    server = ThreadingHTTPServer(("", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
