"""Options: command line over environment over a JSON file over defaults."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, fields
from datetime import timedelta

ENV_PREFIX = "CHANGELOOM_"
_UNITS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 1e-3, "us": 1e-6, "µs": 1e-6, "ns": 1e-9}
#: Constructs of the patterns' original dialect that Python reads otherwise or not at all.
_FOREIGN = re.compile(r"\\z|\\[pP](?:\{|[A-Z])|\(\?[a-z]*U|\\Q|\\C|\[\[:")


def parse_duration(text: str) -> timedelta:
    """`10m`, `1h30m`, `500ms`, `1.5s`."""
    parts = re.findall(r"([0-9]*\.?[0-9]+)(h|ms|us|µs|ns|m|s)", text)
    if text.strip() == "0":
        return timedelta(0)
    if not parts or "".join(a + b for a, b in parts) != text.strip():
        raise ValueError(f"not a duration: {text!r}")
    return timedelta(seconds=sum(float(n) * _UNITS[u] for n, u in parts))


def parse_patterns(text: str) -> tuple[str, ...]:
    """Comma-separated regexes; none for empty text."""
    if not text:
        return ()
    for pattern in (patterns := tuple(text.split(","))):
        if _FOREIGN.search(pattern):
            raise ValueError(f"pattern {pattern!r} uses a construct that this engine does not read the same way")
        re.compile(pattern)
    return patterns


def _truth(text: str) -> bool:
    if text.lower() in ("1", "t", "true"):
        return True
    if text.lower() in ("0", "f", "false"):
        return False
    raise ValueError(f"not a boolean: {text!r}")


def _names(text: str) -> frozenset[str]:
    return frozenset(t for t in text.split(",") if t)


def _option(default, read=str, about: str = ""):
    return field(default=default, metadata={"read": read, "about": about})


@dataclass(frozen=True)
class Config:
    config: str = _option("", about="JSON file of options")
    force_dump: bool = _option(False, _truth, "reset the stored position and snapshot once replication has caught up")
    force_immediate_dump: bool = _option(False, _truth, "reset the stored position and snapshot at once")
    rewind: bool = _option(False, _truth, "replay from the earliest event")
    assume_only_appended_columns: bool = _option(True, _truth, "new source columns come last; relevant for events without column names")
    profile: bool = _option(False, _truth, "log query plans")
    start_from_gtid: str = _option("", about="replay after this set of transactions")
    mysql_db: str = _option("appdb")
    mysql_addr: str = _option("0.0.0.0:3306")
    mysql_user: str = _option("root")
    mysql_password: str = _option("")
    clickhouse_addr: str = _option("0.0.0.0:9000")
    clickhouse_db: str = _option("mysql_changelog")
    clickhouse_username: str = _option("default")
    clickhouse_password: str = _option("")
    batch_write_interval: timedelta = _option(timedelta(minutes=10), parse_duration, "time between batches")
    batch_size: int = _option(200_000, int, "rows of a batch; a larger backlog is applied in several")
    max_files: int = _option(0, int, "files of the feed that a batch admits at most; 0 for all")
    scan_partitions: int = _option(8, int, "queries that share the scan of one table by its key")
    concurrent_batch_writes: int = _option(10, int, "tables written at once")
    concurrent_mysql_dump_selects: int = _option(4, int, "tables scanned at once")
    force_dump_tables: frozenset[str] = _option(frozenset(), _names, "tables to snapshot again")
    ignored_columns_for_deduplication: tuple[str, ...] = _option((".*updated_at",), parse_patterns, "columns whose change alone is no change")
    yaml_columns: tuple[str, ...] = _option((), parse_patterns, "columns to turn from YAML into JSON")
    json_columns: tuple[str, ...] = _option((), parse_patterns, "JSON columns to redact by path")
    anonymize_fields: tuple[str, ...] = _option((), parse_patterns, "fields to hash: table.column.path")
    skip_anonymize_fields: tuple[str, ...] = _option((), parse_patterns, "fields never to hash")
    strict_temporal: bool = _option(False, _truth, "fail on dates that can't be read")
    wrap_integers: bool = _option(False, _truth, "keep the low bits of integers that don't fit")


def flag_of(name: str) -> str:
    return name.replace("_", "-")


def parse_arguments(arguments: list[str]) -> dict[str, str]:
    """`--flag value`, `--flag=value`, `-flag`, and `--flag` alone for booleans."""
    known = {flag_of(f.name): f for f in fields(Config)}
    found: dict[str, str] = {}
    rest = list(arguments)
    while rest:
        token = rest.pop(0)
        if not token.startswith("-"):
            raise ValueError(f"unexpected argument {token!r}")
        name, has_value, value = token.lstrip("-").partition("=")
        if name not in known:
            raise ValueError(f"unknown flag --{name}")
        if not has_value:
            if known[name].metadata["read"] is _truth:
                value = "true"
            elif rest:
                value = rest.pop(0)
            else:
                raise ValueError(f"flag --{name} needs a value")
        found[name] = value
    return found


def load(arguments: list[str], environment: dict[str, str] | None = None) -> Config:
    environment = environment or {}
    given = parse_arguments(arguments)
    env_name = lambda flag: ENV_PREFIX + flag.upper().replace("-", "_")
    path = given.get("config", environment.get(env_name("config"), ""))
    from_file: dict[str, str] = {}
    if path:
        with open(path) as file:
            for name, value in json.load(file).items():
                from_file[name] = json.dumps(value) if isinstance(value, bool) else ",".join(value) if isinstance(value, list) else str(value)
    known = {flag_of(f.name) for f in fields(Config)}
    if unknown := set(from_file) - known:
        raise ValueError(f"{path}: unknown options {sorted(unknown)}")
    values = {}
    for f in fields(Config):
        flag = flag_of(f.name)
        for origin, name in ((given, flag), (environment, env_name(flag)), (from_file, flag)):
            if name in origin:
                values[f.name] = f.metadata["read"](origin[name])
                break
    return Config(**values)
