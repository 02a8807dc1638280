"""Log lines of the driver: events with key=value fields, sessions, formatting, setup."""

from __future__ import annotations

import contextlib
import contextvars
import datetime
import logging
import os
import sys
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_session: contextvars.ContextVar[str | None] = contextvars.ContextVar("session", default=None)
_fields: contextvars.ContextVar[dict] = contextvars.ContextVar("fields", default={})  # noqa: B039  (never changed in place)

# fixed values: escape codes of a terminal
RESET, GREY, MAGENTA, CYAN = "\033[0m", "\033[90m", "\033[35m", "\033[36m"
BY_LEVEL = {"DEBUG": CYAN, "INFO": "\033[94m", "WARNING": "\033[33m", "ERROR": "\033[31m", "CRITICAL": "\033[1;91m"}


def event_line(event: str, fields: dict) -> str:
    """event k="text" k=number; fields that are None are left out."""
    return " ".join([event, *(f'{k}="{v}"' if isinstance(v, str) else f"{k}={v}" for k, v in fields.items() if v is not None)])


def log_event(logger: logging.Logger, event: str, level: str = "INFO", **fields) -> None:
    """One line with the session's fields and these; they hang on the record too."""
    own = {"session_id": _session.get(), **_fields.get(), **fields}
    own = {k: v for k, v in own.items() if v is not None}
    logger.log(getattr(logging, level.upper(), logging.INFO), event_line(event, own), extra={"event_fields": own | {"event": event}})


@contextlib.contextmanager
def session(spark: SparkSession | None = None, session_id: str | None = None, **fields) -> Iterator[str]:
    """Fields for all events inside; an id of eight characters unless an outer session has one.  Spark jobs get it as their group."""
    now = session_id or _session.get() or uuid.uuid4().hex[:8]
    marks = _session.set(now), _fields.set({**_fields.get(), **fields})
    if spark is not None:
        spark.sparkContext.setJobGroup(now, event_line("session", fields))
    try:
        yield now
    finally:
        _session.reset(marks[0])
        _fields.reset(marks[1])
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", _session.get())


def new_session(spark: SparkSession | None = None, kind: str | None = None, **fields):
    """A session with an id of its own."""
    return session(spark, uuid.uuid4().hex[:8], **({"session_type": kind} if kind else {}), **fields)


class LineFormatter(logging.Formatter):
    """2026-01-15T11:01:10.750-04:00  INFO [id] pid --- name : message; levels 5 wide, names 40."""

    def __init__(self, colours: bool = False, width: int = 40) -> None:
        super().__init__()
        self.colours, self.width = colours, width

    def format(self, record: logging.LogRecord) -> str:
        paint = (lambda text, code: f"{code}{text}{RESET}") if self.colours else lambda text, code: text
        at = datetime.datetime.fromtimestamp(record.created).astimezone().isoformat(timespec="milliseconds")
        own = getattr(record, "event_fields", {}).get("session_id")
        line = (
            f"{paint(at, GREY)} {paint(record.levelname.rjust(5), BY_LEVEL.get(record.levelname, ''))} {paint(f'[{own or "-"}]', MAGENTA)} "
            f"{paint(os.getpid(), MAGENTA)} --- {paint(record.name[: self.width].ljust(self.width), CYAN)} : {record.getMessage()}"
        )
        return f"{line}\n{self.formatException(record.exc_info)}" if record.exc_info else line


def setup(env: str | None = None, log_file: str | None = None) -> None:
    """Root logger: standard output (in colours where APP_ENV is dev) and a file, from LOG_LEVEL on."""
    level = os.environ.get("LOG_LEVEL", "INFO").upper()
    path = log_file or "scraping.log"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    console, kept = logging.StreamHandler(sys.stdout), logging.FileHandler(path, encoding="utf-8")
    console.setFormatter(LineFormatter((env or os.environ.get("APP_ENV", "dev")).lower() == "dev"))
    kept.setFormatter(LineFormatter())
    console.setLevel(level)
    kept.setLevel("INFO")
    logging.basicConfig(level=level, handlers=[console, kept], force=True)
