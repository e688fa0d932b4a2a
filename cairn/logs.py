"""Log lines as JSON objects (or plain text), one a line on standard error."""

from __future__ import annotations

import json
import logging
import sys
from datetime import UTC, datetime

_PLAIN = set(vars(logging.makeLogRecord({}))) | {"message", "asctime"}


class JsonLines(logging.Formatter):
    """timestamp, level, logger, event, and whatever ``extra`` names; what JSON lacks is written as text."""

    def format(self, record: logging.LogRecord) -> str:
        line = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage()}
        line |= {k: v for k, v in vars(record).items() if k not in _PLAIN}
        if record.exc_info:
            line["exception"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str, ensure_ascii=False)


def configure_logging(json_logs: bool = True, level: int = logging.INFO) -> logging.Logger:
    """The engine's logger, with exactly one handler however often this is called."""
    log = logging.getLogger("cairn")
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(JsonLines() if json_logs else logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    log.handlers[:], log.propagate = [handler], False
    log.setLevel(level)
    return log
