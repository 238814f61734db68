"""Structured log lines: one JSON object per event on the ``eclusa`` logger."""

import json
import logging

_logger = logging.getLogger("eclusa")


def info(event: str, **fields) -> None:
    _logger.info(json.dumps({"event": event, **fields}, ensure_ascii=False, default=str))


def error(event: str, **fields) -> None:
    _logger.error(json.dumps({"event": event, **fields}, ensure_ascii=False, default=str))
