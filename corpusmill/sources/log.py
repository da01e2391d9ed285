"""Log files of the stages, on the driver."""

from __future__ import annotations

import logging
from logging.handlers import RotatingFileHandler
from pathlib import Path

#: Size at which a log file is turned over, and how many old ones are kept.
BYTES, KEPT = 1 << 30, 5


def stage_log(name: str, folder: str = "log") -> logging.Logger:
    """The logger of a stage; it writes to folder/name.log. The same name gives the same logger."""
    logger = logging.getLogger(f"corpusmill.{name}")
    if not logger.handlers:
        Path(folder).mkdir(parents=True, exist_ok=True)
        handler = RotatingFileHandler(Path(folder) / f"{name}.log", maxBytes=BYTES, backupCount=KEPT, encoding="utf-8")
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        logger.addHandler(handler)
        logger.setLevel(logging.INFO)
        logger.propagate = False
    return logger
