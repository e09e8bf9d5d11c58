"""Thresholds from a JSON file, over the built-in ones."""

from __future__ import annotations

import json
from pathlib import Path

from quire.errors import UsageError
from quire.schema import THRESHOLDS


def load_settings(path: str | None = None) -> dict:
    if path is None:
        return dict(THRESHOLDS)
    try:
        given = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise UsageError(f"settings {path} cannot be read: {e}") from e
    if not isinstance(given, dict):
        raise UsageError(f"settings {path} must be a JSON object")
    if unknown := sorted(set(given) - set(THRESHOLDS)):
        raise UsageError(f"settings {path}: unknown {', '.join(unknown)}")
    return THRESHOLDS | given
