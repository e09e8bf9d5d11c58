"""Failures that a command reports, each with the exit code it ends with."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import DataFrame

#: Problems that a message shows.
SHOWN = 50


class QuireError(Exception):
    exit_code = 1

    def __init__(self, message: str, problems: Sequence[str] = (), total: int | None = None) -> None:
        """total: how many problems there are, if those given are only the first."""
        super().__init__(message)
        self.message, self.problems = message, list(problems)
        self.total = len(self.problems) if total is None else total

    def render(self, most: int = SHOWN) -> str:
        """The message and the first problems; how many more there are is said."""
        lines = [self.message, *(f"  {p}" for p in self.problems[:most])]
        if self.total > len(lines) - 1:
            lines.append(f"  and {self.total - len(lines) + 1} more")
        return "\n".join(lines)


def first_problems(problems: DataFrame, most: int = SHOWN) -> tuple[list[str], int]:
    """The first messages, and how many there are: the driver holds no more of them than are shown."""
    first = [r["message"] for r in problems.limit(most + 1).collect()]
    return first[:most], len(first) if len(first) <= most else problems.count()


class IntegrityError(QuireError):
    """The corpus and the predictions do not fit together."""

    exit_code = 1


class UsageError(QuireError):
    """The call itself is wrong."""

    exit_code = 2


class IncommensurableError(QuireError):
    """Two runs that must not be compared."""

    exit_code = 3


class RunExistsError(QuireError):
    """The output folder is taken."""

    exit_code = 4
