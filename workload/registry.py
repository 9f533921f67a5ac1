"""Named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from workload.given import Given
from workload.prelude import with_prelude


@dataclass(frozen=True)
class Entry:
    run: Callable[[Given], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the given tables under a name."""

    def wrap(run: Callable[[Given], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"query registered twice: {name}")
        ENTRIES[name] = Entry(run, with_prelude(sql) if sql else None)
        return run

    return wrap
