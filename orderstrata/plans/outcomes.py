"""What a stage reports back. Frames in it are lazy."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class TablesCreated:
    """Names of the tables created, up to the first that failed."""

    created: list[str] = field(default_factory=list)
    error: Exception | None = None

    @property
    def success(self) -> bool:
        return self.error is None


@dataclass(frozen=True)
class Migrated:
    """A raw table brought to its typed form, or the text of what stopped it.

    ``duplicates`` are rows whose key another one has; ``rejected`` rows that were turned
    away before, for naming no known product; ``malformed`` rows as they were given that the
    contract does not take, with the ``reasons``, where such rows are held instead of failing
    the stage. ``rows`` are the table's own, ``counts`` those of each part.
    """

    table: str
    rows: int = 0
    error: str | None = None
    duplicates: DataFrame | None = None
    rejected: DataFrame | None = None
    malformed: DataFrame | None = None
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return self.error is None


@dataclass(frozen=True)
class Published:
    """A published table; for products also those without a category."""

    table: str
    rows: int = 0
    error: Exception | None = None
    uncategorised: DataFrame | None = None

    @property
    def success(self) -> bool:
        return self.error is None


@dataclass(frozen=True)
class Section:
    """A question of the report, the frame that answers it, and the table that keeps it."""

    question: str
    result: DataFrame
    table: str


class StageFailed(RuntimeError):
    """A stage whose failure ends the run."""
