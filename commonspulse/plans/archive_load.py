"""Batch load of archive hours into the event and commit tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from commonspulse.operators.filters import archive_types, of_any_organization, of_organization
from commonspulse.operators.merge import absent_rows
from commonspulse.operators.projections import archive_commit_rows, event_rows
from commonspulse.streaming.ingest import COMMIT_ORDER, EVENT_ORDER


@dataclass
class ArchiveLoad:
    """Rows to append to each table, and the matches seen once the events were written."""

    new_events: DataFrame
    new_commits: DataFrame
    matched: Observation

    def matches(self) -> int:
        """Matching events including replays that were not stored; undecodable lines not included."""
        return self.matched.get["matches"]


def load_archive(events: DataFrame, stored: Mapping[str, DataFrame], organizations: DataFrame | str,
                 collected_at: Column | None = None) -> ArchiveLoad:
    """What archive events add to ``gharchive_event`` and ``commit_activity``.

    ``organizations`` is one login or a table of logins.  Stored rows win over
    archive rows, so richer commit rows are never replaced.
    """
    kept = archive_types(events)
    if isinstance(organizations, str):
        chosen = of_organization(kept, organizations)
    else:
        chosen = of_any_organization(kept, organizations)
    matched = Observation()
    rows = event_rows(chosen.observe(matched, F.count(F.lit(1)).alias("matches")), collected_at)
    commits = archive_commit_rows(chosen, collected_at, keep=("archive_hour", "id"))
    return ArchiveLoad(
        absent_rows(stored["gharchive_event"], rows, ["event_id"], EVENT_ORDER),
        absent_rows(stored["commit_activity"], commits, ["repo_id", "sha"], COMMIT_ORDER)
        .select(*stored["commit_activity"].columns),
        matched,
    )
