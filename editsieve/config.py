"""Every tunable of the jobs in one place, with the defaults the workload is run with."""

from __future__ import annotations

from dataclasses import dataclass


def _floored(cap: int | None, floor: int) -> int | None:
    return None if cap is None else max(cap, floor)


@dataclass(frozen=True)
class HarvestConfig:
    """Turning change events into shards. ``None`` for a cap means no cap, which is the default."""

    max_changes: int | None = None
    max_diffs: int | None = None
    hard_cap: int | None = None
    include_non_reverts: bool = True
    source_prefix: str = "harvest"
    easy_negative_rate: float = 0.2
    min_context_score: int = 4
    auto_sampling: bool = True
    # Tags written to a shard row.
    max_tags: int | None = None

    @property
    def scan_cap(self) -> int | None:
        caps = [c for c in (self.max_changes, _floored(self.hard_cap, 1000)) if c is not None]
        return min(caps) if caps else None


@dataclass(frozen=True)
class CollectConfig:
    """Which sources feed the training table, and their caps (``None``: no cap).

    The change cap of the human-revert stage and of the recent-changes stage are
    separate settings, so enabling one stage never changes the other.
    """

    default_lang: str = "fr"
    change_events_limit: int | None = None
    recent_changes: bool = True
    recent_changes_max: int | None = None
    recent_changes_hard_cap: int | None = None
    human_reverts: bool = True
    human_revert_days: int = 30
    human_revert_max_changes: int | None = None
    human_revert_max_diffs: int | None = None

    @property
    def recent_changes_cap(self) -> int | None:
        return self.recent_changes_max or _floored(self.recent_changes_hard_cap, 100)

    @property
    def revert_scan(self) -> tuple[int, int | None, int | None]:
        """(days, changes, diffs) with their floors applied."""
        return (
            max(self.human_revert_days, 1),
            _floored(self.human_revert_max_changes, 100),
            _floored(self.human_revert_max_diffs, 50),
        )


@dataclass(frozen=True)
class TrainConfig:
    min_rows: int = 1000
    negatives_per_positive: int = 6
    seed: int = 42
    word_vocabulary: int = 60_000
    char_vocabulary: int = 40_000
    min_df: int = 2
    max_iter: int = 500
    folds: int = 3
    target_precision: float = 0.90

    @property
    def row_floor(self) -> int:
        return max(self.min_rows, 50)

    @property
    def ratio(self) -> int:
        return max(self.negatives_per_positive, 1)

    @property
    def precision_goal(self) -> float:
        return min(max(self.target_precision, 0.0), 1.0)


# Decision thresholds used when the model metadata carries none.
SERVING_THRESHOLD = 0.65
EVALUATION_THRESHOLD = 0.5

__all__ = [
    "CollectConfig",
    "HarvestConfig",
    "TrainConfig",
    "SERVING_THRESHOLD",
    "EVALUATION_THRESHOLD",
]
