"""Study parameters, passed explicitly to the plans."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    entity: str = "stay_id"
    time: str = "charttime"
    label: str = "stage"

    # cohort
    min_age: float = 18
    max_days: int = 35

    # regular grid
    step_hours: int = 6
    fill_limit: int = 16  # grid steps a label may be carried forward
    most_common: bool = False  # resample every column by its mode instead of mean/max

    # target: None keeps all stages, 1/2/3 binarises at that stage
    stage_threshold: int | None = 1
    horizon_hours: int = 48
    target: str = "first_onset"  # or "continuous"

    # missing values
    impute: str | None = None  # None, "entity" or "column"
    fill_value: float = 0.0

    # scaling
    cap_lower: float = 0.01
    cap_upper: float = 0.99
    fit_on: str = "train"  # or "all"

    # split of entities: hold-out share, then the test share of the hold-out
    holdout: float = 0.2
    test_share: float = 0.5
    seed: int = 42

    # sequences
    steps: int | None = None  # None: as many as the longest sequence has
    batch_size: int = 5

    @property
    def horizon_steps(self) -> int:
        return self.horizon_hours // self.step_hours
