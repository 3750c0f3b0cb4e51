"""Settings shared by the detection operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

MODES = ("prior", "post_update")
SCOPES = ("last", "all")
SILENCES = ("skip", "zero")


@dataclass(frozen=True)
class DetectionParams:
    """One detection run.

    ``mode="prior"`` scores a point against the baseline built from the points
    before it. ``mode="post_update"`` first folds the point into the baseline,
    which bounds the score by ``1/sqrt(alpha)``. ``scope="all"`` scores every
    point (``prior`` only), ``scope="last"`` the newest point of each series.
    """

    lookback_minutes: int = 15
    every_minutes: int = 5
    # Days of saved counts that baselines are trained from.
    train_days: int = 7
    # Saved baselines not updated for this many days, and missing ones, are trained
    # from the counts that earlier cycles saved; None: baselines never age.
    max_age_days: int | None = None
    # Runs whose baselines may lie open before a cycle folds them into a new base.
    compact_every: int = 12
    alpha: float = 0.3
    sigma: float = 3.0
    # Findings reported; None keeps all.
    top_k: int | None = 100
    # Counts scored of each source, the largest; None, the default, keeps all.
    # A limit leaves holes in series and in what later runs train on.
    hotspot_limit: int | None = None
    min_count: int = 5
    mode: str = "prior"
    scope: str = "last"
    # Score whole minutes only: a minute still running at the time of the run is
    # left to the next one, which counts all of it.
    drop_open_minute: bool = True
    # Distance between two points of a series, and the most points of one series
    # that are ever gathered into a single row. A point is a minute's sum, so the
    # second holds whatever the number of rows.
    step_minutes: int = 1
    # Steps without a point: left out, or counted as 0, so that a series that falls
    # silent decays and is found low.
    silence: str = "skip"
    # A deviation of 0 gives a score of 0; with this, any other value is scored
    # against the least deviation, and so found.
    flag_flat: bool = False
    block_points: int = 7 * 24 * 60

    def __post_init__(self) -> None:
        if not 0.0 < self.alpha <= 1.0:
            raise ValueError("alpha must be in (0, 1]")
        if self.sigma < 0:
            raise ValueError("sigma must not be negative")
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.scope not in SCOPES:
            raise ValueError(f"scope must be one of {SCOPES}")
        if self.silence not in SILENCES:
            raise ValueError(f"silence must be one of {SILENCES}")
        if self.mode == "post_update" and self.scope != "last":
            raise ValueError("post_update scores the newest point only")
        for name in ("lookback_minutes", "every_minutes", "train_days", "max_age_days", "top_k", "hotspot_limit", "compact_every", "step_minutes", "block_points"):
            value = getattr(self, name)
            if value is not None and value <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def block_minutes(self) -> int:
        return self.step_minutes * self.block_points

    @property
    def silent_step(self) -> int | None:
        return self.step_minutes if self.silence == "zero" else None

    def with_(self, **changes) -> "DetectionParams":
        return replace(self, **changes)
