"""Settings of the scoring model and of the replay/report helpers."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScoreSettings:
    # Encoder settings of the scored field and of the season
    # field, the warm-up length, the chart threshold and display window, and
    # the replay pacing, as the reference configures them.
    scalar_w: int = 51
    scalar_min: float = 0.0
    scalar_max: float = 0.1
    scalar_resolution: float = 0.001
    season_w: int = 31
    season_radius_days: float = 91.5
    warmup_rows: int = 2
    anomaly_threshold: float = 0.7
    display_window: int = 500
    month_partitions: int = 10
    replay_batch_size: int = 150
    replay_batch_sleep_ms: int = 1000
    batch_interval_ms: int = 5000
    summary_window: str = "60 seconds"

    @property
    def n_buckets(self) -> int:
        """Buckets 0..n_buckets-1 of the scalar encoder (101 by default)."""
        return int(round((self.scalar_max - self.scalar_min) / self.scalar_resolution)) + 1

    @property
    def scalar_bits(self) -> int:
        """Width of the scalar code: buckets + w - 1 bits (151 by default)."""
        return self.n_buckets + self.scalar_w - 1

    @property
    def season_bits(self) -> int:
        """Width of the periodic season code: w * 366 / radius (124 by default)."""
        return int(round(self.season_w * 366 / self.season_radius_days))

    @property
    def display_rows(self) -> int:
        """Rows kept by the display window: one is dropped only when the
        window already holds more than ``display_window`` before a push."""
        return self.display_window + 1


DEFAULT = ScoreSettings()
