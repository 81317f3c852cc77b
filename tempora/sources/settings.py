"""Settings read from TOML: checked types and ranges, unknown keys are errors."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields
from typing import Any


@dataclass(frozen=True)
class Settings:
    """Thresholds of the operators; times in seconds. They become literals in plans."""

    release_seconds: float = 35.0
    singing_threshold: float = 0.05
    overlap_seconds: float = 0.5
    context_seconds: float = 0.5
    target_window_seconds: float = 60.0
    longest_window_seconds: float = 90.0
    match_threshold: float = 0.32
    match_margin: float = 0.03
    window_units: int = 600
    batch_units: int = 200
    batch_chars: int = 8000
    concurrency: int = 16

    def __post_init__(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, bool) or not isinstance(value, (int, float)):
                raise ValueError(f"{f.name} must be a number")
            if f.type == "int" and not isinstance(value, int):
                raise ValueError(f"{f.name} must be a whole number")
            if value < 0 or (f.type == "int" and value == 0):
                raise ValueError(f"{f.name} is out of range")
        if self.target_window_seconds > self.longest_window_seconds:
            raise ValueError("target_window_seconds exceeds longest_window_seconds")
        if not 0 <= self.match_threshold <= 2:
            raise ValueError("match_threshold is out of range")


def from_toml(text: str) -> Settings:
    values: dict[str, Any] = tomllib.loads(text)
    unknown = sorted(set(values) - {f.name for f in fields(Settings)})
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return Settings(**values)
