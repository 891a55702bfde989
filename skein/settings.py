"""Settings of a deployment, read from the environment and checked together."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    batch_size: int = 16
    most_tokens: int = 512
    chunk_limit: int = 448
    chunk_target: int = 400
    chunk_overlap: int = 50
    candidates: int = 50
    publications: int = 15
    years: int = 7
    misses: int = 2
    dense_depth: int = 50
    lexical_depth: int = 50
    fused_depth: int = 100
    owners: int = 10
    fusion_k: int = 60
    listing_spacing: float = 5.0
    catalogue_spacing: float = 1.1

    def __post_init__(self) -> None:
        for f in fields(self):
            if getattr(self, f.name) <= 0:
                raise ValueError(f"{f.name} must be above 0")
        if self.chunk_overlap >= self.chunk_target:
            raise ValueError("chunk_overlap must be below chunk_target")
        if not self.chunk_target <= self.chunk_limit <= self.most_tokens:
            raise ValueError("chunk_target, chunk_limit and most_tokens must not decrease")
        if self.publications > self.candidates:
            raise ValueError("publications must not exceed candidates")


def from_environment(values: Mapping[str, str] = os.environ, prefix: str = "SKEIN_") -> Settings:
    """Settings with the fields that the environment names (SKEIN_BATCH_SIZE and so on)."""
    found = {}
    for f in fields(Settings):
        raw = values.get(prefix + f.name.upper())
        if raw is not None:
            found[f.name] = type(f.default)(raw)
    return Settings(**found)
