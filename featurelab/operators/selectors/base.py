"""What every selector takes and returns."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Protocol, TypeVar

from pyspark.sql import DataFrame

from featurelab.operators.splits import Roles, Splits


@dataclass(frozen=True)
class SelectorResult:
    """`drop` is in feature order; `reports` are small tables, one row per fold and feature or so."""

    drop: tuple[str, ...]
    reports: Mapping[str, DataFrame] = field(default_factory=dict)
    kept: tuple[str, ...] = ()


class Selector(Protocol):
    def __call__(
        self, splits: Splits, roles: Roles, features: Sequence[str], settings: object, task: str,
        keys: Sequence[str],
    ) -> SelectorResult: ...


S = TypeVar("S")


def settings_from(kind: type[S], section: Mapping | None) -> S:
    """The settings dataclass with the keys it knows taken from a configuration section."""
    known = {f.name for f in fields(kind)}
    ignored = sorted(set(section or {}) - known)
    if ignored:
        warnings.warn(f"{kind.__name__} has no settings {ignored}; they are ignored", stacklevel=2)
    return kind(**{k: v for k, v in (section or {}).items() if k in known})


def require(features: Sequence[str]) -> tuple[str, ...]:
    if not features:
        raise ValueError("the list of features is empty")
    return tuple(features)


def keep_only(features: Sequence[str], kept: Sequence[str]) -> tuple[str, ...]:
    """The features that were not kept."""
    chosen = set(kept)
    return tuple(c for c in features if c not in chosen)
