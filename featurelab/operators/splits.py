"""The three parallel tables and the roles of their columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DecimalType,
)


@dataclass(frozen=True)
class Splits:
    """Train is required, validation and scoring may be absent."""

    train: DataFrame
    valid: DataFrame | None = None
    scoring: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.train is None:
            raise ValueError("a train table is required")

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Splits:
        return Splits(*(df if df is None else change(df) for df in self))

    def __iter__(self):
        return iter((self.train, self.valid, self.scoring))


@dataclass(frozen=True)
class Roles:
    """What each column is for. `features` keeps the table's column order."""

    index: str
    target: str | None
    skip: tuple[str, ...] = ()
    features: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    other: tuple[str, ...] = ()

    @property
    def numeric(self) -> tuple[str, ...]:
        return tuple(c for c in self.features if c not in self.categorical)

    def without(self, names: Iterable[str]) -> Roles:
        gone = set(names)
        return replace(
            self,
            features=tuple(c for c in self.features if c not in gone),
            categorical=tuple(c for c in self.categorical if c not in gone),
            other=tuple(c for c in self.other if c not in gone),
        )

    def as_numeric(self, names: Iterable[str]) -> Roles:
        """The same features, with `names` no longer categorical."""
        moved = set(names)
        return replace(self, categorical=tuple(c for c in self.categorical if c not in moved))

    def role_of(self, name: str) -> str:
        if name == self.index:
            return "index"
        if name == self.target:
            return "target"
        if name in self.skip:
            return "skip"
        if name in self.categorical:
            return "categorical"
        return "numeric" if name in self.features else "other"


def classify(
    df: DataFrame,
    index: str,
    target: str | None = None,
    skip: Sequence[str] = (),
    force_categorical: Sequence[str] = (),
) -> Roles:
    """Derive the roles from the schema.

    Strings and forced columns are categorical, numbers and booleans numeric;
    dates, arrays and the like get the role "other" and are never features.
    """
    reserved = {index, target, *skip}
    fields = [f for f in df.schema.fields if f.name not in reserved]
    categorical = [
        f.name for f in fields if f.name in force_categorical or isinstance(f.dataType, T.StringType)
    ]
    numeric = [
        f.name for f in fields if f.name not in categorical and isinstance(f.dataType, NUMERIC_TYPES)
    ]
    known = {*categorical, *numeric}
    return Roles(
        index=index,
        target=target,
        skip=tuple(skip),
        features=tuple(f.name for f in fields if f.name in known),
        categorical=tuple(categorical),
        other=tuple(f.name for f in fields if f.name not in known),
    )


def settle_types(df: DataFrame, roles: Roles) -> DataFrame:
    """Forced-categorical columns become strings, booleans become 0/1."""
    types = dict(df.dtypes)
    to_text = [c for c in roles.categorical if c in types and types[c] != "string"]
    to_int = [c for c in roles.numeric if types.get(c) == "boolean"]
    changes = {c: F.col(c).cast("string") for c in to_text} | {c: F.col(c).cast("int") for c in to_int}
    return df.withColumns(changes) if changes else df


def match_types(df: DataFrame, model: DataFrame) -> DataFrame:
    """Give each column that `model` also has the type it has there."""
    wanted = {f.name: f.dataType for f in model.schema.fields}
    changes = {
        f.name: F.col(f.name).cast(wanted[f.name])
        for f in df.schema.fields
        if f.name in wanted and f.dataType != wanted[f.name]
    }
    return df.withColumns(changes) if changes else df
