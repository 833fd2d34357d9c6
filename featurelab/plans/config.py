"""The configuration: a nested mapping with the sections common, sampling, artifacts,
result, preprocessing and pipeline_steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from featurelab.operators.models import Task


def read_yaml(path: str) -> dict:
    """Load a configuration file; needs PyYAML, which is otherwise not required."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading a YAML configuration needs PyYAML; pass a mapping instead") from missing
    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)


def _identity(name: str) -> bool:
    if name not in ("key", "content"):
        raise ValueError(f"unknown row_identity: {name!r}")
    return name == "content"


@dataclass(frozen=True)
class Config:
    index: str
    target: str | None
    task: str = "binary_classification"
    skip: tuple[str, ...] = ()
    force_drop: tuple[str, ...] = ()
    row_key: tuple[str, ...] = ()
    by_content: bool = False  # common.row_identity: content
    steps: tuple[str, ...] = ()
    sampling: Mapping = field(default_factory=dict)
    artifacts: str | None = None
    result: Mapping | None = None
    sections: Mapping = field(default_factory=dict)

    @staticmethod
    def of(source: Mapping | str | Config) -> Config:
        if isinstance(source, Config):
            return source
        if isinstance(source, str):
            source = read_yaml(source)
        common = source["common"]
        index = common["index_col"]
        config = Config(
            index=index,
            target=common.get("target_col"),
            task=common.get("task_type", "binary_classification"),
            skip=tuple(common.get("skip_cols") or ()),
            force_drop=tuple(common.get("force_drop_cols") or ()),
            row_key=tuple(common.get("row_key") or (index,)),
            by_content=_identity(common.get("row_identity", "key")),
            steps=tuple(source.get("pipeline_steps") or ()),
            sampling=source.get("sampling") or {},
            artifacts=(source.get("artifacts") or {}).get("path"),
            result=source.get("result"),
            sections=source.get("preprocessing") or {},
        )
        Task.of(config.task)
        return config

    def section(self, name: str) -> Mapping:
        return self.sections.get(name) or {}

    @property
    def dedup_subset(self) -> Sequence[str]:
        return list(self.section("deduplicate").get("subset") or [self.index])
