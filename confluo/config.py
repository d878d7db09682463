"""Settings from a document with ${VARIABLE:-default} in its texts, checked when they are read."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def expanded(value, environment: Mapping[str, str] | None = None):
    """The value with variables filled in, in lists and mappings too; a variable without value and default is an error."""
    env = os.environ if environment is None else environment
    if isinstance(value, str):

        def one(m: re.Match) -> str:
            found = env.get(m.group(1)) or m.group(2)
            if found is None:
                raise KeyError(f"{m.group(1)} is not set")
            return found

        return _VARIABLE.sub(one, value)
    if isinstance(value, Mapping):
        return {k: expanded(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, env) for v in value]
    return value


@dataclass(frozen=True)
class Settings:
    link_threshold: float = 0.95
    quality_threshold: float = 0.95
    attempts: int = 3
    batch_rows: int = 50_000
    sources: Mapping[str, Mapping] = field(default_factory=dict)
    data_sets: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in ("link_threshold", "quality_threshold"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must be between 0 and 1")
        for name in ("attempts", "batch_rows"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")


def settings(path: str, environment: Mapping[str, str] | None = None) -> Settings:
    """Settings of a JSON or YAML file (the latter where a YAML reader is installed); unknown names are an error."""
    text = Path(path).read_text()
    if path.endswith((".yml", ".yaml")):
        import yaml

        document = yaml.safe_load(text)
    else:
        document = json.loads(text)
    unknown = set(document) - set(Settings.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**expanded(document, environment))
