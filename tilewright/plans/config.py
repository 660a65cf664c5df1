"""Build settings, and the manifest that hands a run's parameters from step to step."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

MODES = ("tiles", "points")


@dataclass
class Config:
    """Settings of a build; defaults are the production settings."""

    source: str = ""
    source_format: str = "parquet"
    database: str | None = None
    partitions: int | None = None
    target: str = ""
    table_prefix: str = "maps"
    threshold: int = 250_000
    salt_modulus: int = 100
    tile_size: int = 512
    buffer_size: int = 64
    max_zoom: int = 16
    projections: tuple[int, ...] = (3857, 4326, 3575, 3031)
    strict: bool = True
    compat_empty_approve: bool = False

    def __post_init__(self):
        self.projections = tuple(self.projections)
        if not 0 <= self.max_zoom <= 16:
            raise ValueError("max_zoom must be 0 to 16: pixels are 32-bit")
        if self.tile_size < 2 * self.buffer_size:
            raise ValueError("a tile must be at least two buffers wide")
        if self.partitions is not None and self.partitions < 1:
            raise ValueError("partitions must be positive")
        if self.salt_modulus < 1:
            raise ValueError("salt_modulus must be positive")

    @classmethod
    def from_yaml(cls, text: str) -> Config:
        import yaml

        known = {f.name for f in dataclasses.fields(cls)}
        values = yaml.safe_load(text) or {}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**values)

    def replace(self, **values) -> Config:
        return dataclasses.replace(self, **values)


@dataclass
class Manifest:
    """One run: its mode, its table's name and the settings all steps share."""

    mode: str
    timestamp: str
    config: Config = field(default_factory=Config)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")

    @classmethod
    def start(cls, mode: str, config: Config, now: datetime | None = None) -> Manifest:
        return cls(mode, (now or datetime.now()).strftime("%Y%m%d_%H%M"), config)

    @classmethod
    def from_args(cls, args: list[str]) -> Manifest:
        """From the command line: mode, a YAML settings file and, if wanted, the timestamp."""
        if len(args) not in (2, 3):
            raise ValueError("usage: MODE SETTINGS.yml [TIMESTAMP]")
        config = Config.from_yaml(Path(args[1]).read_text())
        return cls(args[0], args[2], config) if len(args) == 3 else cls.start(args[0], config)

    @property
    def table(self) -> str:
        return f"{self.config.table_prefix}_{self.mode}_{self.timestamp}"

    @property
    def families(self) -> list[str]:
        return [f"EPSG_{e}" for e in self.config.projections] if self.mode == "tiles" else ["EPSG_4326"]

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), indent=1, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        values = json.loads(text)
        return cls(values["mode"], values["timestamp"], Config(**values["config"]))
