"""Run settings: dataclasses to and from JSON; unknown keys are errors."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime
from pathlib import Path

from . import model


@dataclass
class Processing:
    min_genes: int = model.MIN_GENES_PER_CELL
    min_cells: int = model.MIN_CELLS_PER_GENE
    top: int = model.TOP_GENES
    k: int = model.NEIGHBOURS
    n_components: int = model.COMPONENTS
    target: float = model.FEATURE_TARGET
    by_donor: bool = False


@dataclass
class Config:
    processing: Processing = field(default_factory=Processing)
    output_base: str = "output"

    @classmethod
    def from_dict(cls, values: dict) -> Config:
        return cls(Processing(**values.get("processing", {})), **{k: v for k, v in values.items() if k != "processing"})

    @classmethod
    def load(cls, path: str) -> Config:
        return cls.from_dict(json.loads(Path(path).read_text()))

    def to_dict(self) -> dict:
        return asdict(self)

    def run_folder(self, name: str | None = None) -> Path:
        """SK11: a new folder for a run, with these settings beside its results."""
        folder = Path(self.output_base) / f"{name or 'run'}_{datetime.now():%Y%m%d_%H%M%S}"
        folder.mkdir(parents=True)
        (folder / "config.json").write_text(json.dumps(self.to_dict(), indent=2))
        return folder
