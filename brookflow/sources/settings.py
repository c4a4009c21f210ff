"""Case settings (TOML) and the layout of a case folder. Both are driver-side: they configure plans and are never data."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

#: Later names of settings that older files spell otherwise.
ALIASES = {"dir_resultaten": "dir_results", "topo_burn_width_waterways_factor": "topo_burn_width_waterways"}


@dataclass(frozen=True)
class Settings:
    """The case's, the network data's and one generator's values, later sections winning."""

    generator: str
    values: dict[str, Any] = field(default_factory=dict)

    def __getitem__(self, key: str) -> Any:
        return self.values[key]

    def get(self, key: str, default: Any = None) -> Any:
        return self.values.get(key, default)

    def datasets(self) -> dict[str, str]:
        """Dataset name -> file name, of all file_name_<dataset> settings."""
        return {k.removeprefix("file_name_"): v for k, v in self.values.items() if k.startswith("file_name_")}


def load_settings(path: str, generator: str) -> Settings:
    """Merge [case], [networkdata] and [generator]; KeyError if a section is missing."""
    with open(path, "rb") as file:
        sections = tomllib.load(file)
    merged: dict[str, Any] = {}
    for name in ("case", "networkdata", generator):
        merged |= sections[name]
    return Settings(generator, {ALIASES.get(k, k): v for k, v in merged.items()})


def check_case(path: str) -> tuple[Path, Path]:
    """(input folder, result folder): the first must exist, the second is made."""
    base = Path(path)
    if not base.is_dir():
        raise ValueError(f"{base} is no folder")
    data, results = base / "0_basisdata", base / "1_resultaat"
    if not data.is_dir():
        raise ValueError(f"{data} is missing")
    results.mkdir(exist_ok=True)
    return data, results
