"""Configuration: defaults, deep merge with YAML or a dict, and checks."""

from __future__ import annotations

from copy import deepcopy
from dataclasses import dataclass
from pathlib import Path
from typing import Any

# The default distributions and targets.
DEFAULTS: dict[str, Any] = {
    "dataset_name": "scene_graph_claims",
    "version": "1.0",
    "scale": "100k",
    "paths": {"scene_graphs_train": "data/train", "scene_graphs_test": "data/test", "output_dir": "data/generated"},
    "generation": {"seed": 42, "shard_size": 50_000, "rounds": 0, "semantics": "reference"},
    "splits": {"video_split_ratio": {"train": 0.8, "val": 0.1, "test": 0.1}, "val_share": 0.1},
    "distributions": {
        "reasoning_families": {"action": 0.20, "temporal": 0.20, "compositional": 0.20, "object": 0.15, "spatial_contact": 0.15, "grounding": 0.10},
        "task_modalities": {"single_choice": 0.45, "multi_label": 0.20, "binary": 0.25, "three_way": 0.10},
        "option_counts": {"k_2": 0.25, "k_3": 0.10, "k_4_8": 0.25, "k_9_15": 0.20, "k_16_28": 0.15, "k_29_40": 0.05},
        "reasoning_depth": {"hop_1": 0.20, "hop_2": 0.30, "hop_3": 0.30, "hop_4_plus": 0.20},
        "negative_difficulty": {"easy": 0.20, "medium": 0.40, "hard": 0.40},
    },
}
SCALES = {"10k": 10_000, "100k": 100_000, "1m": 1_000_000, "10m": 10_000_000, "100m": 100_000_000}


def merge(base: dict, over: dict) -> dict:
    """``over`` laid over ``base``, dict by dict."""
    out = deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


@dataclass(frozen=True)
class Config:
    raw: dict[str, Any]

    @staticmethod
    def load(source: None | str | Path | dict = None) -> Config:
        """From nothing (the defaults), a YAML file or a dict. ValueError if a distribution doesn't sum to 1."""
        if source is None:
            over = {}
        elif isinstance(source, dict):
            over = source
        elif isinstance(source, str | Path):
            import yaml

            over = yaml.safe_load(Path(source).read_text()) or {}
        else:
            raise TypeError(f"a path or a dict is asked for, not {type(source).__name__}")
        raw = merge(DEFAULTS, over)
        sums = {**raw["distributions"], "video_split_ratio": raw["splits"]["video_split_ratio"]}
        for name, parts in sums.items():
            if abs(sum(parts.values()) - 1) > 1e-4:
                raise ValueError(f"{name} must sum to 1.0, not {sum(parts.values()):.4f}")
        return Config(raw)

    @property
    def seed(self) -> int:
        return int(self.raw["generation"]["seed"])

    @property
    def strict(self) -> bool:
        return self.raw["generation"]["semantics"] == "strict"

    def targets(self) -> dict[str, int]:
        """Examples by split: those given, else four fifths, one tenth and one tenth of the scale."""
        given = self.raw["splits"].get("target_counts")
        if given:
            return {k: int(v) for k, v in given.items()}
        n = SCALES[self.raw["scale"]]
        return {"train": n * 8 // 10, "val": n // 10, "test": n // 10}

    def distribution(self, name: str) -> dict[str, float]:
        return self.raw["distributions"][name]

    def families(self) -> list[str]:
        """The families that have a share."""
        return [f for f, share in self.distribution("reasoning_families").items() if share > 0]

    def output(self, split: str | None = None) -> str:
        base = f"{self.raw['paths']['output_dir'].rstrip('/')}/{self.raw['scale']}"
        return f"{base}/{split}" if split else base
