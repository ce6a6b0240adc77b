"""Stage settings from YAML, with a default for each key, and layered dictionaries."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any, TypeVar

import yaml

from ..operators.dedup import SURVIVORS
from ..operators.rules import Rules
from ..operators.validate import Limits

T = TypeVar("T")


@dataclass(frozen=True)
class Dedup:
    exact: bool = True
    semantic: bool = True
    threshold: float = 0.9
    cross_page: bool = True
    strategy: str = "longer_answer"
    batch: int = 64


@dataclass(frozen=True)
class Output:
    ratio: float = 0.9
    seed: int = 42
    image_mode: str = "symlink"
    image_dir: str = "images"
    normalize_names: bool = True
    stratify_by: str | None = "section_id"
    #: Accepted for old files; strata of any size are split alike.
    min_stratum_size: int = 10


@dataclass(frozen=True)
class Upload:
    repo_id: str = ""
    private: bool = False
    message: str = "Update dataset"
    card: dict[str, Any] = field(default_factory=dict)


#: Keys of the YAML file by stage and field; fields that aren't listed have their own name there.
KEYS = {
    "filters": {"min_answer": "min_answer_length", "max_answer": "max_answer_length", "min_question": "min_question_length", "question_mark": "require_question_mark", "generic_answers": "generic_answer_patterns", "self_references": "self_referential_patterns", "question_types": "valid_question_types", "max_similarity": "max_question_similarity", "min_types": "min_question_types_per_page"},
    "deduplication": {"exact": "enable_exact_match", "semantic": "enable_semantic", "threshold": "similarity_threshold", "cross_page": "cross_page_enabled", "strategy": "prefer_strategy", "batch": "embedding_batch_size"},
    "output": {"ratio": "train_split", "seed": "random_seed", "image_mode": "image_copy_mode", "image_dir": "image_output_dir", "normalize_names": "normalize_image_names"},
    "vlm_validation": {"require_image": "require_image_field", "check_images": "check_image_exists", "min_width": "min_image_width", "min_height": "min_image_height", "min_question": "min_question_length", "min_answer": "min_answer_length", "max_answer": "max_answer_length", "min_section": "min_qa_per_section", "max_section": "max_qa_per_section"},
    "upload": {"message": "commit_message", "card": "dataset_card"},
}
STAGES = {"filters": Rules, "deduplication": Dedup, "output": Output, "vlm_validation": Limits, "upload": Upload}


def read_yaml(path: str | None) -> dict:
    """A YAML file as a dictionary; without a path, or for an empty file, an empty one."""
    return (yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}) if path else {}


def stage_settings(raw: dict, stage: str):
    """Settings of a stage from the whole file, defaults for absent keys; impossible values are errors."""
    kind, names, given = STAGES[stage], KEYS[stage], raw.get(stage) or {}
    values = {}
    for f in fields(kind):
        key = names.get(f.name, f.name)
        if key in given:
            v = given[key]
            values[f.name] = tuple(v) if isinstance(v, list) else v
    made = kind(**values)
    if stage == "output":
        if not 0 < made.ratio < 1:
            raise ValueError("train_split must lie between 0 and 1")
        if made.image_mode not in ("symlink", "copy", "relative"):
            raise ValueError(f"no such image_copy_mode: {made.image_mode}")
        if made.stratify_by == "none":
            made = Output(**(values | {"stratify_by": None}))
    if stage == "deduplication" and made.strategy not in SURVIVORS:
        raise ValueError(f"no such prefer_strategy: {made.strategy}")
    return made


def layered(*layers: dict) -> dict:
    """Dictionaries merged, later ones first; dictionaries within are merged too."""
    out: dict = {}
    for layer in layers:
        for k, v in layer.items():
            out[k] = layered(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
