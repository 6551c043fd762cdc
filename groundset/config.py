"""Run configurations: nested sections from a mapping or a YAML file; unknown keys are ignored, missing ones take their defaults."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import field, make_dataclass
from pathlib import Path
from typing import Any

from groundset.functions.text import config_hash

#: The sections of a run with the names and defaults of their settings.
SECTIONS: dict[str, dict[str, Any]] = {
    "model": {"model_id": "Qwen/Qwen3.5-9B", "trust_remote_code": False, "dtype": "bfloat16", "use_qlora": False, "lora_r": 16, "lora_alpha": 32, "lora_dropout": 0.05, "lora_target_modules": ["q_proj", "v_proj", "k_proj", "o_proj"], "lora_bias": "none", "router_aux_loss_coef": 0.001},
    "data": {"train_path": "data/train.jsonl", "eval_path": None, "max_length": None, "packing": False, "chunk_overlap": None, "dataset_num_proc": 4, "shuffle": True, "pad_to_multiple_of": None},
    "training": {
        "output_dir": "outputs/run", "per_device_train_batch_size": 2, "per_device_eval_batch_size": 2, "gradient_accumulation_steps": 1, "num_train_epochs": 3.0, "max_steps": -1, "learning_rate": 1e-4, "lr_scheduler_type": "linear", "warmup_steps": 0, "weight_decay": 0.0, "max_grad_norm": 1.0, "gradient_checkpointing": True,
        "bf16": True, "fp16": False, "logging_steps": 10, "save_strategy": "steps", "save_steps": 500, "save_total_limit": 3, "eval_strategy": "no", "eval_steps": None, "report_to": ["tensorboard"], "seed": 42, "dry_run": False, "dry_run_steps": 2, "assistant_only_loss": False, "precompute_ref_log_probs": False,
    },
    "grpo": {"num_generations": 8, "max_completion_length": 512, "temperature": 1.0, "use_vllm": False, "vllm_mode": "colocate", "beta": 0.0, "loss_type": "dapo", "log_completions": False},
    "build": {"mode": "bbox_to_text", "box_format": "qwen", "max_lines": None, "max_n": 3, "seed": 42},
}
METHODS = ("sft", "dpo", "kto", "grpo")


def _section(name: str, settings: dict[str, Any]) -> type:
    kept = [(k, Any, field(default_factory=lambda v=v: list(v)) if isinstance(v, list) else field(default=v)) for k, v in settings.items()]
    return make_dataclass(f"{name.capitalize()}Config", kept, module=__name__)


KINDS = {name: _section(name, settings) for name, settings in SECTIONS.items()}
DataConfig, BuildConfig = KINDS["data"], KINDS["build"]
RunConfig = make_dataclass("RunConfig", [("method", str, field(default="sft")), *((n, k, field(default_factory=k)) for n, k in KINDS.items())], module=__name__)


def from_mapping(kind: type, values: dict[str, Any] | None) -> Any:
    """An instance from a mapping, its sections included."""
    known = {f.name for f in dataclasses.fields(kind)}
    made = {k: from_mapping(KINDS[k], v) if k in KINDS and isinstance(v, dict | None) else v for k, v in (values or {}).items() if k in known}
    return kind(**made)


def load(path: str | os.PathLike | None) -> Any:
    """A run configuration from a YAML or JSON file; the defaults if there is none."""
    if path is None:
        return RunConfig()
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return from_mapping(RunConfig, json.loads(text or "{}"))
    return from_mapping(RunConfig, yaml.safe_load(text))


def metadata(config: Any, commit: str | None = None) -> dict[str, Any]:
    """What a run writes beside its data."""
    as_dict = dataclasses.asdict(config)
    return {"git_commit": commit, "config": as_dict, "config_hash": config_hash(as_dict)}


def run_folder(base: str | os.PathLike, config: Any) -> Path:
    """The folder of a run, made if it isn't there: the method and the hash of its configuration."""
    out = Path(base) / f"{config.method}-{config_hash(dataclasses.asdict(config))}"
    out.mkdir(parents=True, exist_ok=True)
    return out
