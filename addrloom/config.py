"""Configuration: defaults, YAML with ${VARIABLES}, ranges."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path

from .sources.readers import expand_variables

# Ranges of tunables.
RANGES = {"batch_size": (100, 1000), "memory_share": (0.80, 0.98), "queue_size": (5, 20), "cpu_ratio": (0.001, 0.5), "target_rate": (500, 3000), "fuzzy_threshold": (0.0, 1.0), "complexity_threshold": (0.0, 1.0)}
PARSERS = ("rules", "entities", "generic_entities", "components", "answers", "keywords", "routed")
#: Names that older configurations and environments use, and what they are called here.
OLD_NAMES = {
    "gpu_batch_size": "batch_size", "gpu_memory": "memory_share", "gpu_memory_fraction": "memory_share", "gpu_queue_size": "queue_size", "cpu_allocation": "cpu_ratio",
    "cpu_allocation_ratio": "cpu_ratio", "throughput": "target_rate", "target_throughput": "target_rate", "parser": "parser_type", "similarity_threshold": "fuzzy_threshold",
    "input_file": "input_path", "output_file": "output_path",
}
ENVIRONMENT = {"BATCH_SIZE": "batch_size", "GPU_BATCH_SIZE": "batch_size", "GPU_MEMORY": "memory_share", "CPU_RATIO": "cpu_ratio", "TARGET_THROUGHPUT": "target_rate", "QUEUE_SIZE": "queue_size"}


class ConfigurationError(ValueError):
    """A configuration that can't be used; the message says all that is wrong."""


@dataclass
class Config:
    input_path: str = ""
    output_path: str = ""
    report_path: str = ""
    batch_input: list[str] = field(default_factory=list)
    batch_output: str = ""
    parser_type: str = "rules"
    required_columns: list[str] = field(default_factory=lambda: ["addr_text", "pincode", "city_id"])
    fuzzy: bool = False
    normalize: bool = True
    fuzzy_threshold: float = 0.85
    complexity_threshold: float = 0.6
    batch_size: int = 400
    memory_share: float = 0.95
    queue_size: int = 10
    cpu_ratio: float = 0.02
    target_rate: int = 2000

    def problems(self) -> list[str]:
        """All that is wrong, not only the first."""
        out = [f"{k} must be between {a} and {b}" for k, (a, b) in RANGES.items() if not a <= getattr(self, k) <= b]
        if self.parser_type not in PARSERS:
            out.append("parser_type must be one of " + ", ".join(PARSERS))
        if not self.input_path and not self.batch_input:
            out.append("input_path or batch_input is missing")
        if self.input_path and self.batch_input:
            out.append("input_path and batch_input exclude each other")
        if self.output_path and self.batch_output:
            out.append("output_path and batch_output exclude each other")
        if self.input_path and not self.output_path:
            out.append("output_path is missing")
        if self.batch_input and not self.batch_output:
            out.append("batch_output is missing")
        return out

    def warnings(self) -> list[str]:
        """What works, but may not work well together."""
        return ["a high cpu_ratio with a large batch_size may slow both"] if self.batch_size > 600 and self.cpu_ratio > 0.05 else []


def read(path: str) -> dict:
    """The values of a YAML file (or of its subset of `key: value` lines where no YAML library is installed), with variables replaced."""
    text = expand_variables(Path(path).read_text(encoding="utf-8"), dict(os.environ))
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        values = {}
        for line in text.splitlines():
            if ":" in line and not line.lstrip().startswith("#"):
                k, _, v = line.partition(":")
                v = v.split(" #")[0].strip().strip("\"'")
                values[k.strip()] = {"true": True, "false": False}.get(v.lower(), v)
        return values


def load(path: str, overrides: dict | None = None) -> Config:
    """The configuration of a file; overrides come first. Raises ConfigurationError with all problems."""
    return build(read(path) | (overrides or {}))


def _listed(value: object) -> list[str]:
    if isinstance(value, str):
        return [x.strip() for x in value.strip("[]").split(",") if x.strip()]
    return [str(x) for x in value]


def build(values: dict) -> Config:
    """A configuration of these values, converted to their types."""
    known = {f.name: f.type for f in fields(Config)}
    if unknown := sorted(set(values) - set(known)):
        raise ConfigurationError("unknown keys: " + ", ".join(unknown))
    truth = lambda v: v if isinstance(v, bool) else str(v).strip().lower() in ("true", "1", "yes", "on")
    kinds = {"int": int, "float": float, "bool": truth, "str": str, "list[str]": _listed}
    own, bad = {}, []
    for k, v in values.items():
        try:
            own[k] = kinds[known[k]](v)
        except (TypeError, ValueError):
            bad.append(f"{k} is not a valid {known[k]}: {v}")
    if bad:
        raise ConfigurationError("; ".join(bad))
    out = Config(**own)
    if found := out.problems():
        raise ConfigurationError("; ".join(found))
    return out


def migrated(old: dict, env: dict[str, str] | None = None) -> tuple[dict, list[str]]:
    """An older configuration under today's names, and what could not be taken over. Values of the environment come first, then the file's; the rest keeps its default."""
    known = {f.name: f.type for f in fields(Config)}
    out, left = {}, []
    found = {ENVIRONMENT[k]: v for k, v in (env or {}).items() if k in ENVIRONMENT}
    for k, v in [*old.items(), *found.items()]:
        name = OLD_NAMES.get(k, k)
        if name not in known:
            left.append(k)
            continue
        try:
            out[name] = {"int": int, "float": float}.get(known[name], lambda x: x)(v)
        except (TypeError, ValueError):
            left.append(k)
    return out, left


def write(values: dict, path: str) -> None:
    """Writes `key: value` lines, which `load` reads back."""
    Path(path).write_text("".join(f"{k}: {str(v).lower() if isinstance(v, bool) else '[' + ', '.join(v) + ']' if isinstance(v, list) else v}\n" for k, v in values.items()), encoding="utf-8")
