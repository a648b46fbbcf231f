"""Parameters of a run: nested dataclasses with presets, checks, and files."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field

from annulet.operators.classify import Rules


class ConfigError(ValueError):
    """A parameter is outside its range."""


@dataclass(frozen=True)
class Tandem:
    min_match: float = 99.0


@dataclass(frozen=True)
class Chimeric:
    min_loci: int = 2
    min_match_degree: float = 95.0


@dataclass(frozen=True)
class SplitReads:
    mapq: int = 30
    min_depth: float = 5.0
    min_size: int = 200
    support: int = 3
    gap: int = 10
    overlap: int = 10
    distance: int = 1000


@dataclass(frozen=True)
class Curate:
    min_segments: int = 3
    min_splits: int = 0


@dataclass(frozen=True)
class Unify:
    share: float = 0.99
    tolerance: int = 20
    method: str = "overlap"


@dataclass(frozen=True)
class Config:
    prefix: str = "sample"
    tandem: Tandem = field(default_factory=Tandem)
    rules: Rules = field(default_factory=Rules)
    chimeric: Chimeric = field(default_factory=Chimeric)
    split_reads: SplitReads = field(default_factory=SplitReads)
    curate: Curate = field(default_factory=Curate)
    unify: Unify = field(default_factory=Unify)

    def check(self) -> Config:
        """self, or an error that lists everything outside its range."""
        share = lambda x: 0 <= x <= 1
        tests = {
            "prefix": bool(self.prefix) and "/" not in self.prefix, "tandem.min_match": 0 <= self.tandem.min_match <= 100, "rules.gap_percent": 0 <= self.rules.gap_percent <= 100,
            "rules.theta_u": share(self.rules.theta_u), "rules.theta_m": share(self.rules.theta_m), "rules.theta_u2_max": share(self.rules.theta_u2_max), "rules.theta_locus": share(self.rules.theta_locus),
            "rules.pos_tol": self.rules.pos_tol >= 0, "chimeric.min_loci": self.chimeric.min_loci >= 2, "chimeric.min_match_degree": 0 <= self.chimeric.min_match_degree <= 105,
            "split_reads.mapq": 0 <= self.split_reads.mapq <= 60, "split_reads.min_depth": self.split_reads.min_depth > 0, "split_reads.min_size": self.split_reads.min_size > 0,
            "split_reads.support": self.split_reads.support >= 1, "curate.min_segments": self.curate.min_segments >= 2, "unify.share": share(self.unify.share), "unify.tolerance": self.unify.tolerance >= 0,
            "unify.method": self.unify.method in ("overlap", "exact"),
        }
        wrong = [name for name, ok in tests.items() if not ok]
        if wrong:
            raise ConfigError("out of range: " + ", ".join(wrong))
        return self

    def with_preset(self, name: str) -> Config:
        """'relaxed', 'balanced' or 'strict' thresholds."""
        try:
            return dataclasses.replace(self, rules=Rules.preset(name))
        except KeyError:
            raise ConfigError(f"unknown preset {name!r}") from None

    def fingerprint(self) -> str:
        """The same for equal parameters."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True).encode()).hexdigest()[:16]


def from_dict(values: dict) -> Config:
    """A checked configuration; unknown names are an error."""
    base = Config()
    parts = {}
    for name, value in values.items():
        if name not in {f.name for f in dataclasses.fields(Config)}:
            raise ConfigError(f"unknown section {name!r}")
        try:
            parts[name] = dataclasses.replace(getattr(base, name), **value) if isinstance(value, dict) else value
        except TypeError as e:
            raise ConfigError(f"{name}: {e}") from None
    return dataclasses.replace(base, **parts).check()


def load(path: str) -> Config:
    """From JSON, or YAML where a YAML library is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError:
            raise ConfigError("no YAML library here; write the configuration as JSON") from None
        return from_dict(yaml.safe_load(text) or {})
    return from_dict(json.loads(text or "{}"))


def save(config: Config, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(dataclasses.asdict(config), f, indent=2)
