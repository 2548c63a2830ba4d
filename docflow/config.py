"""Names and thresholds that depend on the installation, not on the engine."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class States:
    """Names of the workflow states."""

    imported: str = "import"
    analysed: str = "analyse"
    supervised: str = "supervise"
    verified: str = "verify"
    supervised_again: str = "supervise_again"
    exported: str = "export"


@dataclass(frozen=True)
class Labels:
    """Values of the page classifier."""

    positive: str = "target"
    negative: str = "other"
    unclear: str = "unclear"

    @property
    def allowed(self) -> tuple[str, ...]:
        return self.positive, self.negative, self.unclear


@dataclass(frozen=True)
class Config:
    states: States = field(default_factory=States)
    labels: Labels = field(default_factory=Labels)
    label_field: str = "LABEL_CODE"
    system_actor: str = "SYSTEM"
    service_prefix: str = "SVC"
    lookup_columns: tuple[str, ...] = ("category", "class_name", "action", "detail")
    low_confidence: float = 0.60
    audit_share: float = 0.05
    audit_least: int = 20
    audit_most: int = 400
    retention_days: int = 30


DEFAULT = Config()
