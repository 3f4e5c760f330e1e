"""Settings of the operators, with their usual values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Label 0 stands for every species outside the target list.
OTHER = "Other"
DEFAULT_SPECIES = [
    OTHER,
    "Rhinella marina",
    "Crinia signifera",
    "Limnodynastes peronii",
    "Litoria moorei",
    "Litoria fallax",
    "Limnodynastes tasmaniensis",
    "Crinia parinsignifera",
    "Limnodynastes dumerilii",
    "Litoria caerulea",
    "Litoria ewingii",
    "Litoria verreauxii",
    "Litoria rubella",
    "Crinia glauerti",
    "Litoria peronii",
    "Litoria ridibunda",
]


@dataclass(frozen=True)
class CleaningCriteria:
    """Which flagged recordings may stay."""

    allow_duplicates: bool = False
    allow_inappropriate: bool = False
    allow_people_activity: bool = False
    avoid_poor_quality: bool = True


@dataclass(frozen=True)
class ClassMapping:
    """Class labels 0..n-1 by position in ``species``."""

    species: tuple[str, ...] = tuple(DEFAULT_SPECIES)

    def __post_init__(self):
        if len(set(self.species)) != len(self.species):
            raise ValueError("species names in a class mapping must be unique")

    @classmethod
    def from_dict(cls, labels: dict[int, str]) -> "ClassMapping":
        """Accept ``{label: species}``; labels must be 0..n-1 in order."""
        if list(labels) != list(range(len(labels))):
            raise ValueError(f"class labels must be 0..{len(labels) - 1} in order, got {list(labels)}")
        return cls(tuple(labels.values()))

    @property
    def labels(self) -> range:
        return range(len(self.species))

    @property
    def other_label(self) -> int | None:
        return self.species.index(OTHER) if OTHER in self.species else None


@dataclass(frozen=True)
class SamplingStrategy:
    """How the modelling set is drawn from the cleaned recordings."""

    species_data_to_use: str | None = "single-species-only"
    target_sampling: str = "downsample"
    max_samples_per_class: int | None = 1300
    include_other: bool = True
    other_sampling: str = "random"
    other_boost: float = 1.0
    exclude_other_below_count: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class EmbeddingSettings:
    """Settings under which a feature vector was made; part of its key in the store."""

    strategy: str = "stack"
    source: str = "net"
    window_sec: float = 3.0
    overlap_sec: float = 0.0


@dataclass(frozen=True)
class EvaluationSettings:
    """Pooling and thresholds used by the evaluation run."""

    pooling: str = "mean"
    k: int = 3
    confidence_threshold: float | None = None
    legacy_eval: bool = False
    n_classes: int = field(default=len(DEFAULT_SPECIES))
