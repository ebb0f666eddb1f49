"""What a run computes: segments, corrections, thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The default downsampling grid, 36 ratios.
RATIOS = tuple(round(x * 10**e, 6) for e in (-4, -3, -2, -1) for x in (1, 2, 3, 4, 5, 6, 7, 8, 9))
UMI_METHODS = ("unique", "cluster", "adjacency", "directional")


class ConfigError(ValueError):
    """A setting or an input that can't be used."""


@dataclass(frozen=True)
class Correction:
    """How far a barcode may be from its whitelist."""

    enabled: bool = True
    shift: int = 1
    mismatch: int = 1


@dataclass(frozen=True)
class Segment:
    """Where a piece of a barcode or UMI is, by coordinates, by linkers, or by both."""

    name: str
    target: str  # barcode1, barcode2 or umi
    read: str  # R1 or R2
    length: int
    start: int | None = None
    left: str = ""
    right: str = ""
    linker_mismatch: int = 0
    correction: Correction = Correction()

    def __post_init__(self) -> None:
        if self.target not in ("barcode1", "barcode2", "umi"):
            raise ConfigError(f"{self.name}: no target {self.target}")
        if self.read not in ("R1", "R2") or self.length < 1:
            raise ConfigError(f"{self.name}: read must be R1 or R2, length at least 1")
        if self.start is None and not self.left and not self.right:
            raise ConfigError(f"{self.name}: needs a start, a linker, or both")

    @property
    def method(self) -> str:
        linked = bool(self.left or self.right)
        return "linker_fixed" if linked and self.start is not None else "linker" if linked else "fixed"

    @property
    def corrected(self) -> bool:
        return self.target != "umi"

    @property
    def padding(self) -> int:
        """Bases read on both sides of fixed coordinates, for shifts."""
        return self.correction.shift if self.corrected and self.correction.enabled else 0


@dataclass(frozen=True)
class Plan:
    """A run over all samples."""

    segments: tuple[Segment, ...]
    sequence_only: bool = False
    umi_method: str = "directional"
    umi_distance: int = 1
    dominance: float = 0.8
    min_parent_reads: int = 5
    parent_child_ratio: float = 10.0
    ratios: tuple[float, ...] = RATIOS
    repeats: int = 1
    seed: int = 1
    library: str = ""
    names: dict[str, str] = field(default_factory=lambda: {"barcode1": "CELL", "barcode2": "FB", "umi": "UMI"})

    def __post_init__(self) -> None:
        for target in ("barcode1", "barcode2", "umi"):
            if not self.of(target):
                raise ConfigError(f"no segment for {target}")
        if len({s.name for s in self.segments}) < len(self.segments):
            raise ConfigError("segments share a name")
        if self.umi_method not in UMI_METHODS:
            raise ConfigError(f"no UMI method {self.umi_method}")
        if not 0 <= self.dominance <= 1 or not all(0 <= r <= 1 for r in self.ratios):
            raise ConfigError("dominance and ratios are from 0 to 1")
        if self.library not in ("", "pi-seq", "pb-cb"):
            raise ConfigError(f"no library type {self.library}")
        if self.library == "pb-cb" and (not self.sequence_only or any(s.correction.enabled for s in self.of("barcode2"))):
            raise ConfigError("pb-cb needs sequence_only and barcode2 without correction")
        if self.min_parent_reads < 1 or self.parent_child_ratio < 1:
            raise ConfigError("min_parent_reads and parent_child_ratio are at least 1")

    def of(self, target: str) -> tuple[Segment, ...]:
        return tuple(s for s in self.segments if s.target == target)

    @property
    def grid(self) -> list[tuple[float, int]]:
        """(ratio, repeat): the ends once as repeat 0, others once for each repeat."""
        inner = sorted(set(self.ratios) - {0.0, 1.0})
        return [(0.0, 0), *((r, k) for r in inner for k in range(1, self.repeats + 1)), (1.0, 0)]
