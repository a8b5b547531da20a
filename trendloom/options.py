"""Settings of a trend job, validated on the driver before any plan is built."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING, Any

from trendloom.schema import INTERVALS, Interval

if TYPE_CHECKING:
    from trendloom.operators.aggregates import Aggregate
    from trendloom.operators.points import PointSpec
    from trendloom.operators.rules import Rule

MICROS_PER_UNIT = {"micros": 1, "millis": 1_000, "seconds": 1_000_000}
RANK_RULES = ("half_up", "ceil")
ENCODERS = ("period", "base64", "noop")
ENCODER_ALIASES = {"periodreplacement": "period"}


@dataclass(frozen=True)
class HistogramOptions:
    """Range and resolution of the latency histogram.

    ``rank_rule`` picks the rank of percentile p among N values: ``half_up`` is
    floor(p/100*N + 0.5), ``ceil`` is ceil(p/100*N); both are at least 1.
    """

    max_value: int = 1_800_000
    precision: int = 2
    unit: str | None = "millis"
    rank_rule: str = "half_up"

    def __post_init__(self) -> None:
        unit = "micros" if self.unit is None else self.unit.lower()
        if unit not in MICROS_PER_UNIT:
            raise ValueError(f"unknown histogram unit {self.unit!r}, use millis, micros or seconds")
        object.__setattr__(self, "unit", unit)
        if not 0 <= self.precision <= 5:
            raise ValueError(f"histogram precision must be 0 to 5, got {self.precision}")
        if not 2 <= self.max_value < 2**31:
            raise ValueError(f"histogram max_value must be 2 to 2^31-1, got {self.max_value}")
        if self.rank_rule not in RANK_RULES:
            raise ValueError(f"rank_rule must be one of {RANK_RULES}, got {self.rank_rule!r}")

    @property
    def unit_us(self) -> int:
        return MICROS_PER_UNIT[self.unit]


def encoder_name(name: str) -> str:
    lowered = name.lower()
    lowered = ENCODER_ALIASES.get(lowered, lowered)
    if lowered not in ENCODERS:
        raise ValueError(f"unknown name encoder {name!r}, use one of {ENCODERS}")
    return lowered


def parse_tags(tags: Mapping[str, Any] | str | None) -> dict[str, str]:
    """Constant tags given as a mapping or as a JSON object in a string; nested keys are dotted."""
    if tags is None:
        return {}
    if isinstance(tags, str):
        tags = json.loads(tags) if tags.strip() else {}
    if not isinstance(tags, Mapping):
        raise ValueError("additional tags must be an object of names and values")
    flat: dict[str, str] = {}
    for key, value in tags.items():
        if isinstance(value, Mapping):
            flat.update({f"{key}.{k}": v for k, v in parse_tags(value).items()})
        elif isinstance(value, bool):
            flat[key] = "true" if value else "false"
        elif value is not None:
            flat[key] = str(value)
    return flat


def _default_transformers() -> tuple[Callable[[], PointSpec], ...]:
    from trendloom.operators.points import DEFAULT_TRANSFORMERS

    return DEFAULT_TRANSFORMERS


def _default_rules() -> tuple[Rule, ...]:
    from trendloom.operators.rules import DEFAULT_RULES

    return DEFAULT_RULES


def _default_aggregates() -> tuple[Aggregate, ...]:
    from trendloom.operators.aggregates import DEFAULT_AGGREGATES

    return DEFAULT_AGGREGATES


@dataclass(frozen=True)
class TrendOptions:
    """Everything a trend job can be told.

    ``emit`` is ``all`` (every window with an accepted point) or ``closed`` (only windows that
    later points of the same trend have pushed out). ``arrival_block`` is the width, in units of the
    ``arrival`` column, of the slices in which the strict mode pre-aggregates; it never changes results.
    """

    encoder: str = "period"
    service_level: bool = True
    deny: tuple[str, ...] = ()
    product: str = "tracing"
    intervals: tuple[Interval, ...] = INTERVALS
    histogram: HistogramOptions = field(default_factory=HistogramOptions)
    extra_tags: Mapping[str, str] = field(default_factory=dict)
    emit: str = "all"
    arrival_block: int = 60_000_000
    transformers: tuple[Callable[[], PointSpec], ...] = field(default_factory=_default_transformers)
    rules: tuple[Rule, ...] = field(default_factory=_default_rules)
    aggregates: tuple[Aggregate, ...] = field(default_factory=_default_aggregates)

    def __post_init__(self) -> None:
        object.__setattr__(self, "encoder", encoder_name(self.encoder))
        object.__setattr__(self, "extra_tags", parse_tags(self.extra_tags))
        if self.emit not in ("all", "closed"):
            raise ValueError(f"emit must be 'all' or 'closed', got {self.emit!r}")
        if not self.intervals:
            raise ValueError("at least one interval is needed")
        if len({i.seconds for i in self.intervals}) != len(self.intervals):
            raise ValueError("interval lengths must differ")
        if self.arrival_block <= 0:
            raise ValueError("arrival_block must be positive")
        known = {a.name for a in self.aggregates}
        unknown = {r.agg_type for r in self.rules} - known
        if unknown:
            raise ValueError(f"rules name aggregates that do not exist: {sorted(unknown)}")

    def limited(self, *names: str) -> TrendOptions:
        """The same job for some aggregates only; what the others need is then not grouped by."""
        aggregates = tuple(a for a in self.aggregates if a.name in names)
        return replace(self, aggregates=aggregates, rules=tuple(r for r in self.rules if r.agg_type in names))

    @property
    def grain(self) -> int:
        """The widest window, in seconds, that nests in every interval."""
        return math.gcd(*(i.seconds for i in self.intervals))
