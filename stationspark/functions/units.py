"""Units with dimensions, and conversions that follow from them.

A unit is a scale (and, for temperatures, a zero) against base units, and the
powers of length, mass, time, temperature and angle that it is made of.
Compound labels (``km/h``) are read as products and quotients of the simple
ones.  Two units convert into each other when their powers agree; otherwise
asking for it is a ``ValueError`` while the plan is built.

A temperature label on a departure or on degree days means a difference: such
a metric converts by scale alone, without moving the zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationspark.sources import catalog

# Powers of (length, mass, time, temperature, angle).
NONE = (0, 0, 0, 0, 0)
LENGTH, MASS, TIME = (1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 1, 0, 0)
TEMPERATURE, ANGLE = (0, 0, 0, 1, 0), (0, 0, 0, 0, 1)
PRESSURE = (-1, 1, -2, 0, 0)


@dataclass(frozen=True)
class Unit:
    """``base = scale * x + zero``."""

    label: str
    scale: float
    powers: tuple[int, ...]
    zero: float = 0.0

    def difference(self) -> Unit:
        return Unit(self.label, self.scale, self.powers)


# Definitions of the simple units (fixed values).
_INCH, _MILE, _HOUR, _DAY = 0.0254, 1609.344, 3600.0, 86400.0
_RANKINE = 5 / 9
SIMPLE = {u.label: u for u in (
    Unit("m", 1.0, LENGTH), Unit("mm", 0.001, LENGTH), Unit("cm", 0.01, LENGTH), Unit("km", 1000.0, LENGTH),
    Unit("inches", _INCH, LENGTH), Unit("mi", _MILE, LENGTH), Unit("ft", 0.3048, LENGTH),
    Unit("s", 1.0, TIME), Unit("h", _HOUR, TIME), Unit("days", _DAY, TIME),
    Unit("kg", 1.0, MASS),
    Unit("K", 1.0, TEMPERATURE), Unit("°C", 1.0, TEMPERATURE, 273.15), Unit("°F", _RANKINE, TEMPERATURE, 459.67 * _RANKINE),
    Unit("Pa", 1.0, PRESSURE), Unit("hPa", 100.0, PRESSURE), Unit("inches of mercury", 3386.389, PRESSURE),
    Unit("°", 1.0, ANGLE), Unit("degrees", 1.0, ANGLE),
    Unit("%", 0.01, NONE), Unit("1", 1.0, NONE),
    Unit("mph", _MILE / _HOUR, (1, 0, -1, 0, 0)), Unit("kn", 1852.0 / _HOUR, (1, 0, -1, 0, 0)),
)}


def unit(label: str) -> Unit:
    """The unit of a label: a simple one, or ``a-b`` and ``a/b`` of such."""
    if label in SIMPLE:
        return SIMPLE[label]
    top, *below = label.split("/")
    parts = [(p, 1) for p in top.split("-")] + [(p, -1) for p in below]
    scale, powers = 1.0, NONE
    if len(parts) == 1:
        raise ValueError(f"unknown unit {label!r}")
    for part, power in parts:
        own = SIMPLE.get(part)
        if own is None:
            raise ValueError(f"unknown unit {part!r} in {label!r}")
        scale *= own.scale ** power
        powers = tuple(a + power * b for a, b in zip(powers, own.powers))
    return Unit(label, scale, powers)


def is_difference(kind: str, metric: str) -> bool:
    """Whether a metric measures a difference from something."""
    description = catalog.METRICS[kind][metric][0]
    return "Departure" in description or "Degree Days" in description


def unit_of(kind: str, metric: str) -> Unit:
    """The unit of a catalog metric; that of a difference has no zero."""
    label = catalog.unit_of(kind, metric)
    if label is None:
        raise ValueError(f"{kind} metric {metric!r} has no unit")
    own = unit(label)
    return own.difference() if is_difference(kind, metric) else own


def factors(source: Unit, target: Unit) -> tuple[float, float]:
    """``target value = value * a + b``."""
    if source.powers != target.powers:
        raise ValueError(f"{source.label!r} and {target.label!r} measure different things")
    return source.scale / target.scale, (source.zero - target.zero) / target.scale


def convert(value: Column, source: Unit, target: Unit) -> Column:
    a, b = factors(source, target)
    return value * F.lit(a) + F.lit(b)


def target_unit(kind: str, metric: str, label: str) -> Unit:
    """The unit asked for, as a difference where the metric is one."""
    own = unit(label)
    return own.difference() if is_difference(kind, metric) else own
