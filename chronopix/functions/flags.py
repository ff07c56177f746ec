"""Bit flags: from names and values to (mask, value), and to predicates."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronopix.model import ConfigurationError

# Bits of the water classification byte.
WATER_FLAGS: dict[str, dict[str, Any]] = {
    "nodata": {"bits": 0, "values": {1: True}},
    "noncontiguous": {"bits": 1, "values": {0: False, 1: True}},
    "sea": {"bits": 2, "values": {0: False, 1: True}},
    "terrain_or_low_angle": {"bits": 3, "values": {0: False, 1: True}},
    "high_slope": {"bits": 4, "values": {0: False, 1: True}},
    "cloud_shadow": {"bits": 5, "values": {0: False, 1: True}},
    "cloud": {"bits": 6, "values": {0: False, 1: True}},
    "wet": {"bits": [7, 6, 5, 4, 3, 1, 0], "values": {128: True}},
    "dry": {"bits": [7, 6, 5, 4, 3, 1, 0], "values": {0: True}},
}


def compile_flags(definition: Mapping[str, Mapping[str, Any]], **wanted: Any) -> tuple[int, int]:
    """(mask, value): x has all wanted flags iff x & mask == value.

    A flag of one bit has values {0: .., 1: ..}; one of several bits has values by the bits' number, either as it
    stands in the band or counted from the flag's lowest bit.
    """
    mask = value = 0
    for name, want in wanted.items():
        if name not in definition:
            raise ConfigurationError(f"unknown flag {name!r}; known: {', '.join(sorted(definition))}")
        bits = definition[name]["bits"]
        bits = [bits] if isinstance(bits, int) else list(bits)
        own = sum(1 << b for b in bits)
        raw = next((int(k) for k, v in definition[name]["values"].items() if v == want), None)
        if raw is None:
            raise ConfigurationError(f"flag {name!r} has no value {want!r}")
        low = min(bits)
        placed = raw << low if (raw << low) & ~own == 0 and raw < 1 << len(bits) else raw
        if placed & ~own or mask & own and (value ^ placed) & mask & own:
            raise ConfigurationError(f"flags contradict each other or their bits: {wanted}")
        mask, value = mask | own, value | placed
    return mask, value


def has_flags(band: Column, mask: int, value: int, inverted: bool = False) -> Column:
    """True where the band's masked bits are the value (or, inverted, are not); NULL bits are never true."""
    same = band.bitwiseAND(F.lit(mask)) == F.lit(value)
    return F.coalesce(~same if inverted else same, F.lit(False))


def classes(definition: Mapping[str, Any], names: list[str]) -> list[int]:
    """Codes of named classes of an enumerated band, given as {'values': {code: name}} under any flag."""
    by_name = {str(v): int(k) for flag in definition.values() for k, v in flag["values"].items()}
    if missing := [n for n in names if n not in by_name]:
        raise ConfigurationError(f"unknown classes {missing}")
    return [by_name[n] for n in names]
