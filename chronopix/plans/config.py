"""Validation and normalisation of a job's configuration."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from typing import Any

from chronopix.model import ConfigurationError
from chronopix.operators.base import STATISTICS
from chronopix.plans.epochs import as_time, for_year, parse_duration

TOP = {"sources", "date_ranges", "output_products", "location", "storage", "computation", "input_region", "filter_product", "global_attributes", "var_attributes"}
OUTPUT = {"name", "product_type", "statistic", "statistic_args", "output_params", "file_path_template", "metadata"}
DATES = {"start_date", "end_date", "stats_duration", "step_size", "type"}
STORAGE = {"driver", "crs", "tile_size", "resolution", "chunking", "dimension_order"}
#: What a file name template may use.
FIELDS = {"x", "y", "epoch_start", "epoch_end", "name", "stat_name", "feature_id", "var_name"}


def read(text_or_path: str) -> dict:
    """The first YAML document of a file (or of a text with line ends)."""
    import yaml

    if "\n" not in text_or_path:
        with open(text_or_path, encoding="utf-8") as f:
            text_or_path = f.read()
    return next(iter(yaml.safe_load_all(text_or_path)), None) or {}


def _known(what: str, given: Mapping[str, Any], known: set[str], needed: Sequence[str] = ()) -> None:
    if extra := sorted(set(given) - known):
        raise ConfigurationError(f"unknown keys of {what}: {extra}")
    if lacking := [k for k in needed if k not in given]:
        raise ConfigurationError(f"{what} lacks {lacking}")


def check_template(template: str, extra: Sequence[str] = ()) -> None:
    names = {f.split(".")[0].split("[")[0] for _, f, _, _ in string.Formatter().parse(template) if f is not None}
    if bad := sorted(names - FIELDS - set(extra)):
        raise ConfigurationError(f"a file_path_template uses unknown fields {bad}")


def validate(config: Mapping[str, Any]) -> None:
    _known("the configuration", config, TOP, ("sources", "date_ranges", "output_products"))
    sources, outputs = config["sources"], config["output_products"]
    if not sources or not outputs:
        raise ConfigurationError("at least one source and one output product are needed")
    for s in sources:
        if lacking := [k for k in ("product", "measurements") if k not in s]:
            raise ConfigurationError(f"a source lacks {lacking}")
        for m in s.get("masks") or []:
            if lacking := [k for k in ("product", "measurement") if k not in m]:
                raise ConfigurationError(f"a mask lacks {lacking}")
    if any(list(s["measurements"]) != list(sources[0]["measurements"]) for s in sources):
        raise ConfigurationError("all sources must have the same measurements")
    names = [o.get("name") for o in outputs]
    if len(set(names)) != len(names):
        raise ConfigurationError("output products need distinct names")
    for o in outputs:
        _known("an output product", o, OUTPUT, ("name", "statistic"))
        if o["statistic"] not in STATISTICS:
            raise ConfigurationError(f"unknown statistic {o['statistic']!r}; known: {', '.join(sorted(STATISTICS))}")
        if o.get("file_path_template"):
            check_template(o["file_path_template"], list((o.get("metadata") or {})))
    d = config["date_ranges"]
    _known("date_ranges", d, DATES, ("start_date", "end_date"))
    as_time(d["start_date"]), as_time(d["end_date"])
    if d.get("stats_duration"):
        parse_duration(d["stats_duration"])
    if d.get("step_size"):
        parse_duration(d["step_size"], "ymd")
    _known("storage", config.get("storage") or {}, STORAGE)


def normalise(config: Mapping[str, Any], tiles: Sequence[tuple[int, int]] | None = None, location: str | None = None, year: int | None = None) -> dict:
    """A copy with what the command line says put over it. Tiles given there win, except over from_file."""
    out = {**config, "storage": dict(config.get("storage") or {}), "computation": dict(config.get("computation") or {}), "global_attributes": dict(config.get("global_attributes") or {}), "var_attributes": dict(config.get("var_attributes") or {})}
    if location:
        out["location"] = location
    if year:
        out["date_ranges"] = for_year(config["date_ranges"], year)
    region = config.get("input_region") or {}
    if tiles and "from_file" not in region:
        out["input_region"] = {"tiles": [list(t) for t in tiles]}
    return out
