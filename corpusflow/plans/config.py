"""Checks on a run's configuration, all reported at once before any work starts."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.cleaners import check_cleaners
from ..operators.ledger import MODES
from ..shipping import ship
from ..sources import SOURCES
from .transforms import TRANSFORMS


class ConfigError(ValueError):
    def __init__(self, problems: list[str]) -> None:
        super().__init__("; ".join(problems))
        self.problems = problems


def _get(cfg: dict, path: str):
    """The value at a dotted path; None where there is none."""
    for name in path.split("."):
        cfg = cfg.get(name) if isinstance(cfg, dict) else None
    return cfg


def _is_size(value) -> bool:
    return value == "all" or (isinstance(value, int) and not isinstance(value, bool) and value >= 0)


def _is_date(value) -> bool:
    try:
        datetime.fromisoformat(value)
    except (TypeError, ValueError):
        return False
    return True


def _in_order(cfg: dict) -> bool:
    start, end = _get(cfg, "transform.date.range_start"), _get(cfg, "transform.date.range_end")
    return not (_is_date(start) and _is_date(end)) or datetime.fromisoformat(start) <= datetime.fromisoformat(end)


def _are_labels(value) -> bool:
    return isinstance(value, list) and bool(value) and all(isinstance(x, str) and x for x in value)


def _is_synth(cfg: dict) -> bool:
    return _get(cfg, "transform.type") == "synth"


#: (setting, when it is checked, whether it is fine, what it should be)
RULES = [
    ("dataset.sample_size", None, lambda c, v: _is_size(v), "a number of rows from 0 on, or 'all'"),
    ("source.type", None, lambda c, v: v in SOURCES, lambda: f"one of {', '.join(sorted(SOURCES))}"),
    ("source.path", lambda c: _get(c, "source.type") in ("jsonl", "text_lines"), lambda c, v: bool(v), "where the JSON lines are"),
    ("source.path", lambda c: _get(c, "source.type") == "table", lambda c, v: bool(v or _get(c, "source.name")), "a folder, unless source.name gives a table"),
    ("source.field_map", None, lambda c, v: v is None or isinstance(v, dict), "a mapping from own field names to columns"),
    ("transform.type", None, lambda c, v: v in TRANSFORMS, lambda: f"one of {', '.join(sorted(TRANSFORMS))}"),
    ("transform.cleaners", None, lambda c, v: v is None or isinstance(v, list), "a list of steps"),
    ("transform.prompt_chars", None, lambda c, v: v is None or (isinstance(v, int) and v > 0), "a number of characters above 0"),
    ("transform.category.labels", _is_synth, lambda c, v: _are_labels(v), "a list of names, none of them empty"),
    ("transform.date.range_start", _is_synth, lambda c, v: _is_date(v), "an ISO date"),
    ("transform.date.range_end", _is_synth, lambda c, v: _is_date(v), "an ISO date"),
    ("transform.date.range_end", _is_synth, lambda c, v: _in_order(c), "no earlier than range_start"),
    ("load.target", lambda c: not (c.get("load") or {}).get("dry_run", True), lambda c, v: bool(v), "a folder, when load.dry_run is off"),
    ("load.mode", None, lambda c, v: v is None or v in MODES, f"one of {', '.join(MODES)}"),
]


def validate_config(cfg: dict, has_client: bool = False) -> None:
    """Raise one ``ConfigError`` that names every setting that cannot be used."""
    problems = []
    for name, applies, fine, wanted in RULES:
        value = _get(cfg, name)
        if (applies is None or applies(cfg)) and not fine(cfg, value):
            problems.append(f"{name} = {value!r}; it has to be {wanted() if callable(wanted) else wanted}")
    cleaners = _get(cfg, "transform.cleaners")
    if isinstance(cleaners, list):
        problems += [f"transform.{p}" for p in check_cleaners(cleaners)]
    if _is_synth(cfg) and not has_client:
        problems.append("transform.type = 'synth'; it has to be given a completion client")
    if problems:
        raise ConfigError(problems)


def config_problems(configs: DataFrame) -> DataFrame:
    """``(id, problems)`` of a table ``(id, config)`` of configurations as JSON text: what
    cannot be used in each, none where all can. Checked where the rows are. Text that is no
    JSON object has one problem; a client is taken to be there."""
    ship(configs.sparkSession)
    rows = configs.select("id", "config")

    def problems(text: str | None) -> list[str]:
        try:
            cfg = json.loads(text or "")
            if not isinstance(cfg, dict):
                raise ValueError("not an object")
            validate_config(cfg, has_client=True)
        except ConfigError as e:
            return e.problems
        except ValueError as e:
            return [f"not a configuration: {e}"]
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [problems(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["id", "problems"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, problems array<string>")
