"""Configurations of generators, checked as a whole before anything is made, and the presets that they refer to."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from copy import deepcopy

#: Parameters of each kind of distribution.
DISTRIBUTIONS = {"pareto": {"alpha", "least", "most"}, "mixture": {"components"}, "poisson": {"rate", "most"}, "uniform": {"least", "most"}, "weighted": {"weights"}}


def _problems(what: str, spec: Mapping) -> list[str]:
    kind = spec.get("name")
    if kind not in DISTRIBUTIONS:
        return [f"{what}: no distribution is called {kind!r}"]
    given, wanted = set(spec) - {"name"}, DISTRIBUTIONS[kind]
    out = [f"{what}: {p} is missing" for p in sorted(wanted - given)] + [f"{what}: {kind} has no {p}" for p in sorted(given - wanted)]
    for p in sorted(wanted & given):
        value = spec[p]
        if p == "weights" and (not value or min(value.values()) < 0 or abs(sum(value.values()) - 1) > 1e-9):
            out.append(f"{what}: weights are not negative and add up to 1")
        elif p == "components" and (not value or abs(sum(c[0] for c in value) - 1) > 1e-9):
            out.append(f"{what}: the weights of the components add up to 1")
        elif p in ("alpha", "rate") and not value > 0:
            out.append(f"{what}: {p} is above 0")
    if {"least", "most"} <= wanted & given and spec["least"] > spec["most"]:
        out.append(f"{what}: least is above most")
    return out


def resolve_presets(presets: Mapping[str, Mapping], wanted: Mapping[str, Mapping]) -> dict[str, dict]:
    """Each wanted distribution: a preset and what the domain has in other ways; all that is unknown or out of range is one error."""
    out, problems = {}, []
    for name, spec in presets.items():
        problems += _problems(f"preset {name}", spec)
    for name, spec in wanted.items():
        preset = spec.get("preset")
        if preset not in presets:
            problems.append(f"{name}: there is no preset {preset!r}")
            continue
        out[name] = deepcopy(dict(presets[preset])) | {k: deepcopy(v) for k, v in spec.items() if k != "preset"}
        problems += _problems(name, out[name])
    if problems:
        raise ValueError("; ".join(problems))
    return out


def check_config(config: Mapping, columns: Mapping[str, Sequence[str]], most_rows: int = 250_000) -> list[str]:
    """What is wrong with a generator's configuration; empty if it can be used.

    config: row_targets by table, weights by column, relationships (child, key, parent, key), percents from 0 to 100,
    and join_paths as lists of tables, each related to the one before. columns: the schema's, by table.
    """
    sections = ("row_targets", "weights", "relationships", "percents", "join_paths")
    out = [f"section {s} is missing" for s in sections if s not in config] + [f"section {s} is unknown" for s in config if s not in sections]
    targets, related = config.get("row_targets", {}), set()
    out += [f"row_targets: {t} is missing" for t in columns if t not in targets] + [f"row_targets: the schema has no table {t}" for t in targets if t not in columns]
    out += [f"row_targets.{t}: {n} is not from 1 to {most_rows}" for t, n in targets.items() if isinstance(n, bool) or not isinstance(n, int) or not 1 <= n <= most_rows]
    for name, weights in config.get("weights", {}).items():
        out += _problems(f"weights.{name}", {"name": "weighted", "weights": weights})
    for child, key, parent, parent_key in config.get("relationships", ()):
        known = child in columns and key in columns[child] and parent in columns and parent_key in columns[parent]
        related |= {(child, parent), (parent, child)} if known else set()
        out += [] if known else [f"relationships: {child}.{key} -> {parent}.{parent_key} is not in the schema"]
    out += [f"percents.{n}: {p} is not from 0 to 100" for n, p in config.get("percents", {}).items() if not 0 <= p <= 100]
    for path in config.get("join_paths", ()):
        out += [f"join_paths: {a} and {b} are not related" for a, b in zip(path, path[1:], strict=False) if (a, b) not in related]
    return out


def resolve_path(template: str, base: str, **values: str) -> str:
    """A path of the configuration with its {names} filled in, below base; one that leaves base is an error."""
    path = os.path.normpath(os.path.join(base, template.format_map(values)))
    if os.path.commonpath([os.path.abspath(base), os.path.abspath(path)]) != os.path.abspath(base):
        raise ValueError(f"{template} leads out of {base}")
    return path
