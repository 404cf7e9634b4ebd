"""The family driver: from question families, a catalog of values and quotas to a whole set of questions with answers, or to nothing."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from millrace.functions.answers import Answer, answer, even_sample
from millrace.operators.freshness import Stamp, require_fresh_tables
from millrace.sources.files import distinct_values

from .families import Family


class QuotaError(ValueError):
    """A tier has too few or too many questions; nothing was made."""


@dataclass(frozen=True)
class Question:
    question_id: str
    tier: str
    family: str
    question: str
    param_values: str
    expected_answer: str
    result_hash: str
    reference_sql: str


def catalog(tables: Mapping[str, DataFrame], spec: Mapping[str, str | Sequence]) -> dict[str, list]:
    """The values of each parameter: a given list, or all values of a column `table.column` in order; names that begin with _ are notes."""
    out = {}
    for name, given in spec.items():
        if name.startswith("_"):
            continue
        table, _, column = given.partition(".") if isinstance(given, str) else ("", "", "")
        out[name] = distinct_values(tables[table], column) if column else list(given)
    return out


def combinations(parameters: Iterable[str], values: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the parameters' values, the last parameter changing first."""
    names = list(parameters)
    return [dict(zip(names, some, strict=True)) for some in itertools.product(*(values[n] for n in names))]


def tier_of(family: Family) -> str:
    return family.id.partition(":")[2].partition("-")[0]


def build(tables: Mapping[str, DataFrame], families: Sequence[Family], quotas: Mapping[str, int], tier_quotas: Mapping[str, int], values: Mapping[str, Sequence], *, prefix: str = "QA", phrases: Mapping[str, str] | None = None, threads: int = 8, stamp: Stamp | None = None) -> list[Question]:
    """Questions of all families, numbered within their tier; quotas are by family and by tier.

    Of each family's combinations as many as its quota, at even ranks, are asked; combinations without an answer
    are left out before the others are numbered. Tiers are checked before and after; if one is not met,
    nothing is returned. Plans of different combinations run side by side. With a stamp, tables or parts that
    changed since it was written are an error before anything is asked.
    """
    if stamp is not None:
        require_fresh_tables(tables, stamp)
    for tier, n in tier_quotas.items():
        planned = sum(quotas.get(f.id, 0) for f in families if tier_of(f) == tier)
        if planned != n:
            raise QuotaError(f"{tier}: the families' quotas add up to {planned}, not {n}")
    unknown = sorted({f"{f.id}: {p}" for f in families for p in f.params if p not in values})
    if unknown:
        raise QuotaError("parameters without values: " + ", ".join(unknown))
    asked = [(f, some) for tier in tier_quotas for f in families if tier_of(f) == tier for some in even_sample(combinations(f.params, values), quotas.get(f.id, 0))]
    with ThreadPoolExecutor(threads) as pool:
        found: list[Answer] = list(pool.map(lambda x: answer(x[0].frame(tables, **x[1])), asked))
    out, numbers = [], dict.fromkeys(tier_quotas, 0)
    for (family, some), got in zip(asked, found, strict=True):
        if got.status != "ok":
            continue
        tier = tier_of(family)
        numbers[tier] += 1
        said = ", ".join(f"{k}: {(phrases or {}).get(v, v)}" for k, v in some.items())
        out.append(Question(f"{prefix}-{family.id}-{numbers[tier]:02d}", tier, family.id, f"{family.question} ({said})" if said else family.question, ";".join(f"{k}={v}" for k, v in some.items()), got.text, got.hash, family.sql(**some)))
    short = [f"{t} {numbers[t]}/{n}" for t, n in tier_quotas.items() if numbers[t] != n]
    if short:
        raise QuotaError("tiers that are not met: " + ", ".join(short))
    return out
