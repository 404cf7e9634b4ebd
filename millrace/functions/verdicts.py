"""Judges' verdicts: strict parsing without coercion, and a judge of fixed rules."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.operators.scorecard import DIMENSIONS


def _schema(dimensions: tuple[str, ...], rationale: str) -> str:
    """The variant schema of a verdict: whole numbers, and texts for the rationales; fields in order of name."""
    if rationale == "rationale":
        fields = {d: "BIGINT" for d in dimensions} | {"rationale": "STRING"}
    else:
        inner = ", ".join(f"{d}: STRING" for d in sorted(dimensions))
        fields = {d: "BIGINT" for d in dimensions} | {rationale: f"OBJECT<{inner}>"}
    return f"OBJECT<{', '.join(f'{k}: {fields[k]}' for k in sorted(fields))}>"


def parse_verdict(text: Column, dimensions: tuple[str, ...] = DIMENSIONS) -> Column:
    """A struct of the dimensions and a map of rationales, or null.

    The text must be one JSON object with just the dimensions, as whole numbers from 1 to 5, and
    `rationales` with a text that is not blank for each; "5", 5.0 and true are no numbers.
    """
    v = F.try_parse_json(text)
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    fits = F.schema_of_variant(v) == _schema(dimensions, "rationales")
    for d in dimensions:
        fits = fits & get(f"$.{d}", "long").between(1, 5) & (F.length(F.trim(get(f"$.rationales.{d}", "string"))) > 0)
    rationales = F.create_map(*(x for d in dimensions for x in (F.lit(d), F.trim(get(f"$.rationales.{d}", "string")))))
    return F.when(F.coalesce(fits, F.lit(False)), F.struct(*(get(f"$.{d}", "int").alias(d) for d in dimensions), rationales.alias("rationales")))


def parse_dimension(text: Column, dimension: str) -> Column:
    """A struct (score, rationale) of a verdict on one dimension, or null."""
    v = F.try_parse_json(text)
    score, why = F.try_variant_get(v, f"$.{dimension}", "long"), F.trim(F.try_variant_get(v, "$.rationale", "string"))
    fits = (F.schema_of_variant(v) == _schema((dimension,), "rationale")) & score.between(1, 5) & (F.length(why) > 0)
    return F.when(F.coalesce(fits, F.lit(False)), F.struct(score.cast("int").alias("score"), why.alias("rationale")))


def asked_back(payload: Column) -> Column:
    """Whether a platform's payload holds `clarify: true`, be the inner response an object or an object's text; the text "true" is not it."""
    inner = F.try_parse_json(F.get_json_object(payload, "$.response.response"))
    is_flag = F.schema_of_variant(F.try_variant_get(inner, "$.clarify", "variant")) == "BOOLEAN"
    return F.coalesce(is_flag & F.try_variant_get(inner, "$.clarify", "boolean"), F.lit(False))


#: Least coverage of the reference for each score of completeness, and the lengths from which an answer is too long.
COVERAGE = ((0.6, 5), (0.4, 4), (0.2, 3))
LONG, TIMES_REFERENCE = 400, 6


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def rule_based_scores(expected: Column, reference: Column, answer: Column, sql: Column) -> Column:
    """The four dimensions by fixed rules: shared numbers or words, coverage of the reference, length, and the SQL's shape."""
    found = lambda x: F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0))
    wanted = found(expected)
    hits = F.size(F.filter(wanted, lambda n: F.array_contains(found(answer), n)))
    shared = F.size(F.array_intersect(_tokens(expected), _tokens(answer)))
    factual = F.when(F.size(wanted) == 0, F.when(shared >= 2, 5).when(shared == 1, 3).otherwise(1)).when(hits == F.size(wanted), 5).when(hits == 0, 1).when(hits == 1, 3).otherwise(5)
    covered = F.size(F.array_intersect(_tokens(reference), _tokens(answer))) / F.greatest(F.size(_tokens(reference)), F.lit(1))
    completeness = F.lit(1)
    for least, points in reversed(COVERAGE):
        completeness = F.when(covered >= least, points).otherwise(completeness)
    n = F.length(F.trim(F.coalesce(answer, F.lit(""))))
    form = F.when(n == 0, 1).when(n > F.greatest(F.lit(LONG), TIMES_REFERENCE * F.length(F.coalesce(reference, F.lit("")))), 3).otherwise(5)
    s = F.trim(F.coalesce(sql, F.lit("")))
    balanced = F.length(F.translate(s, ")", "")) == F.length(F.translate(s, "(", ""))
    shape = F.when(s == "", 1).when(~F.lower(s).rlike("^(select|with)"), 2).when(balanced, 5).otherwise(3)
    return F.struct(*(c.cast("int").alias(d) for d, c in zip(DIMENSIONS, (factual, completeness, form, shape), strict=True)))


def cache_key(*parts: str) -> str:
    """The key of an expensive verdict, and its first two characters as a shard."""
    key = hashlib.sha256("\x1f".join(parts).encode()).hexdigest()
    return f"{key[:2]}/{key}"


def child_seed(seed: int, name: str) -> int:
    """A seed of its own for each named stream."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:8], "big")
