"""Whether an answer holds all values of a canonical one, and each label by its own value, as expressions over arrays.

Both texts become arrays: what is asked for, in order, and what is found, by place. There is no state between
them. Of equal requirements the n-th is met if the value is found n times at least, and may stand at all places from the n-th on.
Labels and values are then held against each other by distances alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: months' names; what is a date, a number, a separator of records and of fields, and a currency sign; the size of a label.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
ISO_DATE = r"\b(\d{4})[-/](\d{2})[-/](\d{2})\b"
NUMERAL = r"[-+]?\d{1,3}(?:,\d{3})+(?:\.\d+)?|[-+]?\d+(?:\.\d+)?"
RECORDS, FIELDS, CURRENCY = ";", "[|—–]", "$€£¥"
LABEL_WORDS, LABEL_CHARS, NEAR = 6, 60, 120
_MONTH = "|".join((*MONTHS, "Sept", *(m[:3] for m in MONTHS)))
#: Patterns of dates, and which groups are year, month and day.
DATES = ((ISO_DATE, (1, 2, 3)), (rf"(?i)\b({_MONTH})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b", (3, 1, 2)), (rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?\s+({_MONTH}),?\s+(\d{{4}})\b", (3, 2, 1)))
#: Failures that a verdict tells.
TOLD = 4
_ASKED = "array<struct<record:int,kind:string,value:string,written:string,shown:string>>"


@dataclass(frozen=True)
class Policy:
    """How answers are compared: numbers by value or as they are written, with or without labels, how near a label stands, and whether dates may be prose."""

    as_written: bool = False
    labels: bool = True
    near: int = NEAR
    prose_dates: bool = True


def _single_spaced(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def _length(texts: Column) -> Column:
    return F.aggregate(texts, F.lit(0), lambda n, t: n + F.length(t))


def _places(text: Column, pattern: Column) -> Column:
    """(at, hit) of all matches; at counts from 0."""
    hits, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    return F.transform(hits, lambda h, i: F.struct((_length(F.slice(gaps, F.lit(1), i + 1)) + _length(F.slice(hits, F.lit(1), i))).alias("at"), h.alias("hit")))


def _without(text: Column, pattern: Column) -> Column:
    """The text with spaces in place of all matches."""
    hits, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    return F.array_join(F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(F.repeat(F.lit(" "), F.length(h)), F.lit("")))), "")


def _number(text: Column) -> Column:
    """A number's canonical text: without commas, plus, leading zeros and zeros at the end of its fraction."""
    plain = F.regexp_replace(F.regexp_replace(text, ",", ""), r"^\+", "")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.regexp_replace(F.regexp_replace(plain, r"^(-?)0+(?=\d)", "$1"), "^-0$", "0")


def _date(hit: Column, pattern: str, groups: tuple[int, int, int]) -> Column:
    """The date of a match in ISO form, null if there is no such day."""
    year, month, day = (F.regexp_extract(hit, pattern, g) for g in groups)
    named = F.floor((F.instr(F.lit("".join(m[:3] for m in MONTHS).lower()), F.lower(F.substring(month, 1, 3))) + 2) / 3).cast("string")
    number = month if pattern == ISO_DATE else named
    return F.concat_ws("-", year, F.lpad(number, 2, "0"), F.lpad(day, 2, "0")).try_cast("date").cast("string")


def _dated(text: Column, prose: bool) -> tuple[Column, Column]:
    """(at, value) of all dates, and the text without whatever looks like one."""
    found = F.array().cast("array<struct<at:int,value:string>>")
    for pattern, groups in DATES if prose else DATES[:1]:
        own = F.transform(_places(text, F.lit(pattern)), lambda x: F.struct(x["at"].alias("at"), _date(x["hit"], pattern, groups).alias("value")))  # noqa: B023  used at once
        found, text = F.concat(found, F.filter(own, lambda x: x["value"].isNotNull())), _without(text, F.lit(pattern))
    return found, text


def _requirements(field: Column, record: Column) -> Column:
    """What a field asks for: a date, a value, the numbers of a mixture, a label, or of prose nothing."""
    dates, rest = _dated(field, False)
    amount = F.trim(F.ltrim(field, F.lit(CURRENCY)))
    one = lambda kind, value, written, shown: F.struct(record.cast("int").alias("record"), F.lit(kind).alias("kind"), value.alias("value"), written.alias("written"), shown.alias("shown"))
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, ",", ""), r"^\+", "")
    label = (F.size(F.split(field, r"(?U)\s+")) <= LABEL_WORDS) & (F.length(field) <= LABEL_CHARS) & ~field.rlike("[.?!]$")
    mixed = F.transform(F.regexp_extract_all(rest, F.lit(NUMERAL), F.lit(0)), lambda n: one("value", _number(n), plain(n), plain(n)))
    first = F.try_element_at(dates, F.lit(1))["value"]
    asked = F.when((F.size(dates) > 0) & (F.trim(rest) == ""), F.array(one("date", first, field, first)))
    asked = asked.when(amount.rlike(f"^(?:{NUMERAL})$"), F.array(one("value", _number(amount), amount, plain(amount))))
    asked = asked.when(field.rlike(r"\d"), mixed).when(label, F.array(one("label", field, field, field)))
    return F.coalesce(asked.cast(_ASKED), F.array().cast(_ASKED))


def _asked(golden: Column) -> Column:
    """The requirements of all records in order."""
    fields = lambda r: F.filter(F.transform(F.split(r, FIELDS, -1), lambda f: F.trim(f)), lambda f: f != "")
    return F.flatten(F.transform(F.split(F.coalesce(golden, F.lit("")), RECORDS, -1), lambda r, i: F.flatten(F.transform(fields(r), lambda f: _requirements(f, i)))))


def _found(text: Column, policy: Policy) -> Column:
    """(at, kind, value) of the answer's dates and numbers, by place."""
    dates, rest = _dated(text, policy.prose_dates)
    entry = lambda x, kind, value: F.struct(x["at"].alias("at"), F.lit(kind).alias("kind"), value.alias("value"))
    numbers = F.transform(_places(rest, F.lit(NUMERAL)), lambda x: entry(x, "value", x["hit"] if policy.as_written else _number(x["hit"])))
    return F.array_sort(F.concat(F.transform(dates, lambda x: entry(x, "date", x["value"])), numbers))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^\p{L}\p{N} ])", r"\\$1")


def _stands(text: Column, label: Column) -> Column:
    """(at, hit) of a label; only if it nowhere stands as it is, without regard to spaces."""
    own = _single_spaced(label)
    loose = F.array_join(F.transform(F.split(F.replace(own, F.lit(" "), F.lit("")), ""), _quoted), " ?")
    as_it_is = _places(text, _quoted(own))
    return F.when(F.size(as_it_is) > 0, as_it_is).otherwise(_places(text, loose))


def _strength(at: Column, claims: Column) -> Column:
    """The least distance from a value to the claims on it, twice as far for those after it; null without any."""
    return F.array_min(F.transform(claims, lambda c: F.when(c["end"] <= at, at - c["end"]).when(c["at"] > at, 2 * (c["at"] - at)).otherwise(0)))


def match_owned(df: DataFrame, golden: str, answer: str, name: str = "match", policy: Policy = Policy()) -> DataFrame:  # noqa: B008  frozen
    """df with a struct (result, detail, satisfied, unsatisfied): pass if every value, date and label of the golden text is in the answer, and each label by a value of its own record.

    A value is taken once. A label claims a value by the characters between them, which count twice
    if the label comes after; the strongest claim within policy.near owns the value, and records whose claims are alike share it. A
    record without a found value asks only that its label is there. result is error without an answer (null or blank), and not_applicable where the golden text, null
    too, asks for nothing. Everything is computed row by row in expressions, without Python.
    """
    step = lambda k: f"_{name}_{k}"
    text, asked, found, met, claims, places = (step(k) for k in ("text", "asked", "found", "met", "claims", "places"))
    c = F.col
    compared = (lambda r: F.when(r["kind"] == "value", r["written"]).otherwise(r["value"])) if policy.as_written else (lambda r: r["value"])
    values = lambda own: F.filter(own, lambda r: r["kind"] != "label")
    out = df.withColumn(text, _single_spaced(F.coalesce(c(answer), F.lit("")))).withColumn(asked, _asked(c(golden))).withColumn(found, _found(c(text), policy))

    def places_left(r: Column, i: Column) -> Column:
        same = lambda x: (x["kind"] == r["kind"]) & (compared(x) == compared(r))
        all_ = F.transform(F.filter(c(found), lambda x: (x["kind"] == r["kind"]) & (x["value"] == compared(r))), lambda x: x["at"])
        before = F.size(F.filter(F.slice(values(c(asked)), F.lit(1), i), same))
        left = F.slice(all_, before + 1, F.greatest(F.size(all_) - before, F.lit(0)))
        return F.struct(r["record"].alias("record"), F.concat(r["kind"], F.lit(":"), r["shown"]).alias("key"), left.alias("places"), F.concat(r["kind"], F.lit(" '"), r["written"], F.lit("' is missing")).alias("told"))

    out = out.withColumn(met, F.transform(values(c(asked)), places_left))
    labels = F.filter(c(asked), lambda r: r["kind"] == "label") if policy.labels else F.array().cast(_ASKED)
    spans = F.transform(labels, lambda r: F.struct(r["record"].alias("record"), r["shown"].alias("label"), F.transform(_stands(c(text), r["shown"]), lambda x: F.struct(x["at"].alias("at"), (x["at"] + F.length(x["hit"])).alias("end"))).alias("spans")))
    out = out.withColumn(claims, spans)

    def judged(r: Column) -> Column:
        everyone = F.flatten(F.transform(c(claims), lambda x: x["spans"]))
        own = F.flatten(F.transform(F.filter(c(claims), lambda x: x["record"] == r["record"]), lambda x: x["spans"]))
        where = F.flatten(F.transform(F.filter(c(met), lambda x: x["record"] == r["record"]), lambda x: x["places"]))
        owned = F.exists(where, lambda at: (_strength(at, own) == _strength(at, everyone)) & (_strength(at, own) <= policy.near))
        nearest = F.array_min(F.transform(where, lambda at: _strength(at, everyone)))
        why = F.when(F.size(r["spans"]) == 0, "is missing").when((F.size(where) > 0) & ~owned, F.when(nearest <= policy.near, "stands by values that another label owns").otherwise(F.concat(F.lit("stands "), nearest.cast("string"), F.lit(f" characters from its nearest value, more than {policy.near}"))))
        return F.struct(F.concat(F.lit("label:"), r["label"]).alias("key"), F.concat(F.lit("label '"), r["label"], F.lit("' "), why).alias("told"))

    of_values = F.transform(c(met), lambda r: F.struct(r["key"].alias("key"), F.when(F.size(r["places"]) == 0, r["told"]).alias("told")))
    out = out.withColumn(places, F.concat(of_values, F.transform(c(claims), judged)))
    told = F.filter(F.transform(c(places), lambda r: r["told"]), lambda t: t.isNotNull())
    keys = lambda wanted: F.array_sort(F.transform(F.filter(c(places), lambda r: r["told"].isNull() == wanted), lambda r: r["key"]))
    more = F.when(F.size(told) > TOLD, F.concat(F.lit("; and "), (F.size(told) - TOLD).cast("string"), F.lit(" more"))).otherwise("")
    blank, none = c(text) == "", F.array().cast("array<string>")
    result = F.when(blank, "error").when(F.size(places) == 0, "not_applicable").when(F.size(told) == 0, "pass").otherwise("fail")
    detail = F.when(blank, "there is no answer").when(F.size(places) == 0, "nothing is asked for").when(F.size(told) == 0, F.concat(F.lit("met: "), F.size(places).cast("string"))).otherwise(F.concat(F.array_join(F.slice(told, 1, TOLD), "; "), more))
    verdict = F.struct(result.alias("result"), detail.alias("detail"), F.when(blank, none).otherwise(keys(True)).alias("satisfied"), F.when(blank, none).otherwise(keys(False)).alias("unsatisfied"))
    return out.withColumn(name, verdict).drop(text, asked, found, met, claims, places)
