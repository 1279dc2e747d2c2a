r"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

All of it is built-in functions. A pattern's matches and the gaps between them give the positions: the
end of a match is the sum of the gaps and matches up to it. Patterns are written so that a run of
characters is tried once (possessive repeats; a match starts at the start of a run or where the last
one ended, ``\G``), which keeps very long texts linear and finds the same matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

CONTEXT_CHARS = 48
CONTEXT_GAIN = 0.4
THRESHOLD = 0.5
_STEP = 64  # matches whose lengths are summed at once

Check = Callable[[Column], Column]


def let(value: Column, body: Check) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    n = F.length(number)

    def digit(i: Column) -> Column:
        twice = F.substring(number, n - i, F.lit(1)).cast("int") * (1 + F.pmod(i, F.lit(2)))
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.pmod(F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), digit), F.lit(0), lambda a, x: a + x), F.lit(10)) == 0


def mod97(code: Column) -> Column:
    """Whether a text of digits and capitals passes the check of international account numbers."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        return F.when(char >= "A", F.pmod(rest * 100 + F.ascii(char) - 55, F.lit(97))).otherwise(F.pmod(rest * 10 + F.ascii(char) - 48, F.lit(97)))

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


@dataclass(frozen=True)
class Kind:
    """A kind of data. ``hint`` must match wherever ``pattern`` does and is cheap to test; ``score`` is that
    of a confirmed span; kinds that are not ``certain`` need THRESHOLD with what ``context`` adds."""

    name: str
    hint: str
    pattern: str
    check: Check
    score: float
    context: str
    certain: bool = False


def _between(low: int, high: int) -> Check:
    return lambda s: F.length(digits(s)).between(low, high)


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = [
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda s: F.lit(True), 0.9,
         "e-?mail|mail|contact|write|courriel|correo", True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", lambda s: s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6,
         r"\bip\b|address|host|server|adresse", True),
    Kind("card", "[0-9][ -]?[0-9]", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
         lambda s: F.when(_between(14, 19)(s), luhn(digits(s))).otherwise(False), 0.9, "card|visa|credit|carte|tarjeta|karte", True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", _between(10, 15), 0.7, "phone|tel|call|mobile|fax", True),
    # what the method adds
    Kind("iban", "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         lambda s: let(F.replace(s, F.lit(" "), F.lit("")), lambda c: F.length(c).between(15, 34) & mod97(c)), 0.9, "iban|account|bank|konto|compte|cuenta"),
    Kind("national_id", "[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda s: F.lit(True), 0.3,
         "ssn|social security|tax|national id|passport"),
    Kind("secret", "[A-Za-z0-9+/_-]{16}", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?![A-Za-z0-9+/_-])",
         lambda s: s.rlike("[0-9]") & s.rlike("[A-Za-z]"), 0.2, "password|passwd|token|secret|api[_ -]?key|access[_ -]?key"),
    Kind("secret", "AKIA[0-9A-Z]{16}", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", lambda s: F.lit(True), 0.9, "key"),
]
BASE = ("email", "ip", "card", "phone")


def matches(text: Column, pattern: str) -> Column:
    """``start, end, text`` of each match, leftmost and without overlaps; positions in code points."""
    found = F.filter(F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
                                lambda m, gap: F.struct(m.alias("text"), (F.length(gap) + F.length(m)).alias("reach"))), lambda x: x["text"].isNotNull())
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x["reach"])

    def placed(own: Column) -> Column:
        # sums of whole steps first, so that a text of many matches stays cheap
        steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / _STEP).cast("int")), lambda b: total(F.slice(own, b * _STEP + 1, F.lit(_STEP))))
        before = F.aggregate(steps, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

        def place(offsets: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                step = F.floor(i / _STEP).cast("int")
                end = F.get(offsets, step) + total(F.slice(own, step * _STEP + 1, F.pmod(i, F.lit(_STEP)) + 1))
                return F.struct((end - F.length(x["text"])).alias("start"), end.alias("end"), x["text"].alias("text"))
            return F.transform(own, one)
        return let(before, place)
    return let(found, placed)


_EMPTY = "array<struct<start:int,rank:int,end:int,kind:string,score:double,text:string>>"


def _of_kind(text: Column, rank: int, kind: Kind) -> Column:
    confirmed = F.filter(matches(text, kind.pattern), lambda s: kind.check(s["text"]))

    def scored(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT_CHARS)))
        near = F.lower(F.concat(before, F.lit("\n"), F.substring(text, s["end"] + 1, F.lit(CONTEXT_CHARS))))
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near.rlike(kind.context), F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0)))
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind.name).alias("kind"),
                        F.round(score, 2).alias("score"), s["text"].alias("text"))

    spans = F.transform(confirmed, scored)
    if not kind.certain:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    return F.when(text.rlike(kind.hint), spans).otherwise(F.array().cast(_EMPTY))


def find(docs: DataFrame, text_col: str = "text", kinds: list[Kind] = KINDS, into: str = "pii") -> DataFrame:
    """``docs`` with the spans of each row's text in ``into``: ``start, rank, end, kind, score, text``, sorted.

    Spans of different kinds may overlap; of equal kinds they do not, but for secrets under two patterns,
    of which the surer one stays where both agree. NULL is an empty text. Where there is a column ``into`` the
    new one gets underscores before its name. Rows are independent: no shuffle.
    """
    names = list(dict.fromkeys(k.name for k in kinds))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    every = F.array_sort(F.concat(*[_of_kind(text, names.index(k.name), k) for k in kinds]))
    # the same span under two patterns: the higher score stays
    once = let(every, lambda a: F.filter(a, lambda s, i: (i >= F.size(a) - 1) | (F.get(a, i + 1)["start"] != s["start"]) |
                                         (F.get(a, i + 1)["end"] != s["end"]) | (F.get(a, i + 1)["rank"] != s["rank"])))
    return docs.withColumn(free_name(docs, into), once)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
