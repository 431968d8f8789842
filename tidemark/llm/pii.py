"""Personal data: regular expressions propose spans, checks confirm them, words nearby adjust the score.

One projection of DataFrame functions: no shuffle, no Python, one row in and one row out.

1. Every kind has a pattern. Proposals are its leftmost matches that don't overlap; a proposal that fails its kind's
   check is dropped, and nothing is tried again within it.
2. Checks: the parts of an ``ip`` are at most 255, the digits of a ``card`` are 12 to 19 and pass Luhn, those of a
   ``phone`` are 9 to 15, an ``iban`` passes mod-97. A ``local`` phone and a personal ``number`` have no checksum.
3. A proposal scores its kind's points, plus ``CHECKED`` if a checksum confirmed it, plus ``NEARBY`` if one of its
   kind's words stands in the ``WINDOW`` code points before it (as far back as the proposal before it). The base kinds
   stay whatever they score; the others need ``NEEDED``. So a local phone counts after "call", and not in a table.

Text is only matched by a kind that can be in it: a cheap test comes first. Patterns are possessive and start where no
longer match could have started, so that a text of a million equal characters takes linear time and no deep
recursion. Places come from the lengths of what lies between matches, summed in chunks of about the square root of
their number, so that a text with very many spans isn't copied once for each of them.

Defined results: a null or empty text has no spans. Rows are judged one by one, also with a null or repeated ``doc_id``;
an empty table gives no rows. Very long texts are read whole. Places are code points from 0, ends exclusive. Spans of
different kinds may overlap. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold_case

BASE = ("email", "ip", "card", "phone")
WINDOW = 30
CHECKED, NEARBY, NEEDED = 40, 40, 70


@dataclass(frozen=True)
class Kind:
    """``hint``: what every match contains; ``check(hit, before, after)``: whether a proposal stands."""

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    check: Callable[[Column, Column, Column], Column]
    points: int
    checksum: bool
    words: str


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def luhn(digits: Column) -> Column:
    """Whether the last of the digits is their check digit."""
    reverse = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))
    doubled = F.lit("0246813579")  # the digit sum of twice a digit

    def value(place: Column) -> Column:
        digit = F.substr(reverse, place, F.lit(1)).cast("int")
        return F.when(place % 2 == 0, F.substr(doubled, digit + 1, F.lit(1)).cast("int")).otherwise(digit)

    return _sum(F.transform(places, value)) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether letters and digits, the first four moved to the end and letters read as 10 to 35, leave 1."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, place: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(turned, place, F.lit(1))) - 1
        return F.when(value < 10, (rest * 10 + value) % 97).otherwise((rest * 100 + value) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), step) == 1


def _ip(hit: Column, before: Column, after: Column) -> Column:
    significant = F.transform(F.split(hit, "\\."), lambda part: F.regexp_replace(part, "^0+", ""))
    return F.forall(significant, lambda part: (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255")))


def _card(hit: Column, before: Column, after: Column) -> Column:
    return F.when(F.length(_digits(hit)).between(12, 19), luhn(_digits(hit))).otherwise(False)


def _alone(marks: str) -> Callable[[Column, Column, Column], Column]:
    """Neither of the characters next to the hit is one of ``marks``."""
    return lambda hit, before, after: ~before.rlike(f"[{marks}]$") & ~after.rlike(f"^[{marks}]")


def _iban(hit: Column, before: Column, after: Column) -> Column:
    return _alone("A-Za-z0-9")(hit, before, after) & mod_97(hit)


def _local(hit: Column, before: Column, after: Column) -> Column:
    return _alone("0-9+.-")(hit, before, after) & ~before.rlike("\\+[0-9][\\x20().0-9-]*$")


KINDS = (
    Kind(
        "email", "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")), lambda hit, before, after: F.lit(True), 80, False, "mail|contact|write",
    ),
    Kind(
        "ip", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
        lambda text: text.rlike("[0-9]\\.[0-9]"), _ip, 60, False, "ip|host|server|address",
    ),
    # A run of digits in which single blanks or hyphens may stand, taken whole.
    Kind(
        "card", "[0-9](?:[\\x20-]?[0-9])++",
        lambda text: text.rlike("[0-9](?:[\\x20-]?[0-9]){11}"), _card, 40, True, "card|visa|carte|karte|tarjeta",
    ),
    Kind(
        "phone", "\\+[0-9][\\x20().0-9-]+[0-9]",
        lambda text: F.contains(text, F.lit("+")), lambda hit, before, after: F.length(_digits(hit)).between(9, 15), 60, False,
        "phone|tel|call|fax|mobil",
    ),
    Kind(
        "iban", "[A-Z][A-Z][0-9][0-9](?:\\x20?[A-Z0-9]){11,30}+",
        lambda text: text.rlike("[A-Z][A-Z][0-9][0-9]"), _iban, 40, True, "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "local", "\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[.-][0-9]{4}",
        lambda text: text.rlike("[0-9]{3}[.-][0-9]{4}"), _local, 30, False, "phone|tel|call|fax|mobil",
    ),
    Kind(
        "number", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda text: text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), _alone("0-9+.-"), 30, False, "ssn|social security|tax id",
    ),
)

_SPAN = "array<struct<start:bigint,place:int,end:bigint,kind:string,score:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: what a lambda refers to is else computed for each element."""
    return F.get(F.transform(F.array(value), body), 0)


def _stops(parts: Column, n: Column) -> Column:
    """Where each part ends, their lengths added up. Places within a chunk count from its start, and the starts of
    chunks are added up apart, as every addition to an array copies it."""
    zero = F.lit(0).cast("long")
    chunk = F.greatest(F.floor(F.sqrt(n)), F.lit(1)).cast("int")

    def sums(lengths: Column) -> Column:
        """0 and the running sums."""
        return F.aggregate(lengths, F.array(zero), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + x)))

    def length(part: Column) -> Column:
        return part["gap"] + part["size"]

    def within(chunks: Column) -> Column:
        begins = sums(F.transform(chunks, lambda c: F.aggregate(c, zero, lambda total, part: total + length(part))))
        own = F.transform(chunks, lambda c: F.slice(sums(F.transform(c, length)), 2, F.size(c)))
        return F.flatten(F.zip_with(own, F.slice(begins, 1, F.size(chunks)), lambda places, base: F.transform(places, lambda x: x + base)))

    firsts = F.sequence(F.lit(1), n, chunk)
    return _let(F.struct(parts.alias("parts"), chunk.alias("chunk"), firsts.alias("firsts")), lambda v: _let(
        F.transform(v["firsts"], lambda first: F.slice(v["parts"], first, v["chunk"])), within
    ))


def _confirmed(gaps: Column, hits: Column, kind: Kind, place: int) -> Column:
    n = F.size(hits)
    # The character after a hit is the first of the gap after it, or of the hit after that.
    parts = F.zip_with(F.slice(gaps, 1, n), hits, lambda gap, hit: F.struct(
        F.length(gap).cast("long").alias("gap"), F.length(hit).cast("long").alias("size"), hit.alias("hit"), F.right(gap, F.lit(WINDOW)).alias("before"),
    ))
    after = F.zip_with(F.slice(gaps, 2, n), F.slice(hits, 2, n), lambda gap, hit: F.left(F.concat(F.left(gap, F.lit(1)), F.coalesce(F.left(hit, F.lit(1)), F.lit(""))), F.lit(1)))

    def scored(parts: Column) -> Column:
        placed = F.zip_with(
            F.zip_with(parts, _stops(parts, F.size(parts)), lambda part, stop: F.struct(part.alias("part"), stop.alias("stop"))), after,
            lambda p, c: F.struct(p["part"]["hit"].alias("hit"), p["part"]["before"].alias("before"), p["part"]["size"].alias("size"), p["stop"].alias("stop"), c.alias("after")),
        )
        confirmed = F.filter(placed, lambda p: kind.check(p["hit"], p["before"], p["after"]))
        near = lambda p: F.when(fold_case(p["before"]).rlike(f"(?:{kind.words})"), NEARBY).otherwise(0)
        return F.transform(confirmed, lambda p: F.struct(
            (p["stop"] - p["size"]).alias("start"), F.lit(place).alias("place"), p["stop"].alias("end"), F.lit(kind.name).alias("kind"),
            (F.lit(kind.points + CHECKED * kind.checksum) + near(p)).alias("score"),
        ))

    found = _let(parts, scored)
    return found if kind.name in BASE else F.filter(found, lambda s: s["score"] >= NEEDED)


def _spans(text: Column, kind: Kind, place: int) -> Column:
    """The confirmed proposals of a kind in order: (start, place of the kind, end, kind, score)."""
    matched = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hits"))
    found = _let(matched, lambda m: F.when(F.size(m["hits"]) > 0, _confirmed(m["gaps"], m["hits"], kind, place)))
    return F.coalesce(F.when(kind.hint(text), found), F.array()).cast(_SPAN)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _number(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (spans of these kinds as text), spans (all), found (all as structs,
    with scores): one row per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # Sorted by start, then by place among the kinds.
    found = F.array_sort(F.concat(*[_spans(F.col("text"), kind, place) for place, kind in enumerate(kinds)]))
    rows = rows.select("doc_id", found.alias("found"))
    base = [k.name for k in kinds if k.name in BASE]
    return rows.select(
        "doc_id", *[_number(name).alias(f"n_{name}") for name in base],
        _listed(F.filter("found", lambda s: s["kind"].isin(base))).alias("base"), _listed(F.col("found")).alias("spans"), "found",
    )
