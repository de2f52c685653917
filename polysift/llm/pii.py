"""Personal data in texts, by native expressions: patterns propose spans, checksums confirm, context adjusts the score.

Each kind has a pattern; its matches and the pieces between them give code point offsets in one linear pass, so no row
leaves the JVM or moves. Proposals that fail their check (octets, Luhn, mod 97, digit counts) are dropped; the score of
the others is the weight of the kind plus a bonus for context words close by, and spans under ``THRESHOLD`` are dropped.

The base kinds pass on their pattern and check alone. Their patterns only add look-around and possessive quantifiers to
the plain forms in the comments: same matches, but linear on long runs of letters or digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polysift.functions.bind import let

THRESHOLD = 0.5
#: Code points looked at on either side of a span, up to the neighbouring spans of the kind.
NEAR = 40
_CHUNK = 512
_FOUND = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _only_digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a non-empty string of digits passes the Luhn check."""

    def check(d: Column) -> Column:
        n = F.length(d)

        def add(total: Column, i: Column) -> Column:
            v = F.substring(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
            return total + F.when(v > 9, v - 9).otherwise(v)

        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0

    return let(lambda d: F.when(F.length(d) > 0, check(d)).otherwise(False), d=digits)


def mod97(match: Column) -> Column:
    """Whether an account number in its international form leaves 1 modulo 97, spaces aside."""

    def check(s: Column) -> Column:
        moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

        def add(rest: Column, c: Column) -> Column:
            code = F.ascii(c)
            return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

        return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1

    return let(check, s=F.regexp_replace(match, " ", ""))


def _count_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.length(_only_digits(m)).between(low, high)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: Callable[[Column], Column] | None
    #: A character that every match holds, to pass over texts without it.
    holds: str | None
    weight: float
    context: str | None = None
    bonus: float = 0.0


BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "@", 0.9),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), ".", 0.6,
         r"(?i)\b(?:ip|host|server|address|adresse|direcci)", 0.2),
    # [0-9]([\x20-]?[0-9])+ with 16 to 19 digits passing Luhn
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", lambda m: luhn(_only_digits(m)), None,
         0.7, r"(?i)\b(?:card|visa|credit|carte|karte|tarjeta)", 0.2),
    # \+[0-9][\x20().0-9-]+[0-9] with 8 to 15 digits
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _count_between(8, 15), "+", 0.6,
         r"(?i)\b(?:phone|tel|call|mobile|fax|contact)", 0.3),
)

ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", mod97, None, 0.6,
         r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)", 0.3),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None, "-", 0.3,
         r"(?i)\b(?:ssn|social security|tax id)", 0.5),
    Kind("tel", r"(?<![0-9A-Za-z+().-])\(?[0-9]{2,4}\)?(?:[\x20./-]?[0-9]{2,4}){2,4}(?![0-9])", _count_between(7, 15), None, 0.2,
         r"(?i)\b(?:phone|tel|telefon|call|mobile|fax|whatsapp)", 0.4),
)
KINDS = BASE + ADDED


def exclusive_sums(lengths: Column) -> Column:
    """Sum of all elements before each one; chunk by chunk, so long arrays stay near linear."""
    none = F.array().cast("array<bigint>")

    def local(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).cast("bigint").alias("total"), none.alias("before")),
            lambda acc, x: F.struct((acc.total + x).alias("total"), F.concat(acc.before, F.array(acc.total)).alias("before")),
        )

    def whole(v: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(1), F.size(v), F.lit(_CHUNK)), lambda at: local(F.slice(v, at, F.lit(_CHUNK))))
        start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<array<bigint>>").alias("all"))
        merged = F.aggregate(
            chunks,
            start,
            lambda acc, c: F.struct(
                (acc.total + c.total).alias("total"),
                F.concat(acc["all"], F.array(F.transform(c.before, lambda b: b + acc.total))).alias("all"),
            ),
        )
        return F.flatten(merged["all"])

    return let(lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none), v=lengths)


def _proposals(text: Column, kind: Kind) -> Column:
    """Matches of the pattern with the piece before and after each, or none."""
    match = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return match if kind.holds is None else F.when(F.instr(text, kind.holds) > 0, match).otherwise(none)


def _confirmed(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    """Score of a proposal, null if it fails its check or the threshold."""
    score = F.lit(kind.weight)
    if kind.context:
        near = F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR)))
        score = F.when(near.rlike(kind.context), F.lit(kind.weight + kind.bonus)).otherwise(score)
    kept = score >= THRESHOLD
    return F.when(kept if kind.check is None else kind.check(match) & kept, score)


def _scored(kind: Kind, t: Column, m: Column) -> Column:
    """Every proposal as (before, match, start, score), with null scores for rejected ones."""

    def place(p: Column, m: Column) -> Column:
        steps = F.transform(m, lambda x, i: (F.length(F.get(p, i)) + F.length(x)).cast("bigint"))

        def one(s: Column) -> Column:
            return F.transform(
                m,
                lambda x, i: F.struct(
                    x.alias("match"),
                    F.get(p, i).alias("before"),
                    (F.get(s, i) + F.length(F.get(p, i))).alias("start"),
                    _confirmed(kind, x, F.get(p, i), F.get(p, i + 1)).alias("score"),
                ),
            )

        return let(one, s=exclusive_sums(steps))

    return let(lambda p: place(p, m), p=F.split(t, kind.pattern, -1))


def found_of(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order."""
    empty = F.array().cast(_FOUND)

    def spans(t: Column, m: Column) -> Column:
        good = F.filter(_scored(kind, t, m), lambda x: x.score.isNotNull())
        shaped = F.transform(
            good,
            lambda x: F.struct(
                F.lit(kind.name).alias("kind"), x.start.alias("start"), (x.start + F.length(x.match)).alias("end"), x.score.alias("score")
            ),
        )
        return F.when(F.size(m) > 0, shaped.cast(_FOUND)).otherwise(empty)

    return let(lambda t: let(lambda m: spans(t, m), m=_proposals(t, kind)), t=F.coalesce(text, F.lit("")))


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per document: its id and ``found``, spans by kind as listed, then by start, with offsets in code points.

    Spans of one kind do not overlap, spans of different kinds may. A null or empty text has none. Repeated rows give
    repeated rows; other columns are ignored.
    """
    found = F.concat(*[found_of(F.col(text_col), k) for k in kinds])
    return docs.select(F.col(id_col), found.alias("found" if id_col != "found" else "found_spans"))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def masked(docs: DataFrame, *, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The documents with every confirmed span replaced by its kind in brackets, kind after kind; null stays null.

    A later kind is looked for in what the earlier ones left. All other columns stay as they are.
    """

    def replaced(t: Column, kind: Kind) -> Column:
        label = F.lit(f"[{kind.name.upper()}]")

        def rebuilt(m: Column) -> Column:
            parts = F.transform(_scored(kind, t, m), lambda x: F.concat(x.before, F.when(x.score.isNull(), x.match).otherwise(label)))
            rest = F.element_at(F.split(t, kind.pattern, -1), -1)
            return F.when(F.size(m) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(t)

        return let(rebuilt, m=_proposals(t, kind))

    for kind in kinds:
        text = F.col(text_col)
        # The column is used twice, so each kind keeps a projection of its own and none nests in the next.
        docs = docs.withColumn(text_col, F.when(text.isNull(), text).otherwise(let(lambda t, k=kind: replaced(t, k), t=text)))
    return docs
