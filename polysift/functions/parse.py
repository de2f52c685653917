"""Answer parsing: expressions from model text to values, null when the text cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .text import col, cut_at_eos, drop_eos, py_strip

# The closed answer set of the audio-visual question benchmark.
AVQA_ANSWERS = [
    "zero", "pipa", "middle", "congas", "eight", "saxophone", "tuba", "no", "guzheng", "left", "ten", "four",
    "five", "nine", "more than ten", "drum", "suona", "indoor", "two", "simultaneously", "piano", "right",
    "acoustic_guitar", "trumpet", "seven", "outdoor", "six", "yes", "violin", "flute", "clarinet", "bagpipe",
    "one", "three", "accordion", "cello", "electric_bass", "erhu", "ukulele", "bassoon", "banjo", "xylophone",
]
CHOICE_LETTERS = ["a", "b", "c", "d", "e"]
# Spoken forms folded to yes / no, in the order they are applied.
YES_NO_WORDS = [("不是", "No"), ("是", "Yes"), ("否", "No")]
TRUTH_WORDS = [("true", "yes"), ("false", "no")]

_INT = r"^[+-]?[0-9]+$"
_PAREN = r"\(\s*([0-9]+)\s+([0-9]+)\s*\)"


def tag_bodies(c: Column | str, tag: str) -> Column:
    """All shortest ``<tag>..</tag>`` bodies; a body holds no line feed."""
    return F.regexp_extract_all(col(c), F.lit(rf"(?d)<{tag}>(.*?)</{tag}>"), F.lit(1))


def single_tag(c: Column | str, tag: str) -> Column:
    """Stripped body when the tag occurs exactly once, else null."""
    return let(lambda found: F.when(F.size(found) == 1, py_strip(F.get(found, F.lit(0)))), found=tag_bodies(c, tag))


def to_int(c: Column) -> Column:
    """Signed decimal text with optional edge whitespace -> long, else null."""
    text = py_strip(c)
    return F.when(text.rlike(_INT), text.try_cast("bigint"))


def gold_text(c: Column | str) -> Column:
    """Expected answer: end marker cut, stripped, lower case."""
    return F.lower(py_strip(cut_at_eos(c)))


def parse_ranges(c: Column | str) -> Column:
    """Every well-formed ``<range>a,b</range>`` as ``{start, end}``; malformed ones are left out."""
    parts = F.transform(tag_bodies(c, "range"), lambda body: F.split(py_strip(body), ",", -1))
    pairs = F.transform(
        F.filter(parts, lambda p: F.size(p) == 2),
        lambda p: F.struct(to_int(p[0]).alias("start"), to_int(p[1]).alias("end")),
    )
    return F.filter(pairs, lambda r: r["start"].isNotNull() & r["end"].isNotNull())


def parse_paren_ranges(c: Column | str) -> Column:
    """Every ``(a b)`` pair inside the event text as ``{start, end}``."""
    c = col(c)
    starts = F.regexp_extract_all(c, F.lit(_PAREN), F.lit(1))
    ends = F.regexp_extract_all(c, F.lit(_PAREN), F.lit(2))
    return F.zip_with(
        starts,
        ends,
        lambda s, e: F.struct(s.try_cast("bigint").alias("start"), e.try_cast("bigint").alias("end")),
    )


def paren_event(c: Column | str) -> Column:
    """Event name in front of the first ``(a b)`` pair, trailing commas removed, lower case."""
    head = F.regexp_extract(col(c), rf"(?s)^(.*?){_PAREN}", 1)
    return F.lower(F.rtrim(py_strip(head), F.lit(",")))


def event_of(c: Column | str) -> Column:
    """Name between ``event:`` and ``start_time``, lower case; null when absent."""
    found = F.regexp_extract_all(col(c), F.lit(r"(?d)event:(.*?)start_time"), F.lit(1))
    return F.lower(py_strip(F.get(found, F.lit(0))))


def event_second(c: Column | str, from_end: int) -> Column:
    """Integer after the last colon of the ``from_end``-th last blank-separated token."""
    tokens = F.split(py_strip(drop_eos(c)), " ", -1)
    return to_int(F.substring_index(F.try_element_at(tokens, F.lit(-from_end)), ":", -1))


def parse_choice(c: Column | str) -> Column:
    """First letter a..e that is followed by a blank anywhere in the text; null when there is none."""
    text = F.lower(py_strip(c))
    hits = [F.when(F.contains(text, F.lit(letter + " ")), F.lit(f"({letter})")) for letter in CHOICE_LETTERS]
    return F.coalesce(*hits)


def parse_yesno(c: Column | str) -> Column:
    """yes if the text holds "yes", else no if it holds "no", else null."""
    text = F.lower(py_strip(c))
    return F.when(F.contains(text, F.lit("yes")), F.lit("yes")).when(F.contains(text, F.lit("no")), F.lit("no"))


def parse_yesno_lax(c: Column | str) -> Column:
    """yes if the text holds "yes", otherwise always no."""
    text = F.lower(py_strip(F.replace(col(c), F.lit("\n"), F.lit(" "))))
    return F.when(F.contains(text, F.lit("yes")), F.lit("yes")).otherwise(F.lit("no"))


def parse_yesno_prefix(c: Column | str) -> Column:
    """Exact yes / no, else whichever occurs in the first four characters, else "other"."""
    text = F.lower(col(c))
    head = F.substring(text, 1, 4)
    return (
        F.when(text.isin("yes", "no"), text)
        .when(F.contains(head, F.lit("yes")), F.lit("yes"))
        .when(F.contains(head, F.lit("no")), F.lit("no"))
        .otherwise(F.lit("other"))
    )


def normalize_yesno_text(c: Column | str) -> Column:
    """Drop line feeds and fold Chinese and truth words to yes / no."""
    out = F.replace(col(c), F.lit("\n"), F.lit(""))
    for word, plain in YES_NO_WORDS:
        out = F.replace(out, F.lit(word), F.lit(plain))
    out = F.lower(out)
    for word, plain in TRUTH_WORDS:
        out = F.replace(out, F.lit(word), F.lit(plain))
    return out


def answer_in_vocab(c: Column | str, answers: list[str] | None = None) -> Column:
    return F.lower(py_strip(c)).isin(answers or AVQA_ANSWERS)


def contains_answer(gold: Column | str, pred: Column | str, *, exact: bool = False) -> Column:
    """Gold is a substring of the prediction (or equal to it, when ``exact``)."""
    gold, pred = col(gold), col(pred)
    return (gold == pred) if exact else F.contains(pred, gold)


def label_code(c: Column | str) -> Column:
    """yes / no / other -> 1 / 0 / -1."""
    c = col(c)
    return F.when(c == "yes", 1).when(c == "no", 0).when(c == "other", -1)


def media_codes(c: Column | str) -> Column:
    """Integers of all ``<vqgan_N>`` tags, in order."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"<vqgan_([0-9]+)>"), F.lit(1)), lambda x: x.try_cast("bigint"))
