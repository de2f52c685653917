"""String expressions: stripping, media tags, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed from both ends of a string by a whitespace strip.
EDGE_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
EOS = "</s>"
YES_NO_PHRASE = "Please answer yes or no."
SENTENCE_END = [".", "!", "?"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Remove all edge whitespace; Spark's plain ``trim`` only removes blanks."""
    return F.btrim(col(c), F.lit(EDGE_WHITESPACE))


def cut_at_eos(c: Column | str, eos: str = EOS) -> Column:
    """Text before the first end marker."""
    return F.substring_index(col(c), eos, 1)


def drop_eos(c: Column | str, eos: str = EOS) -> Column:
    """Text with every end marker removed."""
    return F.replace(col(c), F.lit(eos), F.lit(""))


def basename(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", -1)


def stem(c: Column | str) -> Column:
    """Last path part without its extension."""
    return F.regexp_replace(basename(c), r"\.[^.]*$", "")


def media_path(root: str, kind: str, name: Column | str, ext: str) -> Column:
    """``root/kind/<name>.ext``; empty root or kind parts are left out."""
    parts = [F.lit(p) for p in (root, kind) if p]
    return F.concat_ws("/", *parts, F.concat(col(name), F.lit(ext)))


def question_part(c: Column | str, phrase: str = YES_NO_PHRASE) -> Column:
    """Stripped text before the fixed phrase."""
    return py_strip(F.split_part(py_strip(c), F.lit(phrase), F.lit(1)))


def answer_part(c: Column | str, phrase: str = YES_NO_PHRASE) -> Column:
    """Stripped text between the first and second fixed phrase; null when the phrase is absent."""
    line = py_strip(c)
    return F.when(F.contains(line, F.lit(phrase)), py_strip(F.split_part(line, F.lit(phrase), F.lit(2))))


def ensure_terminal_punct(c: Column | str) -> Column:
    c = col(c)
    return F.when(F.right(c, F.lit(1)).isin(SENTENCE_END), c).otherwise(F.concat(c, F.lit(".")))


def strip_tag(c: Column | str, tag: str, *, newlines: bool = False) -> Column:
    """Drop a media placeholder, and line feeds too when asked."""
    out = F.replace(col(c), F.lit(tag), F.lit(""))
    return F.replace(out, F.lit("\n"), F.lit("")) if newlines else out


def expand_placeholder(c: Column | str, tag: str = "<image>", n: int = 32) -> Column:
    """Write each placeholder ``n`` times."""
    return F.replace(col(c), F.lit(tag), F.lit(tag * n))


def normalise_slashes(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("\\"), F.lit("/"))
