"""Text helpers as Spark column expressions.

Offsets are 0-based, half open and counted in characters, as ``length`` does.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the characters treated as blank, ASCII and Unicode
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_OTHER_BLANKS = BLANKS.replace(" ", "")
_NOT_BLANK = "[^" + "".join(f"\\u{ord(b):04x}" for b in BLANKS) + "]"

# fixed value: zero-width marks and punctuation ignored, as blanks are, when matching text
PUNCTUATION = "\u200b\u200c\u200d\u2060\ufeff" + ".,:;!?()[]{}\"'/\\-\u2013\u2014"

# a new line starts after each of these
_LINE_START = r"(?<=\n|\x0b|\x0c|\x1c|\x1d|\x1e|\x85|\u2028|\u2029|\r(?!\n))"

SPAN_TYPE = "array<struct<start:int,end:int,text:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression that uses a costly value several times, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Remove blanks at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """True for null, empty and all-blank text; a look at the first character that is no blank."""
    return F.coalesce(~c.rlike(_NOT_BLANK), F.lit(True))


def _collapse(c: Column, blanks: str) -> Column:
    """One space for each run of the given characters and spaces, none at the ends.

    Mapping the characters first leaves a plain expression, several times faster
    than one over the whole set.
    """
    spaced = F.translate(c, blanks, " " * len(blanks))
    return F.btrim(F.regexp_replace(spaced, " {2,}", " "))


def squash(c: Column) -> Column:
    """Collapse each run of blanks to one space and strip."""
    return _collapse(c, _OTHER_BLANKS)


def text_key(c: Column) -> Column:
    """Grouping and comparison key: squashed, lower case, null as empty."""
    return F.lower(squash(F.coalesce(c, F.lit(""))))


def match_key(c: Column) -> Column:
    """Like :func:`text_key`, with punctuation treated as blank."""
    return _collapse(F.lower(F.coalesce(c, F.lit(""))), _OTHER_BLANKS + PUNCTUATION)


def joined_match_keys(words: Column, mark: str) -> Column:
    """The match keys of an array of words with a mark between them; a null word counts as an empty one.

    The joined text goes through the steps once, not each word by itself; ``mark`` is neither blank nor punctuation.
    """
    key = match_key(F.array_join(words, mark, ""))
    return F.replace(F.replace(key, F.lit(" " + mark), F.lit(mark)), F.lit(mark + " "), F.lit(mark))


def words(key: Column) -> Column:
    """Words of a text that already went through a key function."""
    return F.array_remove(F.split(key, " "), "")


def first_words(key: Column, n: int) -> Column:
    return F.array_join(F.slice(words(key), 1, n), " ")


def last_words(key: Column, n: int) -> Column:
    w = words(key)
    return F.array_join(F.when(F.size(w) > n, F.slice(w, -n, n)).otherwise(w), " ")


def cut(c: Column, start: Column, end: Column) -> Column:
    """The characters ``[start, end)``."""
    return F.substring(c, start + 1, F.greatest(end - start, F.lit(0)))


def context(c: Column, start: Column, end: Column, pad: int) -> Column:
    """A span with up to ``pad`` characters on each side."""
    return cut(c, F.greatest(start - pad, F.lit(0)), end + pad)


def lines_with_ends(c: Column) -> Column:
    """Lines including their terminators; joining them gives the text back."""
    return F.filter(F.split(c, _LINE_START), lambda x: x != "")


def prefix_sums(lengths: Column, chunk: int = 512) -> Column:
    """For each element of an int array the sum of the elements before it.

    Long arrays are summed in chunks. Growing one array element by element
    copies it every time, which for very long ones would be quadratic.
    """

    def small(a: Column) -> Column:
        start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return F.struct(
                (acc["pos"] + x).alias("pos"), F.concat(acc["out"], F.array(acc["pos"])).alias("out")
            )

        return F.aggregate(a, start, step, lambda acc: acc["out"])

    def large(a: Column) -> Column:
        last = F.floor((F.size(a) - 1) / chunk).cast("int")
        cuts = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(a, c * chunk + 1, chunk))

        def joined(parts: Column) -> Column:
            totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + x))
            return F.flatten(
                F.zip_with(parts, small(totals), lambda p, s: F.transform(small(p), lambda x: x + s))
            )

        return let(cuts, joined)

    return let(lengths, lambda a: F.when(F.size(a) <= chunk, small(a)).otherwise(large(a)))


def spans_between(gaps: Column, hits: Column) -> Column:
    """Spans of ``hits``, given the text pieces between them; one piece follows the last hit."""
    pairs = F.zip_with(
        gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("n"), h.alias("hit"))
    )

    def place(found: Column) -> Column:
        before = prefix_sums(F.transform(found, lambda x: x["gap"] + x["n"]))
        return F.zip_with(
            found,
            before,
            lambda x, s: F.struct(
                (s + x["gap"]).alias("start"), (s + x["gap"] + x["n"]).alias("end"), x["hit"].alias("text")
            ),
        )

    return let(F.filter(pairs, lambda x: x["hit"].isNotNull()), place)


# what looks at the text around a match, or gives nothing back once taken
_AROUND = re.compile(r"[$^]|\(\?<?[=!>]|[*+?}]\+")
_CLASS = re.compile(r"\[\^?\]?[^\]]*\]")
_FLAGS = re.compile(r"\(\?(?!:|i\))")


def stays_in_line(regex: str) -> bool:
    """Whether every match lies within one line and stays a match if blanks or other lines are put around or taken away.

    Errs on the side of no: takes no anchors, look-arounds or possessive parts, no classes that are negated, joined or
    nested, and no escapes but those of punctuation, ``\\b``, ``\\d``, ``\\w`` and ``\\S``.
    """
    escapes = set(re.findall(r"\\(.)", regex, re.DOTALL))
    plain = re.sub(r"\\.", "e", regex, flags=re.DOTALL)
    classes = _CLASS.findall(plain)
    bare = _CLASS.sub("", plain)
    if any(x.isalnum() and x not in "bdwS" for x in escapes) or any(ord(x) < 32 for x in regex) or "&&" in regex:
        return False
    return not (any(x.startswith("[^") or "[" in x[1:] for x in classes) or _AROUND.search(bare) or _FLAGS.search(bare))


def occurs(c: Column, pattern: str, needs: str | None = None) -> Column:
    """Whether a pattern occurs; ``needs`` is a literal part of every match, looked for first."""
    return c.rlike(pattern) if needs is None else F.contains(c, F.lit(needs)) & c.rlike(pattern)


def pieces_and_hits(c: Column, pattern: str) -> list[Column]:
    """The pieces between the matches of a pattern, and the matches, from two scans."""
    return [F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(pattern), F.lit(0))]


def pattern_spans(c: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches of a pattern as ``array<struct<start,end,text>>``."""
    found = spans_between(*pieces_and_hits(c, pattern))
    return F.when(occurs(c, pattern, needs), found).otherwise(F.array().cast(SPAN_TYPE))


def literal_spans(c: Column, query: Column, limit: int | None = None) -> Column:
    """Case-insensitive occurrences of a literal, at most ``limit`` of them.

    Does not find overlapping occurrences. ``query`` must not be empty.
    """
    quoted = F.concat(F.lit("(?iu)\\Q"), F.replace(query, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    pieces = F.split(c, quoted, -1 if limit is None else limit + 1)
    hits = F.regexp_extract_all(c, quoted, F.lit(0))
    n = F.size(pieces) - 1
    spans = spans_between(F.slice(pieces, 1, F.greatest(n, F.lit(0))), F.slice(hits, 1, F.greatest(n, F.lit(0))))
    return F.when(F.rlike(c, quoted), spans).otherwise(F.array().cast(SPAN_TYPE))


def quoted(c: Column) -> Column:
    """Text in quotes: single quotes unless the text holds only single ones."""
    esc = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.when(
        F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"')),
        F.concat(F.lit('"'), esc, F.lit('"')),
    ).otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """True if any of a fixed list of literals occurs in the text."""
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(c, F.lit(n))
    return out


def show(c: Column, null_text: str) -> Column:
    """A scalar as display text."""
    return F.coalesce(c.cast("string"), F.lit(null_text))
