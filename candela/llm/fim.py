"""Fill-in-the-middle transformation by counted quantifiers (operator 12).

A text is a run of units (a run of ASCII letters, or one other code point).
``regexp_count`` gives their number n; two cut points a <= b in 0..n go into
a pattern of the row's own, ``^(unit{a})(unit{b-a})(rest)$``, whose groups
capture prefix, middle and suffix in one match. The counted groups are
possessive: the regular-expression engine then loops over the units instead
of recursing once per unit, and never gives a unit back, so texts of any
length match in linear time on a small stack. Everything is a JVM-side
column expression; no row leaves its partition.

One match has to hand over three strings: it rewrites the text to its three
parts with a marker between them, and the parts are split at the marker. A
text that holds a marker is never cut (its form is plain), and a marker can
not arise across a seam, since no marker's beginning is a marker's end.

Counting holds all matches of a string at one time, so it goes over slices
of ``SLICE`` code points; a letter run over a seam is counted once.

Defined results: a NULL or empty text has no units and stays plain (output
and restored text empty); a NULL id draws its numbers as the empty id; ties
of the cut points give an empty middle; repeated rows give equal rows, an
empty table no rows; other columns, whatever their names, are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import empty_if_null, unused_name

#: One unit, as a possessive alternative (no part of a letter run is ever given back).
UNIT = "[A-Za-z]++|[^A-Za-z]"
#: Code points whose units are counted at one time.
SLICE = 1 << 18


@dataclass(frozen=True)
class Markers:
    """The three marks: plain signs only, and no mark begins with the end of one (else a seam could make a mark)."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.all()
        if len(set(marks)) < 3 or not all(re.fullmatch(r"[\w<>:#/-]+", mark) for mark in marks):
            raise ValueError("markers must be three different words of letters, digits and < > : # / -")
        if any(a.endswith(b[:k]) and (a != b or k < len(a)) for a in marks for b in marks for k in range(1, len(b) + 1)):
            raise ValueError("a marker begins with the end of a marker")

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


MARKERS = Markers()


def count_units(text: Column) -> Column:
    """Number of units of ``text``: over its slices, less the letter runs that go over a seam."""
    slices = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(text) - 1) / SLICE)).cast("int"))

    def units(at: Column) -> Column:
        start = at * SLICE + 1
        inside = F.regexp_count(F.substr(text, start, F.lit(SLICE)), F.lit(UNIT))
        over = (at > 0) & F.rlike(F.substr(text, start - 1, F.lit(2)), F.lit("^[A-Za-z]{2}"))
        return (inside - over.cast("int")).cast("long")

    return F.aggregate(slices, F.lit(0).cast("long"), lambda n, at: n + units(at))


def draws(seed: Column, n: int = 4) -> list[Column]:
    """``n`` unsigned 32-bit numbers: the leading 8-digit groups of the SHA-256 of ``seed``."""
    digest = F.sha2(seed.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(n)]


def cut_in_three(text: Column, first: Column, second: Column, between: str) -> Column:
    """[prefix, middle, suffix] of ``text`` cut after ``first`` and ``second`` units, from one match."""
    counted = lambda n: F.concat(F.lit(f"((?:{UNIT}){{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit("(?s)^"), counted(first), counted(second - first), F.lit("(.*+)$"))
    return F.split(F.regexp_replace(text, pattern, F.lit(f"$1{between}$2{between}$3")), between, -1)


def transform(
    docs: DataFrame,
    *,
    seed: Column,
    text: str = "text",
    plain_percent: int = 10,
    spm_percent: int = 20,
    markers: Markers = MARKERS,
) -> DataFrame:
    """Add the struct column ``fim``: n, form, prefix, middle, suffix, output.

    ``seed`` is the text whose digest decides on cut points and form;
    ``plain_percent`` of the texts stay as they are, ``spm_percent`` of the
    rest put the suffix first. Parts are NULL where the form is plain.
    """
    out, t = unused_name(docs, "fim"), empty_if_null(text)
    held = F.lit(False)
    for mark in markers.all():
        held = held | F.contains(t, F.lit(mark))
    h1, h2, h3, h4 = draws(seed)
    # Columns of one struct, filled level by level: each level's expressions read the level before.
    numbers = F.struct(
        count_units(t).alias("n"), h1.alias("h1"), h2.alias("h2"),
        F.when((t == "") | held | (h3 % 100 >= 100 - plain_percent), "plain")
        .when(h4 % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
    )
    level = docs.withColumn(out, numbers)
    units, a, b = F.col(out)["n"] + 1, F.col(out)["h1"], F.col(out)["h2"]
    first, second = F.least(a % units, b % units), F.greatest(a % units, b % units)
    parts = F.when(F.col(out)["form"] != "plain", cut_in_three(t, first, second, markers.middle))
    level = level.withColumn(out, F.struct(F.col(out)["n"].alias("n"), F.col(out)["form"].alias("form"), parts.alias("parts")))
    form = F.col(out)["form"]
    prefix, middle, suffix = (F.col(out)["parts"][k] for k in range(3))
    p, s, m = (F.lit(x) for x in markers.all())
    written = (
        F.when(form == "plain", t)
        .when(form == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, s, suffix, m, middle))
    )
    return level.withColumn(
        out,
        F.struct(
            F.col(out)["n"].alias("n"), form.alias("form"), prefix.alias("prefix"), middle.alias("middle"),
            suffix.alias("suffix"), written.alias("output"),
        ),
    )


def restore(output: Column, form: Column, markers: Markers = MARKERS) -> Column:
    """The text that ``output`` of the given form was made from."""
    p, s, m = markers.all()
    part = "(.*?)"  # lazy over single code points: the engine loops, it does not recurse
    psm, spm = f"(?s)^{p}{part}{s}{part}{m}(.*+)$", f"(?s)^{s}{part}{p}{part}{m}(.*+)$"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )
