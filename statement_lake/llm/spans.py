"""Spans of patterns in texts, with built-in functions only.

All offsets are code points, as length() counts them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches are counted up in stretches of this many, so long lists stay cheap.
STRETCH = 128

SPANS = "array<struct<start:bigint,size:bigint,text:string>>"
FOUND = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, likely: str | None = None) -> Column:
    """Leftmost non-overlapping matches of a pattern, as an array of (start, size, text).

    split() and regexp_extract_all() find the same matches; a match begins after
    all gaps and matches before it.  likely: a simpler pattern that every text
    with a match has; only texts that have it are searched.
    """

    def placed(parts: Column) -> Column:
        last = F.greatest(F.ceil(F.size(parts) / F.lit(STRETCH)).cast("int") - 1, F.lit(0))
        cut = F.transform(
            F.sequence(F.lit(0), last), lambda c: F.slice(parts, c * STRETCH + 1, F.lit(STRETCH))
        )

        def total(some: Column) -> Column:
            return F.aggregate(some, F.lit(0).cast("bigint"), lambda a, p: a + p["gap"] + p["size"])

        def within(stretch: Column, before: Column) -> Column:
            return F.transform(
                stretch,
                lambda p, i: F.struct(
                    (before + total(F.slice(stretch, F.lit(1), i)) + p["gap"]).alias("start"),
                    p["size"].alias("size"),
                    p["text"].alias("text"),
                ),
            )

        def over(stretches: Column, totals: Column) -> Column:
            return F.flatten(
                F.transform(
                    stretches,
                    lambda s, c: let(
                        F.aggregate(
                            F.slice(totals, F.lit(1), c), F.lit(0).cast("bigint"), lambda a, x: a + x
                        ),
                        lambda before: within(s, before),
                    ),
                )
            )

        return let(cut, lambda st: let(F.transform(st, total), lambda totals: over(st, totals)))

    def zipped(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.zip_with(
            gaps,
            found,
            lambda g, m: F.struct(
                F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size"), m.alias("text")
            ),
        )

    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    whole = let(every, lambda found: let(zipped(found), placed))
    none = F.array().cast(SPANS)
    return F.when(text.rlike(likely or pattern), whole).otherwise(none).cast(SPANS)


def kept(matches: Column, kind: str, rank: int, test: Callable[[Column], Column]) -> Column:
    """(start, rank, end, kind) of the matches whose text passes."""
    return F.transform(
        F.filter(matches, lambda m: test(m["text"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (m["start"] + m["size"]).alias("end"),
            F.lit(kind).alias("kind"),
        ),
    ).cast(FOUND)


def merged(lists: Sequence[Column]) -> Column:
    """All spans in order of start, then kind as listed."""
    return F.array_sort(F.concat(*lists))


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def apart(found: Column, others: Column) -> Column:
    """The spans of found that share no character with any of the others, which are in order of start.

    The others are looked at by stretches that know where they begin and end.
    """

    def cut(spans: Column) -> Column:
        last = F.greatest(F.ceil(F.size(spans) / F.lit(STRETCH)).cast("int") - 1, F.lit(0))
        parts = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(spans, c * STRETCH + 1, F.lit(STRETCH)))
        return F.transform(
            parts,
            lambda p: F.struct(
                F.get(p, F.lit(0))["start"].alias("start"),
                F.array_max(F.transform(p, lambda o: o["end"])).alias("end"),
                p.alias("spans"),
            ),
        )

    def meets(s: Column, o: Column) -> Column:
        return (s["start"] < o["end"]) & (o["start"] < s["end"])

    def free(stretches: Column) -> Column:
        return F.filter(
            found,
            lambda s: ~F.exists(
                stretches,
                lambda g: F.coalesce(meets(s, g), F.lit(False)) & F.exists(g["spans"], lambda o: meets(s, o)),
            ),
        )

    return F.when(F.size(others) > 0, let(cut(others), free)).otherwise(found)


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans count as one.

    found must be in order of start.
    """
    begun = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        mark = F.when(s["start"] >= a["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(
            F.concat(a["done"], gap, mark).alias("done"), F.greatest(a["at"], s["end"]).alias("at")
        )

    rest = lambda a: F.concat(a["done"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(found) > 0, F.aggregate(found, begun, step, rest)).otherwise(text)
