"""Formats of date texts, inferred from the shapes of a whole column.

The texts are aggregated to their shapes, which are few: four digits in a row are ``Y``, one or
two ``9``, other runs of digits ``D``, up to three letters ``a``, more letters ``aa``. Every
shape that is a date gets a pattern. Whether day or month comes first is decided by all shapes
of that order together: a number above 12 is a day.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from surtido.session import fresh_folder, remove_folder

# Shapes are cut here; what is longer is no date.
SHAPE_LENGTH = 40

_DATE = r"(?P<date>(?:Y|9|a|aa)(?P<s1>[-/. ]|, ?|\. ?)(?:9|a|aa)(?P<s2>[-/. ]|, ?|\. ?)(?:Y|9))"
_TIME = r"(?:(?P<gap> )(?P<time>9:9(?::9)?)(?P<half> ?a)?)?"
_SHAPE = re.compile(_DATE + _TIME)
_TOKEN = re.compile(r"Y|9|aa?")


def date_shape(text: Column) -> Column:
    """The shape of a text without its outer blanks."""
    shape = F.regexp_replace(F.trim(text), r"\p{L}{4,}", "aa")
    shape = F.regexp_replace(shape, r"(?<!\p{L})(?!aa)\p{L}{1,3}(?!\p{L})", "a")
    shape = F.regexp_replace(shape, r"(?<!\d)(\d{3}|\d{5,})(?!\d)", "D")
    shape = F.regexp_replace(shape, r"(?<!\d)\d{4}(?!\d)", "Y")
    return F.substring(F.regexp_replace(shape, r"\d+", "9"), 1, SHAPE_LENGTH)


def date_shapes(df: DataFrame, column: str) -> DataFrame:
    """One row per shape: ``forma, filas, mayor_1, mayor_2, ejemplo``.

    ``mayor_1`` and ``mayor_2`` are the largest first and second numbers of one or two digits,
    ``ejemplo`` is the least text. Nulls are left out. Dates repeat, so equal texts are counted
    first, in the tasks before the shuffle as well, and each text is looked at once.
    """
    texts = df.select(F.col(f"`{column}`").cast("string").alias("texto")).where(
        F.col("texto").isNotNull()).groupBy("texto").agg(F.count(F.lit(1)).alias("filas"))
    text = F.col("texto")
    small = F.transform(F.regexp_extract_all(text, F.lit(r"(?<!\d)(\d{1,2})(?!\d)"), 1),
                        lambda n: n.cast("int"))
    return texts.select(
        date_shape(text).alias("forma"), F.get(small, F.lit(0)).alias("n1"),
        F.get(small, F.lit(1)).alias("n2"), "texto", "filas").groupBy("forma").agg(
        F.sum("filas").alias("filas"), F.max("n1").alias("mayor_1"),
        F.max("n2").alias("mayor_2"), F.min("texto").alias("ejemplo"))


@dataclass(frozen=True)
class DateFormats:
    """Patterns by rows, most first, and how many rows they do not settle.

    ``ambiguous`` rows could have day or month first, and are read month first;
    ``contradictory`` ones have numbers above 12 in both places. ``unread`` rows have no
    date shape; ``examples`` are some of their texts.
    """

    formats: tuple[str, ...]
    ambiguous: int
    contradictory: int
    unread: int
    examples: tuple[str, ...]


def _order(tokens: Sequence[str]) -> str:
    return "".join(tokens)


def _pattern(shape: str, day_first: bool) -> str | None:
    """The pattern of a date shape; None if it is none."""
    found = _SHAPE.fullmatch(shape)
    if not found:
        return None
    tokens = _TOKEN.findall(found["date"])
    names = {"a": "MMM", "aa": "MMMM"}
    parts = {
        "Y99": ["yyyy", "M", "d"],
        "99Y": ["d", "M", "yyyy"] if day_first else ["M", "d", "yyyy"],
        "999": ["d", "M", "yy"] if day_first else ["M", "d", "yy"],
    }.get(_order(tokens))
    if parts is None and [t[0] for t in tokens] in (["9", "a", "Y"], ["9", "a", "9"]):
        parts = ["d", names[tokens[1]], "yyyy" if tokens[2] == "Y" else "yy"]
    if parts is None and [t[0] for t in tokens] == ["a", "9", "Y"]:
        parts = [names[tokens[0]], "d", "yyyy"]
    if parts is None and [t[0] for t in tokens] == ["Y", "a", "9"]:
        parts = ["yyyy", names[tokens[1]], "d"]
    if parts is None:
        return None
    pattern = parts[0] + found["s1"] + parts[1] + found["s2"] + parts[2]
    if found["time"]:
        hour = "h" if found["half"] else "H"
        pattern += " " + hour + ":mm" + ":ss" * (found["time"].count(":") == 2)
        pattern += found["half"] or ""
    return pattern


def formats_of(shapes: Sequence[Row | dict]) -> tuple[tuple[str, ...], int, int]:
    """(patterns, ambiguous rows, contradictory rows) of date shapes and their counts."""
    largest: dict[str, tuple[int, int]] = {}
    orders: dict[str, str] = {}
    for row in shapes:
        found = _SHAPE.fullmatch(row["forma"])
        order = _order(_TOKEN.findall(found["date"])) if found else ""
        if order in ("99Y", "999"):
            one, two = largest.get(order, (0, 0))
            largest[order] = max(one, row["mayor_1"]), max(two, row["mayor_2"])
        orders[row["forma"]] = order
    patterns: dict[str, int] = {}
    ambiguous = contradictory = 0
    for row in shapes:
        one, two = largest.get(orders[row["forma"]], (0, 13))
        if orders[row["forma"]] in largest:
            ambiguous += row["filas"] * (one <= 12 and two <= 12)
            contradictory += row["filas"] * (one > 12 and two > 12)
        pattern = _pattern(row["forma"], one > 12 and two <= 12)
        if pattern:
            patterns[pattern] = patterns.get(pattern, 0) + row["filas"]
    return (tuple(sorted(patterns, key=lambda p: (-patterns[p], p))), ambiguous, contradictory)


def infer_formats(df: DataFrame, column: str) -> DateFormats:
    """The formats of a column of date texts; ISO texts need none.

    Only shapes of the date grammar come to the driver, which are some hundreds at most. The
    shapes are written to the shared folder first, so the column is read once.
    """
    spark, path = df.sparkSession, fresh_folder(df.sparkSession)
    shapes = date_shapes(df, column)
    shapes.write.parquet(path)
    shapes = spark.read.schema(shapes.schema).parquet(path)
    iso = F.col("forma").startswith("Y-9")
    dated = F.col("forma").rlike(f"^{_SHAPE.pattern.replace('?P<', '?<')}$")
    formats, ambiguous, contradictory = formats_of(shapes.where(dated & ~iso).collect())
    others = shapes.where(~dated & ~iso & (F.col("forma") != ""))
    unread = others.agg(F.coalesce(F.sum("filas"), F.lit(0))).first()[0]
    examples = others.orderBy(F.desc("filas"), "ejemplo").limit(5).collect() if unread else ()
    remove_folder(spark, path)
    return DateFormats(formats, ambiguous, contradictory, unread,
                       tuple(r["ejemplo"] for r in examples))
