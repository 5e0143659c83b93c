"""Text inside fixed page regions, from a table of word boxes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rect = tuple[float, float, float, float]


def inside(rect: Rect, box: Sequence[str] = ("x0", "y0", "x1", "y1")) -> Column:
    """The word box lies wholly within the rectangle (x0, y0, x1, y1)."""
    left, top, right, bottom = rect
    x0, y0, x1, y1 = (F.col(c) for c in box)
    return (x0 >= left) & (y0 >= top) & (x1 <= right) & (y1 <= bottom)


def _region_conditions(
    regions: Mapping[str, Rect] | Mapping[str, Mapping[str, Rect]], template: str | None
) -> dict[str, Column]:
    if template is None:
        return {name: inside(rect) for name, rect in regions.items()}
    conditions: dict[str, Column] = {}
    for key, named in regions.items():
        for name, rect in named.items():
            here = (F.col(template) == F.lit(key)) & inside(rect)
            conditions[name] = conditions[name] | here if name in conditions else here
    return conditions


def _line_key(line: str) -> Column:
    """Line position to a millionth of a unit: exact for page coordinates, and, unlike a double, a
    grouping key whose partitioning Spark can reuse."""
    return F.col(line).cast("decimal(18,6)")


def region_text(
    words: DataFrame,
    regions: Mapping[str, Rect] | Mapping[str, Mapping[str, Rect]],
    page: Sequence[str] = ("doc", "page"),
    template: str | None = None,
    word: str = "word",
    line: str = "y0",
    across: str = "x0",
) -> DataFrame:
    """One row for each page, one text column for each region (null where no word lies in it).

    Words of a line are joined by a blank, lines by a line end, in reading order. ``regions`` is the
    region map of the caller (tens of entries), so containment is a set of literal conditions and no
    join. With ``template`` it is keyed first by the page template.

    Two steps, line then page: the words of a hot page are gathered by line in many tasks, and only
    finished lines meet in the task that owns the page. A list of words does not shrink before the
    shuffle, so the words are shuffled as they are rather than as half-built lists: each once, with a
    flag for each region. A line then has one list for each region that holds words of it, however many
    regions there are. A page without a word in any region still gives its row.
    """
    conditions = _region_conditions(regions, template)
    slots = {name: f"__region_{i}" for i, name in enumerate(conditions)}
    flagged = words.select(
        *page,
        _line_key(line).alias("__line"),
        F.col(across).alias("__across"),
        F.col(word).alias("__word"),
        *[F.coalesce(conditions[n], F.lit(False)).alias(s) for n, s in slots.items()],
    )
    # A row for each region that holds the word, or one without a word that keeps the page; made behind the shuffle.
    held = F.explode(F.array(
        *[F.when(F.col(s), F.lit(i)) for i, s in enumerate(slots.values())],
        F.when(~reduce(lambda a, b: a | b, map(F.col, slots.values()), F.lit(False)), F.lit(len(slots))),
    ))
    tagged = flagged.repartition(*page, "__line").select(*page, "__line", "__across", "__word", held.alias("__region")).where("__region IS NOT NULL")
    tagged = tagged.withColumn("__word", F.when(F.col("__region") < len(slots), F.col("__word")))
    lines = tagged.groupBy(*page, "__line", "__region").agg(
        F.expr("listagg(__word, ' ') within group (order by __across, __word)").alias("__text")
    )
    texts = lines.repartition(*page).groupBy(*page, "__region").agg(F.expr("listagg(__text, '\\n') within group (order by __line)").alias("__text"))
    pages = texts.groupBy(*page).agg(*[F.max(F.when(F.col("__region") == i, F.col("__text"))).alias(s) for i, s in enumerate(slots.values())])
    return pages.select(*page, *[F.col(s).alias(n) for n, s in slots.items()])


def region_text_long(
    words: DataFrame,
    regions: Mapping[str, Rect] | Mapping[str, Mapping[str, Rect]],
    page: Sequence[str] = ("doc", "page"),
    template: str | None = None,
    word: str = "word",
    line: str = "y0",
    across: str = "x0",
) -> DataFrame:
    """The same as rows (page, region, text), for region maps too wide to become columns."""
    conditions = _region_conditions(regions, template)
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))
    tagged = words.select(
        *page,
        F.explode(names).alias("region"),
        _line_key(line).alias("__line"),
        F.col(across).alias("__across"),
        F.col(word).alias("__word"),
    )
    keys = [*page, "region", "__line"]
    lines = tagged.repartition(*keys).groupBy(*keys).agg(
        F.expr("listagg(__word, ' ') within group (order by __across, __word)").alias("text")
    )
    return lines.groupBy(*page, "region").agg(
        F.expr(f"listagg(text, '\\n') within group (order by __line)").alias("text")
    )


LEVELS = 40


def region_text_by_table(
    words: DataFrame,
    rectangles: DataFrame,
    page: Sequence[str] = ("doc", "page"),
    template: str | None = None,
    band: float = 16.0,
    word: str = "word",
    line: str = "y0",
    across: str = "x0",
) -> DataFrame:
    """Rows (page, region, text) for the regions of a table: ``region, x0, y0, x1, y1`` and, if named, ``template``.

    Rectangles are data: any number of them, for any number of templates, and several may make up one region. Each is
    cut into two or three horizontal bands, whose height is ``band`` doubled until it reaches that of the rectangle. A
    word, which starts in one band of each height, is matched on template, height and band, and then tested by its
    edges. So the join is on equal keys, a word meets few rectangles, and words that lie in no region leave before
    anything is gathered. Which of the ``LEVELS`` heights occur is all that reaches the driver. A word that two
    rectangles of one region hold counts once.
    """
    side = [template] if template else []
    tall = F.greatest(F.ceil(F.log2((F.col("y1") - F.col("y0")) / band)), F.lit(0))
    level = F.coalesce(F.least(tall, F.lit(LEVELS)), F.lit(0)).cast("int")
    held = rectangles.where("x0 <= x1 AND y0 <= y1").select(
        *side, "region", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")]
    ).distinct().withColumn("__level", level)
    held = held.withColumn("__rank", F.dense_rank().over(Window.partitionBy("region").orderBy("x0", "y0", "x1", "y1")))
    height = F.pow(F.lit(2.0), F.col("__level")) * band
    held = held.select(
        *[F.col(c).alias(f"__{c}") for c in [*side, "x0", "y0", "x1", "y1"]],
        "region", "__rank", "__level", F.explode(F.sequence(F.floor(F.col("y0") / height), F.floor(F.col("y1") / height))).alias("__band"),
    )
    levels = sorted(r["__level"] for r in held.select("__level").distinct().collect())
    places = F.array(*[
        F.struct(F.lit(i).alias("level"), F.floor(F.col("y0") / (band * 2.0**i)).alias("band")) for i in levels or [0]
    ])
    keyed = words.withColumn("__at", F.explode(places))
    same = (F.col("__at.level") == F.col("__level")) & (F.col("__at.band") == F.col("__band"))
    for c in side:
        same = same & (F.col(c) == F.col(f"__{c}"))
    inside_of = (
        (F.col("x0") >= F.col("__x0")) & (F.col("y0") >= F.col("__y0")) & (F.col("x1") <= F.col("__x1")) & (F.col("y1") <= F.col("__y1"))
    )
    box = F.struct(F.col(across).alias("across"), F.col(word).alias("word"), "x0", "y0", "x1", "y1")
    found = keyed.join(held, same & inside_of).select(
        *page, "region", _line_key(line).alias("__line"), box.alias("__box"), "__rank"
    )
    keys = [*page, "region", "__line"]
    # Of the rectangles of one region that hold a box the least counts. Boxes are counted by rectangle and then across
    # them, rank and count in one number, all as the line is partitioned: nothing is compared pair by pair.
    counted = found.repartition(*keys).groupBy(*keys, "__box", "__rank").agg(F.count("*").alias("__n"))
    ranked = F.shiftleft(F.col("__rank").cast("bigint"), 32) + F.col("__n")
    least = counted.groupBy(*keys, "__box").agg(F.min(ranked).alias("__least")).select(
        *keys, F.col("__box.across").alias("__across"), F.col("__box.word").alias("__word"), F.col("__least").bitwiseAND(2**32 - 1).cast("int").alias("__n")
    )
    copies = F.when(F.col("__n") == 1, F.col("__word")).when(F.col("__word").isNotNull(), F.array_join(F.array_repeat("__word", F.col("__n")), " "))
    lines = least.withColumn("__copies", copies).groupBy(*keys).agg(
        F.expr("coalesce(listagg(__copies, ' ') within group (order by __across, __word), '')").alias("text")
    )
    return lines.groupBy(*page, "region").agg(F.expr("listagg(text, '\\n') within group (order by __line)").alias("text"))
