"""The archive's faceted search: filters, sort modes, pages, facets, headers, map."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 100


@dataclass(frozen=True)
class Filters:
    """Conditions that all have to hold; unset ones do not restrict."""

    text: str | None = None
    program_type: str | None = None
    listeners_host: bool | None = None
    year_from: int | None = None
    year_to: int | None = None
    returning: bool = False
    gender: str | None = None
    citizenship: str | None = None
    occupation: str | None = None
    topics: tuple[int, ...] = field(default=())
    themes: tuple[int, ...] = field(default=())
    episode_id: int | None = None
    age_from: int | None = None
    age_to: int | None = None


def matching(rows: DataFrame, f: Filters) -> DataFrame:
    """Rows that meet the filters. Years are calendar years of ``date``; chosen topics take the place of themes; free text looks at ``description``; of several ages any may fit."""
    tests: list[Column] = []
    if f.text:
        tests.append(F.lower("description").contains(f.text.strip().lower()))
    if f.program_type:
        tests.append(F.col("program_type") == f.program_type)
    if f.listeners_host is not None:
        tests.append(F.col("is_listeners_host") == f.listeners_host)
    if f.year_from is not None:
        tests.append(F.col("date") >= F.lit(f"{f.year_from:04d}-01-01"))
    if f.year_to is not None:
        tests.append(F.col("date") < F.lit(f"{f.year_to + 1:04d}-01-01"))
    if f.returning:
        tests.append(F.col("returning"))
    for name, value in (("genders", f.gender), ("citizenships", f.citizenship), ("occupations", f.occupation)):
        if value:
            tests.append(F.array_contains(name, value))
    if f.topics:
        tests.append(F.arrays_overlap("topic_ids", F.lit(list(f.topics))))
    elif f.themes:
        tests.append(F.arrays_overlap("theme_ids", F.lit(list(f.themes))))
    if f.episode_id is not None:
        tests.append(F.col("sr_episode_id") == f.episode_id)
    if f.age_from is not None or f.age_to is not None:
        lo, hi = f.age_from if f.age_from is not None else 0, f.age_to if f.age_to is not None else 200
        tests.append(F.exists("ages", lambda a: a.between(lo, hi)))
    for test in tests:
        rows = rows.filter(test)
    return rows


def mean_age(ages: Column) -> Column:
    """Mean of the ages that are known; null without any."""
    known = F.filter(ages, lambda a: a.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda s, a: s + a) / F.nullif(F.size(known), F.lit(0))


def sort_keys(mode: str, match: Column | None = None) -> list[Column]:
    """Keys of a sort mode. Names follow Swedish collation, missing ages come last in both directions, then newest first."""
    newest = [F.desc("date"), F.desc("sr_episode_id")]
    age = mean_age(F.col("ages"))
    modes = {
        "newest": newest,
        "oldest": [F.asc("date"), F.asc("sr_episode_id")],
        "speaker": [F.collate("speaker", "sv").asc(), *newest],
        "age_up": [age.asc_nulls_last(), *newest],
        "age_down": [age.desc_nulls_last(), *newest],
        "topic": [(F.lit(0.0) if match is None else match).desc(), *newest],
    }
    return modes[mode]


def page(rows: DataFrame, mode: str = "newest", size: int = PAGE, offset: int = 0, match: Column | None = None) -> DataFrame:
    """A page of the sorted rows: a top-k, without a full sort where the offset is 0."""
    rows = rows.orderBy(*sort_keys(mode, match))
    return (rows.offset(offset) if offset else rows).limit(size)


def facet_values(rows: DataFrame, column: str, is_array: bool = True) -> DataFrame:
    """Distinct values of a facet with the rows that have them."""
    value = rows.select("sr_episode_id", (F.explode(column) if is_array else F.col(column)).alias("value"))
    return value.filter("value is not null").groupBy("value").agg(F.count_distinct("sr_episode_id").alias("episodes"))


def facet_bounds(rows: DataFrame) -> DataFrame:
    """First and last calendar year, and the least and largest of all known ages."""
    year = F.substring("date", 1, 4).cast("int")
    return rows.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.min(F.array_min("ages")).alias("youngest"), F.max(F.array_max("ages")).alias("oldest"))


def leaf_options(topics: DataFrame, themes: list | None = None) -> DataFrame:
    """Topics (``topic_id``, ``label``, ``parent``) to choose from: those of the chosen themes, or all, in Swedish order of the labels."""
    rows = topics.filter(F.col("parent").isin(list(themes))) if themes else topics
    return rows.orderBy(F.collate("label", "sv"), "topic_id")


#: Neighbours and topics that a result shows.
SHOWN_RELATED, SHOWN_TOPICS = 6, 2


def shown(rows: DataFrame, related: int = SHOWN_RELATED, topics: int = SHOWN_TOPICS) -> DataFrame:
    """Rows with the first of their ``related`` and ``topics`` only, as a result shows them."""
    return rows.withColumns({"related": F.slice("related", 1, related), "topics": F.slice("topics", 1, topics)})


def page_after(rows: DataFrame, date: str, ident: int, size: int = PAGE) -> DataFrame:
    """The page of the newest-first order behind the row (``date``, ``ident``): by its key, without counting what lies before."""
    return page(rows.filter((F.col("date") < date) | ((F.col("date") == date) & (F.col("sr_episode_id") < ident))), "newest", size)


def assemble(episodes: DataFrame, speakers: DataFrame, ident: str = "sr_episode_id", entity: str = "wikidata_id") -> DataFrame:
    """Search records: episodes with the sets of their speakers' ``gender``, ``citizenships`` and ``occupations``, the mean of ``returning``, and the names in credit order."""
    named = episodes.select(ident, F.posexplode("episode_speakers").alias("__p", entity)).join(speakers, entity, "left")
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    sets = named.groupBy(ident).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__p", "speaker"))), lambda s: s["speaker"]).alias("speakers"), F.array_sort(F.collect_set("gender")).alias("genders"), flat("citizenships").alias("citizenships"), flat("occupations").alias("occupations"), F.max(F.col("episode_count") > 1).alias("returning"),
    )
    return episodes.join(sets, ident, "left")


def topic_match(topics: Column, wanted: list[int]) -> Column:
    """The largest share among the wanted topics; 0 without any."""
    shares = F.transform(F.filter(topics, lambda t: t["topic_id"].isin(wanted)), lambda t: t["share"])
    return F.coalesce(F.array_max(shares), F.lit(0.0))


def with_headers(rows: DataFrame, key: Column, order: list[Column], partition: list[str]) -> DataFrame:
    """Adds ``header``: the key where it differs from that of the row before in the same list."""
    before = F.lag(key).over(Window.partitionBy(*partition).orderBy(*order))
    return rows.withColumn("header", F.when(before.isNull() | (before != key), key))


def others_of_same(rows: DataFrame, id_col: str, entity: str, season: str, order: str) -> DataFrame:
    """For each row, the other rows of its entities, the first of each season, newest first. ``entity`` is a column of ids."""
    own = rows.select(F.col(id_col).alias("id"), F.col(entity).alias("e"))
    # Two rows of an entity and season are enough: the first, and the one that stands for it where a row would meet itself.
    first = Window.partitionBy("e", "season").orderBy("at", "other")
    heads = rows.select(F.col(id_col).alias("other"), F.col(entity).alias("e"), F.col(season).alias("season"), F.col(order).alias("at")).distinct()
    heads = heads.withColumn("__p", F.row_number().over(first)).filter("__p <= 2").drop("__p")
    pairs = own.join(heads, "e").filter("id <> other").drop("e").distinct()
    pairs = pairs.withColumn("__r", F.row_number().over(Window.partitionBy("id", "season").orderBy("at", "other"))).filter("__r = 1")
    return pairs.select(F.col("id").alias(id_col), "other", "season", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("at"), F.desc("other"))).alias("position"))


def to_canvas(points: DataFrame, width: float, height: float) -> DataFrame:
    """``x`` and ``y`` scaled to a canvas; a span below 1e-9 counts as that much."""
    bounds = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    span = lambda a, b: F.greatest(F.col(b) - F.col(a), F.lit(1e-9))
    rows = points.join(F.broadcast(bounds))  # one row
    return rows.withColumns({"x": (F.col("x") - F.col("x0")) / span("x0", "x1") * width, "y": (F.col("y") - F.col("y0")) / span("y0", "y1") * height}).drop("x0", "x1", "y0", "y1")


def nearest_points(clicks: DataFrame, points: DataFrame, click: str, ident: str, radius: float = 12.0) -> DataFrame:
    """The closest point within ``radius`` (exclusive) of each click: an equi-join on grid cells of that size and their neighbours."""
    cell = lambda c: F.floor(F.col(c) / radius)
    near = F.sequence(F.lit(-1), F.lit(1))
    around = clicks.withColumn("dx", F.explode(near)).withColumn("dy", F.explode(near)).select(click, "cx", "cy", (cell("cx") + F.col("dx")).alias("gx"), (cell("cy") + F.col("dy")).alias("gy"))
    pairs = around.join(points.withColumns({"gx": cell("x"), "gy": cell("y")}), ["gx", "gy"])
    apart = F.sqrt((F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2)
    best = pairs.withColumn("distance", apart).filter(F.col("distance") < radius).groupBy(click).agg(F.min(F.struct("distance", ident)).alias("b"))
    return best.select(click, F.col(f"b.{ident}").alias(ident), F.col("b.distance").alias("distance"))
