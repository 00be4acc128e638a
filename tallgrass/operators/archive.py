"""The archive's tables: episodes from raw API records, appearances, entity matches, speakers, songs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T

# Names whose entity is known.
LABEL_OVERRIDES = {"Stefan, pappa till Ebba": "Stefan Åkerlund", "Hooja": "Joakim Lithner", "Mårdis": "Markus Mattsby", "Johanna Almer": "Johanna Andersson"}
ID_OVERRIDES = {"Emil Beer": "Q113960293"}

RAW_SCHEMA = "id bigint, title string, description string, url string, publishdateutc string, downloadpodfile struct<id:bigint,duration:bigint,url:string,filesizeinbytes:bigint>, listenpodfile struct<id:bigint,duration:bigint,url:string,filesizeinbytes:bigint>, imageurltemplate string, imageurl string, photographer string"


def parse_episodes(raw: DataFrame) -> DataFrame:
    """Raw records (``RAW_SCHEMA``) as episodes with ``exclusion_reason``, null for programmes of one host. One narrow projection."""
    filled = lambda a: a["id"].isNotNull() | a["url"].isNotNull() | a["duration"].isNotNull()
    audio = F.when(filled(F.col("downloadpodfile")), F.col("downloadpodfile")).otherwise(F.col("listenpodfile"))
    title, summary = F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))
    rows = raw.withColumns({"__date": T.original_date(title, summary, T.stockholm(T.radio_time(F.col("publishdateutc")))), "__audio": audio})
    rows = rows.withColumn("program_type", T.program_type(F.month("__date"), title, summary))
    rows = rows.withColumn("speaker", T.speaker_of(title, F.year("__date")))
    out = rows.select(
        F.col("id").alias("sr_episode_id"), F.col("__audio.id").alias("sr_audio_id"), title.alias("source_title"), "speaker", F.date_format("__date", "yyyy-MM-dd").alias("date"), T.season_year(F.col("__date"), F.coalesce("program_type", F.lit(""))).alias("year"), "program_type", F.col("url").alias("episode_url"),
        F.col("__audio.url").alias("mp3_url"), F.col("__audio.duration").alias("length_seconds"), F.col("__audio.filesizeinbytes").alias("audio_file_size_bytes"), T.first_filled(F.col("imageurltemplate"), F.col("imageurl")).alias("image_url"), F.col("photographer").alias("image_credit"), F.col("description").alias("short_summary"),
        T.listener_host(F.col("id"), title, summary, F.col("program_type")).alias("is_listeners_host"),
    )
    return out.withColumn("exclusion_reason", T.exclusion_reason(F.col("speaker"), F.col("length_seconds"), F.col("mp3_url"), F.col("program_type")))


def programmes(parsed: DataFrame, include_specials: bool = False) -> DataFrame:
    rows = parsed if include_specials else parsed.filter("exclusion_reason is null")
    return rows.drop("exclusion_reason").orderBy("date", "sr_episode_id")


def reasons(parsed: DataFrame) -> DataFrame:
    return parsed.filter("exclusion_reason is not null").groupBy("exclusion_reason").agg(F.count(F.lit(1)).alias("n"))


def replace_images(episodes: DataFrame, excluded: list[str], lookup: DataFrame) -> DataFrame:
    """Image URLs in ``excluded`` are replaced from ``lookup`` (``sr_episode_id``, ``image_url``) where it has the episode."""
    new = lookup.select("sr_episode_id", F.col("image_url").alias("__new"))
    rows = episodes.join(new, "sr_episode_id", "left")
    return rows.withColumn("image_url", F.when(F.col("image_url").isin(excluded), F.coalesce("__new", "image_url")).otherwise(F.col("image_url"))).drop("__new")


def appearances(episodes: DataFrame, ident: str = "sr_episode_id", name: str = "speaker") -> DataFrame:
    """A row for each credited person: index from 1 and ``id:index``."""
    rows = episodes.select(F.col(ident), F.posexplode(T.credited_names(F.col(name))).alias("__p", "speaker"))
    index = F.col("__p") + 1
    return rows.select(ident, index.alias("speaker_index"), F.concat(F.col(ident).cast("string"), F.lit(":"), index.cast("string")).alias("speaker_appearance_id"), "speaker")


def match_entities(speakers: DataFrame, episodes: DataFrame, participants: DataFrame, key=T.name_key) -> DataFrame:
    """Adds ``wikidata_id``: a known id, else the only participant of the date with the same name, else the only
    participant of the date where the episode has one speaker, else null.

    ``participants`` has ``date``, ``wikidata_id`` and ``label``; malformed ids don't count. Names are compared by ``key``.
    """
    people = participants.filter(F.col("wikidata_id").rlike("^Q[1-9][0-9]*$") & (F.coalesce("date", F.lit("")) != "")).select(F.substring("date", 1, 10).alias("date"), "wikidata_id", "label")
    people = people.groupBy("date", "wikidata_id").agg(F.min("label").alias("label")).withColumn("__label", key(F.col("label")))
    only = people.groupBy("date").agg(F.count(F.lit(1)).alias("__n"), F.min("wikidata_id").alias("__only"))
    rows = speakers.join(episodes.select("sr_episode_id", "date"), "sr_episode_id", "left")
    rows = rows.withColumn("__speakers", F.count(F.lit(1)).over(Window.partitionBy("sr_episode_id")))
    # Participants are counted by date and name before a speaker meets them: the pairs of a day's speakers and participants are never made. A
    # speaker who has another name too looks under a name of their own, where the participants of both names are.
    other = [F.when((F.col("__label") == key(F.lit(said))) | (F.col("__label") == key(F.lit(name))), f"\0{said}") for said, name in LABEL_OVERRIDES.items()]
    named = people.withColumn("__names", F.array_compact(F.array("__label", *other))).select("date", "wikidata_id", F.explode("__names").alias("__name"))
    same = named.groupBy("date", "__name").agg(F.count(F.lit(1)).alias("__m"), F.min("wikidata_id").alias("__match"))
    name = F.when(F.col("speaker").isin(*LABEL_OVERRIDES), F.concat(F.lit("\0"), "speaker")).otherwise(key(F.col("speaker")))
    rows = rows.withColumn("__name", name).join(same, ["date", "__name"], "left").join(only, "date", "left")
    ids = F.create_map(*[F.lit(x) for kv in ID_OVERRIDES.items() for x in kv])
    found = F.coalesce(ids[F.col("speaker")], F.when(F.col("__m") == 1, F.col("__match")), F.when((F.coalesce("__m", F.lit(0)) != 1) & (F.col("__n") == 1) & (F.col("__speakers") == 1), F.col("__only")))
    return rows.withColumn("wikidata_id", found).select(*speakers.columns, "wikidata_id") if "wikidata_id" not in speakers.columns else rows.withColumn("wikidata_id", found).select(*speakers.columns)


def denormalised(appearing: DataFrame, episodes: DataFrame, ident: str = "sr_episode_id") -> DataFrame:
    """Appearances with all columns of their episode."""
    return appearing.join(episodes, ident)


def with_metadata(chunks: DataFrame, episodes: DataFrame, ident: str = "sr_episode_id") -> DataFrame:
    """Chunks with date, year, kind and speakers of their episode; the episode's ``source_title`` goes before the chunk's own. Unknown episodes leave nulls, and no speakers."""
    known = episodes.select(ident, F.nullif("source_title", F.lit("")).alias("__title"), "date", "year", "program_type", "episode_speakers")
    rows = chunks.join(known, ident, "left")
    return rows.withColumns({"source_title": F.coalesce("__title", "source_title"), "episode_speakers": F.coalesce("episode_speakers", F.array().cast("array<string>"))}).drop("__title")


def ordered_ids(appearing: DataFrame, ident: str, index: str, value: str, out: str) -> DataFrame:
    """The distinct values of each id in the order of ``index``."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(value).alias("v"))))
    return appearing.groupBy(ident).agg(F.array_distinct(F.transform(pairs, lambda p: p["v"])).alias(out))


def attach_speakers(episodes: DataFrame, appearing: DataFrame, require: bool = True) -> DataFrame:
    """Adds ``episode_speakers``, the distinct entity ids in credit order; a missing id is an error unless ``require`` is off."""
    value = F.coalesce("wikidata_id", F.raise_error(F.concat(F.lit("no entity for "), F.col("speaker")))) if require else F.col("wikidata_id")
    lists = ordered_ids(appearing.withColumn("wikidata_id", value).filter("wikidata_id is not null"), "sr_episode_id", "speaker_index", "wikidata_id", "episode_speakers")
    return episodes.join(lists, "sr_episode_id", "left").withColumn("episode_speakers", F.coalesce("episode_speakers", F.array().cast("array<string>")))


#: Rows from which on a person counts as one of the few that are in very many.
HOT_ROWS = 100_000


def _with_dates(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Adds ``birth_date`` and ``death_date`` by ``wikidata_id``. The few people with very many rows, and rows without one, are not brought together by the id: that would be one task."""
    dates = people.select("wikidata_id", "birth_date", "death_date")
    hot = rows.groupBy("wikidata_id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= HOT_ROWS).select("wikidata_id")
    hot = dates.join(F.broadcast(hot), "wikidata_id", "right").filter("wikidata_id IS NOT NULL").withColumn("__hot", F.lit(True))
    rows = rows.join(F.broadcast(hot), "wikidata_id", "left")  # of HOT_ROWS rows each
    apart = F.col("__hot").isNotNull() | F.col("wikidata_id").isNull()
    others = rows.filter(~apart).drop("birth_date", "death_date").join(dates, "wikidata_id", "left")
    return rows.filter(apart).drop("__hot").unionByName(others.drop("__hot"))


def attach_ages(episodes: DataFrame, people: DataFrame) -> DataFrame:
    """Adds ``speaker_ages``, aligned with ``episode_speakers``; nulls keep their places."""
    rows = episodes.select("sr_episode_id", "date", F.posexplode("episode_speakers").alias("p", "wikidata_id"))
    rows = _with_dates(rows, people)
    rows = rows.withColumn("age", T.age_at(F.col("birth_date"), F.col("date"), F.col("death_date")))
    lists = rows.groupBy("sr_episode_id").agg(F.array_sort(F.collect_list(F.struct("p", "age"))).alias("l"))
    out = episodes.join(lists.select("sr_episode_id", F.transform("l", lambda x: x["age"]).alias("speaker_ages")), "sr_episode_id", "left")
    return out.withColumn("speaker_ages", F.coalesce("speaker_ages", F.array().cast("array<int>")))


def merge_people(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """One row per entity from ungrouped query rows in the order of ``pos``.

    Dates come from the first row only, labels and descriptions from the first that has one, the article is the last
    Swedish or else the first English one, the gender the first valid one. Citizenships and occupations are distinct
    ids in order of first appearance with the label that came last.
    """
    first = lambda c: F.min_by(c, F.when(F.coalesce(c, F.lit("")) != "", F.col(pos)))
    rows = rows.withColumn("wikidata_id", T.entity_id(F.col("speaker"))).filter("wikidata_id is not null")
    gender_id = T.entity_id(F.col("gender"))
    heads = rows.groupBy("wikidata_id").agg(
        first(F.col("speakerLabel")).alias("wikidata_label"),
        first(F.col("speakerDescription")).alias("wikidata_description"),
        F.coalesce(F.max_by("svArticle", F.when(F.coalesce("svArticle", F.lit("")) != "", F.col(pos))), first(F.col("enArticle"))).alias("wikipedia_url"),
        F.min_by(F.struct(gender_id.alias("id"), F.coalesce(F.nullif("genderLabel", F.lit("")), gender_id).alias("label")), F.when(gender_id.isNotNull(), F.col(pos))).alias("g"),
        F.min_by(F.struct(T.date_by_precision(F.col("birthDate"), F.col("birthPrecision").try_cast("int")).alias("b"), T.date_by_precision(F.col("deathDate"), F.col("deathPrecision").try_cast("int")).alias("d")), pos).alias("dates"),
    )
    out = heads.select("wikidata_id", "wikidata_label", "wikidata_description", "wikipedia_url", F.col("g.label").alias("gender"), F.col("g.id").alias("gender_id"), F.col("dates.b").alias("birth_date"), F.col("dates.d").alias("death_date"))
    for one, many in (("citizenship", "citizenships"), ("occupation", "occupations")):
        ident = T.entity_id(F.col(one))
        per = rows.withColumn("__v", ident).filter("__v is not null").groupBy("wikidata_id", "__v")
        per = per.agg(F.min(pos).alias("__p"), F.max_by(F.coalesce(F.nullif(F.col(one + "Label"), F.lit("")), F.col("__v")), pos).alias("__l"))
        lists = per.groupBy("wikidata_id").agg(F.array_sort(F.collect_list(F.struct("__p", "__v", "__l"))).alias("__s"))
        lists = lists.select("wikidata_id", F.transform("__s", lambda s: s["__l"]).alias(many), F.transform("__s", lambda s: s["__v"]).alias(one + "_ids"))
        out = out.join(lists, "wikidata_id", "left")
        for c in (many, one + "_ids"):
            out = out.withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out


def speaker_records(appearing: DataFrame, people: DataFrame) -> DataFrame:
    """One row per entity: distinct names in order, the name that was newly seen last, episodes and the ages at them.

    ``appearing`` has ``wikidata_id``, ``speaker``, ``sr_episode_id``, ``speaker_index`` and ``date``.
    """
    rows = appearing.filter("wikidata_id is not null").join(people.select("wikidata_id", "birth_date", "death_date"), "wikidata_id", "left")
    rows = rows.withColumn("age", T.age_at(F.col("birth_date"), F.col("date"), F.col("death_date")))
    names = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("date", "sr_episode_id", "speaker_index", "speaker"))), lambda s: s["speaker"]))
    visits = F.array_sort(F.collect_set(F.struct("sr_episode_id", F.struct("age").alias("a"))))
    out = rows.groupBy("wikidata_id").agg(names.alias("sr_names"), visits.alias("__v"))
    out = out.select("wikidata_id", F.element_at("sr_names", -1).alias("speaker"), "sr_names", F.size("__v").alias("episode_count"), F.transform("__v", lambda v: v["sr_episode_id"]).alias("episode_ids"), F.transform("__v", lambda v: v["a"]["age"]).alias("ages_at_episodes"))
    return out.join(people, "wikidata_id", "left")


def number_songs(plays: DataFrame, group: str, key: list[Column], richness: Column, start: Column, pos: str) -> DataFrame:
    """Distinct plays of a group, numbered by start (missing ones last), then by the place of the key's first row.

    Of plays with the same key the richest stays, the first of equally rich ones.
    """
    keys = [c.alias(f"__k{i}") for i, c in enumerate(key)]
    rows = plays.select("*", *keys, richness.alias("__rich"), start.alias("__start"))
    same = Window.partitionBy(group, *[f"__k{i}" for i in range(len(key))])
    rows = rows.withColumns({"__first": F.min(pos).over(same), "__r": F.row_number().over(same.orderBy(F.desc("__rich"), pos))}).filter("__r = 1")
    order = Window.partitionBy(group).orderBy(F.asc_nulls_last("__start"), "__first")
    return rows.withColumn("track_number", F.row_number().over(order)).drop("__r", "__rich", "__start", "__first", *[f"__k{i}" for i in range(len(key))])


def music(playlists: DataFrame) -> DataFrame:
    """Songs of playlists (``sr_episode_id``, ``songs``) as one row per play."""
    rows = playlists.select(F.col("sr_episode_id"), F.posexplode("songs").alias("__pos", "s")).select("sr_episode_id", "__pos", "s.*")
    key = [T.music_key(F.col("title")), T.music_key(F.col("artist")), F.coalesce("starttimeutc", F.lit("")), F.coalesce("stoptimeutc", F.lit(""))]
    fields = ("title", "artist", "composer", "lyricist", "albumname", "recordlabel")
    rows = number_songs(rows, "sr_episode_id", key, T.filled_fields(*[F.col(f) for f in fields]), T.radio_time(F.col("starttimeutc")), "__pos")
    names = dict(zip(fields, ("title", "artist", "composer", "lyricist", "album", "record_label"), strict=True))
    return rows.select("sr_episode_id", "track_number", *[T.blank_to_null(F.col(f)).alias(n) for f, n in names.items()], T.is_theme_song(F.col("title")).alias("is_theme_song"))
