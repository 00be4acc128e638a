"""Scalar rules, on inputs like those that the archive has."""

from pyspark.sql import functions as F

from tallgrass.functions import text as T


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema or "x int").select(column.alias("r")).first()["r"]


def test_names_in_titles(spark):
    cases = [
        ("Kalle Moraeus 2015", 2015, "Kalle Moraeus"),
        ("Sommar i P1 med Anna Ek", 2020, "Anna Ek"),
        ("Anna Ek - Sommarprat 2016", 2016, "Anna Ek"),
        ("1998: Anna Ek", 2001, "Anna Ek"),
        ("Anna Ek (Repris från 1999)", 2004, "Anna Ek"),
        ("Ingrid Sommar", 2004, "Ingrid Sommar"),
        ("Anna Ek 1920-2001", 2004, "Anna Ek"),
        ("Anna Ek - Vinterprat 2016/17", 2016, "Anna Ek"),
    ]
    rows = spark.createDataFrame(cases, "t string, y int, want string").select("want", T.speaker_of(F.col("t"), F.col("y")).alias("got")).collect()
    assert [(r.want, r.got) for r in rows if r.want != r.got] == []


def test_times(spark):
    rows = spark.createDataFrame([("/Date(1435143600000)/",), ("2015-06-24T11:00:00",), ("2015-06-24T13:00:00+02:00",), ("nonsense",)], "v string")
    got = [str(r[0]) for r in rows.select(T.stockholm(T.radio_time(F.col("v")))).collect()]
    assert got == ["2015-06-24 13:00:00", "2015-06-24 13:00:00", "2015-06-24 13:00:00", "None"]


def test_seasons(spark):
    rows = spark.createDataFrame([("2026-01-01",), ("2025-12-25",), ("2025-07-01",), ("2025-10-01",)], "d string").withColumn("d", F.col("d").cast("date"))
    kind = T.program_type(F.month("d"), F.lit("x"), F.lit("ett sommarprogram"))
    assert [tuple(r) for r in rows.select(kind, T.season_year(F.col("d"), kind)).collect()] == [("Vinter", 2025), ("Vinter", 2025), ("Sommar", 2025), ("Sommar", 2025)]


def test_ages(spark):
    cases = [("1980", "2020-01-01", None, 39), ("1980-06", "2020-06-30", None, 39), ("1980-06-15", "2020-06-15", None, 40), ("1980-06-15", "2020-06-15", "2010", None), ("1980-02-29", "2021-03-01", None, None), (None, "2020-01-01", None, None), ("", "2020-01-01", None, None), ("2030", "2020-01-01", None, None), ("x", "2020-01-01", None, None), ("1980", "2020-05-01", "2020-04", None), ("1980", "2020-05-01", "2020-05-02", 39)]
    rows = spark.createDataFrame(cases, "b string, a string, d string, want int").select("want", T.age_at(F.col("b"), F.col("a"), F.col("d")).alias("got")).collect()
    assert [(tuple(c), r.got) for c, r in zip(cases, rows, strict=True) if r.want != r.got] == []


def test_dates_by_precision(spark):
    rows = spark.createDataFrame([("+1852-03-04T00:00:00Z", 9), ("+1852-03-04T00:00:00Z", 10), ("1852-03-04T00:00:00Z", 11), ("1852-03-04", 7)], "v string, p int")
    assert [r[0] for r in rows.select(T.date_by_precision(F.col("v"), F.col("p"))).collect()] == ["1852", "1852-03", "1852-03-04", None]


def test_credits(spark):
    rows = spark.createDataFrame([("Jenny och Susanna Kallur",), ("Niklas Natt och Dag",), ("IJustWantToBeCool",), ("Anna Ek",), ("Anna Ek och Bo Al",)], "n string")
    got = [r[0] for r in rows.select(T.credited_names(F.col("n"))).collect()]
    assert got == [["Jenny Kallur", "Susanna Kallur"], ["Niklas Natt och Dag"], ["Victor Beer", "Emil Beer", "Joel Adolphson"], ["Anna Ek"], ["Anna Ek", "Bo Al"]]


def test_theme_songs(spark):
    rows = spark.createDataFrame([("Sommar, sommar, sommar",), ("Signatur: Vintergatan",), ("Sommar",), ("Sommarens sista",), (None,)], "t string")
    assert [r[0] for r in rows.select(T.is_theme_song(F.col("t"))).collect()] == [True, True, False, False, False]


def test_artifacts(spark):
    texts = ["hej " * 25, "ha" + "a" * 130, ". " * 120, "en helt vanlig mening om sommar och musik", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.artifact_reasons(F.col("t"))).collect()]
    assert got == [["dominant_token_loop"], ["character_noise_loop"], ["punctuation_noise_loop"], [], [], []]


def test_boilerplate_needs_its_place(spark):
    rows = spark.createDataFrame([("Dags för Sommar i P1", 10.0, 15.0), ("Dags för Sommar i P1", 60.0, 65.0), ("Producent Anna Ek", 3500.0, 3510.0), ("Producent Anna Ek", 1000.0, 1010.0)], "t string, s double, e double")
    got = [r[0] for r in rows.select(T.boilerplate_reasons(F.col("t"), F.col("s"), F.col("e"), F.lit(3600.0))).collect()]
    assert got == [["programme_announcement"], [], ["producer_credit"], []]


def test_exclusions(spark):
    rows = spark.createDataFrame([("Poddtips: nytt", 3000, "u", "Sommar"), ("Anna", None, "u", "Sommar"), ("Anna", 600, "u", "Sommar"), ("Anna", 3000, "u", None), ("Anna", 3000, "u", "Vinter")], "n string, s int, m string, k string")
    got = [r[0] for r in rows.select(T.exclusion_reason(F.col("n"), F.col("s"), F.col("m"), F.col("k"))).collect()]
    assert got == ["podcast_promo", "missing_audio", "too_short", "outside_season", None]


def test_unicode_keys(spark):
    rows = spark.createDataFrame([("  Ａnna  D’Ek ",), ("Straße",), (None,)], "n string")
    assert [r[0] for r in rows.select(T.name_key(F.col("n"))).collect()] == ["anna d'ek", "strasse", None]
    rows = spark.createDataFrame([("Kärlek & längtan!",), ("Öar",)], "n string")
    assert [tuple(r) for r in rows.select(T.ascii_slug(F.col("n")), T.simple_slug(F.col("n"))).collect()] == [("karlek-langtan", "karlek-langtan"), ("oar", "oar")]


def test_small_ones(spark):
    assert one(spark, T.initials(F.col("n")), n=["Anna Maria Ek", "Bo Al"]) == "AM · BA"
    assert one(spark, T.initials(F.col("n")), n=["Anna Ek", "Bo Al", "Cy Di"]) == "A · B · C"
    assert one(spark, T.content_id(F.col("i"), "u", F.lit(12345), F.lit("x")), i=7).startswith("7:u12345:")
    assert one(spark, T.minutes(F.col("s")), s=89) == 1 and one(spark, T.minutes(F.col("s")), s=90) == 2
    assert one(spark, T.entity_id(F.col("u")), u="http://www.wikidata.org/entity/Q42") == "Q42"
    assert one(spark, T.entity_id(F.col("u")), u="http://x/.well-known/genid/1") is None
    assert one(spark, T.squeeze(F.col("t")), t=" a \n b ") == "a b"

    def colour(s):
        h = 0
        for c in s:
            h = (h * 31 + ord(c) + 2**31) % 2**32 - 2**31
        return abs(h) % 12

    assert one(spark, T.colour_of(F.col("k")), k="broad-07 and more") == colour("broad-07 and more")
