"""Column expressions for titles, names, dates and transcript text. Everything here runs inside Catalyst; what it lacks of Unicode is called by ``reflect``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every pattern is case-insensitive with Unicode case and character classes.
I = "(?iuU)"  # noqa: E741

# They define which records are programmes and what their text is.
MIN_MINUTES = 15
EXCLUSIONS = (
    ("podcast_promo", r"\bpoddtips\b"),
    ("trailer", r"\btrailer\b"),
    ("host_announcement", r"\bpresenteras\b"),
    ("anniversary", r"\bsommar (?:50|60) år\b"),
    ("anniversary", r"\bsommar i p1 50 år\b"),
    ("recap", r"\bsommar (?:i )?backspegeln\b|\bsommar bonus\b"),
    ("documentary", r"\bbakom kulisserna\b"),
    ("question_show", r"^fråga värden\b"),
    ("multi_guest_special", r"\blive på poddfest\b"),
    ("standalone_music", r"^pojken på månen\b"),
    ("alternate_language", r"\benglish version\b|\bin english\b|humanity has not yet failed|courage to speak out"),
)
LISTENER_HOST = r"\blyssnarnas\s+sommar(?:värd|prat(?:are)?)\b"
LISTENER_HOST_IDS = (921565, 1077289, 2578973)
MONTHS = ("januari", "februari", "mars", "april", "maj", "juni", "juli", "augusti", "september", "oktober", "november", "december")
PROGRAMME_SUFFIX = r"\s*(?:[-–—]\s*|\()?(?:På Vintergatan|(?:Lyssnarnas\s+)?Sommarvärd|Sommar(?:prat| i P1)?|Vinter(?:prat| i P1)?)(?:\s+\d{4}(?:/\d{2})?)?(?:\s*\((?:jan|dec)\))?\)?\s*$"
TITLE_STRIPS = (r"^Sommar rekommenderar:\s*", r"^Sommar i P1 med\s+", r"^\d{4}:\s*", r"\s*\(Repris från \d{4}\)\s*$", r"\s*-\s*repris Vinter \d{4}\s*$", r"\s+\d{4}\s*[-–—]\s*\d{4}\s*$")
GROUP_PREFIX, GROUP_MEMBERS = "IJustWantToBeCool", ("Victor Beer", "Emil Beer", "Joel Adolphson")
WHOLE_NAMES = ("Niklas Natt och Dag",)
OPENING = (
    ("programme_identification", r"\bdet här (?:programmet )?(?:är|var) (?:(?:ett )?poddradioprogram från|podd(?:radio)?versionen av)?\s*(?:sommar|vinter) i p\s*1\b"),
    ("copyright_music_notice", r"\b(?:av upphovsrättsliga skäl .*?musiken .*?(?:förkortad|nedkortad)|musiken .*?(?:förkortad|nedkortad).*?upphovsrättsliga skäl)\b|^\s*musiken (?:är|har) (?:förkortad|nedkortad)\.?\s*$"),
    ("programme_announcement", r"\bdags för (?:sommar|vinter)\s*i p\s*1\b"),
    ("sr_play_promotion", r"\balla (?:sommar|vinter)program finns .*?(?:sveriges radio play|vår app)\b"),
)
CLOSING = (
    ("programme_signoff", r"^\s*(?:det var|glad) (?:sommar|vinter)(?:en)? i p\s*1\b"),
    ("producer_credit", r"^\s*producent(?:en)?\s+[a-zåäö]"),
    ("sr_play_promotion", r"\b(?:lyssna|hör|hittar|finns|sök(?: på)?).*?(?:sveriges radio(?: play)?|sverigesradio\.se|vår app|appen|på webben)\b"),
    ("music_list_promotion", r"\b(?:hela )?(?:musiklistan|lista över musiken|listan (?:med|över) musiken).*?(?:hemsidan|sveriges\s*radio(?:s)?|sverigesradio)\b"),
    ("legacy_web_promotion", r"\b(?:ladda ner .*?(?:webbradioapparat|sr\.se)|lyssna .*?musiken .*?(?:webben|30 dagar)|köpa .*?program utan musik|sms[- ]?påminnelser?|sommars hemsida .*?musik|gå in på sr\.se)\b"),
)
PRODUCTION_CREDIT = r"^\s*(?:(?:och|samt)\s+)?(?:producent(?:en)?|redaktör(?:en)?|tekniker(?:n)?|slutmix)\b(?:\s*(?:,|:)|\s+(?:var|är))?\s+[A-ZÅÄÖ]"
RECOMMENDATION_CUE = r"(?:\b(?:sommar|vinter)pratade\b|\b(?:förra årets|en annan|tidigare)\b.*?\b(?:sommar|vinter)värd(?:en)?\b|\b(?:var|blev)\s+(?:sommar|vinter)pratare\b)"
OPENING_SECONDS, CLOSING_SECONDS, TAIL_SECONDS = 45.0, 120.0, 180.0


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(I + pattern)


def squeeze(text: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(blank_to_null(c).isNotNull(), c) for c in columns])


def casefold(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def music_key(text: Column) -> Column:
    return squeeze(casefold(F.coalesce(text, F.lit(""))))


def is_theme_song(title: Column) -> Column:
    """Only the word of the summer theme, twice or more, or only the winter theme's name; ``signatur`` does not count."""
    tokens = F.filter(F.regexp_extract_all(casefold(F.coalesce(title, F.lit(""))), F.lit(r"(?U)[^\W_]+"), 0), lambda t: t != "signatur")
    summer = (F.size(tokens) >= 2) & (F.array_distinct(tokens) == F.array(F.lit("sommar")))
    return summer | (tokens == F.array(F.lit("vintergatan")))


def filled_fields(*columns: Column) -> Column:
    """How many of the columns are neither null nor blank."""
    return sum((blank_to_null(c).isNotNull().cast("int") for c in columns), F.lit(0))


def radio_time(value: Column) -> Column:
    """``/Date(milliseconds)/`` (an offset inside is ignored) or ISO 8601; without a zone it is UTC."""
    millis = F.regexp_extract(value, r"^/Date\((-?\d+)(?:[+-]\d{4})?\)/$", 1)
    return F.when(millis != "", F.timestamp_millis(millis.try_cast("bigint"))).otherwise(F.try_to_timestamp(value))


def stockholm(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, "Europe/Stockholm")


def original_date(title: Column, description: Column, aired: Column) -> Column:
    """The date in a re-issue's description, where it was published out of season; else the date that it aired."""
    found = lambda i: F.regexp_extract(F.coalesce(description, F.lit("")), I + r"\bfrån den (\d{1,2}) (" + "|".join(MONTHS) + r") (\d{4})\b", i)
    months = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i))])
    built = F.try_to_date(F.format_string("%04d-%02d-%02d", found(3).try_cast("int"), F.element_at(months, F.lower(found(2))), found(1).try_cast("int")), "yyyy-MM-dd")
    reissue = ~F.month(aired).isin(1, 6, 7, 8, 9, 12) & F.lower(F.coalesce(title, F.lit(""))).startswith("sommar i p1 med ")
    return F.when(reissue & (found(3) != ""), built).otherwise(F.to_date(aired))


def program_type(month: Column, title: Column, summary: Column) -> Column:
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit("")))
    return (
        F.when(month.between(6, 9), "Sommar")
        .when(month.isin(12, 1), "Vinter")
        .when(matches(text, r"\bvinter(?:program|värd|prat| i p1)\b|på vintergatan"), "Vinter")
        .when(matches(text, r"\bsommar(?:program|värd|prat| i p1)\b"), "Sommar")
    )


def season_year(date: Column, kind: Column) -> Column:
    """The year in which the season began: January belongs to the winter before."""
    return F.year(date) - F.when((kind == "Vinter") & (F.month(date) == 1), 1).otherwise(0)


def speaker_of(title: Column, year: Column) -> Column:
    """The name in a programme title, without prefixes, repeats, life spans, the year of airing and programme names."""
    for pattern in TITLE_STRIPS:
        title = F.regexp_replace(title, I + pattern, "")
    trailing = F.regexp_extract(title, r"(?U)\s*-?\s*(\d{4})$", 1)
    title = F.when(trailing.try_cast("int") == year, squeeze_ends(F.regexp_replace(title, r"(?U)\s*-?\s*\d{4}$", ""))).otherwise(title)
    bare = F.regexp_replace(title, I + PROGRAMME_SUFFIX, "")
    named = F.when((F.lower(title) != "ingrid sommar") & matches(title, PROGRAMME_SUFFIX), F.element_at(F.split(bare, r"(?U)\s[-–—]\s", 2), 1)).otherwise(title)
    return squeeze_ends(F.regexp_replace(named, r"[ -]+$", ""))


def squeeze_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def listener_host(ident: Column, title: Column, summary: Column, kind: Column) -> Column:
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit("")))
    return ident.isin(*LISTENER_HOST_IDS) | F.coalesce((kind == "Sommar") & matches(text, LISTENER_HOST), F.lit(False))


def exclusion_reason(speaker: Column, seconds: Column, mp3: Column, kind: Column) -> Column:
    """Why a record is not a programme of one host; null where it is. Patterns look at the cleaned name."""
    rules = [F.when(matches(speaker, p), F.lit(reason)) for reason, p in EXCLUSIONS]
    return F.coalesce(*rules, F.when(seconds.isNull() | mp3.isNull(), "missing_audio"), F.when(seconds < MIN_MINUTES * 60, "too_short"), F.when(kind.isNull(), "outside_season"))


def credited_names(name: Column) -> Column:
    """People of one credit; a first name alone gets the second person's surname."""
    parts = F.split(name, " och ", 2)
    first, second = F.element_at(parts, 1), F.element_at(parts, 2)
    lead, tail = F.split(squeeze(first), " "), F.split(squeeze(second), " ")
    shared = F.when((F.size(lead) == 1) & (F.size(tail) >= 2), F.concat(first, F.lit(" "), F.element_at(tail, -1))).otherwise(first)
    return (
        F.when(name.startswith(GROUP_PREFIX), F.array(*[F.lit(m) for m in GROUP_MEMBERS]))
        .when(name.isin(*WHOLE_NAMES) | ~name.contains(" och "), F.array(name))
        .otherwise(F.array(shared, second))
    )


def entity_id(uri: Column) -> Column:
    last = F.element_at(F.split(uri, "/"), -1)
    return F.when(last.rlike("^Q[1-9][0-9]*$"), last)


def date_by_precision(value: Column, precision: Column) -> Column:
    """A knowledge-graph time cut to what its precision says: day (11), month (10), year (9), else null."""
    day = F.substring(F.regexp_replace(value, r"^\+", ""), 1, 10)
    return F.when(precision >= 11, day).when(precision == 10, F.substring(day, 1, 7)).when(precision == 9, F.substring(day, 1, 4))


def age_at(birth: Column, aired: Column, death: Column) -> Column:
    """Whole years, the smaller where a partial birth date leaves two; null for the dead, the unborn and the unreadable.

    Dates are ISO strings; birth and death may be ``YYYY`` or ``YYYY-MM``.
    """
    day = F.try_to_date(F.substring(aired, 1, 10), "yyyy-MM-dd")
    part = lambda c, i: F.get(F.split(c, "-"), i - 1).try_cast("int")
    size = lambda c: F.size(F.split(c, "-"))
    y, m = F.year(day), F.month(day)
    gone = (
        F.when(size(death) == 1, y > part(death, 1))
        .when(size(death) == 2, y * 12 + m > part(death, 1) * 12 + part(death, 2))
        .otherwise(day > F.try_to_date(death, "yyyy-MM-dd"))
    )
    born = F.try_to_date(birth, "yyyy-MM-dd")
    birthday = F.try_to_date(F.concat(F.date_format(day, "yyyy"), F.date_format(born, "-MM-dd")), "yyyy-MM-dd")
    years = (
        F.when(size(birth) == 1, y - part(birth, 1) - 1)
        .when(size(birth) == 2, y - part(birth, 1) - (m <= part(birth, 2)).cast("int"))
        .otherwise(y - F.year(born) - (day < birthday).cast("int"))
    )
    alive = F.nullif(death, F.lit("")).isNull() | ~F.coalesce(gone, F.lit(True))
    return F.when(alive & (years >= 0) & (F.coalesce(birth, F.lit("")) != ""), years)


def _unicode(kind: str, name: str, text: Column) -> Column:
    """A function of the Unicode library that Spark brings, where Spark has none of its own: a text and a flag in, a text out; null stays null."""
    return F.when(text.isNotNull(), F.reflect(F.lit(f"com.ibm.icu.{kind}"), F.lit(name), F.coalesce(text, F.lit("")), F.lit(True)))


def name_key(names: Column) -> Column:
    """NFKC, case folded, plain apostrophes, single spaces."""
    plain = F.when(F.length(names) == F.octet_length(names), F.lower(names)).otherwise(_unicode("lang.UCharacter", "foldCase", _unicode("text.Normalizer", "compose", names)))
    return F.trim(F.regexp_replace(F.replace(plain, F.lit("’"), F.lit("'")), r"[\s\p{Z}\x{85}\x1c-\x1f]+", " "))


def ascii_slug(labels: Column) -> Column:
    """ASCII letters and digits of the NFKD form, lower-cased, runs of anything else as one hyphen."""
    plain = F.lower(F.regexp_replace(_unicode("text.Normalizer", "decompose", labels), r"[^\x00-\x7f]", ""))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def simple_slug(label: Column) -> Column:
    """``ascii_slug`` for Latin letters with the accents of western European languages, without Python."""
    plain = F.translate(F.lower(label), "åäáàâãéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"[^\x00-\x7f]", ""), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def content_id(ident: Column, kind: str, index: Column, text: Column) -> Column:
    """``id:kindNNNN:hash``: four digits at least, twelve of the text's SHA-256."""
    number = F.when(index < 10_000, F.lpad(index.cast("string"), 4, "0")).otherwise(index.cast("string"))
    return F.concat(ident.cast("string"), F.lit(f":{kind}"), number, F.lit(":"), F.substring(F.sha2(text, 256), 1, 12))


def initials(names: Column) -> Column:
    """Two letters a name, or one where there are more than two names, joined by middle dots."""
    letters = lambda n: F.upper(F.array_join(F.transform(F.slice(F.filter(F.split(n, " "), lambda w: w != ""), 1, F.when(F.size(names) > 2, 1).otherwise(2)), lambda w: F.substring(w, 1, 1)), ""))
    return F.array_join(F.transform(names, letters), " · ")


def word_list(text: Column) -> Column:
    """Runs of letters, lower-cased."""
    return F.regexp_extract_all(casefold(F.coalesce(text, F.lit(""))), F.lit(r"(?U)[^\W\d_]+"), 0)


def swedish_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-zåäö]+"), 0)


def most_frequent(words: Column) -> Column:
    """How often the most frequent entry of an array is there: longest run of the sorted array."""
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("top"))

    def step(acc: Column, w: Column) -> Column:
        n = F.when(acc["w"] == w, acc["n"] + 1).otherwise(1)
        return F.struct(w.alias("w"), n.alias("n"), F.greatest(acc["top"], n).alias("top"))

    return F.aggregate(F.sort_array(words), start, step, lambda acc: acc["top"])


def majority_count(words: Column) -> Column:
    """How often the entry that makes up more than half of an array is there; without one, some number that is not above the half."""
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("n"))

    def step(acc: Column, w: Column) -> Column:
        same = acc["w"] == w
        return F.struct(F.when(acc["n"] == 0, w).otherwise(acc["w"]).alias("w"), F.when(acc["n"] == 0, 1).when(same, acc["n"] + 1).otherwise(acc["n"] - 1).alias("n"))

    candidate = F.aggregate(words, start, step, lambda acc: acc["w"])
    return F.size(words) - F.size(F.array_remove(words, candidate))


def artifact_reasons(text: Column, words: Column | None = None) -> Column:
    """Recognition loops: one token in 70 % of 20 words or more, a run of one character, or punctuation alone. ``words`` may hold ``swedish_words`` of the text."""
    text = F.coalesce(text, F.lit(""))
    words, long = swedish_words(text) if words is None else words, F.length(text) >= 120
    marks = F.regexp_count(text, F.lit(r"(?iuU)[^a-zåäö\s]"))
    return F.array_compact(
        F.array(
            F.when((F.size(words) >= 20) & (majority_count(words) >= 0.7 * F.size(words)), "dominant_token_loop"),
            F.when((F.size(words) <= 3) & long & text.rlike(r"(?iu)(.)\1{19,}"), "character_noise_loop"),
            F.when((F.size(words) == 0) & long & (marks >= 100), "punctuation_noise_loop"),
        )
    )


def boilerplate_reasons(text: Column, start: Column, end: Column, duration: Column) -> Column:
    """Framing phrases, each only near its end of the programme; every reason once, in order."""
    opening, closing = start <= OPENING_SECONDS, (duration > 0) & (end >= duration - CLOSING_SECONDS)
    rules = [F.when(opening & matches(text, p), r) for r, p in OPENING] + [F.when(closing & matches(text, p), r) for r, p in CLOSING]
    return F.array_distinct(F.array_compact(F.array(*rules)))


def minutes(seconds: Column) -> Column:
    return F.floor((seconds + 30) / 60).cast("long")


def season_label(kind: Column, year: Column) -> Column:
    return F.concat(F.when(kind == "Vinter", "VT").otherwise(""), year.cast("string"))


#: Short names of the months, and where episodes and their images are found.
SHORT_MONTHS = ("jan.", "feb.", "mars", "apr.", "maj", "juni", "juli", "aug.", "sep.", "okt.", "nov.", "dec.")
EPISODE_URL, IMAGE_URL = "https://www.sverigesradio.se/avsnitt/", "https://static-cdn.sr.se"


def short_date(date: Column) -> Column:
    """``2 aug. 2021`` of an ISO date."""
    names = F.array(*[F.lit(m) for m in SHORT_MONTHS])
    day = F.try_to_date(F.substring(date, 1, 10), "yyyy-MM-dd")
    return F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.get(names, F.month(day) - 1), F.year(day).cast("string"))


def duration(minutes_: Column) -> Column:
    return F.concat(minutes_.cast("string"), F.lit(" min"))


def capitalise(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 2_000_000_000))


def episode_url(ident: Column, base: str = EPISODE_URL) -> Column:
    return F.concat(F.lit(base), ident.cast("string"))


def image_url(image: Column, base: str = IMAGE_URL) -> Column:
    """The image's address; null without an image."""
    return F.when(F.coalesce(image, F.lit("")) != "", F.concat(F.lit(base), image))


def excerpt(text: Column, most: int = 500) -> Column:
    """The first characters of a text."""
    return F.substring(text, 1, most)


def recipe_slug(recipe: Column) -> Column:
    """A folder name: readable characters, runs of others as a hyphen, and eight digits of the SHA-256."""
    readable = F.regexp_replace(F.regexp_replace(recipe, "[^a-zA-Z0-9._-]+", "-"), "^-+|-+$", "")
    return F.concat(readable, F.lit("-"), F.substring(F.sha2(recipe, 256), 1, 8))


def embedding_recipe(backend: Column, model: Column, prompt: Column, max_length: Column) -> Column:
    """What vectors depend on, as one text."""
    return F.concat(backend, F.lit("::"), model, F.lit("::prompt="), F.coalesce(F.nullif(prompt, F.lit("")), F.lit("none")), F.lit("::max_length="), max_length.cast("string"))


def colour_of(key: Column, colours: int = 12) -> Column:
    """The 32-bit string hash (h * 31 + code) of the browser view, as a place among the colours."""
    step = lambda h, c: F.pmod(h * 31 + F.ascii(c) + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)
    return F.pmod(F.abs(F.aggregate(F.split(key, ""), F.lit(0).cast("long"), step)), F.lit(colours))
