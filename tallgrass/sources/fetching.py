"""Remote sources behind caches: query results, people in batches, playlists, portraits. Only what the cache lacks is fetched."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from pathlib import Path
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.operators import archive, incremental
from tallgrass.sources import requests

#: Seconds to wait where a service limits its requests without saying for how long; tries after a broken connection.
DEFAULT_WAIT, TRIES = 65, 3
#: Ids to a request for people, and requests whose results are kept together.
BATCH_IDS, WAVE = 100, 8

Fetch = Callable[[str], dict]


def wait_seconds(header: str | None, now: datetime | None = None) -> int:
    """Seconds that a ``Retry-After`` header asks for: a number, or a date; one second at least."""
    try:
        return max(1, int(header or ""))
    except ValueError:
        pass
    try:
        then = parsedate_to_datetime(header or "")
    except (TypeError, ValueError):
        return DEFAULT_WAIT
    then = then if then.tzinfo else then.replace(tzinfo=timezone.utc)
    return max(1, round((then - (now or datetime.now(timezone.utc))).total_seconds()))


def get_json(url: str, form: dict | None = None, agent: str = "tallgrass", send: Callable = urlopen, sleep: Callable = time.sleep) -> dict:
    """A JSON answer. A limited request (429) is tried once more after the wait that was asked for, a broken connection ``TRIES`` times.

    Plain paths and ``file`` URLs work too, so saved answers can stand in for a service.
    """
    if "://" not in url:
        return json.loads(Path(url).read_text(encoding="utf-8"))
    body = urlencode(form).encode() if form else None
    limited = broken = 0
    while True:
        try:
            with send(Request(url, data=body, headers={"User-Agent": agent, "Accept": "application/json"}), timeout=60) as answer:  # noqa: S310
                return json.loads(answer.read().decode("utf-8"))
        except HTTPError as error:
            if error.code != 429 or limited:
                raise
            limited = 1
            sleep(wait_seconds(error.headers.get("Retry-After")))
        except URLError:
            broken += 1
            if broken > TRIES:
                raise
            sleep(1)


def load_json(path: str | Path) -> object | None:
    """A cached value; None where there is none that can be read."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None


def cached_bindings(path: str | Path, fetch: Callable[[], dict], refresh: bool = False) -> list[dict]:
    """The bindings of a query, from the cache file if it can be read, else fetched and written there."""
    known = None if refresh else load_json(path)
    if known is None:
        known = fetch()["results"]["bindings"]
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(json.dumps(known, ensure_ascii=False), encoding="utf-8")
    return known


def participants(spark: SparkSession, path: str | Path, fetch: Callable[[], dict], refresh: bool = False) -> DataFrame:
    """``date``, ``wikidata_id``, ``label`` of season participants: one small query result."""
    value = lambda b, k: (b.get(k) or {}).get("value")
    rows = [(value(b, "date"), (value(b, "speaker") or "").rsplit("/", 1)[-1], value(b, "speakerLabel")) for b in cached_bindings(path, fetch, refresh)]
    return spark.createDataFrame(rows, "date string, wikidata_id string, label string")


def people(ids: DataFrame, cache: str, fetch: Callable[[list[str]], list[dict]], refresh: bool = False, size: int = BATCH_IDS, wave: int = WAVE) -> DataFrame:
    """``wikidata_id``, ``pos`` and ``binding`` (JSON) of the wanted ids (column ``wikidata_id``; malformed ones are left out).

    Missing ids are asked for in batches of ``size``, a task each. ``wave`` batches at a time are appended to the table ``cache``,
    so a run that breaks off loses no more than these; an id without an answer is remembered too.
    """
    wanted = ids.filter(F.col("wikidata_id").rlike("^Q[1-9][0-9]*$")).select("wikidata_id").distinct()

    def ask(names: list[str]) -> list[tuple]:
        own: dict[str, list[dict]] = {name: [] for name in names}
        for b in fetch(names):
            own.get(((b.get("speaker") or {}).get("value") or "").rsplit("/", 1)[-1], []).append(b)
        return [(name, i, json.dumps(b, ensure_ascii=False)) for name in names for i, b in enumerate(own[name])]

    found = requests.answers(wanted, "wikidata_id", cache, ask, "wikidata_id string, pos int, binding string", size, wave, refresh=refresh)
    return found.join(wanted, "wikidata_id", "left_semi")


def playlists(episodes: DataFrame, ids: DataFrame, cache: str, fetch: Callable[[int], dict], order: list[str], most: int | None = None, tasks: int = 4) -> DataFrame:
    """``sr_episode_id``, ``publishdateutc``, ``songs`` (JSON) of the first wanted episodes in ``order``; what is not in the table ``cache`` is fetched by ``tasks`` tasks and added, some at a time."""
    if tasks < 1:
        raise ValueError("tasks must be positive")
    spark, schema = episodes.sparkSession, "sr_episode_id bigint, songs string"
    plan = incremental.fetch_plan(episodes, ids, requests.table(spark, cache, schema), "sr_episode_id", order, most)
    ask = lambda i: [(i[0], json.dumps(fetch(int(i[0])).get("song", []), ensure_ascii=False))]
    found = requests.answers(plan.select(F.col("sr_episode_id").cast("bigint")), "sr_episode_id", cache, ask, schema, wave=tasks * WAVE, tasks=tasks)
    return plan.drop("origin").join(found, "sr_episode_id").orderBy(*order).select("sr_episode_id", "publishdateutc", "songs")


def portraits(episodes: DataFrame, excluded: list[str], fetch: Callable[[int], dict]) -> DataFrame:
    """Episodes whose ``image_url`` is one of ``excluded`` get the image of their own page, where it has one. Only those are asked for."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"sr_episode_id": batch["sr_episode_id"], "image_url": [(fetch(int(i)).get("item") or {}).get("imageSrc") for i in batch["sr_episode_id"]]})

    wanted = episodes.filter(F.col("image_url").isin(excluded)).select("sr_episode_id")
    found = wanted.mapInPandas(ask, "sr_episode_id bigint, image_url string")
    return archive.replace_images(episodes, excluded, found.filter("coalesce(image_url, '') <> ''"))


def people_of_triples(triples: DataFrame, ids: DataFrame) -> DataFrame:
    """The people query over a table of triples (``s``, ``p``, ``o``, ``lang``): one row for each combination of optional values, null where there is none.

    ``ids`` has ``s``. Labels are Swedish or else English; ``gender``, ``citizenship`` and ``occupation`` are P21, P27 and P106, articles ``sv_article`` and ``en_article``.
    """
    label = triples.filter("p = 'label'").groupBy("s").agg(F.coalesce(F.min(F.when(F.col("lang") == "sv", F.col("o"))), F.min(F.when(F.col("lang") == "en", F.col("o")))).alias("label"))
    rows = ids.select("s").distinct().join(label, "s", "left")
    for name, p in (("gender", "P21"), ("birthDate", "P569"), ("deathDate", "P570"), ("citizenship", "P27"), ("occupation", "P106"), ("svArticle", "sv_article"), ("enArticle", "en_article")):
        rows = rows.join(triples.filter(F.col("p") == p).select("s", F.col("o").alias(name)), "s", "left")
    for name in ("gender", "citizenship", "occupation"):
        rows = rows.join(label.select(F.col("s").alias(name), F.col("label").alias(name + "Label")), name, "left")
    return rows.withColumnRenamed("s", "speaker").withColumnRenamed("label", "speakerLabel").dropDuplicates()
