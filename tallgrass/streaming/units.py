"""Units of episodes whose segments arrive over time, in any order. An extension: the same units as ``transcripts.build_units`` over the whole table.

An episode's state is the index that comes next, segments that came too early, the open unit, and the unit before, which is held back
while the open one may still join it. An episode ends when nothing of it has come for some time, by the watermark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallgrass.functions import text as T
from tallgrass.operators.transcripts import MIN_WORDS, PAUSE_SECONDS, TARGET_WORDS

#: A unit that is not done: first start, last end, words, texts, and the seconds since the segment before it.
Unit = dict
_OUT = "unit_index int, start_seconds double, end_seconds double, text string, word_count long, segment_count long, pause_before_seconds double"


class Fold:
    """What is known of one episode; ``add`` and ``finish`` give the units that are done."""

    def __init__(self, target: int, least: int, pause: float, saved: str | None = None):
        self.target, self.least, self.pause = target, least, pause
        known = json.loads(saved) if saved else {"next": 0, "early": {}, "open": None, "held": None, "number": 0, "end": None}
        self.next, self.early, self.open, self.held, self.number, self.end = (known[k] for k in ("next", "early", "open", "held", "number", "end"))

    def saved(self) -> str:
        return json.dumps({"next": self.next, "early": self.early, "open": self.open, "held": self.held, "number": self.number, "end": self.end})

    def add(self, index: int, segment: tuple | None) -> list[tuple]:
        """Takes in a segment (start, end, words, text), or None where the one with this index is left out. A second one of an index is ignored."""
        if index >= self.next:
            self.early.setdefault(str(index), segment)
        out = []
        while str(self.next) in self.early:
            out += self._fold(self.early.pop(str(self.next)))
            self.next += 1
        return out

    def finish(self) -> list[tuple]:
        """The rest: segments behind gaps that stayed open, in their order, and the last units."""
        out = [unit for index in sorted(self.early, key=int) for unit in self._fold(self.early[index])]
        if self.open and self.held:  # the open unit is short, and no pause is before it
            self.open = {**self.held, "start": min(self.held["start"], self.open["start"]), "end": self.open["end"], "words": self.held["words"] + self.open["words"], "texts": self.held["texts"] + self.open["texts"]}
            self.held = None
        return out + ([self._done(self.open)] if self.open else [])

    def _done(self, unit: Unit) -> tuple:
        since = 0.0 if self.end is None else max(0.0, unit["start"] - self.end)
        self.number, self.end = self.number + 1, unit["end"]
        return self.number - 1, unit["start"], unit["end"], " ".join(unit["texts"]), unit["words"], len(unit["texts"]), since

    def _fold(self, segment: tuple | None) -> list[tuple]:
        if segment is None:
            return []
        start, end, words, text = segment
        out, gap = [], max(0.0, start - self.open["end"]) if self.open else 0.0
        if self.open and self.open["words"] >= max(self.least, 1) and (self.open["words"] >= self.target or gap >= self.pause):
            if gap < self.pause:
                self.held = self.open
            else:  # nothing joins a unit over a pause
                out.append(self._done(self.open))
            self.open = None
        if self.open:
            self.open = {"start": min(self.open["start"], start), "end": end, "words": self.open["words"] + words, "texts": [*self.open["texts"], text]}
        else:
            self.open = {"start": start, "end": end, "words": words, "texts": [text]}
        if self.held and self.open["words"] >= self.least:
            out.append(self._done(self.held))
            self.held = None
        return out


def units(stream: DataFrame, arrived: str, keep: Column | None = None, idle: str = "1 hour", idle_seconds: int = 3600, ident: str = "sr_episode_id", index: str = "segment_index", target: int = TARGET_WORDS, least: int = MIN_WORDS, pause: float = PAUSE_SECONDS) -> DataFrame:
    """Units as in ``build_units``, each once it is sure; an episode's last ones when the watermark (``idle`` behind ``arrived``) has passed its last segment by ``idle_seconds``.

    The stream has all segments of an episode, indexed from 0: those without text or readable times, and those not to ``keep``, take part as gaps.
    Rows without identifier, index or time of arrival are left out; of rows that repeat an index the first one counts; what comes after an episode's end is dropped.
    """
    kind = stream.schema[ident].dataType.simpleString()
    text = T.squeeze(F.coalesce("text", F.lit("")))
    start, end = F.col("start").try_cast("double"), F.col("end").try_cast("double")
    valid = F.coalesce((text != "") & start.isNotNull() & (end >= start), F.lit(False)) & F.coalesce(F.lit(True) if keep is None else keep, F.lit(False))
    rows = stream.filter(F.col(ident).isNotNull() & F.col(index).isNotNull() & F.col(arrived).isNotNull()).withWatermark(arrived, idle)
    rows = rows.select(ident, F.col(arrived).alias("arrived"), F.col(index).cast("int").alias("i"), valid.alias("valid"), start.alias("start"), end.alias("end"), text.alias("text"), F.size(F.split(text, " ")).alias("words"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        saved, last = state.get if state.exists else (None, 0)
        fold, out = Fold(target, least, pause, saved), []
        if state.hasTimedOut:
            out = fold.finish()
            state.remove()
        else:
            for batch in batches:
                last = max(last, int(batch["arrived"].max().timestamp() * 1000))
                for row in batch.sort_values("i", kind="stable").itertuples():
                    out += fold.add(int(row.i), (float(row.start), float(row.end), int(row.words), row.text) if row.valid else None)
            state.update((fold.saved(), last))
            state.setTimeoutTimestamp(max(last + idle_seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *unit) for unit in out], columns=[ident, *[c.split()[0] for c in _OUT.split(", ")]])

    found = rows.groupBy(ident).applyInPandasWithState(run, f"{ident} {kind}, {_OUT}", "saved string, last long", "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("text", T.squeeze(F.col("text"))).withColumn("unit_id", T.content_id(F.col(ident), "u", F.col("unit_index"), F.col("text")))
