"""A paged source of messages: channels are read in parallel, each from its own cursor on.

A client has page(channel, after, limit) and archived(channel, before, limit), which return lists of dicts. Any object that can be pickled will do;
FolderClient reads JSON lines and stands in for a chat server.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Messages of a page, and how often a call is tried.
PAGE, ATTEMPTS = 100, 6
MESSAGE = "ch string, id string, ts string, author string, content string, embeds array<struct<url:string,title:string>>, denied boolean"
THREAD = "parent_id string, id string, name string, type int, stamp string, denied boolean"


class Denied(Exception):
    """This channel can't be read, others may."""


class Refused(Exception):
    """No call will succeed."""


class Answer(Exception):
    """A server's answer that is no page: status, and seconds to wait if it says so."""

    def __init__(self, status: int, wait: float | None = None) -> None:
        super().__init__(f"status {status}")
        self.status, self.wait = status, wait


def patiently(call: Callable, *args, sleep: Callable[[float], None] = time.sleep):
    """call(*args), tried again where the server is busy (after what it asks for) or broken (after 1, 2, 4, ... seconds)."""
    for attempt in range(ATTEMPTS):
        try:
            return call(*args)
        except Answer as a:
            if a.status == 429:
                sleep((1.0 if a.wait is None else a.wait) + 0.25)
            elif a.status == 403:
                raise Denied(str(args)) from a
            elif 500 <= a.status < 600:
                sleep(2.0**attempt)
            else:
                raise Refused(str(a)) from a
        except OSError:
            if attempt == ATTEMPTS - 1:
                raise
            sleep(2.0**attempt)
    raise Refused(f"gave up on {args}")


class FolderClient:
    """Messages in <folder>/<channel>.jsonl and archived threads in <folder>/<channel>.threads.jsonl; <channel>.denied refuses."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _rows(self, name: str) -> list[dict]:
        path = Path(self.folder, name)
        return [json.loads(x) for x in path.read_text().splitlines() if x.strip()] if path.exists() else []

    def page(self, channel: str, after: str, limit: int) -> list[dict]:
        if Path(self.folder, f"{channel}.denied").exists():
            raise Answer(403)
        later = sorted((m for m in self._rows(f"{channel}.jsonl") if int(m["id"]) > int(after)), key=lambda m: int(m["id"]))
        return later[:limit][::-1]

    def archived(self, channel: str, before: str | None, limit: int) -> list[dict]:
        rows = sorted(self._rows(f"{channel}.threads.jsonl"), key=lambda t: t.get("stamp") or "", reverse=True)
        return [t for t in rows if before is None or (t.get("stamp") or "") < before][:limit]


def messages(channels: DataFrame, client, limit: int | None = None, page: int = PAGE) -> DataFrame:
    """MESSAGE rows of channels (ch, cursor): all after each cursor, or some pages of them until limit rows; a channel that is denied is one row that says so."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ch, cursor in zip(batch["ch"], batch["cursor"], strict=True):
                after, n = "0" if cursor is None or pd.isna(cursor) else str(int(cursor)), 0
                try:
                    while True:
                        got = sorted(patiently(client.page, ch, after, page), key=lambda m: int(m["id"]))
                        if not got:
                            break
                        after, n = got[-1]["id"], n + len(got)
                        yield pd.DataFrame([{"ch": ch, "id": m["id"], "ts": m.get("ts"), "author": m.get("author"), "content": m.get("content"), "embeds": [{"url": e.get("url"), "title": e.get("title")} for e in m.get("embeds") or []], "denied": False} for m in got])
                        if len(got) < page or (limit and n >= limit):
                            break
                except Denied:
                    yield pd.DataFrame([{"ch": ch, "id": None, "ts": None, "author": None, "content": None, "embeds": None, "denied": True}])

    dealt = channels.select(F.col("ch").cast("string").alias("ch"), F.col("cursor").cast("string").alias("cursor"))
    return dealt.repartition("ch").mapInPandas(read, MESSAGE)


def archived_threads(parents: DataFrame, client, page: int = PAGE) -> DataFrame:
    """THREAD rows of parents (ch, since): newest-first pages, down to the one that reaches the stamp since. See harvest.archived_after for which count."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ch, since in zip(batch["ch"], batch["since"], strict=True):
                since, before = None if since is None or pd.isna(since) else since, None
                try:
                    while True:
                        got = patiently(client.archived, ch, before, page)
                        if got:
                            yield pd.DataFrame([{"parent_id": ch, "id": t["id"], "name": t.get("name"), "type": t.get("type"), "stamp": t.get("stamp"), "denied": False} for t in got])
                        stamps = [t["stamp"] for t in got if t.get("stamp")]
                        before = got[-1].get("stamp") if got else None
                        if len(got) < page or not before or (since and min(stamps) <= since):
                            break
                except Denied:
                    yield pd.DataFrame([{"parent_id": ch, "id": None, "name": None, "type": None, "stamp": None, "denied": True}])

    return parents.select(F.col("ch").cast("string").alias("ch"), F.col("since").cast("string").alias("since")).repartition("ch").mapInPandas(read, THREAD)
