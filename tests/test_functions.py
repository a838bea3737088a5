"""Expressions on edge rows, with expected values worked out by hand; invariants of the archive."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from linkloom.functions import html, text, urls
from linkloom.operators import archive, enrich, harvest
from linkloom.sources import files
from linkloom.streaming.harvest import harvested, windows

KEYS = {
    "https://youtu.be/AbC?si=x": "youtube.com/watch?v=AbC",
    "https://www.youtube.com/watch?v=AbC&t=5": "youtube.com/watch?v=AbC",
    "https://x.com/u/status/123": "x.com/status/123",
    "https://fxtwitter.com/u/status/123": "x.com/status/123",
    "https://github.com/Own/Repo.git/issues/4": "github.com/own/repo",
    "https://github.com/topics/spark": "github.com/topics/spark",
    "https://www.m.Example.com/A/?b=2&a=1&utm_source=x#f": "example.com/a?a=1&b=2",
    "http://Ex.com": "ex.com/",
    "https://ex.com/docs/index.html": "ex.com/docs",
    "https://ex.com/a?x": "ex.com/a?x=",
    "https://u:p@ex.com:8080/a": "ex.com/a",
    "https://news.ycombinator.com/item?id=1": "news.ycombinator.com/item?id=1",
    "https://ex.com/?q=%zz+1": "ex.com/?q=%25zz%2B1",
    "#footnote-1": None,
    "": None,
    None: None,
    "mailto:x@y": None,
    "https://[bad/": None,
}


def test_canonical_key(spark):
    rows = spark.createDataFrame([(u,) for u in KEYS], "url string").select("url", urls.canonical_key(F.col("url")).alias("key")).collect()
    assert {r.url: r.key for r in rows} == KEYS


def test_key_is_stable(spark):
    found = [k for k in KEYS.values() if k and "%" not in k]
    rows = spark.createDataFrame([(f"https://{k}", k) for k in found], "url string, key string")
    assert rows.where(~urls.canonical_key(F.col("url")).eqNullSafe(F.col("key"))).count() == 0


@pytest.mark.parametrize(("said", "tidied"), [(", and a fast tool", "A fast tool."), ("done!", "Done!"), ("", ""), (None, ""), ("  but  so what?", "So what?"), ("android apps", "Android apps."), ("…", "")])
def test_tidy(spark, said, tidied):
    assert spark.createDataFrame([(said,)], "x string").select(text.tidy(F.col("x"))).first()[0] == tidied


def test_meta_takes_either_order(spark):
    page = """<html><meta name="description" content="plain"><meta content="Social &amp; bold" property='og:description'><title> A
    title </title>"""
    row = spark.createDataFrame([(page,), ("no markup",)], "h string").select(html.scraped(F.col("h")).alias("m")).select("m.*").collect()
    assert tuple(row[0]) == ("A title", "Social & bold.") and tuple(row[1]) == (None, None)


def test_tags(spark):
    row = spark.createDataFrame([("tool", "An LLM agent in your terminal", "", "github.com", "https://github.com/a/b", "a/b")], "k string, t string, d string, h string, u string, r string")
    assert row.select(html.tags(*[F.col(c) for c in "ktdhur"])).first()[0] == ["tool", "ai", "devtools", "opensource"]


ROWS = "key string, url string, src string, chan string, date string, id long, seq long, title string, description string, kind string, tags array<string>"


def sightings(spark, order=1):
    rows = [
        ("a", "u1", "chat", "tools", "2024-01-05", 5, 1, "A", "long description", "tool", ["tool", "ai"]),
        ("a", "u2", "newsletter", None, "2024-02-01", 1, 2, "B", "short", "read", ["read"]),
        ("a", "u3", "chat", "reads", None, 9, 3, "C", "", "read", ["read", "web"]),
        ("b", "u4", "chat", "tools", "2024-01-02", 7, 4, "D", "same", "tool", ["tool"]),
        ("b", "u5", "chat", "tools", "2024-01-01", 8, 5, "E", "same", "tool", ["tool"]),
        (None, None, "newsletter", None, "2024-01-01", 2, 6, "Q", "", "quote", ["quote"]),
        (None, None, "newsletter", None, "2024-01-01", 3, 7, "Q", "", "quote", ["quote"]),
    ]
    return spark.createDataFrame(rows[::order], ROWS)


def test_folded(spark):
    merged = archive.folded(sightings(spark))
    nested = archive.with_also(merged, archive.occurrences(sightings(spark), merged))
    out = {(r.key or r.seq): r for r in nested.collect()}
    assert out["a"].title == "B" and out["a"]["first"] == "2024-01-05" and out["a"]["last"] == "2024-02-01" and out["a"].tags == ["read", "web", "tool", "ai"]
    assert [o.chan for o in out["a"].also] == ["reads", "tools"]
    assert out["b"].title == "E" and len(out) == 4
    assert sum(r.n for r in out.values()) == 7


def test_folded_ignores_row_order(spark):
    a, b = (sorted(map(str, archive.folded(sightings(spark, o)).collect())) for o in (1, -1))
    assert a == b


def test_fingerprint_sees_edits_and_order(spark):
    digest = lambda rows: archive.fingerprint(spark.createDataFrame(rows, "i int, t string"), "t", "i").first()[0]
    one = digest([(1, "a"), (2, "b")])
    assert len({one, digest([(1, "b"), (2, "a")]), digest([(1, "a"), (2, "c")]), digest([(1, "ab"), (2, "")])}) == 4
    assert one == digest([(2, "b"), (1, "a")])


def test_merge_never_adds_or_overwrites(spark):
    cache = spark.createDataFrame([("a", False, None, None, None, None), ("b", True, "Own", None, None, None)], "key string, ok boolean, title string, description string, via string, fetched_at timestamp")
    found = spark.createDataFrame([("a", " T ", "sign in to read"), ("b", "X", "y"), ("c", "Z", "z")], "key string, title string, description string")
    out = {r.key: (r.ok, r.title, r.description, r.via) for r in enrich.merged(cache, found, "2024-01-01").collect()}
    assert out == {"a": (True, "T", None, "agent"), "b": (True, "Own", None, None)}


def test_first_scan_has_no_cursor(spark):
    t = spark.createDataFrame([("a", None), ("b", "x")], "id string, stamp string")
    assert harvest.archived_after(t, t.select("id"), None).count() == 2


def test_harvest_document(spark, tmp_path):
    old = {"guildId": "g", "channelId": "c", "lastMessageId": "9", "messages": [{"id": "1", "ts": "2024-01-01T00:00:00+00:00", "content": "hi", "urls": [{"url": "https://ex.com", "text": None}]}]}
    (tmp_path / "h.json").write_text(json.dumps(old))
    channels, messages = files.harvest(spark, str(tmp_path / "h.json"))
    assert channels.first().ch == "c" and messages.first().ch == "c" and messages.first().said == "hi"
    assert files.sightings_of(messages).first().date == "2024-01-01"
    assert files.harvest(spark, str(tmp_path / "none.json"))[1].count() == 0


def test_posts_and_publish(spark, tmp_path):
    (tmp_path / "posts").mkdir()
    (tmp_path / "posts/12.edition-3.html").write_text("<h1>x</h1>")
    (tmp_path / "roster.csv").write_text("post_id,is_published,title,post_date\n12.edition-3,true,T,2024-01-01\n13,false,U,\n")
    row = files.posts(spark, str(tmp_path / "posts"), str(tmp_path / "roster.csv")).first()
    assert (row.post_id, row.slug, row.body) == ("12", "edition-3", "<h1>x</h1>")
    for n in (3, 5):
        files.publish(spark.range(n), str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == n


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "event_id long, ts timestamp, event_type string"
    for k, rows in enumerate(([(1, "a"), (2, "b")], [(2, "b"), (3, "c")])):
        spark.createDataFrame([(i, None, t) for i, t in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = harvested(spark, str(tmp_path / "in"), "*.parquet", schema, str(tmp_path / "state"))
        assert got.count() == (2, 3)[k]
    assert windows(spark.createDataFrame([(1, datetime(2024, 1, 1), "a"), (2, None, "a")], schema)).collect()[0].n == 1
