"""Sources, enrichment, search and publication on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from linkloom.functions import adapters, html, text
from linkloom.operators import archive, enrich, harvest, newsletter, search
from linkloom.operators import sightings as sight
from linkloom.operators.ordering import numbered
from linkloom.plans import publication
from linkloom.plans import vocabulary as V
from linkloom.sources import files, fixtures, matrix, options, paged, pages


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# ---- the paged source -----------------------------------------------------------------------------------------------


def server(folder):
    for ch, ids in (("1", range(1, 8)), ("2", range(20, 22))):
        (folder / f"{ch}.jsonl").write_text("\n".join(json.dumps({"id": str(i), "ts": "2024-01-01T00:00:00", "author": "a", "content": f"see https://ex.com/{i}" if i % 2 else "nothing", "embeds": [{"url": "https://ex.com/e", "title": " E "}] if i == 2 else []}) for i in ids))
    (folder / "3.denied").write_text("")
    (folder / "9.threads.jsonl").write_text("\n".join(json.dumps({"id": f"t{i}", "name": "n", "type": 11, "stamp": f"2024-01-0{i}"}) for i in range(1, 8)))
    return paged.FolderClient(str(folder))


def test_paged_messages(spark, tmp_path):
    client = server(tmp_path)
    channels = spark.createDataFrame([("1", "3"), ("2", None), ("3", None), ("4", None)], "ch string, cursor string")
    got = paged.messages(channels, client, page=2)
    assert rows(got.where("not denied"), "ch", "id") == [("1", "4"), ("1", "5"), ("1", "6"), ("1", "7"), ("2", "20"), ("2", "21")]
    assert rows(got.where("denied"), "ch") == [("3",)]
    assert paged.messages(channels.where("ch = '1'"), client, limit=1, page=2).count() == 2
    assert rows(harvest.cursors(got.where("not denied")), "ch", "cursor") == [("1", 7), ("2", 21)]
    kept = harvest.with_links(paged.messages(channels.select("ch", F.lit("0").alias("cursor")), client))
    assert [(r.id, [(u.url, u.text) for u in r.urls]) for r in kept.orderBy(F.col("id").cast("int")).collect()][:2] == [("1", [("https://ex.com/1", None)]), ("2", [("https://ex.com/e", "E")])]


def test_archived_threads_stop_at_the_cursor(spark, tmp_path):
    client = server(tmp_path)
    parents = spark.createDataFrame([("9", "2024-01-05")], "ch string, since string")
    got = paged.archived_threads(parents, client, page=2)
    assert rows(got, "id") == [("t4",), ("t5",), ("t6",), ("t7",)]
    assert rows(harvest.archived_after(got, spark.createDataFrame([("t5",)], "id string"), "2024-01-05"), "id") == [("t6",), ("t7",)]
    old = spark.createDataFrame([("9", "2024-01-05"), ("8", "2024-01-01")], "ch string, stamp string")
    scanned = got.select("parent_id", "stamp")
    assert rows(harvest.archive_cursors(old, scanned, spark.createDataFrame([], "parent_id string")), "ch", "stamp") == [("8", "2024-01-01"), ("9", "2024-01-07")]
    assert rows(harvest.archive_cursors(old, scanned, spark.createDataFrame([("9",)], "parent_id string")), "ch", "stamp") == [("8", "2024-01-01"), ("9", "2024-01-05")]


def test_archived_threads_are_read_too(spark):
    channels = spark.createDataFrame([("1", "general", 0, None, []), ("2", "secret", 0, None, [("g", "1024")])], "id string, name string, type int, parent_id string, permission_overwrites array<struct<id:string,deny:string>>")
    none = spark.createDataFrame([], "id string, name string, type int, parent_id string")
    old = spark.createDataFrame([("7", "old", "1"), ("8", "hidden", "2")], "id string, name string, parent_id string")
    assert rows(harvest.visible(channels, none, "g", archived=old), "id") == [("1",), ("7",)]
    assert rows(harvest.visible(channels, none, "g", archived=old, excluded=("7",)), "id") == [("1",)]
    assert rows(harvest.visible(channels, none, "g", archived=old, only=("7",)), "id") == [("7",)]


def test_patience():
    waits, answers = [], [paged.Answer(429, 2.0), paged.Answer(503), OSError(), 5]

    def call():
        x = answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert paged.patiently(call, sleep=waits.append) == 5 and waits == [2.25, 2.0, 4.0]
    for status, error in ((403, paged.Denied), (401, paged.Refused), (404, paged.Refused)):
        answers[:] = [paged.Answer(status)]
        with pytest.raises(error):
            paged.patiently(call, sleep=waits.append)
    answers[:] = [paged.Answer(500)] * 6
    with pytest.raises(paged.Refused):
        paged.patiently(call, sleep=waits.append)


# ---- enrichment -----------------------------------------------------------------------------------------------------


def test_enrichment_goes_on_where_it_stopped(spark, tmp_path):
    work = spark.createDataFrame([(f"k{i}", f"https://ex.com/{i}", i) for i in range(7)], "key string, url string, seq long")

    def fetch(url):
        if url.endswith("3"):
            raise ValueError("no " * 200)
        return f"  Title   {url[-1]} ", "and  a description"

    state = str(tmp_path / "state")
    assert enrich.run(work, fetch, "2024-01-01", state, budget=-1.0, pause=0).count() == 0
    assert enrich.run(work.where("seq < 3"), fetch, "2024-01-01", state, slice_rows=2, pause=0).count() == 3
    got = {r.key: r for r in enrich.run(work, fetch, "2024-01-01", state, slice_rows=2, pause=0).collect()}
    assert len(got) == 7 and got["k1"].title == "Title 1" and got["k1"].description == "A description." and got["k1"].ok
    assert not got["k3"].ok and got["k3"].title is None and len(got["k3"].error) == 200
    cache = spark.createDataFrame([("k1", True, "Old"), ("x", True, "X")], "key string, ok boolean, title string")
    assert rows(enrich.upserted(cache, spark.createDataFrame([("k1", True, "New")], cache.schema)), "key", "title") == [("k1", "New"), ("x", "X")]


def test_researched_batches(spark):
    work = enrich.batches(spark.createDataFrame([(f"k{i:02d}", f"u{i}") for i in range(60)], "key string, url string"), "key")
    assert work.groupBy("batch").count().orderBy("batch").collect() == [(0, 25), (1, 25), (2, 10)]

    def ask(items):
        if items[0][0] == "k25":
            raise OSError
        return {k: {"title": " T " if int(k[1:]) % 2 else " ", "description": u} for k, u in items} | {"bad": "x"}

    assert rows(enrich.researched(work, ask), "key", "title") == [(f"k{i:02d}", "T") for i in (*range(1, 25, 2), *range(51, 60, 2))]


def test_worklist_limit(spark):
    want = spark.createDataFrame([(f"k{i}", "u", 9 - i) for i in range(5)], "key string, url string, seq long")
    cache = spark.createDataFrame([], "key string, url string, ok boolean, title string, via string, fetched_at timestamp")
    assert [r.key for r in enrich.worklist(want, cache, "2024-01-01", limit=2).orderBy("seq").collect()] == ["k4", "k3"]


# ---- adapters -------------------------------------------------------------------------------------------------------


def test_adapters(spark):
    feed = "<feed><title>query</title><entry><title>On\n  graphs</title><summary> About &amp; around </summary></entry></feed>"
    long = "word " * 40
    post = lambda t, name="N", handle="h": json.dumps({"tweet": {"text": t, "author": {"name": name, "screen_name": handle}}})
    one = lambda c: tuple(spark.range(1).select(c.alias("x")).first().x)
    assert one(adapters.repo(F.lit('{"full_name":"A/b","description":"d"}'), F.lit("a/b"))) == ("A/b", "d")
    assert one(adapters.repo(F.lit("{}"), F.lit("a/b"))) == ("a/b", None)
    assert one(adapters.video(F.lit('{"title":"T","author_name":"Who"}'))) == ("T", "Video by Who.") and one(adapters.video(F.lit('{"title":"T"}'))) == ("T", None)
    assert one(adapters.wiki(F.lit('{"title":"T","extract":"E"}'))) == ("T", "E") and one(adapters.paper(F.lit(feed))) == ("On graphs", "About & around")
    assert one(adapters.post(F.lit(post("short")))) == ("short", "Post by N (@h)") and one(adapters.post(F.lit(post("")))) == ("Post by N (@h)", None)
    title, description = one(adapters.post(F.lit(post(long))))
    assert title == "word " * 21 + "word…" and description == long.strip()
    assert one(adapters.post_by_path(F.lit("/me/status/1"))) == ("Post by @me", None) and one(adapters.post_by_path(F.lit("/i/status/1"))) == (None, None)


def test_stories_climb_to_the_title(spark):
    items = spark.createDataFrame([(1, None, "Story", "u", None), (2, 1, None, None, "c"), (3, 2, "", None, "c"), (4, 4, None, None, None), (5, None, None, None, None)], "id long, parent long, title string, url string, text string")
    got = adapters.stories(spark.createDataFrame([(3,), (1,), (4,), (5,), (9,)], "id long"), items)
    assert {r.id: (r.story, r.title) for r in got.collect()} == {3: (1, "Story"), 1: (1, "Story"), 4: (4, None), 5: (5, None), 9: (9, None)}


# ---- text and newsletter --------------------------------------------------------------------------------------------


def test_references(spark):
    texts = ["&amp;lt; &#38;lt; &#x1F600;&#233;&eacute; &nope; &amp &apos;&#0;&#xD800;", None, "plain"]
    got = [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(text.decoded(F.col("t")).alias("x")).collect()]
    assert got == ["&lt; &lt; 😀éé &nope; &amp '&#0;&#xD800;", None, "plain"]


def test_markers_and_unknown_headings(spark):
    unit = spark.createDataFrame([('🔥 Big: <a href="https://ex.com/a">A</a> end',)], "u string").select(html.first_link(F.col("u")).alias("l")).first().l
    assert (unit.marker, unit.before, unit.title, unit.after) == ("🔥", "Big", "A", "end")
    body = "<h2>Odd &amp; new</h2><ul><li><a href='x'>y</a></li></ul><h3>Sub</h3><h2>Friends of Letters</h2><blockquote>q</blockquote>"
    found = newsletter.with_kind(newsletter.sections(spark.createDataFrame([(1, body), (2, body)], "ed int, body string")), excluded=V.excluded_sections("letters"))
    assert [tuple(r) for r in newsletter.unknown_headings(found).collect()] == [("odd new", 2, [1, 2])]
    assert {r.name: r.kind for r in found.collect()} == {"odd new": "awe", "sub": "awe", "friends of letters": None}


def test_rule_tables_are_parameters(spark):
    row = spark.createDataFrame([("gizmo", "https://a.example/jobs/1")], "t string, u string")
    from linkloom.functions import urls

    got = row.select(html.tags(F.lit("tool"), F.col("t"), F.lit(""), F.lit("h"), F.col("u"), F.lit(None).cast("string"), [(r"\bgizmo\b", "gadgets", "Gadgets", "topic")]).alias("tags"), html.kind_for(F.lit("pics"), F.lit("h"), [("pics", "awe")]).alias("kind"), html.section_kind(F.col("t"), {"til": ["gizmo"]}).alias("section"), urls.is_job(F.col("u"), paths="^/work").alias("job")).first()
    assert tuple(got) == (["tool", "gadgets"], "awe", "til", False)


# ---- the archive ----------------------------------------------------------------------------------------------------


def test_titles_of_slugs(spark):
    got = spark.createDataFrame([("llm-ops",), ("k8s x",), ("école",)], "s string").select(archive.titled(F.col("s")).alias("t")).collect()
    assert [r.t for r in got] == ["Llm-Ops", "K8S X", "École"]


def test_enriched_takes_link_text_and_remark(spark):
    seen = spark.createDataFrame([("https://ex.com/a-page", "tools", "Shown", "and a remark that is certainly longer than forty signs", "chat"), ("https://ex.com/a-page", "tools", "https://ex.com", "short", "chat"), ("https://ex.com/a-page", None, None, None, "newsletter")], "url string, chan string, text string, said string, src string")
    cache = spark.createDataFrame([("ex.com/a-page", "Cached", "Blurb.")], "key string, title string, description string")
    got = sight.enriched(seen, cache, sight.channel_slugs(seen.where("chan is not null").select(F.col("chan").alias("name"))))
    assert sorted((r.title, r.description, tuple(r.tags)) for r in got.collect()) == [
        ("Cached", "Blurb.", ("tool",)), ("Cached", "Blurb.", ("tool", "discord", "tools")), ("Shown", "A remark that is certainly longer than forty signs.", ("tool", "discord", "tools")),
    ]


def test_publication(spark):
    found = newsletter.with_kind(newsletter.sections(spark.createDataFrame([(1, '<h2>Builders Nest</h2><ul><li><a href="https://ex.com/a">A</a> tells something</li></ul><h2>Wisdom bits</h2><blockquote>Be brief. ~ Me</blockquote>')], "ed int, body string")))
    rewrites = spark.createDataFrame([("1::https://ex.com/a", "Rewritten at length.")], "rewrite_key string, clean string")
    entries = newsletter.curated(newsletter.entries(found, "letters"), spark.createDataFrame([(1, "2024-03-01T00:00")], "ed int, date string"), rewrites)
    said = spark.createDataFrame([("11", "1", "2024-01-01", "w", "", 0, "https://www.ex.com/a?utm_source=x", None), ("10", "2", "2024-02-01", "w", "", 0, "https://ex.com/b", "B"), ("12", "1", "2024-02-02", "w", "", 0, "https://ex.com/hidden", None), ("12", "3", "2024-02-02", "w", "", 0, "https://ex.com/x", None)], "msg string, ch string, date string, author string, said string, pos int, url string, text string")
    channels = spark.createDataFrame([("1", "tools", None), ("2", "thread", "video"), ("3", "memes", None)], "ch string, name string, parent string")
    cache = spark.createDataFrame([], "key string, title string, description string")
    p = publication.built(entries, said, channels, cache, "9")
    got = [(r.entry_id, r.src, r.title, r["first"], r["last"], r.tags) for r in p.entries.orderBy("entry_id").collect()]
    assert got == [
        (1, "newsletter", "A", "2024-01-01", "2024-03-01", ["tool", "discord", "tools"]), (2, "newsletter", "Be brief.", "2024-03-01", "2024-03-01", ["quote"]),
        (3, "chat", "B", "2024-02-01", "2024-02-01", ["tool", "discord", "ch-video"]), (4, "chat", "Hidden", "2024-02-02", "2024-02-02", ["tool", "discord", "tools"]),
    ]
    assert p.entries.where("entry_id = 1").first().clean == "Rewritten at length."
    assert [tuple(r) for r in p.occurrences.select("key", "src", "date", "msg_url").collect()] == [("ex.com/a", "chat", "2024-01-01", "https://discord.com/channels/9/1/11")]
    assert [(r.slug, r.label, r.facet, r.n) for r in p.facets.collect()] == [("discord", "Discord", "source", 3), ("tool", "Tool", "kind", 3), ("tools", "#tools", "channel", 2), ("ch-video", "#video", "channel", 1), ("quote", "Quote", "kind", 1)]
    assert tuple(p.figures.first()) == (2, 2, 1, 4) and [r.name for r in p.channels.collect()] == ["tools", "video"]
    empty = publication.built(entries.limit(0), said.limit(0), channels.limit(0), cache)
    assert empty.entries.count() == 0 and tuple(empty.figures.first()) == (0, 0, 0, 0)


def test_numbers_without_a_single_task(spark):
    got = numbered(spark.range(1000).withColumn("rank", F.lit("x")).repartition(7), [F.col("id").desc()], first=0)
    assert got.columns == ["id", "rank"] and {r.id + r["rank"] for r in got.collect()} == {999}


# ---- pages, vectors, fixtures, options ------------------------------------------------------------------------------


def test_page_keeps_its_stamp(spark, tmp_path):
    one = pages.blob({"entries": spark.createDataFrame([(2, "b"), (1, None)], "id int, t string")}, {"generatedAt": "now"}, {"entries": [F.col("id")]}).first().blob
    assert json.loads(one) == {"generatedAt": "now", "entries": [{"id": 1}, {"id": 2, "t": "b"}]}
    page = pages.inlined("<html>\nconst BOOTSTRAP = {};\n</html>", one)
    (tmp_path / "p.html").write_text(page)
    with pytest.raises(ValueError):
        pages.inlined("<html>", one)
    schema = "generatedAt string, entries array<struct<id:int,t:string>>"
    old = pages.previous(spark, str(tmp_path / "p.html"), schema)
    same = spark.createDataFrame([("later", [(1, None), (2, "b")])], schema)
    assert pages.stamp(old, same, "later") == "now" and pages.stamp(old, same.withColumn("entries", F.slice("entries", 1, 1)), "later") == "later"
    assert pages.stamp(pages.previous(spark, str(tmp_path / "none.html"), schema), same, "later") == "later"


def test_vectors_file(spark, tmp_path):
    path = str(tmp_path / "v.f32")
    v = spark.range(5000).select(F.col("id").alias("entry_id"), F.array(F.col("id").cast("float"), F.lit(0.5).cast("float")).alias("embedding")).repartition(5)
    assert matrix.write(v, path, "abc") == {"hash": "abc", "rows": 5000, "dim": 2}
    meta, size = matrix.metadata(path)
    assert size == 40000 and not archive.vectors_stale(meta, 5000, 2, "abc", size) and archive.vectors_stale(meta, 5000, 2, "abd", size) and archive.vectors_stale({}, 5000, 2, "abc", 0)
    assert rows(matrix.read(spark, path, 2, 5000).selectExpr("row - embedding[0] as d", "embedding[1] as e").distinct(), "d", "e") == [(0.0, 0.5)]
    with pytest.raises(ValueError):
        matrix.read(spark, path, 2, 4999)
    assert matrix.metadata(str(tmp_path / "none.f32")) == ({}, 0)
    got = spark.createDataFrame([([[3.0, 0.0], [9.0, 9.0], [5.0, 0.0]], [1, 0, 1])], "s array<array<double>>, m array<int>").select(matrix.pooled(F.col("s"), F.col("m")).alias("p")).first().p
    assert got == [1.0, 0.0]


def test_fixture(spark, tmp_path):
    entries = spark.createDataFrame([(f"https://ex.com/{i}" if i % 3 else f"https://www.youtube.com/watch?v=v{i}", f"T{i}", "2024-06-01") for i in range(30)], "url string, title string, date string")
    path = str(tmp_path / "h")
    fixtures.write(fixtures.harvest(entries), path)
    channels, messages = files.harvest(spark, path)
    links = files.sightings_of(messages)
    assert messages.count() == 35 and channels.count() == 3 and links.where("url like '%utm_source=chat%'").count() == 20
    assert links.where("url like '%utm_source%'").selectExpr("datediff(date'2024-06-01', date) as n").where("n not between 3 and 160").count() == 0
    assert fixtures.harvest(entries).first() == fixtures.harvest(entries.repartition(3)).first()
    fixtures.write(fixtures.harvest(entries), path)
    real = str(tmp_path / "real")
    fixtures.harvest(entries).withColumn("fixture", F.lit(False)).write.json(real)
    with pytest.raises(ValueError):
        fixtures.write(fixtures.harvest(entries), real)


def test_publish_in_order_and_cursors(spark, tmp_path):
    files.publish(spark.createDataFrame([("10",), ("9",)], "id string"), str(tmp_path / "m"), "id")
    assert [r.id for r in spark.read.parquet(str(tmp_path / "m")).collect()] == ["9", "10"] and {p.name for p in tmp_path.iterdir()} == {"m"}
    (tmp_path / "h.json").write_text(json.dumps({"archiveCursors": {"1": "2024"}, "messages": []}))
    assert rows(files.archive_cursors(spark, str(tmp_path / "h.json")), "ch", "stamp") == [("1", "2024")] and files.archive_cursors(spark, str(tmp_path / "no.json")).count() == 0
    files.dump(spark.range(2), str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 2


def test_options():
    assert options.ids("A", "B", env={"A": " ", "B": "1, 2\n3,"}) == ("1", "2", "3") and options.ids("A", env={}) == ()
    got = options.parsed(["--backfill", "--limit", "5", "--only", "1,2", "--refetch", "ex"])
    assert (got.backfill, got.limit, got.only, got.refetch, got.prune) == (True, 5, ("1", "2"), "ex", False)


# ---- search ---------------------------------------------------------------------------------------------------------


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Fast databases", "x", ["data"]), (2, "A data set", "database tokens", ["read"]), (3, None, "cat", ["tool"]), (4, "cats and tools", None, [])], "entry_id long, title string, description string, tags array<string>")
    search.index(docs).write.parquet(str(tmp_path / "index"))
    held = spark.read.parquet(str(tmp_path / "index"))
    whole = docs.withColumn("all", F.concat_ws(" ", "title", "description", F.concat_ws(" ", "tags")))
    for terms, also in ((["data"], {}), (["cat", "zz"], {"cat": ["tool"]}), (["zz"], {"zz": ["data"]}), (["a"], {})):
        assert rows(search.looked_up(held, 4, terms, also), "entry_id", "literal", "score") == rows(search.keyword(whole, terms, also, "all", "entry_id"), "entry_id", "literal", "score")
    assert rows(held.where("token = 'data'"), "entry_id", "fields") == [(1, ["tags"]), (2, ["title"])]
    words = search.looked_up(held, 4, ["data"], {})
    alone = search.searched(words, None)
    near = spark.createDataFrame([(3, 0.9), (4, 0.1)], "entry_id long, similarity double")
    assert alone.count() == 2 and rows(search.searched(words, near, floor=0.25), "entry_id") == [(1,), (2,), (3,)]


def test_requests():
    r = search.Request.parsed("#q=fast%20db&tag=ai,tools&w=7d&p=3&n=50")
    assert r == search.Request("fast db", ("ai", "tools"), 7, 2, 50) and search.Request.parsed(r.fragment()) == r
    assert search.Request.parsed("#w=2d&p=x&n=7") == search.Request() and search.Request().fragment() == "#"
