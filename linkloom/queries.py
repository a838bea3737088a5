"""Queries over the test tables, and the SQL that each is held against.

events and pages stand for a message stream: each event is a sighting of one page.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import html, text, urls
from .operators import archive, enrich, harvest, newsletter, search
from .operators import sightings as sight
from .operators.ordering import numbered, shared_folder
from .plans import publication
from .plans import vocabulary as V
from .sources.files import table
from .streaming.harvest import harvested

ASOF, SITE = "2024-01-30", r"letters\.example"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def inline(spark: SparkSession, values: str, names: str) -> DataFrame:
    """Literal rows; the same text works in the SQL that the query is held against."""
    return spark.sql(f"SELECT * FROM (VALUES {values}) AS t({names})")


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---- DuckDB's side of the expressions -------------------------------------------------------------------------------

_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def d_host(u: str) -> str:
    return f"regexp_replace(split_part(lower(regexp_extract({u}, '{_PARTS}', 1)), ':', 1), '^www\\.', '')"


def d_path(u: str) -> str:
    return f"regexp_extract({u}, '{_PARTS}', 2)"


def d_repo(u: str) -> str:
    s = f"list_filter(string_split({d_path(u)}, '/'), lambda s: s <> '')"
    reserved = ", ".join(literal(r) for r in V.RESERVED)
    return f"CASE WHEN {d_host(u)} = 'github.com' AND len({s}) >= 2 AND lower({s}[1]) NOT IN ({reserved}) THEN lower({s}[1] || '/' || regexp_replace({s}[2], '[.]git$', '')) END"


def d_key(source: str, u: str = "url") -> str:
    """A query that adds key to the rows of source."""
    reserved = ", ".join(literal(r) for r in V.RESERVED)
    return f"""
    SELECT * EXCLUDE (u_, bare_, auth_, h_, p_, q_, kv_, seg_, kept_, plain_), CASE WHEN bare_ <> '' AND contains(auth_, '[') = contains(auth_, ']') THEN coalesce(
        CASE WHEN h_ = 'youtu.be' THEN 'youtube.com/watch?v=' || seg_[1] END,
        CASE WHEN h_ IN ('youtube.com', 'music.youtube.com') AND rtrim(p_, '/') = '/watch' THEN 'youtube.com/watch?v=' || list_filter(kv_, lambda k: k.k = 'v' AND k.v <> '')[-1].v END,
        CASE WHEN regexp_matches(h_, '^((vx|fx)?twitter\\.com|x\\.com|fixupx\\.com)$') THEN 'x.com/status/' || nullif(regexp_extract(p_, '/status(?:es)?/([0-9]+)', 1), '') END,
        CASE WHEN h_ = 'github.com' AND len(seg_) >= 2 AND lower(seg_[1]) NOT IN ({reserved}) THEN 'github.com/' || lower(seg_[1] || '/' || regexp_replace(seg_[2], '[.]git$', '')) END,
        h_ || lower(CASE WHEN plain_ = '' THEN '/' ELSE plain_ END) || CASE WHEN len(kept_) > 0 THEN '?' || array_to_string(kept_, '&') ELSE '' END) END AS key
    FROM (SELECT *, list_transform(list_sort(list_filter(kv_, lambda k: NOT regexp_matches(lower(k.k), '{V.JUNK_PARAMETER}'))), lambda k: replace(url_encode(k.k), '%20', '+') || '=' || replace(url_encode(k.v), '%20', '+')) AS kept_,
        list_filter(string_split(p_, '/'), lambda s: s <> '') AS seg_, regexp_replace(regexp_replace(p_, '/index\\.(html?|php)$', '/'), '/+$', '') AS plain_
    FROM (SELECT *, regexp_replace(regexp_replace(bare_, '^www\\.', ''), '^m\\.', '') AS h_, CASE WHEN regexp_extract(u_, '{_PARTS}', 2) = '' THEN '/' ELSE regexp_extract(u_, '{_PARTS}', 2) END AS p_, regexp_extract(u_, '{_PARTS}', 3) AS q_,
        list_transform(list_filter(string_split(regexp_extract(u_, '{_PARTS}', 3), '&'), lambda x: x <> ''), lambda x: {{'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': CASE WHEN contains(x, '=') THEN url_decode(replace(substr(x, instr(x, '=') + 1), '+', ' ')) ELSE '' END}}) AS kv_
    FROM (SELECT *, split_part(string_split(auth_, '@')[-1], ':', 1) AS bare_
    FROM (SELECT *, lower(regexp_extract(u_, '{_PARTS}', 1)) AS auth_ FROM (SELECT *, trim(coalesce({u}, '')) AS u_ FROM {source})))))"""


def d_tidy(x: str) -> str:
    lead = f"regexp_replace(coalesce({x}, ''), '^[\\s.,;:!?)\\]…–—-]+', '')"
    rest = f"regexp_replace(regexp_replace({lead}, '^(?i:and|but|so|also|plus|yet)\\b[\\s,]*', ''), '^\\s+|\\s+$', '', 'g')"
    capital = f"upper(substr({rest}, 1, 1)) || substr({rest}, 2)"
    return f"CASE WHEN {rest} = '' THEN '' WHEN right({rest}, 1) IN ('.', '!', '?', ')', '”', '\"') THEN {capital} ELSE {capital} || '.' END"


# ---- sightings ------------------------------------------------------------------------------------------------------


def d_commentary(x: str) -> str:
    return f"substr(trim(regexp_replace(regexp_replace(coalesce({x}, ''), 'https?://\\S+', ' ', 'g'), '\\s+', ' ', 'g'), ' -–—:•|'), 1, 300)"


SIGHTINGS = f"""
SELECT e.event_id AS msg, e.user_id AS ch, e.event_type AS chan, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS date, p.url, p.page_id, CASE WHEN e.event_id % 7 = 0 THEN 'newsletter' ELSE 'chat' END AS src,
CASE WHEN e.event_id % 11 = 0 THEN 'Link ' || e.event_id WHEN e.event_id % 13 = 0 THEN 'https://shown.example/' || e.event_id END AS text, CASE WHEN e.event_id % 3 = 0 THEN coalesce(d.said, '') ELSE '' END AS said
FROM (SELECT ev.*, ev.event_id % n.n AS page_ref, ev.event_id % n.d AS doc_ref FROM events ev CROSS JOIN (SELECT (SELECT count(*) FROM pages) AS n, (SELECT count(*) FROM documents) AS d) n) e
JOIN pages p ON p.page_id = e.page_ref LEFT JOIN (SELECT doc_id, {d_commentary('text')} AS said FROM documents) d ON d.doc_id = e.doc_ref"""


def sightings(spark: SparkSession, d: str) -> DataFrame:
    """(msg, ch, chan, date, url, page_id, src, text, said, seq, id) of the stand-in stream: every event is a sighting of a page, some with a link text or a remark."""
    pages = table(spark, d, "pages").select("page_id", "url")
    docs = table(spark, d, "documents").select("doc_id", text.commentary(F.col("text")).alias("_said"))
    n = pages.agg(F.count(F.lit(1)).alias("n")).crossJoin(table(spark, d, "documents").agg(F.count(F.lit(1)).alias("m")))  # one row
    events = table(spark, d, "events").crossJoin(F.broadcast(n)).withColumn("page_ref", F.col("event_id") % F.col("n")).withColumn("doc_ref", F.col("event_id") % F.col("m"))
    rows = events.join(pages, F.col("page_ref") == F.col("page_id")).join(docs, F.col("doc_ref") == F.col("doc_id"), "left")
    number = F.col("event_id")
    shown = F.when(number % 11 == 0, F.concat(F.lit("Link "), number.cast("string"))).when(number % 13 == 0, F.concat(F.lit("https://shown.example/"), number.cast("string")))
    said = F.when(number % 3 == 0, F.coalesce("_said", F.lit(""))).otherwise("")
    return rows.select(number.alias("msg"), F.col("user_id").alias("ch"), F.col("event_type").alias("chan"), F.col("ts").cast("date").cast("string").alias("date"), "url", "page_id", F.when(number % 7 == 0, "newsletter").otherwise("chat").alias("src"), shown.alias("text"), said.alias("said"), number.alias("seq"), number.alias("id"))


def cache_of(spark: SparkSession, d: str) -> DataFrame:
    """A link cache out of the pages: one row for each key, that of its first page."""
    pages = table(spark, d, "pages").select("page_id", "url", "html").withColumn("key", urls.canonical_key(F.col("url"))).withColumn("m", html.scraped(F.col("html")))
    w = Window.partitionBy("key").orderBy("page_id")
    rows = pages.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    bad = F.col("page_id") % 5 == 0
    return rows.select(
        "key", "url", (~bad).alias("ok"), F.when(~bad, F.col("m.title")).alias("title"), F.col("m.description").alias("description"), F.when(F.col("page_id") % 15 == 0, "agent").alias("via"),
        F.expr("timestamp'2024-01-30' - make_interval(0, 0, 0, cast(page_id % 60 as int))").alias("fetched_at"),
    )


def d_decoded(x: str) -> str:
    return f"""replace(replace(replace(replace({x}, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"""


_RAW_TITLE = r"regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
_TITLE = rf"""substr(trim(regexp_replace({d_decoded(_RAW_TITLE)}, '\s+', ' ', 'g')), 1, 160)"""
CACHE = f"""SELECT key, url, page_id % 5 <> 0 AS ok, CASE WHEN page_id % 5 <> 0 THEN {_TITLE} END AS title, CAST(NULL AS VARCHAR) AS description, CASE WHEN page_id % 15 = 0 THEN 'agent' END AS via,
TIMESTAMP '2024-01-30' - to_days(CAST(page_id % 60 AS INTEGER)) AS fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS n FROM ({d_key('pages')})) WHERE n = 1"""


def archive_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = sightings(spark, d)
    return sight.enriched(rows, cache_of(spark, d), sight.channel_slugs(rows.select(F.col("chan").alias("name")).distinct()))


# what enriched() makes of a sighting, as SQL
def d_tags(kind: str, title: str, description: str, host: str, url: str, repo: str) -> str:
    # letters of any language bound a word, which DuckDB's \\b doesn't know: they are made Latin ones
    hay = f"regexp_replace(lower({title} || ' ' || {description} || ' ' || coalesce({host}, '') || ' ' || coalesce({url}, '')), '[^\\x00-\\x7F\\P{{L}}]', 'z', 'g')"
    found = lambda pattern: f"regexp_matches({hay}, {literal(pattern)})"
    named = [f"CASE WHEN {found(p)} THEN '{slug}' END" for p, slug, _, _ in V.TOPICS]
    source = next(p for p, slug, _, _ in V.TOPICS if slug == "opensource")
    more = [f"CASE WHEN {repo} IS NOT NULL AND NOT {found(source)} THEN 'opensource' END", f"CASE WHEN ends_with(coalesce({host}, ''), 'wikipedia.org') THEN 'wikipedia' END", f"CASE WHEN regexp_matches(coalesce({host}, ''), {literal(V.VIDEO_HOST)}) OR {found(V.VIDEO_WORD)} THEN 'video' END"]
    return f"list_filter([{', '.join([kind, *named, *more])}], lambda t: t IS NOT NULL)"


_KIND = f"CASE WHEN regexp_matches(lower(chan), '{V.CHANNEL_KINDS[0][0]}') THEN 'read' WHEN regexp_matches(lower(chan), '{V.CHANNEL_KINDS[1][0]}') THEN 'til' WHEN regexp_matches(lower(chan), '{V.CHANNEL_KINDS[2][0]}') THEN 'tool' WHEN regexp_matches(host, '{V.READ_HOST}') THEN 'read' ELSE 'tool' END"
_NAME = f"""CASE WHEN seg IS NOT NULL AND length(said) > 2 AND NOT regexp_matches(said, '^[^A-Za-z_]+$') THEN upper(substr(said, 1, 1)) || substr(said, 2) ELSE host END"""
_NAMED = lambda x: f"CASE WHEN coalesce({x}, '') <> '' AND NOT regexp_matches({x}, '^https?://') THEN {x} END"
_WITH_TEXT = f"""SELECT s.* EXCLUDE (text, said), {d_host('s.url')} AS host, {d_repo('s.url')} AS repo, substr(coalesce({_NAMED('trim(s.text)')}, {_NAMED('trim(c.title)')}, n.name), 1, 200) AS title,
substr(CASE WHEN length(s.remark) >= 20 THEN s.remark ELSE '' END, 1, 500) AS description
FROM (SELECT *, {d_tidy('said')} AS remark FROM ({d_key(f'({SIGHTINGS})')})) s LEFT JOIN ({CACHE}) c ON s.key = c.key JOIN (SELECT page_id, {_NAME} AS name FROM (SELECT page_id, {d_host('url')} AS host, seg, trim(regexp_replace(regexp_replace(seg, '\\.(html?|php|aspx?|md|pdf)$', ''), '[-_+]+', ' ', 'g')) AS said
FROM (SELECT page_id, url, list_filter(string_split(split_part(regexp_replace(url, '^https?://[^/]+', ''), '?', 1), '/'), lambda x: x <> '')[-1] AS seg FROM pages))) n ON n.page_id = s.page_id"""
ENRICHED = f"""SELECT *, list_concat({d_tags('kind', 'title', 'description', 'host', 'url', 'repo')}, CASE WHEN src = 'newsletter' THEN [] ELSE ['discord', chan] END) AS tags FROM (SELECT *, {_KIND} AS kind FROM ({_WITH_TEXT}))"""
RANKED = f"""SELECT *, row_number() OVER (PARTITION BY key ORDER BY (src = 'newsletter') DESC, length(description) DESC, (title <> '' AND NOT starts_with(title, 'http')) DESC, date, msg) AS place, row_number() OVER (PARTITION BY key ORDER BY date, msg) AS turn FROM ({ENRICHED})"""
FOLDED = f"""SELECT b.key, b.url, b.src, b.msg AS id, b.title, b.date, b.host, b.chan, g.n, g.first, g.last, g.key_seq FROM (SELECT * FROM ({RANKED}) WHERE place = 1) b JOIN (SELECT key, count(*) AS n, min(date) AS first, max(date) AS last, min(msg) AS key_seq FROM ({ENRICHED}) GROUP BY key) g ON b.key = g.key"""


def d_union(ranked: str) -> str:
    """(key, tag, m): the distinct tags of a key, m giving their order; ranked has place (1 survives), turn (the order of the others) and tags."""
    each = f"SELECT key, unnest(tags) AS tag, (CASE WHEN place = 1 THEN 0 ELSE turn END) * 1000 + generate_subscripts(tags, 1) AS m FROM ({ranked})"
    return f"SELECT key, tag, min(m) AS m FROM ({each}) GROUP BY key, tag"


def d_facets(tags: str, channels: list[str]) -> str:
    """Facets of a table with a row for each entry and tag."""
    names = {slug: (label, facet) for _, slug, label, facet in V.TOPICS} | {k: (v[0], "kind") for k, v in V.KINDS.items()} | {k: (v, "source") for k, v in V.SOURCE_TAGS.items()}
    names = {c: (f"#{c}", "channel") for c in channels} | names
    pick = lambda i: f"CASE tag {' '.join(f'WHEN {literal(k)} THEN {literal(v[i])}' for k, v in names.items())} END"
    return f"SELECT tag AS slug, {pick(0)} AS label, {pick(1)} AS facet, count(*) AS n FROM ({tags}) GROUP BY tag"


# ---- URLs -----------------------------------------------------------------------------------------------------------

EDGE_URLS = [
    "https://youtu.be/AbC?si=x", "https://www.youtube.com/watch?v=AbC&t=5", "https://x.com/u/status/123", "https://fxtwitter.com/u/status/123", "https://github.com/Own/Repo.git/issues/4",
    "https://github.com/topics/spark", "https://www.m.Example.com/A/?b=2&a=1&utm_source=x#f", "http://Ex.com", "https://ex.com/docs/index.html", "https://ex.com/a?x", "https://u:p@ex.com:8080/a",
    "https://news.ycombinator.com/item?id=1", "https://news.ycombinator.com/item?id=2", "#footnote-1", "", "mailto:x@y", "https://[bad/", "https://arxiv.org/abs/2101.00001v2", "https://en.wikipedia.org/wiki/Cunningham%27s_Law",
    "https://tenor.com/x", "https://media3.giphy.com/y", "https://jobs.lever.co/z", "https://ex.com/careers/1", "https://ex.com/tech/careers/1", "https://imdb.com/title/tt5537002", "https://ex.com/a+b_c-d.html?q=1", "https://ex.com/12",
    "https://vimeo.com/1", "https://play.google.com/store?id=Com.X&hl=de+DE",
]
URL_VALUES = ", ".join(f"({i}, {literal(u)})" for i, u in enumerate(EDGE_URLS))
URLS = f"(SELECT i, url FROM (VALUES {URL_VALUES}) t(i, url) UNION ALL SELECT 1000 + page_id, url FROM pages)"


def edge_urls(spark: SparkSession, d: str) -> DataFrame:
    return inline(spark, URL_VALUES, "i, url").select(F.col("i").cast("long").alias("i"), "url").unionByName(table(spark, d, "pages").select((F.col("page_id") + 1000).alias("i"), "url"))


@query(f"SELECT CAST(i AS BIGINT) AS i, key FROM ({d_key(URLS)})")
def canonical_key(spark, d):
    return edge_urls(spark, d).select("i", urls.canonical_key(F.col("url")).alias("key"))


@query(f"SELECT CAST(i AS BIGINT) AS i, {d_host('url')} AS host, {d_repo('url')} AS repo FROM {URLS}")
def entity_host_repo(spark, d):
    return edge_urls(spark, d).select("i", urls.host(F.col("url")).alias("host"), urls.repo(F.col("url")).alias("repo"))


@query(f"SELECT CAST(i AS BIGINT) AS i FROM {URLS} WHERE NOT regexp_matches({d_host('url')}, '{V.FURNITURE_HOST}')")
def furniture_filter(spark, d):
    return edge_urls(spark, d).where(~urls.is_furniture(F.col("url"))).select("i")


@query(f"SELECT CAST(i AS BIGINT) AS i FROM {URLS} WHERE NOT regexp_matches({d_host('url')}, '{V.JOB_HOST}') AND NOT regexp_matches(lower({d_path('url')}), '{V.JOB_PATH}')")
def job_filter(spark, d):
    return edge_urls(spark, d).where(~urls.is_job(F.col("url"))).select("i")


@query(f"SELECT page_id, {_NAME} AS name FROM (SELECT page_id, {d_host('url')} AS host, seg, trim(regexp_replace(regexp_replace(seg, '\\.(html?|php|aspx?|md|pdf)$', ''), '[-_+]+', ' ', 'g')) AS said FROM (SELECT page_id, url, list_filter(string_split(split_part(regexp_replace(url, '^https?://[^/]+', ''), '?', 1), '/'), lambda x: x <> '')[-1] AS seg FROM pages))")
def name_from_url(spark, d):
    return table(spark, d, "pages").select("page_id", urls.name_from_url(F.col("url")).alias("name"))


@query(f"""SELECT CAST(i AS BIGINT) AS i, CASE WHEN {d_repo('url')} IS NOT NULL THEN 'repo' WHEN regexp_matches({d_host('url')}, '(^|\\.)(youtube\\.com|youtu\\.be)$') THEN 'video' WHEN {d_host('url')} LIKE '%wikipedia.org' AND contains(url, '/wiki/') THEN 'wiki'
WHEN {d_host('url')} = 'news.ycombinator.com' AND regexp_matches(url, '[?&]id=[0-9]+') THEN 'forum' WHEN regexp_matches({d_host('url')}, '(^|\\.)arxiv\\.org$') THEN 'paper' WHEN regexp_matches({d_host('url')}, '(^|\\.)((vx|fx)?twitter\\.com|x\\.com|fixupx\\.com)$') THEN 'post' ELSE 'scrape' END AS handler FROM {URLS}""")
def handler_route(spark, d):
    return edge_urls(spark, d).select("i", urls.handler(F.col("url"))["handler"].alias("handler"))


# ---- text -----------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {d_tidy('text')} AS tidy FROM documents")
def tidy_desc(spark, d):
    return table(spark, d, "documents").select("doc_id", text.tidy(F.col("text")).alias("tidy"))


@query(f"SELECT doc_id, {d_commentary('text')} AS said FROM documents")
def commentary(spark, d):
    return table(spark, d, "documents").select("doc_id", text.commentary(F.col("text")).alias("said"))


MESSAGES = [
    "see https://ex.com/a, and https://ex.com/a again", "[Name](https://ex.com/b) then [Other](https://ex.com/b)", "<https://ex.com/c> https://tenor.com/x", "none here", "(https://ex.com/d?x=1). https://ex.com/e!",
]
MESSAGE_VALUES = ", ".join(f"({i}, {literal(m)})" for i, m in enumerate(MESSAGES))


@query("""SELECT * FROM (VALUES (0, 0, 'https://ex.com/a', NULL), (1, 0, 'https://ex.com/b', 'Other'), (2, 0, 'https://ex.com/c', NULL), (4, 0, 'https://ex.com/d?x=1', NULL), (4, 1, 'https://ex.com/e', NULL)) t(i, pos, url, label)""")
def extract_urls(spark, d):
    rows = inline(spark, MESSAGE_VALUES, "i, said").select("i", F.posexplode(text.links(F.col("said"))).alias("pos", "l"))
    return rows.select("i", "pos", "l.url", F.col("l.text").alias("label"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(lower(replace(replace(replace(replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')), '[''’()]', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS name FROM pages""")
def heading_norm(spark, d):
    return table(spark, d, "pages").select("page_id", text.heading(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)).alias("name"))


@query(r"""SELECT page_id, trim(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<footer>([^<]*)', 1), '<[^>]+>', '', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')) AS clean FROM pages""")
def clean_text(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean(F.regexp_extract("html", r"(?s)<footer>([^<]*)", 1)).alias("clean"))


@query("SELECT doc_id, CASE WHEN length(text) <= 110 THEN text ELSE rtrim(regexp_replace(substr(text, 1, 110), '\\s\\S*$', '')) || '…' END AS short FROM documents")
def word_safe_cut(spark, d):
    return table(spark, d, "documents").select("doc_id", text.cut_words(F.col("text")).alias("short"))


@query("SELECT doc_id, substr(source || '. ' || coalesce(text, ''), 1, 400) AS t FROM documents")
def corpus_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", text.corpus_text(F.col("source"), F.col("text")).alias("t"))


@query("SELECT sha256(unhex(string_agg(lpad(printf('%X', strlen(t)), 16, '0') || hex(encode(t)), '' ORDER BY doc_id))) AS digest, count(*) AS n FROM (SELECT doc_id, substr(source || '. ' || coalesce(text, ''), 1, 400) AS t FROM documents)")
def corpus_fingerprint(spark, d):
    return archive.fingerprint(corpus_texts(spark, d), "t", "doc_id")


@query()
def content_hash(spark, d):
    from .functions.udfs import content_hash as digest

    return table(spark, d, "pages").select("page_id", digest("html").alias("hash"))


# ---- the archive ----------------------------------------------------------------------------------------------------


@query(f"SELECT kind, count(*) AS n FROM (SELECT {_KIND} AS kind FROM (SELECT chan, {d_host('url')} AS host FROM ({SIGHTINGS}))) GROUP BY kind")
def kind_for_channel_host(spark, d):
    return sightings(spark, d).groupBy(html.kind_for(F.col("chan"), urls.host(F.col("url"))).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM (VALUES ('click', 'click'), ('error', 'error'), ('purchase', 'purchase'), ('signup', 'signup'), ('view', 'view'), ('AI', 'ch-ai'), ('Cool Tools!', 'cool-tools'), ('video', 'ch-video')) t(name, slug)")
def channel_slugs(spark, d):
    names = table(spark, d, "events").select(F.col("event_type").alias("name")).distinct().unionByName(inline(spark, "('AI'), ('Cool Tools!'), ('  '), ('!!'), ('video')", "name"))
    return sight.channel_slugs(names)


@query(f"SELECT msg FROM ({SIGHTINGS}) WHERE chan NOT IN ('error', 'memes')")
def hidden_channels_semi(spark, d):
    names = sightings(spark, d).select(F.col("chan").alias("ch"), F.concat(F.lit("#"), "chan").alias("name"), F.lit(None).cast("string").alias("parent")).distinct()
    shown = sight.shown_channels(names, (*V.HIDDEN_CHANNELS, "error"))
    return sightings(spark, d).join(shown.select(F.col("ch").alias("chan")), "chan", "left_semi").select("msg")


@query("SELECT * FROM (VALUES (1, 0, 'ex.com/a'), (1, 2, 'ex.com/b'), (2, 0, 'ex.com/a')) t(msg, pos, key)")
def within_message_distinct(spark, d):
    rows = inline(spark, "(1, 0, 'https://ex.com/a'), (1, 1, 'http://www.ex.com/a/'), (1, 2, 'https://ex.com/b'), (1, 3, 'https://tenor.com/q'), (2, 0, 'https://m.ex.com/a?ref=1'), (2, 1, '#x'), (2, 2, 'https://ex.com/jobs/1')", "msg, pos, url")
    return sight.one_per_message(rows).select("msg", "pos", "key")


@query(f"SELECT msg, title FROM ({ENRICHED})")
def title_fallback(spark, d):
    return archive_rows(spark, d).select("msg", "title")


@query("SELECT * FROM (VALUES (1, 'A remark that is certainly longer than forty signs.'), (2, 'Blurb.'), (3, 'A remark over twenty signs.'), (4, '')) t(i, description)")
def description_priority(spark, d):
    rows = inline(spark, "(1, 'and a remark that is certainly longer than forty signs', 'Blurb.'), (2, 'short', 'Blurb.'), (3, 'a remark over twenty signs', ''), (4, 'short', '')", "i, remark, cached")
    return rows.select("i", sight.description_of(F.col("remark"), F.col("cached")).alias("description"))


@query(f"SELECT key, url, src, id, title, date FROM ({FOLDED})")
def dedupe_survivor(spark, d):
    columns = ["url", "src", "id", "title", "date"]
    return archive.folded(archive_rows(spark, d), columns).select("key", *columns)


@query(f"SELECT key, string_agg(src || ':' || date || ':' || chan, ',' ORDER BY date, msg) AS also FROM ({RANKED}) WHERE place > 1 GROUP BY key")
def dedupe_also(spark, d):
    rows = archive_rows(spark, d)
    merged = archive.folded(rows, ["seq"])
    nested = archive.with_also(merged, archive.occurrences(rows, merged)).where("also is not null")
    return nested.select("key", F.array_join(F.transform("also", lambda o: F.concat_ws(":", o["src"], o["date"], o["chan"])), ",").alias("also"))


@query(f"SELECT key, n, first, last FROM ({FOLDED})")
def first_last_seen(spark, d):
    return archive.folded(archive_rows(spark, d), []).select("key", "n", "first", "last")


@query(f"SELECT key, string_agg(tag, ',' ORDER BY m) AS tags FROM ({d_union(RANKED)}) GROUP BY key")
def tag_union(spark, d):
    return archive.folded(archive_rows(spark, d), ["tags"]).select("key", F.array_join("tags", ",").alias("tags"))


@query(f"SELECT src, count(*) AS n, sum(n) - count(*) AS collapsed FROM ({FOLDED}) GROUP BY src")
def source_summary(spark, d):
    return archive.folded(archive_rows(spark, d), ["src"]).groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n") - 1).alias("collapsed"))


@query(f"SELECT count(DISTINCT key) AS entities FROM ({d_key(f'({SIGHTINGS})')})")
def entity_count(spark, d):
    return sightings(spark, d).select("url").distinct().agg(F.count_distinct(urls.canonical_key(F.col("url"))).alias("entities"))


@query(f"SELECT string_agg(chan, ',' ORDER BY chan) AS channels FROM (SELECT DISTINCT chan FROM ({SIGHTINGS}))")
def channel_list(spark, d):
    return sightings(spark, d).agg(F.array_join(F.sort_array(F.collect_set("chan")), ",").alias("channels"))


@query(f"SELECT count(*) AS both_sources, CAST(count(*) FILTER (first < date) AS BIGINT) AS chat_first FROM (SELECT f.key, f.first, f.date FROM ({FOLDED}) f JOIN (SELECT key FROM ({ENRICHED}) GROUP BY key HAVING count(DISTINCT src) = 2) b ON f.key = b.key)")
def cross_source_overlap(spark, d):
    rows = archive_rows(spark, d)
    merged = archive.folded(rows, ["date"])
    sources = rows.where("key is not null").groupBy("key").agg(F.count_distinct("src").alias("sources")).where("sources = 2").select(F.col("key").alias("_key"))
    return merged.join(sources, F.col("key") == F.col("_key"), "left_semi").agg(F.count(F.lit(1)).alias("both_sources"), F.count_if(F.col("first") < F.col("date")).alias("chat_first"))


@query(f"SELECT key, row_number() OVER (ORDER BY CASE WHEN src = 'newsletter' THEN 0 ELSE 1 END, id, key_seq) AS entry_id FROM ({FOLDED})")
def stable_ids(spark, d):
    return archive.with_ids(archive.folded(archive_rows(spark, d), ["src", "id", "msg"])).select("key", "entry_id")


CHANNELS = ["click", "error", "purchase", "signup", "view"]


@query(d_facets(d_union(RANKED), CHANNELS))
def facet_counts(spark, d):
    rows = archive_rows(spark, d)
    return archive.facet_counts(archive.folded(rows, ["tags"]), publication.tag_names(spark), sight.channel_slugs(rows.select(F.col("chan").alias("name")).distinct()))


@query(f"SELECT key, last FROM ({FOLDED}) WHERE CAST(last AS DATE) >= DATE '{ASOF}' - 7")
def time_range(spark, d):
    return archive.within(archive.folded(archive_rows(spark, d), []), ASOF, 7).select("key", "last")


@query(f"SELECT count(*) AS n, min(first) AS first_seen, (SELECT key FROM ({FOLDED}) ORDER BY first, key LIMIT 1) AS first_key, max(last) AS last_seen, (SELECT key FROM ({FOLDED}) ORDER BY last DESC, key DESC LIMIT 1) AS last_key FROM ({FOLDED})")
def trace_first_last(spark, d):
    return archive.trace(archive.folded(archive_rows(spark, d), []))


@query(f"SELECT key FROM ({d_union(RANKED)}) WHERE tag IN ('read', 'purchase') GROUP BY key HAVING count(*) = 2")
def facet_filter(spark, d):
    return archive.with_tag(archive.folded(archive_rows(spark, d), ["tags"]), "read", "purchase").select("key")


# ---- enrichment -----------------------------------------------------------------------------------------------------


@query(f"SELECT page_id, {_TITLE} AS title, CAST(NULL AS VARCHAR) AS description FROM pages")
def scrape_meta(spark, d):
    return table(spark, d, "pages").select("page_id", html.scraped(F.col("html")).alias("m")).select("page_id", "m.title", "m.description")


WANT = f"SELECT key, arg_min(url, msg) AS url, min(msg) AS seq FROM ({d_key(f'({SIGHTINGS})')}) GROUP BY key"


@query(f"SELECT w.key, w.url, w.seq FROM ({WANT}) w JOIN ({CACHE}) c ON w.key = c.key WHERE NOT c.ok AND NOT (coalesce(c.via, '') = 'agent' AND coalesce(c.title, '') <> '') AND c.fetched_at < TIMESTAMP '{ASOF}' - INTERVAL 30 DAY")
def enrich_worklist(spark, d):
    return enrich.worklist(enrich.wanted(sightings(spark, d)), cache_of(spark, d), ASOF)


@query(f"SELECT c.key FROM ({CACHE}) c WHERE c.key IN (SELECT key FROM ({d_key(f'({SIGHTINGS})')}) WHERE chan = 'view')")
def cache_prune_anti(spark, d):
    return enrich.pruned(cache_of(spark, d), enrich.wanted(sightings(spark, d).where("chan = 'view'"))).select("key")


@query(f"SELECT key, ok OR title IS NULL AS ok, coalesce(title, 'Found ' || key) AS title, CASE WHEN title IS NULL THEN 'Read it.' END AS description, CASE WHEN title IS NULL THEN 'agent' ELSE via END AS via FROM (SELECT key, ok, nullif(title, '') AS title, via FROM ({CACHE}))")
def merge_researched(spark, d):
    found = cache_of(spark, d).select("key", F.concat(F.lit(" Found "), "key").alias("title"), F.lit("and  read it").alias("description")).unionByName(inline(spark, "('nowhere', 'Never', 'x')", "key, title, description"))
    return enrich.merged(cache_of(spark, d), found, ASOF).select("key", "ok", "title", "description", "via")


@query(f"SELECT key, url FROM ({CACHE}) WHERE coalesce(title, '') = ''")
def cache_gaps(spark, d):
    return enrich.gaps(cache_of(spark, d)).select("key", "url")


@query(f"SELECT count(*) AS n, CAST(count(*) FILTER (coalesce(title, '') <> '') AS BIGINT) AS titled, CAST(count(*) FILTER (coalesce(description, '') <> '') AS BIGINT) AS blurbed FROM ({CACHE})")
def cache_stats(spark, d):
    return enrich.stats(cache_of(spark, d))


@query(f"SELECT key, CAST((row_number() OVER (ORDER BY key) - 1) // 25 AS BIGINT) AS batch, CAST((row_number() OVER (ORDER BY key) - 1) % 25 AS BIGINT) AS slot FROM ({CACHE}) WHERE coalesce(title, '') = ''")
def agent_batches(spark, d):
    return enrich.batches(enrich.gaps(cache_of(spark, d)), "key").select("key", "batch", "slot")


# ---- harvest --------------------------------------------------------------------------------------------------------


@query("SELECT user_id AS ch, max(event_id) AS cursor FROM events GROUP BY user_id")
def harvest_cursor(spark, d):
    return harvest.cursors(table(spark, d, "events").select(F.col("user_id").alias("ch"), F.col("event_id").cast("string").alias("id")))


@query("SELECT event_id AS id FROM events WHERE event_id % 3 <> 0")
def harvest_anti_known(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"))
    return harvest.fresh(e, e.where("id % 3 = 0"))


@query("SELECT CASE WHEN event_type IN ('click', 'view') THEN 'use' ELSE event_type END AS name, count(*) AS n FROM events GROUP BY 1")
def held_per_channel(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("ch"))
    c = e.distinct().select("ch", F.col("ch").alias("name"), F.when(F.col("ch").isin("click", "view"), "use").alias("parent"))
    return harvest.held(e, c)


@query("SELECT * FROM (VALUES ('1', 'general', NULL), ('5', 'news', NULL), ('20', 'thread', 'general'), ('21', 'post', 'forum')) t(id, name, parent)")
def visible_channels(spark, d):
    c = spark.createDataFrame(
        [("1", "general", 0, "9", []), ("2", "secret", 0, None, [("g", "1024")]), ("3", "hidden", 0, "8", []), ("4", "forum", 15, None, [("role", "1024")]), ("5", "news", 5, None, [("g", "2048")]), ("8", "private", 4, None, [("g", "3072")]), ("9", "open", 4, None, None)],
        "id string, name string, type int, parent_id string, permission_overwrites array<struct<id:string,deny:string>>",
    )
    t = spark.createDataFrame([("20", "thread", 11, "1"), ("21", "post", 11, "4"), ("22", "lost", 11, "2"), ("23", "own", 12, "1")], "id string, name string, type int, parent_id string")
    return harvest.visible(c, t, "g")


@query("SELECT * FROM (VALUES ('b'), ('d'), ('e')) t(id)")
def archived_after_cursor(spark, d):
    t = inline(spark, "('a', '2024-01-01'), ('b', '2024-01-03'), ('c', '2024-01-02'), ('d', '2024-01-02'), ('e', CAST(NULL AS STRING))", "id, stamp")
    return harvest.archived_after(t, inline(spark, "('c')", "id"), "2024-01-02").select("id")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_harvest(spark, d):
    state = f"{shared_folder(spark)}/harvest-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return harvested(spark, d, "events.parquet", schema, state).select("event_id", "user_id", "event_type")


# ---- newsletter -----------------------------------------------------------------------------------------------------

EDITIONS = [
    (1, """<p>lead</p><h2>What's happening</h2><ul><li><a href="https://ex.com/n">News</a></li></ul><h2>Builders' Nest</h2><ul><li>🔥 <strong><a href="https://github.com/a/b">Tool</a></strong> and a fast tool</li><li>Before it <a href="https://ex.com/t">T</a></li></ul><h3>Deep dive</h3><ul><li><a href="#footnote-1">1</a></li><li><a href="https://ex.com/q?a=1&amp;b=2">Q</a>, done!</li></ul>"""),
    (2, """<h1>Odd ones</h1><ul><li><a href="https://ex.com/o">Odd</a></li></ul><h2>Meme of the week</h2><ul><li><a href="https://ex.com/m">M</a></li></ul><h3>Sub</h3><ul><li><a href="https://ex.com/s">S</a></li></ul><h2>Wisdom bits</h2><blockquote>“Be brief.”<br>— Someone</blockquote><blockquote>Stay curious ~ Another</blockquote> letters.example/p/1 letters.example/2 letters.example/p/101 letters.example/7"""),
]


def editions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDITIONS, "ed int, body string")


@query("SELECT * FROM (VALUES (1, 0, 2, 'whats happening', 'news'), (1, 1, 2, 'builders nest', 'tool'), (1, 2, 3, 'deep dive', 'tool'), (2, 0, 1, 'odd ones', 'awe'), (2, 1, 2, 'meme of the week', NULL), (2, 2, 3, 'sub', NULL), (2, 3, 2, 'wisdom bits', 'quote')) t(ed, pos, level, name, kind)")
def kind_forward_fill(spark, d):
    return newsletter.with_kind(newsletter.sections(editions(spark))).select("ed", "pos", "level", "name", "kind")


@query("SELECT * FROM (VALUES (1, 'tool', 'Tool', 'A fast tool.', NULL, 'https://github.com/a/b'), (1, 'tool', 'T', 'Before it.', NULL, 'https://ex.com/t'), (1, 'tool', 'Q', 'Done!', NULL, 'https://ex.com/q?a=1&b=2'), (2, 'awe', 'Odd', '', NULL, 'https://ex.com/o'), (2, 'quote', 'Be brief.', '', 'Someone', NULL), (2, 'quote', 'Stay curious', '', 'Another', NULL)) t(ed, kind, title, description, attribution, url)")
def newsletter_entries(spark, d):
    return newsletter.entries(newsletter.with_kind(newsletter.sections(editions(spark))), SITE).select("ed", "kind", "title", "description", "attribution", "url")


@query("SELECT * FROM (VALUES (1, ''), (2, '1,7')) t(ed, refs)")
def edition_crossrefs(spark, d):
    return newsletter.cross_references(editions(spark), SITE).select("ed", F.array_join(F.transform("refs", lambda n: n.cast("string")), ",").alias("refs"))


@query("SELECT page_id, CAST(1 AS INTEGER) AS level, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS heading FROM pages")
def section_split(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.explode(html.sections(F.col("html"))).alias("s"))
    return rows.select("page_id", "s.level", "s.heading")


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)) AS INTEGER) AS units, regexp_extract(html, '(?s)<a\b[^>]*href="([^"]+)"[^>]*>(.*?)</a>', 1) AS url, regexp_extract(html, '(?s)<a\b[^>]*href="([^"]+)"[^>]*>(.*?)</a>', 2) AS title FROM pages""")
def list_units_first_anchor(spark, d):
    rows = table(spark, d, "pages").select("page_id", html.units(F.col("html")).alias("u")).withColumn("l", html.first_link(F.get("u", F.lit(0))))
    return rows.select("page_id", F.size("u").alias("units"), "l.url", "l.title")


@query("SELECT * FROM (VALUES (1, 'Be brief.', 'Someone'), (2, 'Stay curious', 'Another'), (3, 'No one said it', NULL), (4, 'Two lines here', 'X')) t(i, quote, attribution)")
def parse_quote(spark, d):
    rows = inline(spark, "(1, '“Be brief.”<br>— Someone'), (2, 'Stay curious ~ Another'), (3, 'No one said it'), (4, 'Two lines<br/>here -- X')", "i, unit")
    return rows.select("i", html.quotation(F.col("unit")).alias("q")).select("i", "q.quote", "q.attribution")


@query("SELECT * FROM (VALUES ('edition-7', 7), ('012', 12), ('edition-0', NULL), ('101', NULL), ('about', NULL)) t(slug, ed)")
def edition_numbers(spark, d):
    rows = inline(spark, "('edition-7'), ('012'), ('edition-0'), ('101'), ('about')", "slug")
    return rows.select("slug", newsletter.edition_number(F.col("slug")).alias("ed"))


@query("SELECT * FROM (VALUES ('1::https://ex.com/a', 'Clean'), ('1::q:Words', NULL)) t(rewrite_key, clean)")
def rewrite_descriptions(spark, d):
    rows = inline(spark, "(1, 'https://ex.com/a', 'A'), (1, CAST(NULL AS STRING), 'Words')", "ed, url, title")
    return newsletter.rewritten(rows, inline(spark, "('1::https://ex.com/a', 'Clean'), ('1::q:Words', '')", "rewrite_key, clean")).select("rewrite_key", "clean")


# ---- the publication ------------------------------------------------------------------------------------------------

#: Sections of the stand-in newsletter, whose items are every fourth page: (heading as written, as cleaned, kind).
SECTIONS = [("Builders' Nest", "Builders' Nest", "tool"), ("Cool stuff", "Cool stuff", "awe"), ("TILs", "TILs", "til"), ("What's happening", "What's happening", "news"), ("Off-topic reads &amp; watches", "Off-topic reads & watches", "read")]
HIDDEN = (*V.HIDDEN_CHANNELS, "error")


def newsletter_editions(spark: SparkSession, d: str) -> DataFrame:
    """(ed, slug, title, published, body): editions whose sections list pages, and a quote each."""
    page = F.col("page_id")
    raw = F.regexp_extract("html", V.TITLE, 1)
    n = page.cast("string")
    after = F.concat(F.lit('<li>🔥 <strong><a href="'), "url", F.lit('">'), raw, F.lit("</a></strong>, and number "), n, F.lit(" of the pages we liked</li>"))
    before = F.concat(F.lit("<li>Number "), n, F.lit(': <a href="'), "url", F.lit('">'), raw, F.lit("</a></li>"))
    items = table(spark, d, "pages").where(page % 4 == 0).select((F.floor(page / 20) % 100 + 1).cast("int").alias("ed"), (F.floor(page / 4) % 5).cast("int").alias("part"), page, F.when(page % 8 == 0, after).otherwise(before).alias("li"))
    parts = items.groupBy("ed", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "li"))), lambda x: x["li"]), "").alias("ul"))
    heading = F.get(F.array(*[F.lit(h) for h, _, _ in SECTIONS]), F.col("part"))
    parts = parts.select("ed", "part", F.concat(F.lit("<h2>"), heading, F.lit("</h2><ul>"), "ul", F.lit("</ul>")).alias("section"))
    ed = F.col("ed").cast("string")
    quote = F.concat(F.lit("<h2>Wisdom bits</h2><blockquote>“Saying "), ed, F.lit("”<br>— Author "), ed, F.lit("</blockquote><p>see letters.example/p/1 and letters.example/"), ed, F.lit("</p>"))
    body = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "section"))), lambda x: x["section"]), ""), F.first(quote))
    return parts.groupBy("ed").agg(body.alias("body")).select("ed", F.concat(F.lit("edition-"), ed).alias("slug"), F.concat(F.lit("Edition "), ed).alias("title"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("ed")).cast("string").alias("published"), "body")


def newsletter_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(sections with kinds, entries as the archive takes them) of the stand-in newsletter."""
    editions = newsletter_editions(spark, d)
    found = newsletter.with_kind(newsletter.sections(editions), excluded=V.excluded_sections("letters"))
    return found, newsletter.curated(newsletter.entries(found, SITE), editions.select("ed", F.col("published").alias("date")))


_PART = lambda i: f"CASE part {' '.join(f'WHEN {n} THEN {literal(s[i])}' for n, s in enumerate(SECTIONS))} END"
_ITEMS = f"SELECT CAST((page_id // 20) % 100 + 1 AS INTEGER) AS ed, (page_id // 4) % 5 AS part, page_id, url, trim({d_decoded(_RAW_TITLE)}) AS title, 'Number ' || page_id || CASE WHEN page_id % 8 = 0 THEN ' of the pages we liked.' ELSE '.' END AS description, CASE WHEN page_id % 8 = 0 THEN '🔥' END AS marker FROM pages WHERE page_id % 4 = 0"
_LISTED = f"""SELECT ed, part, page_id, url, title, description, marker, {_PART(1)} AS heading, {_PART(2)} AS kind, CAST(NULL AS VARCHAR) AS attribution FROM ({_ITEMS}) WHERE title <> ''
UNION ALL SELECT DISTINCT ed, 5, 0, CAST(NULL AS VARCHAR), 'Saying ' || ed, '', CAST(NULL AS VARCHAR), 'Wisdom bits', 'quote', 'Author ' || ed FROM ({_ITEMS})"""
_CURATED = f"SELECT *, row_number() OVER (ORDER BY ed, part, page_id) AS id, CAST(DATE '2024-01-01' + ed AS VARCHAR) AS date FROM ({_LISTED}) WHERE kind <> 'news'"


@query(f"SELECT id, ed, kind, heading, title, description, attribution, marker, url, date FROM ({_CURATED})")
def newsletter_index(spark, d):
    return newsletter_rows(spark, d)[1].select("id", "ed", "kind", "heading", "title", "description", "attribution", "marker", "url", "date")


@query(f"SELECT ed || '::' || coalesce(url, 'q:' || title) AS rewrite_key, title, description FROM ({_CURATED}) WHERE description <> ''")
def rewrite_todo(spark, d):
    return newsletter.to_rewrite(newsletter_rows(spark, d)[1])


@query(f"""SELECT e.ed, 'edition-' || e.ed AS slug, 'Edition ' || e.ed AS title, 'https://letters.example/p/edition-' || e.ed AS url, CAST(DATE '2024-01-01' + e.ed AS VARCHAR) AS published, CASE WHEN e.ed = 1 THEN '' ELSE '1' END AS refs, coalesce(c.n, 0) AS n_entries
FROM (SELECT DISTINCT ed FROM ({_ITEMS})) e LEFT JOIN (SELECT ed, count(*) AS n FROM ({_CURATED}) GROUP BY ed) c ON c.ed = e.ed""")
def edition_index(spark, d):
    rows = newsletter.edition_table(newsletter_editions(spark, d), newsletter_rows(spark, d)[1], SITE, "https://letters.example")
    return rows.select("ed", "slug", "title", "url", "published", F.array_join(F.transform("refs", lambda n: n.cast("string")), ",").alias("refs"), "n_entries")


def published(spark: SparkSession, d: str) -> publication.Publication:
    """The archive of the stand-in newsletter and chat."""
    rows = sightings(spark, d)
    said = rows.select("msg", F.col("chan").alias("ch"), "date", F.concat(F.lit("user"), F.col("ch").cast("string")).alias("author"), "said", F.lit(0).alias("pos"), "url", "text")
    channels = rows.select(F.col("chan").alias("ch"), F.concat(F.lit("#"), "chan").alias("name"), F.lit("").alias("parent")).distinct()
    channels = channels.withColumn("name", F.regexp_replace("name", "^#", ""))
    return publication.built(newsletter_rows(spark, d)[1], said, channels, cache_of(spark, d), "9", HIDDEN)


_NIB = f"""SELECT 'newsletter' AS src, kind, heading, title, description, url, key, {d_host('url')} AS host, {d_repo('url')} AS repo, date, ed, CAST(NULL AS VARCHAR) AS chan, CAST(NULL AS BIGINT) AS msg, id, id AS seq,
CASE WHEN kind = 'quote' THEN ['quote'] ELSE {d_tags('kind', 'title', 'description', d_host('url'), 'url', d_repo('url'))} END AS tags FROM ({d_key(f'({_CURATED})')})"""
_LABEL = f"CASE kind {' '.join(f'WHEN {literal(k)} THEN {literal(v[0])}' for k, v in V.KINDS.items())} END"
_CHAT = f"""SELECT 'chat' AS src, kind, {_LABEL} AS heading, title, description, url, key, host, repo, date, CAST(NULL AS INTEGER) AS ed, chan, msg, CAST(NULL AS BIGINT) AS id, 1000000000 + msg AS seq,
list_concat({d_tags('kind', 'title', 'description', 'host', 'url', 'repo')}, ['discord', chan]) AS tags FROM (SELECT *, {_KIND} AS kind FROM ({_WITH_TEXT})) WHERE chan <> 'error' AND key IS NOT NULL AND NOT regexp_matches(host, '{V.FURNITURE_HOST}') AND NOT regexp_matches(host, '{V.JOB_HOST}') AND NOT regexp_matches(lower({d_path('url')}), '{V.JOB_PATH}')"""
_BOTH = f"""SELECT *, row_number() OVER (PARTITION BY k ORDER BY (src = 'newsletter') DESC, length(description) DESC, (title <> '' AND NOT starts_with(title, 'http')) DESC, date, coalesce(id, 0), seq) AS place, row_number() OVER (PARTITION BY k ORDER BY date, coalesce(id, 0), seq) AS turn
FROM (SELECT *, coalesce(key, 'single ' || seq) AS k FROM (SELECT * FROM ({_NIB}) UNION ALL SELECT * FROM ({_CHAT})))"""
_UNION = d_union(_BOTH.replace("SELECT *, row_number()", "SELECT * EXCLUDE (key) RENAME (k AS key), row_number()", 1))
_MERGED = f"""SELECT row_number() OVER (ORDER BY CASE WHEN src = 'newsletter' THEN 0 ELSE 1 END, CASE WHEN src = 'newsletter' THEN id ELSE msg END) AS entry_id, b.*, g.n, g.first, g.last, t.all_tags
FROM (SELECT * FROM ({_BOTH}) WHERE place = 1) b JOIN (SELECT k, count(*) AS n, min(date) AS first, max(date) AS last FROM ({_BOTH}) GROUP BY k) g ON g.k = b.k JOIN (SELECT key AS tk, string_agg(tag, ',' ORDER BY m) AS all_tags FROM ({_UNION}) GROUP BY key) t ON t.tk = b.k"""


@query(f"SELECT entry_id, src, kind, heading, title, description, url, host, repo, date, ed, chan, first, last, n, all_tags AS tags FROM ({_MERGED})")
def publish_index(spark, d):
    return published(spark, d).entries.select("entry_id", "src", "kind", "heading", "title", "description", "url", "host", "repo", "date", "ed", "chan", "first", "last", "n", F.array_join("tags", ",").alias("tags"))


@query(d_facets(_UNION, ["click", "purchase", "signup", "view"]))
def publish_facets(spark, d):
    return published(spark, d).facets


@query(f"SELECT b.k AS key, b.src, b.date, b.ed, b.chan, CASE WHEN b.msg IS NOT NULL THEN 'https://discord.com/channels/9/' || b.chan || '/' || b.msg END AS msg_url FROM ({_BOTH}) b WHERE place > 1")
def publish_occurrences(spark, d):
    return published(spark, d).occurrences.select("key", "src", "date", "ed", "chan", "msg_url")


@query(f"SELECT CAST(count(*) FILTER (src = 'newsletter') AS BIGINT) AS newsletter, CAST(count(*) FILTER (src = 'chat') AS BIGINT) AS chat, CAST(sum(n - 1) AS BIGINT) AS collapsed, count(DISTINCT coalesce(key, 'quote::' || title)) AS entities FROM ({_MERGED})")
def publish_figures(spark, d):
    return published(spark, d).figures


@query(f"SELECT chan, n, row_number() OVER (ORDER BY n DESC, f) AS place FROM (SELECT chan, count(*) AS n, min(kf) AS f FROM (SELECT m.*, (SELECT min(seq) FROM ({_BOTH}) b WHERE b.k = m.k) AS kf FROM ({_MERGED}) m) WHERE src = 'chat' GROUP BY chan)")
def publish_per_channel(spark, d):
    return archive.per_channel(published(spark, d).entries).select("chan", "n", "place")


# ---- search ---------------------------------------------------------------------------------------------------------

TERMS, SYNONYMS = ["license", "token"], {"license": ["released"], "token": ["secret", "mit"]}
_EVERY = ["license", "token", "released", "secret", "mit"]
_WORDS = "SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')) AS w FROM documents"
_HITS = f"SELECT doc_id, {', '.join(f'len(list_filter(w, lambda t: starts_with(t, {literal(t)}))) > 0 AS h_{i}' for i, t in enumerate(_EVERY))} FROM ({_WORDS})"
_WEIGHTS = f"SELECT count(*) AS n, {', '.join(f'count(*) FILTER (h_{i}) AS df_{i}' for i in range(5))} FROM ({_HITS})"


def _d_keyword(literals: int) -> str:
    score = " + ".join(f"CASE WHEN h_{i} THEN ln(1 + n / df_{i}) * {1.0 if i < literals else 0.5} ELSE 0 END" for i in range(5))
    return f"SELECT doc_id, CAST({' + '.join(f'CAST(h_{i} AS BIGINT)' for i in range(literals))} AS BIGINT) AS literal, round({score}, 6) AS score FROM ({_HITS}) CROSS JOIN ({_WEIGHTS}) WHERE {' OR '.join(f'h_{i}' for i in range(5))}"


QUERY_VECTORS = "SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 100 = 0"
_SIMS = f"SELECT query_id, vec_id, round(list_sum(list_transform(list_zip(e.embedding, q.q), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))), 6) AS similarity FROM embeddings e CROSS JOIN ({QUERY_VECTORS}) q"


def query_vectors(spark, d):
    return table(spark, d, "embeddings").where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))


@query(f"SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM ({_SIMS})) WHERE rank <= 5")
def vector_topk(spark, d):
    return search.nearest(table(spark, d, "embeddings"), query_vectors(spark, d), 5)


_FLOORS = ", ".join(f"CAST(count(*) FILTER (similarity >= {f / 100}) AS BIGINT) AS floor_{f}" for f in (25, 30, 35, 40, 45))


@query(f"SELECT query_id, {', '.join(f'max(CASE WHEN r = {r} THEN similarity END) AS top{r}' for r in (1, 5, 20, 50))}, round(quantile_cont(similarity, 0.9), 6) AS p90, round(median(similarity), 6) AS median, {_FLOORS} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS r FROM ({_SIMS})) GROUP BY query_id")
def probe_stats(spark, d):
    return search.probe(table(spark, d, "embeddings"), query_vectors(spark, d))


@query(_d_keyword(2))
def keyword_synonym_search(spark, d):
    return search.keyword(table(spark, d, "documents"), TERMS, SYNONYMS)


@query("SELECT term, count(*) AS df FROM (" + f"SELECT doc_id, unnest({_EVERY}) AS term, w FROM ({_WORDS})" + ") WHERE len(list_filter(w, lambda t: starts_with(t, term))) > 0 GROUP BY term")
def idf(spark, d):
    row = search.idf(table(spark, d, "documents"), _EVERY)
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"df_{i}").alias("df")) for i, t in enumerate(_EVERY)])
    return row.select(F.inline(pairs)).where("df > 0")


@query("SELECT doc_id, CAST(1 AS BIGINT) AS literal, 0.0 AS score FROM documents WHERE false")
def empty_gate(spark, d):
    return search.keyword(table(spark, d, "documents"), ["zzzqx", "qqqxz"], {"zzzqx": ["the"]})


_KEYRANK = f"SELECT doc_id, row_number() OVER (ORDER BY literal DESC, score DESC, doc_id) AS ra FROM ({_d_keyword(2)})"
_VECRANK = f"SELECT vec_id AS doc_id, row_number() OVER (ORDER BY similarity DESC, vec_id) AS rb FROM ({_SIMS}) WHERE query_id = 0"


@query(f"SELECT doc_id, round(coalesce(1.0::DOUBLE / (60 + ra), 0) + coalesce(1.0::DOUBLE / (60 + rb), 0), 9) AS score FROM ({_KEYRANK}) FULL JOIN ({_VECRANK}) USING (doc_id)")
def rrf_fusion(spark, d):
    words = search.ranking(keyword_synonym_search(spark, d))
    sims = search.similarities(table(spark, d, "embeddings"), query_vectors(spark, d).where("query_id = 0"))
    near = numbered(sims, [F.col("similarity").desc(), F.col("vec_id")]).select(F.col("vec_id").alias("doc_id"), "rank")
    return search.fused(words, near).select("doc_id", "score")


@query(f"SELECT doc_id FROM ({_d_keyword(2)}) ORDER BY literal DESC, score DESC, doc_id LIMIT 20 OFFSET 20")
def page_n(spark, d):
    return search.page(keyword_synonym_search(spark, d), [F.col("literal").desc(), F.col("score").desc(), F.col("doc_id")], 1).select("doc_id")
