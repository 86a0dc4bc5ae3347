"""Pages -> documents, links, site traversal and crawl statistics.

``walk`` runs the HTML helper once per page (Arrow batches); all later steps
are Spark SQL expressions: node filters, joining, length rules, URL
resolution, same-site rules and the breadth-first traversal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.html import WALK_SCHEMA, walk_pages
from textlens.functions.text import collapse_ws, strip
from textlens.operators.common import broadcast_if_small, spread
from textlens.session import checkpoint_dir, ship_package

MIN_NODE_CHARS = 20       # a node is kept when longer than this
MIN_CONTENT_CHARS = 150   # pages with shorter content count as failed
MAX_CONTENT_CHARS = 5000  # content is cut to this length
MAX_PAGES = 50
MAX_DEPTH = 4
# Fixed value: title when no candidate exists.
UNTITLED = "Untitled"

# Link extensions that are never followed.
IGNORED_EXTENSIONS = (
    "7z 7zip bz2 rar tar tar.gz xz zip "
    "mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
    "mp3 wma ogg wav ra aac mid au aiff "
    "3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
    "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py"
).split()
# URL schemes a link may use.
LINK_SCHEMES = ("http", "https", "file", "ftp")

IGNORED_RE = r"\.(?:" + "|".join(e.replace(".", r"\.") for e in IGNORED_EXTENSIONS) + r")$"
URL_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def walk(pages: DataFrame) -> DataFrame:
    """One HTML pass per page (mapInPandas); columns of WALK_SCHEMA."""
    ship_package(pages.sparkSession)
    src = pages.select("page_id", "url", "html")
    if not src.isStreaming:
        src = spread(src)
    return src.mapInPandas(walk_pages, WALK_SCHEMA)


def _keep_node(t: Column, min_chars: int) -> Column:
    low = F.lower(t)
    return (
        (F.length(t) > min_chars)
        & ~t.startswith("[")
        & (F.instr(F.substring(low, 1, 20), "wikipedia") == 0)
        & (F.instr(F.substring(low, 1, 10), "edit") == 0)
    )


def extract_documents(walked: DataFrame, max_content: int = MAX_CONTENT_CHARS,
                      min_content: int = MIN_CONTENT_CHARS, min_node: int = MIN_NODE_CHARS) -> DataFrame:
    """(page_id, url, title, content, n_chars, ok): title by fallback chain;
    content = kept nodes joined by a space, whitespace collapsed, cut to
    ``max_content`` characters; ``ok`` is false for content under
    ``min_content`` characters and for pages the parser could not read."""
    nz = lambda c: F.when(F.col(c) != "", F.col(c))
    title = F.coalesce(nz("h1_id"), nz("h1_class"), nz("h1_any"), nz("title_tag"), F.lit(UNTITLED))
    kept = F.filter(F.transform("nodes", lambda x: strip(x)), lambda t: _keep_node(t, min_node))
    content = collapse_ws(F.array_join(kept, " "))
    out = walked.select("page_id", "url", title.alias("title"), content.alias("full"), "failed")
    return out.select(
        "page_id", "url", "title",
        F.substring("full", 1, max_content).alias("content"),
        F.length(F.substring("full", 1, max_content)).cast("bigint").alias("n_chars"),
        ((F.length("full") >= min_content) & ~F.col("failed")).alias("ok"),
    )


def crawl_items(documents: DataFrame) -> DataFrame:
    """Successful pages as crawl items (title, content, url, ts)."""
    return documents.where("ok").select("page_id", "title", "content", "url",
                                        F.current_timestamp().alias("ts"))


# ------------------------------------------------------------------ URLs
def url_host(url: Column) -> Column:
    """Lower-cased host name (no user info, no port)."""
    auth = F.regexp_extract(url, URL_RE, 3)
    return F.lower(F.regexp_extract(auth, r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1))


def strip_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def seed_domain(url: Column) -> Column:
    """Text after the last ``//`` up to the next ``/``, port removed."""
    d = F.substring_index(F.substring_index(url, "//", -1), "/", 1)
    return F.lower(F.regexp_replace(d, r":\d*$", ""))


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 on an absolute path: one fold over its segments, where
    ``..`` drops the segment before it and never the root."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))))
    closed = F.element_at(segments, -1).isin(".", "..")
    return F.when(path.contains("/."), F.concat(F.array_join(kept, "/"), F.when(closed, "/").otherwise(""))).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` (RFC 3986 5.2: absolute, //authority,
    /path, ?query, #fragment, relative path).  Dot segments are removed from
    the path only, never from the query or fragment."""
    h = F.regexp_replace(href, r"^[\t\n\f\r ]+|[\t\n\f\r ]+$", "")
    scheme = F.regexp_extract(base, URL_RE, 1)
    auth = F.regexp_extract(base, URL_RE, 2)
    path = F.regexp_extract(base, URL_RE, 4)
    query = F.regexp_extract(base, URL_RE, 5)
    root = F.concat(scheme, F.lit(":"), auth)
    own_scheme = F.regexp_extract(h, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    rest = F.regexp_replace(h, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    own_auth = F.regexp_extract(rest, r"^(//[^/?#]*)", 1)
    own_path = F.regexp_extract(F.regexp_replace(rest, r"^//[^/?#]*", ""), r"^[^?#]*", 0)
    tail = F.regexp_extract(rest, r"^[^?#]*(.*)$", 1)
    merged = F.concat(F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", "")), own_path)
    return (
        F.when((own_scheme != "") & (own_auth != ""), F.concat(own_scheme, own_auth, remove_dot_segments(own_path), tail))
        .when(own_scheme != "", h)
        .when(own_auth != "", F.concat(scheme, F.lit(":"), own_auth, remove_dot_segments(own_path), tail))
        .when(own_path.startswith("/"), F.concat(root, remove_dot_segments(own_path), tail))
        .when(own_path != "", F.concat(root, remove_dot_segments(merged), tail))
        .when(tail.startswith("?"), F.concat(root, path, tail))
        .otherwise(F.concat(root, path, query, tail))
    )


def extract_links(walked: DataFrame) -> DataFrame:
    """(page_id, pos, link): distinct per page, resolved against the page's
    ``base`` element or else its URL, followable scheme, no ignored file
    ending.  Fragments are kept here (links differ) and dropped when pages
    are visited."""
    base = F.when(F.col("base_href") != "", resolve(F.col("url"), F.col("base_href"))).otherwise(F.col("url"))
    e = walked.select("page_id", base.alias("base"), F.posexplode("hrefs").alias("pos", "href"))
    e = e.select("page_id", "pos", resolve(F.col("base"), F.col("href")).alias("link"))
    path = F.lower(F.regexp_extract(F.col("link"), URL_RE, 4))
    ok = F.lower(F.regexp_extract("link", URL_RE, 1)).isin(*LINK_SCHEMES) & ~path.rlike(IGNORED_RE)
    first = e.where(ok).groupBy("page_id", "link").agg(F.min("pos").alias("pos"))
    return first.select("page_id", "pos", "link")


def same_site(host: Column, domain: Column) -> Column:
    return (host == domain) | host.endswith(F.concat(F.lit("."), domain))


# ------------------------------------------------------------- traversal
def traverse(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_pages: int = MAX_PAGES,
             max_depth: int = MAX_DEPTH, include_seed: bool = False) -> DataFrame:
    """Breadth-first site traversal for many crawls at once.

    seeds(crawl_id, seed_url); edges(src, dst) as URLs; pages(page_id, url)
    = pages that can be fetched.  A page is visited once per crawl (URL
    without fragment) at its smallest depth; links are followed only to the
    seed's site (host equal to it or a subdomain) and to depth ``max_depth``.
    Each crawl returns at most ``max_pages`` pages ordered by (depth, url).
    A crawl that holds ``max_pages`` pages after a level goes no deeper: later
    pages could not be among them.  Only pages that can be fetched are kept.
    One join + anti join per level; edges and levels are cut off their
    lineage with reliable checkpoints, so nothing stays cached afterwards.

    Returns (crawl_id, page_id, url, depth INT, rank INT).
    """
    spark = seeds.sparkSession
    checkpoint_dir(spark)
    crawls = seeds.select("crawl_id", seed_domain(F.col("seed_url")).alias("domain"),
                          strip_fragment(F.col("seed_url")).alias("key"))
    fetchable = pages.select(strip_fragment(F.col("url")).alias("key"), "page_id", "url").groupBy("key").agg(
        F.min_by("page_id", "page_id").alias("page_id"), F.min_by("url", "page_id").alias("url")).checkpoint()
    e = (
        edges.select(strip_fragment(F.col("src")).alias("key"), strip_fragment(F.col("dst")).alias("dst"))
        .where(F.col("dst") != "")
        .distinct()
        .join(fetchable.select("key"), "key", "left_semi")  # only fetched pages have out-links
        .join(fetchable.select(F.col("key").alias("dst")), "dst", "left_semi")  # and only they are visited
        .checkpoint()
    )
    dom = broadcast_if_small(crawls.select("crawl_id", "domain"))
    level = crawls.select("crawl_id", "key", F.lit(0).alias("depth")).checkpoint()
    visited = level
    for depth in range(1, max_depth + 1):
        counted = visited if include_seed else visited.where(F.col("depth") > 0)
        full = counted.groupBy("crawl_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max_pages)
        nxt = (
            level.join(full, "crawl_id", "left_anti").join(e, "key")
            .select("crawl_id", F.col("dst").alias("key"))
            .join(dom, "crawl_id")
            .where(same_site(url_host(F.col("key")), F.col("domain")))
            .select("crawl_id", "key")
            .distinct()
            .join(visited, ["crawl_id", "key"], "left_anti")
            .select("crawl_id", "key", F.lit(depth).alias("depth"))
        )
        level = nxt.checkpoint()
        visited = visited.unionByName(level)
    got = visited.join(fetchable, "key")
    if not include_seed:
        got = got.where(F.col("depth") > 0)
    rank = F.row_number().over(Window.partitionBy("crawl_id").orderBy("depth", "key"))
    ranked = got.withColumn("rank", rank).where((F.col("rank") <= max_pages))
    return ranked.select("crawl_id", "page_id", "url", F.col("depth").cast("int").alias("depth"), "rank")


# Why a crawl ended.
FINISHED, PAGE_LIMIT = "finished", "closespider_pagecount"


def crawl_stats(visits: DataFrame, documents: DataFrame, key: str = "crawl_id", seeds: DataFrame | None = None,
                max_pages: int = MAX_PAGES, started: Column | None = None, ended: Column | None = None) -> DataFrame:
    """Per crawl: total, successful and failed pages, the success rate text
    (``%.1f%%``, 0 when nothing was fetched), start and end time and the
    reason of the end.  With ``seeds`` (one row per crawl) crawls that visited
    no page have a row of zeros.  The times are columns of ``seeds`` or
    literals; by default the time of the query."""
    pages = documents.select("page_id", "ok")
    if seeds is not None:
        start = seeds.select(key, (started if started is not None else F.current_timestamp()).alias("start_time"),
                             (ended if ended is not None else F.current_timestamp()).alias("end_time"))
        j = start.join(visits.select(key, "page_id").join(pages, "page_id"), key, "left")
    else:
        j = visits.select(key, "page_id").join(pages, "page_id").select(
            "*", (started if started is not None else F.current_timestamp()).alias("start_time"),
            (ended if ended is not None else F.current_timestamp()).alias("end_time"))
    agg = j.groupBy(key).agg(
        F.count("page_id").alias("total_pages"),
        F.count_if("ok").alias("successful_pages"),
        F.count_if(~F.col("ok")).alias("failed_pages"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
    )
    rate = F.when(F.col("total_pages") > 0, F.col("successful_pages") * 100.0 / F.col("total_pages")).otherwise(0.0)
    reason = F.when(F.col("total_pages") >= max_pages, F.lit(PAGE_LIMIT)).otherwise(F.lit(FINISHED))
    return agg.select(key, "total_pages", "successful_pages", "failed_pages",
                      F.format_string("%.1f%%", rate).alias("success_rate"), "start_time", "end_time",
                      reason.alias("close_reason"))


def write_crawl_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per crawl."""
    stats.write.mode(mode).json(path)
