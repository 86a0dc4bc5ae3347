"""Independent DuckDB SQL for every registered query.

The driver runs these against the same Parquet tables (registered as views)
and compares row count, schema and values with the Spark result.  Fragments
are plain CTE text so the larger queries can reuse the smaller ones.
"""

from __future__ import annotations

from textlens.functions.words import ENGLISH_STOP_WORDS, FALLBACK_DICTIONARY

STOP_LIST = "string_split('" + " ".join(ENGLISH_STOP_WORDS) + "', ' ')"
FALLBACK_LIST = "string_split('" + " ".join(FALLBACK_DICTIONARY) + "', ' ')"

# Corpus: stripped text longer than 50 characters.
CORPUS = r"""
corpus AS (
  SELECT doc_id, text FROM (
    SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM documents)
  WHERE length(text) > 50
),
n AS (SELECT count(*)::DOUBLE AS n FROM corpus)"""

# TF-IDF: terms, tf, df/cf, vocabulary, normalised document weights.
TFIDF = CORPUS + r""",
sw AS (SELECT """ + STOP_LIST + r""" AS sl),
dtok AS (
  SELECT c.doc_id,
         list_filter(regexp_extract_all(lower(c.text), '[\p{L}\p{N}_]{2,}'),
                     lambda t: NOT list_contains(sw.sl, t)) AS k
  FROM corpus c, sw
),
dterm AS (
  SELECT doc_id, unnest(k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS term
  FROM dtok
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dterm GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term),
vocab AS (
  SELECT term, df, cf, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM stats, n WHERE df >= 1 AND df <= 0.8 * n
  ORDER BY cf DESC, term ASC LIMIT 5000
),
dw0 AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w0 FROM tf JOIN vocab v USING (term)),
dw AS (SELECT doc_id, term, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY doc_id)) AS w FROM dw0)"""


def search_sql(queries_cte: str, k: str | int) -> str:
    """Top-k cosine search.  ``queries_cte`` defines ``q(query_id,
    query_text, k)``; ``k`` is a literal or a column name of q."""
    return (
        "WITH " + TFIDF + ",\n" + queries_cte + r""",
qtok AS (
  SELECT q.query_id,
         list_filter(regexp_extract_all(lower(q.query_text), '[\p{L}\p{N}_]{2,}'),
                     lambda t: NOT list_contains(sw.sl, t)) AS k
  FROM q, sw
),
qterm AS (
  SELECT query_id, unnest(k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS term
  FROM qtok
),
qtf AS (SELECT query_id, term, count(*) AS tf FROM qterm GROUP BY query_id, term),
qw0 AS (SELECT qtf.query_id, qtf.term, qtf.tf * v.idf AS w0 FROM qtf JOIN vocab v USING (term)),
qw AS (SELECT query_id, term, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY query_id)) AS w FROM qw0),
contrib AS (SELECT qw.query_id, dw.doc_id, qw.w * dw.w AS c FROM qw JOIN dw USING (term)),
firstd AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM (SELECT doc_id FROM corpus ORDER BY doc_id LIMIT 100)),
fill AS (SELECT q.query_id, f.doc_id, 0.0::DOUBLE AS c FROM q JOIN firstd f ON f.r <= q.k),
scored AS (
  SELECT query_id, doc_id, round(sum(c), 6) AS score
  FROM (SELECT * FROM contrib UNION ALL SELECT * FROM fill) GROUP BY query_id, doc_id
),
ranked AS (
  SELECT s.query_id, CAST(row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.doc_id ASC) AS INTEGER) AS rank,
         s.doc_id, s.score, q.k
  FROM scored s JOIN q USING (query_id)
)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= k"""
    )


BENCH_QUERIES = "q AS (SELECT item_id AS query_id, text AS query_text, 5 AS k FROM benchmark)"
USER_QUERIES = ("q AS (SELECT conv_id * 1000 + turn AS query_id, text AS query_text, 10 AS k "
                "FROM conversations WHERE role = 'user')")

POSTINGS_BODY = r"""
words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(generate_series(0, len(ws) - 1)) AS pos
  FROM (SELECT doc_id, string_split_regex(lower(text), '\s+') AS ws FROM corpus)
),
terms AS (
  SELECT doc_id, pos, regexp_replace(word, '[^\p{L}\p{N}]', '', 'g') AS term FROM words
),
postings AS (
  SELECT term, doc_id, list_sort(list(pos)) AS positions
  FROM terms WHERE length(term) >= 3 GROUP BY term, doc_id
)"""
POSTINGS = CORPUS + "," + POSTINGS_BODY

PUNCT_SQL = "'!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"

# Queries with typing errors: the second letter of every word of 6+ letters
# is dropped.
MISSPELLED = r"""mq AS (
  SELECT item_id AS query_id,
         regexp_replace(text, '(^|\s)(\pL)\pL(\pL{4,})', '\1\2\3', 'g') AS query_text
  FROM benchmark
)"""

# Spell check of ``sq(query_id, query_text)`` against fallback + vocabulary.
# DuckDB's levenshtein counts bytes; the few non-ASCII letters are mapped to
# unused control characters first so distances count characters.
SPELL = r"""
dct AS (
  SELECT DISTINCT word FROM (
    SELECT unnest(""" + FALLBACK_LIST + r""") AS word UNION ALL SELECT lower(term) FROM vocab)
  WHERE word <> ''
),
toks AS (
  SELECT query_id, unnest(ws) AS token, unnest(generate_series(0, len(ws) - 1)) AS pos
  FROM (SELECT query_id,
               CASE WHEN regexp_replace(lower(query_text), '^\s+|\s+$', '', 'g') = '' THEN []::VARCHAR[]
                    ELSE string_split_regex(regexp_replace(lower(query_text), '^\s+|\s+$', '', 'g'), '\s+') END AS ws
        FROM sq)
),
ctoks AS (SELECT query_id, pos, token, trim(token, """ + PUNCT_SQL + r""") AS clean FROM toks),
unknown AS (
  SELECT DISTINCT clean AS word FROM ctoks
  WHERE clean <> '' AND clean NOT IN (SELECT word FROM dct)
),
chars AS (
  SELECT DISTINCT ch FROM (
    SELECT unnest(string_split(word, '')) AS ch FROM (SELECT word FROM unknown UNION ALL SELECT word FROM dct))
  WHERE ord(ch) > 127
),
cmap AS (
  SELECT coalesce(string_agg(ch, '' ORDER BY ch), '') AS src,
         coalesce(string_agg(chr(CAST(rn AS INTEGER)), '' ORDER BY ch), '') AS dst
  FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS rn FROM chars)
),
cand AS (
  SELECT u.word, d.word AS suggestion,
         levenshtein(translate(u.word, m.src, m.dst), translate(d.word, m.src, m.dst)) AS distance
  FROM unknown u JOIN dct d ON abs(length(u.word) - length(d.word)) <= 2, cmap m
),
sug AS (
  SELECT * FROM (
    SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY distance, suggestion) AS INTEGER) AS rank,
           suggestion, CAST(distance AS INTEGER) AS distance
    FROM cand WHERE distance <= 2)
  WHERE rank <= 3
),
lists AS (SELECT word, list(suggestion ORDER BY rank) AS sl FROM sug GROUP BY word),
tk AS (SELECT t.query_id, t.pos, t.token, t.clean, l.sl FROM ctoks t LEFT JOIN lists l ON l.word = t.clean),
sugstr AS (
  SELECT query_id, string_agg(clean || '=' || array_to_string(sl, '|'), ';' ORDER BY clean) AS suggestions
  FROM (SELECT DISTINCT query_id, clean, sl FROM tk WHERE sl IS NOT NULL) GROUP BY query_id
),
chk AS (
  SELECT sq.query_id, coalesce(sq.query_text, '') AS original,
         coalesce(a.corrected, '') AS corrected, coalesce(a.has_errors, false) AS has_errors,
         coalesce(a.misspelled, '') AS misspelled_words, coalesce(s.suggestions, '') AS suggestions
  FROM sq
  LEFT JOIN (
    SELECT query_id,
           string_agg(CASE WHEN sl IS NOT NULL THEN sl[1] ELSE token END, ' ' ORDER BY pos) AS corrected,
           bool_or(sl IS NOT NULL) AS has_errors,
           string_agg(CASE WHEN sl IS NOT NULL THEN clean END, ',' ORDER BY pos) AS misspelled
    FROM tk GROUP BY query_id) a USING (query_id)
  LEFT JOIN sugstr s USING (query_id)
)"""

USER_SQ = ("sq AS (SELECT conv_id * 1000 + turn AS query_id, text AS query_text "
           "FROM conversations WHERE role = 'user')")
MISSPELLED_SQ = MISSPELLED + ",\nsq AS (SELECT query_id, query_text FROM mq)"

URL_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def _decode(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), "
            f"'&middot;', '·'), '&amp;', '&')")


def _host(x: str) -> str:
    return (f"lower(regexp_extract(regexp_extract({x}, '{URL_RE}', 3), "
            r"'^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)', 1))")


_IGNORED = ", ".join(f"'{e}'" for e in (
    "7z 7zip bz2 rar tar tar.gz xz zip mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr "
    "ico webp mp3 wma ogg wav ra aac mid au aiff 3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
    "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py").split())

# Regex oracle for page extraction: on the test pages every article holds
# an h1 followed by p / b / br markup only.
PAGE_DOCS = r"""
art AS (
  SELECT page_id, url, html,
         regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1),
                        '(?s)<h1[^>]*>.*?</h1>', '', 'g') AS a
  FROM pages
),
nodes AS (
  SELECT page_id, list_filter(
           list_transform(string_split_regex(a, '<[^>]*>'),
                          lambda x: regexp_replace(""" + _decode("x") + r""", '^\s+|\s+$', '', 'g')),
           lambda t: length(t) > 20 AND NOT starts_with(t, '[')
                     AND strpos(substr(lower(t), 1, 20), 'wikipedia') = 0
                     AND strpos(substr(lower(t), 1, 10), 'edit') = 0) AS kept
  FROM art
),
ftext AS (
  SELECT page_id,
         regexp_replace(regexp_replace(array_to_string(kept, ' '), '\s+', ' ', 'g'), '^ | $', '', 'g') AS body
  FROM nodes
),
pdocs AS (
  SELECT page_id, substr(body, 1, 5000) AS content, CAST(length(substr(body, 1, 5000)) AS BIGINT) AS n_chars,
         length(body) >= 150 AS ok
  FROM ftext
),
ptitles AS (
  SELECT page_id,
         coalesce(nullif(""" + _decode(r"regexp_extract(html, '<h1[^>]*>([^<]*)', 1)") + r""", ''),
                  nullif(""" + _decode(r"regexp_extract(html, '<title[^>]*>([^<]*)', 1)") + r""", ''),
                  'Untitled') AS title
  FROM pages
)"""

PAGE_LINKS = r"""
hrefs AS (
  SELECT page_id, url, h.href, h.pos FROM (
    SELECT page_id, url,
           unnest(regexp_extract_all(html, '<(?:a|area)\s[^>]*href="([^"]*)"', 1)) AS href,
           unnest(generate_series(0, len(regexp_extract_all(html, '<(?:a|area)\s[^>]*href="([^"]*)"', 1)) - 1)) AS pos
    FROM pages) h
),
parts AS (
  SELECT page_id, pos, regexp_replace(href, '^[	

 ]+|[	

 ]+$', '', 'g') AS h,
         regexp_extract(url, '""" + URL_RE + r"""', 1) AS scheme,
         regexp_extract(url, '""" + URL_RE + r"""', 2) AS auth,
         regexp_extract(url, '""" + URL_RE + r"""', 4) AS path,
         regexp_extract(url, '""" + URL_RE + r"""', 5) AS query
  FROM hrefs
),
resolved AS (
  SELECT page_id, pos,
         CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h
              WHEN starts_with(h, '//') THEN scheme || ':' || h
              WHEN starts_with(h, '/') THEN scheme || ':' || auth || h
              WHEN starts_with(h, '?') THEN scheme || ':' || auth || path || h
              WHEN starts_with(h, '#') THEN scheme || ':' || auth || path || query || h
              WHEN h = '' THEN scheme || ':' || auth || path || query
              ELSE scheme || ':' || auth || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || h
         END AS l0
  FROM parts
),
dots AS (
  SELECT page_id, pos, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           regexp_replace(l0, '/(\./)+', '/', 'g'),
           '/(?:[^/?#.][^/?#]*|\.[^/?#.][^/?#]*|\.\.[^/?#]+)/\.\./', '/'),
           '/(?:[^/?#.][^/?#]*|\.[^/?#.][^/?#]*|\.\.[^/?#]+)/\.\./', '/'),
           '/(?:[^/?#.][^/?#]*|\.[^/?#.][^/?#]*|\.\.[^/?#]+)/\.\./', '/'), '$^', '') AS link
  FROM resolved
),
plinks AS (
  SELECT page_id, min(pos) AS pos, link FROM dots
  WHERE lower(regexp_extract(link, '""" + URL_RE + r"""', 1)) IN ('http', 'https', 'file', 'ftp')
    AND lower(regexp_extract(regexp_extract(link, '""" + URL_RE + r"""', 4), '\.([^./]*)$', 1)) NOT IN (""" + _IGNORED + r""")
  GROUP BY page_id, link
)"""

# Traversal fixture: links of the pages plus edges derived from the table
# (host root <-> every page of the host, page -> 2*page and 2*page+1, self).
TRAVERSE = PAGE_LINKS + r""",
ph AS (SELECT page_id, url, """ + _host("url") + r""" AS host FROM pages),
roots AS (SELECT host, min(page_id) AS root FROM ph GROUP BY host),
ids AS (SELECT p.page_id, p.url, p.host, r.root FROM ph p JOIN roots r USING (host)),
edges0 AS (
  SELECT p.url AS src, l.link AS dst FROM plinks l JOIN pages p USING (page_id)
  UNION ALL SELECT i.url, r.url FROM ids i JOIN pages r ON r.page_id = i.root
  UNION ALL SELECT r.url, i.url FROM ids i JOIN pages r ON r.page_id = i.root
  UNION ALL SELECT i.url, c.url FROM ids i JOIN pages c ON c.page_id = 2 * i.page_id
  UNION ALL SELECT i.url, c.url FROM ids i JOIN pages c ON c.page_id = 2 * i.page_id + 1
  UNION ALL SELECT url, url FROM pages
),
edges AS (
  SELECT DISTINCT regexp_replace(src, '#.*$', '') AS key, regexp_replace(dst, '#.*$', '') AS dst
  FROM edges0 WHERE regexp_replace(dst, '#.*$', '') <> ''
),
crawls AS (
  SELECT p.page_id AS crawl_id,
         lower(regexp_replace(split_part(string_split(p.url, '//')[-1], '/', 1), ':[0-9]*$', '')) AS domain,
         regexp_replace(p.url, '#.*$', '') AS key
  FROM pages p JOIN roots r ON r.root = p.page_id
),
fetchable AS (
  SELECT regexp_replace(url, '#.*$', '') AS key, min(page_id) AS page_id, arg_min(url, page_id) AS url
  FROM pages GROUP BY key
),
bfs(crawl_id, key, depth) AS (
  SELECT crawl_id, key, 0 FROM crawls
  UNION
  SELECT b.crawl_id, e.dst, b.depth + 1
  FROM bfs b JOIN fetchable f ON f.key = b.key JOIN edges e ON e.key = b.key
       JOIN crawls c ON c.crawl_id = b.crawl_id
  WHERE b.depth < 4
    AND (""" + _host("e.dst") + r""" = c.domain OR ends_with(""" + _host("e.dst") + r""", '.' || c.domain))
),
visits AS (
  SELECT * FROM (
    SELECT v.crawl_id, f.page_id, f.url, CAST(v.depth AS INTEGER) AS depth,
           CAST(row_number() OVER (PARTITION BY v.crawl_id ORDER BY v.depth, v.key) AS INTEGER) AS rank
    FROM (SELECT crawl_id, key, min(depth) AS depth FROM bfs GROUP BY crawl_id, key) v
    JOIN fetchable f USING (key)
    WHERE v.depth > 0)
  WHERE rank <= 50
)"""

KNN_L2 = r"""
WITH cells AS (
  SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings
),
cent AS (
  SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS q
  FROM (SELECT label, i, avg(x) AS m FROM cells GROUP BY label, i) GROUP BY label
),
d AS (
  SELECT c.query_id, e.vec_id,
         round(list_sum(list_transform(list_zip(c.q, e.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6)
           AS distance
  FROM cent c, embeddings e
)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
         vec_id, distance, round(1.0 / (1.0 + distance), 6) AS similarity
  FROM d)
WHERE rank <= 10"""

SEM_TOKENS = r"""list_filter(regexp_extract_all(strip_accents(lower({t})), '[\p{{L}}\p{{Nl}}\p{{No}}_]+'),
                     lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))"""

WORD_MEAN = r"""
WITH btok AS (SELECT DISTINCT unnest(""" + SEM_TOKENS.format(t="text") + r""") AS word FROM benchmark),
wv AS (
  SELECT word, sqrt(length(word)::DOUBLE) AS x0, ln(unicode(word)::DOUBLE) AS x1,
         sqrt(unicode(substring(word, length(word), 1))::DOUBLE) AS x2
  FROM btok
),
dtok AS (SELECT doc_id, unnest(""" + SEM_TOKENS.format(t="text") + r""") AS word FROM documents),
m AS (
  SELECT d.doc_id, avg(w.x0) AS v0, avg(w.x1) AS v1, avg(w.x2) AS v2
  FROM dtok d JOIN wv w USING (word) GROUP BY d.doc_id
)
SELECT d.doc_id, round(coalesce(m.v0, 0.0), 6) AS v0, round(coalesce(m.v1, 0.0), 6) AS v1,
       round(coalesce(m.v2, 0.0), 6) AS v2
FROM documents d LEFT JOIN m USING (doc_id)"""

# Fixed values: what the references of RFC 3986 section 5.4 resolve to,
# written down from its tables (strict parsing), behind http://<host>.
RFC_3986 = """
g /b/c/g|./g /b/c/g|g/ /b/c/g/|/g /g|?y /b/c/d;p?y|g?y /b/c/g?y|#s /b/c/d;p?q#s|g#s /b/c/g#s|g?y#s /b/c/g?y#s
|;x /b/c/;x|g;x /b/c/g;x|g;x?y#s /b/c/g;x?y#s| /b/c/d;p?q|. /b/c/|./ /b/c/|.. /b/|../ /b/|../g /b/g|../.. /
|../../ /|../../g /g|../../../g /g|../../../../g /g|/./g /g|/../g /g|g. /b/c/g.|.g /b/c/.g|g.. /b/c/g..
|..g /b/c/..g|./../g /b/g|./g/. /b/c/g/|g/./h /b/c/g/h|g/../h /b/c/h|g;x=1/./y /b/c/g;x=1/y|g;x=1/../y /b/c/y
|g?y/./x /b/c/g?y/./x|g?y/../x /b/c/g?y/../x|g#s/./x /b/c/g#s/./x|g#s/../x /b/c/g#s/../x
|a/b/c/d/../../../../../../e /e
""".replace("\n", "")

REQUESTS = r"""rq AS (
  SELECT conv_id * 1000 + turn AS n,
         regexp_replace(CASE WHEN (conv_id * 1000 + turn) % 23 = 0 THEN repeat(text || ' ', 40) ELSE text END,
                        '(^|\s)(\pL)\pL(\pL{4,})', '\1\2\3', 'g') AS t
  FROM conversations WHERE role = 'user'
),
req AS (
  SELECT n AS query_id, CASE WHEN n % 17 = 0 THEN substr(t, 1, 1) ELSE t END AS query_text,
         CASE WHEN n % 11 = 0 THEN 'x' WHEN n % 13 = 0 THEN repeat('9', 45) ELSE CAST(n % 7 AS VARCHAR) END AS top_k,
         n % 2 = 0 AS auto_correct
  FROM rq
),
checked AS (
  SELECT *, CASE WHEN query_text IS NULL THEN 'Query parameter is missing'
                 WHEN regexp_replace(query_text, '^\s+|\s+$', '', 'g') = '' THEN 'Query is empty'
                 WHEN length(regexp_replace(query_text, '^\s+|\s+$', '', 'g')) < 2 THEN 'Query too short'
                 WHEN length(query_text) > 1000 THEN 'Query too long'
                 WHEN top_k = 'x' THEN 'top_k must be an integer'
                 WHEN top_k NOT IN ('1', '2', '3', '4', '5', '6') THEN 'top_k must be between 1 and 100' END AS error
  FROM req
),
sq AS (SELECT query_id, query_text FROM checked WHERE error IS NULL),""" + SPELL + r""",
q AS (SELECT c.query_id, CASE WHEN c.auto_correct AND k.has_errors THEN k.corrected ELSE c.query_text END AS query_text,
             CAST(c.top_k AS INTEGER) AS k, k.has_errors, k.corrected
      FROM checked c JOIN chk k USING (query_id))"""

ANSWERS = "WITH " + TFIDF + ",\n" + REQUESTS + r"""
SELECT c.query_id, CASE WHEN c.error IS NULL THEN 'success' ELSE 'invalid' END AS status, c.error,
       CAST(q.k AS INTEGER) AS top_k, q.query_text AS search_query, CASE WHEN q.has_errors THEN q.corrected END AS corrected
FROM checked c LEFT JOIN q USING (query_id)"""

# Word vectors by rule (see the query): the sums that cosine and mean need.
RULE_VECTORS = r"""
btok AS (SELECT item_id, unnest(t) AS word, unnest(generate_series(1, len(t))) AS pos
         FROM (SELECT item_id, """ + SEM_TOKENS.format(t="text") + r""" AS t FROM benchmark)),
wv AS (
  SELECT word, sqrt(length(word)::DOUBLE) AS x0, ln(unicode(word)::DOUBLE) AS x1,
         sqrt(unicode(substring(word, length(word), 1))::DOUBLE) AS x2
  FROM (SELECT DISTINCT word FROM btok)
)"""

SQL: dict[str, str] = {
    "link_resolution": r"""
WITH refs AS (SELECT string_split(x, ' ') AS r FROM (SELECT unnest(string_split('""" + RFC_3986 + r"""', '|')) AS x)),
p AS (SELECT page_id, """ + _host("url") + r""" AS host FROM pages)
SELECT page_id, r[1] AS href, 'http://' || host || r[2] AS link FROM p, refs""",
    "saved_index_search": search_sql(BENCH_QUERIES, 5).replace(
        "k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])", "k").replace(
        "LIMIT 5000", "LIMIT 2000").replace(STOP_LIST, "['the', 'of', 'and', 'de', 'der']"),
    "corpus_file": "WITH " + PAGE_DOCS + r"""
SELECT text, count(*) AS n FROM (
  SELECT regexp_replace(regexp_replace(regexp_replace(title, '\s+', ' ', 'g'), '^ | $', '', 'g') || chr(10) || content,
                        '^\s+|\s+$', '', 'g') AS text
  FROM pdocs JOIN ptitles USING (page_id) WHERE ok)
WHERE length(text) > 50 GROUP BY text""",
    "search_requests": search_sql(REQUESTS, "k"),
    "stream_search_requests": search_sql(REQUESTS, "k"),
    "stream_request_log": "SELECT r.query_id, c.query_text, r.rank, r.doc_id AS document_id FROM ("
    + search_sql(REQUESTS, "k") + ") r JOIN (WITH " + TFIDF + ",\n" + REQUESTS
    + "\nSELECT query_id, query_text FROM checked WHERE error IS NULL) c USING (query_id)",
    "request_answers": ANSWERS,
    "json_answers": "SELECT a.query_id, a.status, a.error, a.corrected, "
    "CAST(count(h.doc_id) OVER (PARTITION BY a.query_id) AS INTEGER) AS results_count, "
    "h.rank, h.doc_id AS document_id, h.score AS similarity_score, CASE WHEN h.doc_id IS NOT NULL THEN "
    "CASE WHEN coalesce(c.text, '') = '' THEN 'Content not available' ELSE substr(c.text, 1, 200) END END AS content_preview "
    "FROM (" + ANSWERS + ") a LEFT JOIN (" + search_sql(REQUESTS, "k") + ") h USING (query_id) LEFT JOIN ("
    "SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM documents) c ON c.doc_id = h.doc_id",
    "word_similarity_rule": "WITH " + RULE_VECTORS + r""",
pairs AS (SELECT DISTINCT a.word AS word1, b.word AS word2 FROM btok a JOIN btok b
          ON a.item_id = b.item_id AND b.pos = a.pos + 1)
SELECT word1, word2, round((a.x0 * b.x0 + a.x1 * b.x1 + a.x2 * b.x2)
         / (sqrt(a.x0 * a.x0 + a.x1 * a.x1 + a.x2 * a.x2) * sqrt(b.x0 * b.x0 + b.x1 * b.x1 + b.x2 * b.x2)), 6) AS similarity
FROM pairs JOIN wv a ON a.word = word1 JOIN wv b ON b.word = word2""",
    "postings_lookup": "WITH " + POSTINGS + r""",
bw AS (
  SELECT DISTINCT regexp_replace(unnest(string_split_regex(lower(text), '\s+')), '[^\p{L}\p{N}]', '', 'g') AS term
  FROM benchmark
)
SELECT term, count(*) AS n_docs, CAST(sum(len(positions)) AS BIGINT) AS n_positions
FROM postings JOIN bw USING (term) GROUP BY term""",
    "index_objects": "WITH " + POSTINGS + "\nSELECT term, doc_id, array_to_string(positions, ',') AS positions FROM postings",
    "term_totals": "WITH " + POSTINGS + "\nSELECT count(DISTINCT term) AS total_terms, true AS within_bounds FROM postings",
    "stream_index": "WITH " + TFIDF + "\nSELECT term, df, cf, round(idf, 9) AS idf FROM vocab",
    "corrected_text": "WITH " + TFIDF + ",\n" + MISSPELLED_SQ + "," + SPELL + "\nSELECT query_id, corrected FROM chk",
    "result_log": "SELECT r.query_id, r.rank, r.doc_id AS document_id, b.text AS query_text FROM ("
    + search_sql(BENCH_QUERIES, 5) + ") r JOIN benchmark b ON b.item_id = r.query_id",
    "postings_ascii": "WITH " + CORPUS + "," + POSTINGS_BODY.replace(
        "lower(text)", r"lower(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'), '^\s+|\s+$', '', 'g'))")
    + "\nSELECT term, doc_id, array_to_string(positions, ',') AS positions FROM postings",
    "result_previews": "SELECT r.*, CASE WHEN coalesce(c.text, '') = '' THEN 'Content not available' "
    "ELSE substr(c.text, 1, 200) END AS content_preview FROM (" + search_sql(BENCH_QUERIES, 5) + ") r LEFT JOIN ("
    "SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM documents) c USING (doc_id)",
    "similar_words_rule": "WITH " + RULE_VECTORS + r""",
u AS (SELECT word, x0 / n AS x0, x1 / n AS x1, x2 / n AS x2
      FROM (SELECT *, sqrt(x0 * x0 + x1 * x1 + x2 * x2) AS n FROM wv)),
p AS (SELECT a.word, b.word AS other, round(a.x0 * b.x0 + a.x1 * b.x1 + a.x2 * b.x2, 6) AS similarity
      FROM u a, u b WHERE a.word <> b.word)
SELECT word, rank, similarity FROM (
  SELECT word, CAST(row_number() OVER (PARTITION BY word ORDER BY similarity DESC, other) AS INTEGER) AS rank, similarity
  FROM p)
WHERE rank <= 3""",
    "semantic_search_rule": "WITH " + RULE_VECTORS + r""",
dtok AS (SELECT doc_id, unnest(""" + SEM_TOKENS.format(t="text") + r""") AS word FROM documents),
dv AS (SELECT d.doc_id, coalesce(avg(x0), 0) AS v0, coalesce(avg(x1), 0) AS v1, coalesce(avg(x2), 0) AS v2
       FROM documents d LEFT JOIN (SELECT * FROM dtok JOIN wv USING (word)) t USING (doc_id) GROUP BY d.doc_id),
qv AS (SELECT b.item_id AS query_id, coalesce(avg(x0), 0) AS v0, coalesce(avg(x1), 0) AS v1, coalesce(avg(x2), 0) AS v2
       FROM benchmark b LEFT JOIN (SELECT * FROM btok JOIN wv USING (word)) t USING (item_id) GROUP BY b.item_id),
d AS (SELECT query_id, doc_id, (q.v0 - d.v0) ** 2 + (q.v1 - d.v1) ** 2 + (q.v2 - d.v2) ** 2 AS distance
      FROM qv q, dv d)
SELECT query_id, rank, distance FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 6), doc_id) AS INTEGER) AS rank,
         round(distance, 6) AS distance FROM d)
WHERE rank <= 5""",
    "corpus_filter": "WITH " + CORPUS + "\nSELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM corpus",
    "vocab_df_cf": "WITH " + TFIDF + "\nSELECT term, df, cf, round(idf, 9) AS idf FROM vocab",
    "doc_weights": "WITH " + TFIDF + "\nSELECT doc_id, term, round(w, 9) AS w FROM dw",
    "tfidf_search_topk": search_sql(BENCH_QUERIES, 5),
    "search_zero_fill": search_sql(USER_QUERIES, 10),
    "postings": "WITH " + POSTINGS + "\nSELECT term, doc_id, array_to_string(positions, ',') AS positions FROM postings",
    "postings_nested": "WITH " + POSTINGS + """
SELECT term, doc_id // 1000000 AS block,
       string_agg(CAST(doc_id AS VARCHAR) || ':' || array_to_string(positions, ','), ';' ORDER BY doc_id) AS postings
FROM postings GROUP BY term, block""",
    "validate_queries": r"""
SELECT query_id, error IS NULL AS valid, error,
       CASE WHEN error IS NULL THEN CAST(k AS INTEGER) END AS top_k
FROM (
  SELECT conv_id * 1000 + turn AS query_id, turn AS k,
         CASE WHEN text IS NULL THEN 'Query parameter is missing'
              WHEN regexp_replace(text, '^\s+|\s+$', '', 'g') = '' THEN 'Query is empty'
              WHEN length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 2 THEN 'Query too short'
              WHEN length(text) > 1000 THEN 'Query too long'
              WHEN turn < 1 OR turn > 100 THEN 'top_k must be between 1 and 100'
         END AS error
  FROM conversations)""",
    "spell_unknown": "WITH " + TFIDF + ",\n" + USER_SQ + "," + SPELL + "\nSELECT word FROM unknown",
    "spell_suggest": "WITH " + TFIDF + ",\n" + MISSPELLED_SQ + "," + SPELL
    + "\nSELECT word, rank, suggestion, distance FROM sug",
    "check_queries": "WITH " + TFIDF + ",\n" + MISSPELLED_SQ + "," + SPELL
    + "\nSELECT query_id, original, corrected, has_errors, misspelled_words, suggestions FROM chk",
    "search_with_spelling": search_sql(
        MISSPELLED_SQ + "," + SPELL + ",\nq AS (SELECT query_id, "
        "CASE WHEN has_errors THEN corrected ELSE original END AS query_text, 5 AS k FROM chk)", "k"),
    "page_titles": "WITH " + PAGE_DOCS + "\nSELECT page_id, title FROM ptitles",
    "page_documents": "WITH " + PAGE_DOCS + "\nSELECT page_id, content, n_chars, ok FROM pdocs",
    "page_links": "WITH " + PAGE_LINKS + "\nSELECT page_id, link FROM plinks",
    "link_domains": "WITH " + PAGE_LINKS + "\nSELECT " + _host("link") + """ AS host,
       count(*) AS n_links, count(DISTINCT page_id) AS n_pages FROM plinks GROUP BY host""",
    "traverse": "WITH RECURSIVE " + TRAVERSE + "\nSELECT crawl_id, page_id, url, depth, rank FROM visits",
    "crawl_stats": "WITH RECURSIVE " + TRAVERSE + "," + PAGE_DOCS + """,
per AS (SELECT crawl_id, count(*) AS n, count_if(ok) AS good FROM visits JOIN pdocs USING (page_id) GROUP BY crawl_id)
SELECT c.crawl_id, coalesce(n, 0) AS total_pages, CAST(coalesce(good, 0) AS BIGINT) AS successful_pages,
       CAST(coalesce(n - good, 0) AS BIGINT) AS failed_pages,
       format('{:.1f}%', CASE WHEN n > 0 THEN good * 100.0 / n ELSE 0.0 END) AS success_rate,
       CASE WHEN n >= 50 THEN 'closespider_pagecount' ELSE 'finished' END AS close_reason
FROM crawls c LEFT JOIN per USING (crawl_id)""",
    "knn_l2": KNN_L2,
    "word_mean_vectors": WORD_MEAN,
    "results_csv": search_sql(BENCH_QUERIES, 5).replace(
        "SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= k",
        "SELECT query_id, rank, doc_id AS document_id, format('{:.4f}', score) AS similarity_score "
        "FROM ranked WHERE rank <= k"),
    "health": "WITH " + TFIDF + r""",
dct AS (
  SELECT DISTINCT word FROM (
    SELECT unnest(""" + FALLBACK_LIST + r""") AS word UNION ALL SELECT lower(term) FROM vocab)
  WHERE word <> ''
)
SELECT 'healthy' AS status, (SELECT count(*) FROM corpus) AS documents_loaded, true AS index_ready,
       true AS spell_checker_ready, (SELECT count(*) FROM dct) AS vocabulary_size""",
    "corpus_ready": """
SELECT corpus_bytes, corpus_bytes >= 1000 AS ready,
       CASE WHEN n = 0 THEN 'corpus not found' WHEN corpus_bytes < 1000 THEN 'corpus too small' ELSE 'ok' END AS reason
FROM (SELECT count(*) AS n, CAST(coalesce(sum(strlen(text) + 2), 0) AS BIGINT) AS corpus_bytes FROM documents)""",
    "stream_queries": search_sql(BENCH_QUERIES, 5),
    "stream_pages": "WITH " + PAGE_DOCS + "\nSELECT page_id, content, n_chars, ok FROM pdocs",
    "index_stats": "WITH " + TFIDF + "," + POSTINGS_BODY + """
SELECT (SELECT count(DISTINCT term) FROM postings) AS total_terms,
       (SELECT count(*) FROM corpus) AS total_documents,
       (SELECT count(*) FROM vocab) AS vocabulary_size""",
}
