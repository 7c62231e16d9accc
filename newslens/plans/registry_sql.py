"""The registered queries as SQL for DuckDB, written independently of the operators.

Regular expressions here are RE2's: no back references and no look-ahead, so pages are
cut with one alternative per raw-text element.
"""

from __future__ import annotations

from newslens.sources.lexicon import SAMPLE

# Fixed values, written out here and not taken from the operators, so that a wrong one shows.
# The sample lexicon is data, as the tables are.
STOP_WORDS = ("the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "is", "are", "was", "were")
RUN_WINDOWS = 3
PLAIN, NEGATED = 1000, -500

# Fixed value: the characters Python takes for blank.
BLANKS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

ARTICLES = """
articles AS (
  SELECT doc_id AS raw_id, source, split_part(text, chr(10), 1) AS title, text AS content,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS "timestamp"
  FROM documents
)"""

FRAMED = """
framed AS (
  SELECT *, time_bucket(INTERVAL '15 minutes', "timestamp") AS window_start,
         time_bucket(INTERVAL '15 minutes', "timestamp") + INTERVAL '15 minutes' AS window_end
  FROM {source}
)"""

LEXICON = "lexicon(word, score, kind) AS (VALUES {})".format(
    ", ".join(f"('{w}', {s}, '{k}')" for w, s, k in SAMPLE)
)


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')"


def words_in(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '[^{BLANKS}]+')) AS INTEGER)"


def sentiment(source: str, key: str, modifiers: bool = True, threshold: int = 0) -> str:
    """CTEs ending in ``labels_of(key, sentiment)`` over ``source(key, content)``."""
    factor = (
        f"""coalesce(i1.score, {PLAIN}) * CASE WHEN n1.word IS NOT NULL
              OR (i1.word IS NOT NULL AND n2.word IS NOT NULL) THEN {NEGATED} ELSE {PLAIN} END"""
        if modifiers
        else f"{PLAIN * PLAIN}"
    )
    return f"""
{LEXICON},
tokens_of AS (
  SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT {key}, regexp_split_to_array(lower(content), '\\W+') AS ws FROM {source})
),
near AS (
  SELECT {key}, w, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2
  FROM tokens_of WINDOW o AS (PARTITION BY {key} ORDER BY i)
),
sums AS (
  SELECT {key}, sum(p.score * {factor}) AS total, count(*) AS hits
  FROM near JOIN lexicon p ON p.word = w AND p.kind = 'polar'
  LEFT JOIN lexicon i1 ON i1.word = w1 AND i1.kind = 'intensifier'
  LEFT JOIN lexicon n1 ON n1.word = w1 AND n1.kind = 'negator'
  LEFT JOIN lexicon n2 ON n2.word = w2 AND n2.kind = 'negator'
  GROUP BY {key}
),
labels_of AS (
  SELECT a.{key}, CASE WHEN total > hits * {threshold * PLAIN * PLAIN} THEN 'positive'
              WHEN total < -hits * {threshold * PLAIN * PLAIN} THEN 'negative'
              ELSE 'neutral' END AS sentiment
  FROM {source} a LEFT JOIN sums s ON s.{key} = a.{key}
)"""


SCORED = (
    ARTICLES
    + ","
    + sentiment("articles", "raw_id")
    + """,
scored AS (SELECT a.*, l.sentiment FROM articles a JOIN labels_of l ON l.raw_id = a.raw_id)"""
)


def long_words(source: str, by: str = "") -> str:
    return f"""(SELECT {by} word FROM (
      SELECT {by} unnest(regexp_split_to_array(lower(content), '\\W+')) AS word FROM {source})
    WHERE length(word) > 3 AND regexp_full_match(word, '[a-zA-Z]+'))"""


def all_words(source: str) -> str:
    return f"""(SELECT word FROM (
      SELECT unnest(regexp_split_to_array(content, '\\W+')) AS word FROM {source})
    WHERE word <> '')"""


WORD_COUNTS = f"SELECT word, count(*) AS count FROM {long_words('articles')} GROUP BY word"
WORD_COUNTS_BATCH = f"SELECT word, count(*) AS count FROM {all_words('articles')} GROUP BY word"
TOP = "ORDER BY count DESC, word LIMIT {}"

BATCH_REPORT = f"""
report AS (
  SELECT 'word_counts_batch' AS metric_name, word AS key, count, CAST(NULL AS BIGINT) AS total_length
  FROM ({WORD_COUNTS_BATCH} {TOP.format(5)})
  UNION ALL
  SELECT 'sentiment_distribution_batch', sentiment, count(*), NULL FROM scored GROUP BY sentiment
  UNION ALL
  SELECT 'source_statistics_batch', source, count(*), CAST(sum(length(content)) AS BIGINT)
  FROM scored GROUP BY source
)"""

WINDOW_REPORT = (
    FRAMED.format(source="scored")
    + f""",
ranked AS (
  SELECT window_start, window_end, word, count,
         row_number() OVER (PARTITION BY window_start ORDER BY count DESC, word) AS rank
  FROM (SELECT window_start, window_end, word, count(*) AS count
        FROM {long_words('framed', 'window_start, window_end,')} GROUP BY ALL)
),
report AS (
  SELECT window_start, window_end, 'word_counts' AS metric_name, word AS key, count,
         CAST(NULL AS BIGINT) AS total_length
  FROM ranked WHERE rank <= 10
  UNION ALL
  SELECT window_start, window_end, 'sentiment_distribution', sentiment, count(*), NULL
  FROM framed GROUP BY ALL
  UNION ALL
  SELECT window_start, window_end, 'source_statistics', source, count(*),
         CAST(sum(length(content)) AS BIGINT)
  FROM framed GROUP BY ALL
)"""
)


def metric_rows(kind: str) -> str:
    return f"""
metric_rows AS (
  SELECT window_start, window_end, metric_name,
         to_json(list({{'word': key, 'count': count}} ORDER BY count DESC, key))::VARCHAR AS metric_value,
         '{kind}' AS processing_type
  FROM report WHERE metric_name LIKE 'word%' GROUP BY ALL
  UNION ALL
  SELECT window_start, window_end, metric_name,
         to_json(list({{'sentiment': key, 'count': count}} ORDER BY key))::VARCHAR, '{kind}'
  FROM report WHERE metric_name LIKE 'sentiment%' GROUP BY ALL
  UNION ALL
  SELECT window_start, window_end, metric_name,
         to_json(list({{'source': key, 'count': count, 'total_length': total_length}} ORDER BY key))::VARCHAR,
         '{kind}'
  FROM report WHERE metric_name LIKE 'source%' GROUP BY ALL
)"""


RUNS = """
runs AS (
  SELECT 'streaming' AS processing_type, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n
  FROM events GROUP BY time_bucket(INTERVAL '15 minutes', ts)
  UNION ALL
  SELECT 'batch', min(ts), max(ts), count(*) FROM events GROUP BY date_trunc('day', ts)
),
timed AS (
  SELECT *, CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000 AS seconds FROM runs
),
timing AS (
  SELECT processing_type, start_time, end_time, seconds AS processing_duration_seconds,
         n AS records_processed,
         CASE WHEN seconds > 0 THEN CAST(n AS DOUBLE) / seconds ELSE 0.0 END AS records_per_second
  FROM timed
)"""


# Pages


def entities(text: str) -> str:
    """The character references that occur in the test pages; the ampersand comes last."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


TOKENS = r"""
tokens AS (
  SELECT page_id, unnest(ts) AS token, CAST(generate_subscripts(ts, 1) - 1 AS INTEGER) AS pos
  FROM (SELECT page_id, regexp_extract_all(html,
    '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<title\b[^>]*>.*?</title\s*>|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<') AS ts
    FROM pages)
),
named AS (
  SELECT *, lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1)) AS tag FROM tokens
),
tag_events AS (
  SELECT page_id, pos, tag, token,
    CASE WHEN token LIKE '<!%' OR token LIKE '<?%' THEN 'comment'
         WHEN tag = '' THEN 'text'
         WHEN tag IN ('script', 'style', 'title') THEN 'raw'
         WHEN token LIKE '</%' THEN 'close'
         WHEN tag IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta',
                      'param', 'source', 'track', 'wbr') OR token LIKE '%/>' THEN 'void'
         ELSE 'open' END AS kind
  FROM named
)"""

BODY = (
    TOKENS
    + r""",
body AS (
  SELECT e.* FROM tag_events e
  JOIN (SELECT page_id, min(pos) AS start FROM tag_events WHERE tag = 'body' AND kind = 'open'
        GROUP BY page_id) b ON b.page_id = e.page_id AND e.pos > b.start
),
nested AS (
  SELECT *, sum(CASE kind WHEN 'open' THEN 1 ELSE -1 END)
              OVER (PARTITION BY page_id, tag ORDER BY pos) AS depth
  FROM body WHERE kind IN ('open', 'close')
),
spans AS (
  SELECT o.page_id, o.tag, o.token, o.pos AS first, coalesce(min(c.pos), 1000000000) AS last,
    o.tag IN ('aside', 'nav', 'footer')
      OR (o.tag = 'div' AND regexp_matches(regexp_extract(o.token, '(?s)\s(?i:class)\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1),
            'ad|ads|sponsored|promo|related|recommendation|footer'))
      OR (o.tag = 'section' AND regexp_matches(regexp_extract(o.token, '(?s)\s(?i:class)\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1),
            'related|recommendations'))
      OR regexp_matches(o.token, '(?i:style)\s*=.*display:\s?none') AS removed
  FROM nested o LEFT JOIN nested c
    ON c.page_id = o.page_id AND c.tag = o.tag AND c.kind = 'close' AND c.pos > o.pos
       AND c.depth = o.depth - 1
  WHERE o.kind = 'open'
  GROUP BY o.page_id, o.tag, o.token, o.pos
),
gone AS (SELECT * FROM spans WHERE removed),
kept AS (
  SELECT b.* FROM body b
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.page_id = b.page_id AND b.pos BETWEEN g.first AND g.last)
),
article AS (
  SELECT s.page_id, min(s.first) AS first, min_by(s.last, s.first) AS last
  FROM spans s JOIN kept k ON k.page_id = s.page_id AND k.pos = s.first
  WHERE s.tag = 'article' GROUP BY s.page_id
),
pieces AS (
  SELECT k.page_id, k.pos, """
    + entities("k.token")
    + r""" AS piece
  FROM kept k JOIN article a ON a.page_id = k.page_id AND k.pos > a.first AND k.pos < a.last
  WHERE k.kind = 'text'
),
marked AS (
  SELECT p.*, min(CASE WHEN contains(piece, 'End of Article') THEN pos END)
                OVER (PARTITION BY page_id) AS marker
  FROM pieces p
),
article_texts AS (
  SELECT page_id, string_agg(s, ' ' ORDER BY pos) AS text
  FROM (SELECT page_id, pos, """
    + strip("piece")
    + r""" AS s FROM marked WHERE marker IS NULL OR pos < marker)
  WHERE s <> '' GROUP BY page_id
),
titles AS (
  SELECT page_id, regexp_replace(
    split_part(split_part("""
    + entities(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")
    + rf""", '_', 1), '|', 1),
    '<[\s\S]*?>|[\t\r\f\x{{0B}}]|^[{BLANKS}]+|[{BLANKS}]+$', '', 'g') AS title
  FROM pages
),
extracted AS (
  SELECT p.page_id, p.url, t.title, coalesce(a.text, '') AS content
  FROM pages p JOIN titles t ON t.page_id = p.page_id LEFT JOIN article_texts a ON a.page_id = p.page_id
)"""
)

FEED = r"""
feed AS (
  SELECT e.page_id, e.url, e.title,
    CASE regexp_extract(e.url, '^https?://[^/]*\.([a-z]+)(?:[/?#]|$)', 1)
      WHEN 'com' THEN 'BBC' WHEN 'net' THEN 'Guardian' ELSE 'Reuters' END AS source
  FROM (SELECT p.page_id, p.url, t.title FROM pages p JOIN titles t ON t.page_id = p.page_id) e
),
raw AS (SELECT page_id, md5(concat_ws('|', source, url, page_id)) AS id, source, title, url FROM feed)"""

ROUTED = """
routed AS (
  SELECT page_id, CASE source WHEN 'BBC' THEN 'bbc_news' WHEN 'Guardian' THEN 'guardian_news'
                  ELSE 'reuters_news' END AS topic,
         to_json({'source': source, 'title': title, 'url': url})::VARCHAR AS value
  FROM feed
)"""

PROCESSED = (
    BODY
    + ","
    + FEED
    + """,
accepted AS (
  SELECT r.id AS raw_article_id, r.source, e.title, e.content
  FROM raw r JOIN extracted e ON e.page_id = r.page_id WHERE e.title <> '' AND e.content <> ''
),"""
    + sentiment("accepted", "raw_article_id")
    + f""",
processed AS (
  SELECT md5('processed|' || a.raw_article_id) AS id, a.raw_article_id, a.source, a.title, a.content,
         l.sentiment, {words_in('a.content')} AS word_count
  FROM accepted a JOIN labels_of l ON l.raw_article_id = a.raw_article_id
)"""
)

RAW_DOCUMENTS = """
raw_documents AS (
  SELECT raw_id AS id, source, title, 'doc:' || raw_id AS url FROM articles
)"""

CLOSERS = """('address', 'article', 'aside', 'blockquote', 'center', 'details', 'dialog', 'dir',
  'div', 'dl', 'fieldset', 'figcaption', 'figure', 'footer', 'form', 'h1', 'h2', 'h3', 'h4', 'h5',
  'h6', 'header', 'hgroup', 'main', 'menu', 'nav', 'ol', 'p', 'pre', 'section', 'summary', 'table',
  'ul')"""

TEXT_BLOCKS = f"""
blocks AS (
  SELECT k.page_id, k.tag, k.pos AS first,
    (SELECT min(n.pos) FROM body n WHERE n.page_id = k.page_id AND n.pos > k.pos AND (
       (n.tag = k.tag AND n.kind = 'close')
       OR (k.tag = 'p' AND n.kind = 'open' AND n.tag IN {CLOSERS})
       OR (n.kind = 'close' AND n.tag = 'article'))) AS last
  FROM kept k WHERE k.kind = 'open' AND k.tag IN ('p', 'div')
),
seen AS (
  SELECT * FROM kept k
  WHERE kind NOT IN ('comment', 'raw') AND tag NOT IN ('img', 'body', 'html')
    AND NOT EXISTS (SELECT 1 FROM spans s WHERE s.page_id = k.page_id
                    AND s.tag IN ('a', 'noscript') AND k.pos BETWEEN s.first AND s.last)
),
markup AS (
  SELECT b.page_id, b.tag, b.first,
    '<' || b.tag || '>' || coalesce(string_agg(s.token, '' ORDER BY s.pos), '') || '</' || b.tag || '>' AS html
  FROM blocks b LEFT JOIN seen s ON s.page_id = b.page_id AND s.pos > b.first AND s.pos < b.last
  GROUP BY b.page_id, b.tag, b.first
),
whole AS (
  SELECT page_id, '<body>' || string_agg(token, '' ORDER BY pos) || '</body>' AS html
  FROM seen GROUP BY page_id
),
limits AS (
  SELECT page_id, CAST(length(regexp_replace(bare, '</?\\w+[^>]*>|[\\s\\x{{0B}}]', '', 'g')) AS DOUBLE) / length(bare) AS ratio
  FROM (SELECT *, regexp_replace(html, '\\s*[^=\\s+]+\\s*=\\s*(?:[^=>]*(>)|[^=>]*(\\s))', '\\1\\2', 'g') AS bare FROM whole)
),
ratios AS (
  SELECT *, CAST(length(regexp_replace(bare, '</?\\w+[^>]*>|[\\s\\x{{0B}}]', '', 'g')) AS DOUBLE) / length(bare) AS ratio
  FROM (SELECT *, regexp_replace(html, '\\s*[^=\\s+]+\\s*=\\s*(?:[^=>]*(>)|[^=>]*(\\s))', '\\1\\2', 'g') AS bare FROM markup)
),
texts AS (
  SELECT b.page_id, b.first, string_agg(x.s, ' ' ORDER BY x.pos) AS text
  FROM blocks b JOIN (SELECT page_id, pos, {strip(entities('token'))} AS s FROM kept WHERE kind = 'text') x
    ON x.page_id = b.page_id AND x.pos > b.first AND x.pos < b.last AND x.s <> ''
  GROUP BY b.page_id, b.first
)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def stop_list() -> str:
    return ", ".join(f"'{w}'" for w in STOP_WORDS)


SQL: dict[str, str] = {
    "article_count": "SELECT count(*) AS article_count FROM documents",
    "article_preview": "SELECT doc_id AS raw_id, substring(text, 1, 200) AS preview FROM documents",
    "batch_metric_rows": with_(
        SCORED
        + ","
        + BATCH_REPORT
        + """, stamped AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS window_start,
             TIMESTAMP '2024-01-01 00:00:00' AS window_end FROM report),"""
        + metric_rows("batch").replace("FROM report", "FROM stamped"),
        "SELECT * FROM metric_rows",
    ),
    "batch_report": with_(SCORED + "," + BATCH_REPORT, "SELECT * FROM report"),
    "batch_report_incremental": with_(SCORED + "," + BATCH_REPORT, "SELECT * FROM report"),
    "cascade_delete": with_(
        ARTICLES + "," + RAW_DOCUMENTS,
        """SELECT id AS raw_article_id, source, title, url FROM raw_documents
           WHERE id IN (SELECT doc_id FROM labels)""",
    ),
    "compare_performance": with_(
        RUNS,
        """SELECT processing_type,
          round(CAST(sum(CAST(processing_duration_seconds AS DECIMAL(20,6))) AS DOUBLE) / count(*), 4) AS avg_duration,
          round(CAST(sum(CAST(records_per_second AS DECIMAL(20,6))) AS DOUBLE) / count(*), 4) AS avg_throughput,
          max(records_per_second) AS max_throughput, min(records_per_second) AS min_throughput,
          count(*) AS num_executions
        FROM timing GROUP BY processing_type""",
    ),
    "conform_schema": with_(
        ARTICLES,
        """SELECT CAST(NULL AS VARCHAR) AS id, CAST(raw_id AS VARCHAR) AS raw_article_id, source, title,
          content, CAST(NULL AS VARCHAR) AS sentiment, CAST(NULL AS INTEGER) AS word_count,
          CAST(NULL AS TIMESTAMP) AS processed_at, "timestamp" FROM articles""",
    ),
    "decode_messages": with_(
        ARTICLES, "SELECT CAST(raw_id AS BIGINT) AS raw_id, source, title, content FROM articles"
    ),
    "encode_messages": with_(
        ARTICLES,
        """SELECT raw_id, to_json({'raw_id': raw_id, 'source': source, 'title': title,
             'content': content})::VARCHAR AS value FROM articles""",
    ),
    "extract_accepted": with_(
        BODY, "SELECT page_id, title, content FROM extracted WHERE title <> '' AND content <> ''"
    ),
    "extract_rejected": with_(
        BODY, "SELECT page_id, title, content FROM extracted WHERE title = '' OR content = ''"
    ),
    "feed_json_api": with_(BODY + "," + FEED, "SELECT 'Guardian' AS source, title, url FROM feed"),
    "feed_stream_paged": with_(BODY + "," + FEED, "SELECT 'Guardian' AS source, title, url FROM feed"),
    "feed_rss": with_(BODY + "," + FEED, "SELECT 'BBC' AS source, title, url FROM feed"),
    "filter_links": with_(
        BODY + "," + FEED, "SELECT title, url FROM feed WHERE url NOT LIKE '%/videos%'"
    ),
    "filter_since": with_(
        ARTICLES,
        """SELECT raw_id, "timestamp" FROM articles
           WHERE "timestamp" >= TIMESTAMP '2024-01-01 00:45:00'""",
    ),
    "fk_orphans": with_(
        ARTICLES + "," + RAW_DOCUMENTS,
        """SELECT id AS raw_article_id, source, title, url FROM raw_documents
           WHERE id NOT IN (SELECT doc_id FROM labels)""",
    ),
    "merge_topics": with_(BODY + "," + FEED + "," + ROUTED, "SELECT topic, value FROM routed"),
    "metrics_one_scan": with_(
        SCORED,
        """SELECT 'sentiment_distribution' AS metric_name, sentiment AS key, count(*) AS count,
             CAST(NULL AS BIGINT) AS total_length FROM scored GROUP BY sentiment
           UNION ALL
           SELECT 'source_statistics', source, count(*), CAST(sum(length(content)) AS BIGINT)
           FROM scored GROUP BY source""",
    ),
    "next_minute": """SELECT event_id, date_trunc('minute', ts) + INTERVAL '1 minute' AS next_minute
      FROM events""",
    "page_articles": with_(BODY, "SELECT page_id, title, content FROM extracted"),
    "page_clean_text": with_(
        BODY,
        f"""SELECT p.page_id, coalesce(t.text, '') AS text FROM pages p LEFT JOIN (
              SELECT page_id, string_agg(s, ' ' ORDER BY pos) AS text FROM (
                SELECT page_id, pos, {strip(entities('token'))} AS s FROM kept WHERE kind = 'text')
              WHERE s <> '' GROUP BY page_id) t ON t.page_id = p.page_id""",
    ),
    "page_end_marker": with_(
        BODY,
        """SELECT p.page_id, CAST(count(m.pos) AS INTEGER) AS pieces,
             CAST(count(CASE WHEN m.marker IS NULL OR m.pos < m.marker THEN m.pos END) AS INTEGER) AS kept
           FROM pages p LEFT JOIN marked m ON m.page_id = p.page_id GROUP BY p.page_id""",
    ),
    "page_hidden_removed": with_(
        BODY
        + """,
outer_gone AS (
  SELECT * FROM gone g WHERE NOT EXISTS (SELECT 1 FROM gone o WHERE o.page_id = g.page_id
                                         AND g.first > o.first AND g.first < o.last)
)""",
        """SELECT p.page_id, CAST(count(g.first) AS INTEGER) AS removed,
             CAST(count(CASE WHEN regexp_matches(g.token, '(?i:style)\\s*=.*display:\\s?none') THEN 1 END)
                  AS INTEGER) AS hidden,
             CAST(coalesce(sum(g.last - g.first + 1), 0) AS INTEGER) AS tokens
           FROM pages p LEFT JOIN outer_gone g ON g.page_id = p.page_id GROUP BY p.page_id""",
    ),
    "page_tag_events": with_(TOKENS, "SELECT page_id, pos, kind, tag, token FROM tag_events"),
    "page_text_blocks": with_(
        BODY + "," + TEXT_BLOCKS,
        """SELECT r.page_id, CAST(row_number() OVER (PARTITION BY r.page_id ORDER BY r.first) AS INTEGER) AS block,
             r.tag, round(r.ratio, 6) AS ratio, r.ratio >= l.ratio AS dense, coalesce(t.text, '') AS text
           FROM ratios r JOIN limits l ON l.page_id = r.page_id
           LEFT JOIN texts t ON t.page_id = r.page_id AND t.first = r.first""",
    ),
    "page_titles": with_(BODY, "SELECT page_id, title FROM titles"),
    "parse_envelope": with_(
        ARTICLES,
        """SELECT CAST(raw_id AS BIGINT) AS raw_id, source, title, content, "timestamp"
           FROM articles""",
    ),
    "processed_articles": with_(PROCESSED, "SELECT * FROM processed"),
    "raw_articles": with_(BODY + "," + FEED, "SELECT id, source, title, url FROM raw"),
    "raw_with_processed": with_(
        ARTICLES + "," + RAW_DOCUMENTS,
        """SELECT l.doc_id AS raw_article_id, r.url, l.quality, l.toxic
           FROM raw_documents r JOIN labels l ON l.doc_id = r.id""",
    ),
    "recent_metrics": with_(
        SCORED + "," + WINDOW_REPORT + "," + metric_rows("streaming"),
        """SELECT metric_name, metric_value, window_start, window_end FROM metric_rows
           ORDER BY window_start DESC, metric_name LIMIT 3""",
    ),
    "rollup_sentiment": with_(
        SCORED + "," + WINDOW_REPORT,
        """SELECT key AS sentiment, CAST(sum(count) AS BIGINT) AS count,
             round(CAST(100 AS DOUBLE) * sum(count) / sum(sum(count)) OVER (), 1) AS share
           FROM report WHERE metric_name = 'sentiment_distribution' GROUP BY key""",
    ),
    "rollup_sources": with_(
        SCORED + "," + WINDOW_REPORT,
        """SELECT key AS source, CAST(sum(count) AS BIGINT) AS article_count,
             CAST(sum(total_length) AS BIGINT) AS total_length,
             round(CAST(sum(total_length) AS DOUBLE) / sum(count), 0) AS avg_length
           FROM report WHERE metric_name = 'source_statistics' GROUP BY key""",
    ),
    "rollup_top_words": with_(
        SCORED + "," + WINDOW_REPORT,
        """SELECT key AS word, CAST(sum(count) AS BIGINT) AS count FROM report
           WHERE metric_name = 'word_counts' GROUP BY key ORDER BY count DESC, word LIMIT 10""",
    ),
    "rollup_words": with_(
        SCORED + "," + WINDOW_REPORT,
        """SELECT key AS word, CAST(sum(count) AS BIGINT) AS count FROM report
           WHERE metric_name = 'word_counts' GROUP BY key""",
    ),
    "route_topics": with_(BODY + "," + FEED + "," + ROUTED, "SELECT page_id, topic, value FROM routed"),
    "scan_processed": with_(ARTICLES, "SELECT source, title, content FROM articles"),
    "schema_gaps": with_(
        ARTICLES,
        """SELECT * FROM (
             SELECT 'raw_articles' AS table_name, 'content' AS column_name, 'missing' AS issue,
                    count(*) AS rows FROM pages
             UNION ALL SELECT 'raw_articles', 'received_at', 'missing', count(*) FROM pages
             UNION ALL SELECT 'processed_articles', 'sentiment', 'missing', count(*) FROM articles
             UNION ALL SELECT 'processed_articles', 'processed_at', 'missing', count(*) FROM articles
             UNION ALL SELECT 'processed_articles', 'title', 'null', count(*) FROM articles
                       WHERE title = content)
           WHERE issue = 'missing' OR rows > 0
           UNION ALL SELECT 'new_articles', unnest(['raw_article_id', 'title', 'content', 'sentiment',
             'word_count', 'processed_at']), 'missing', 0
           UNION ALL SELECT 'analytics_results', NULL, 'absent', 0""",
    ),
    "scraped_messages": with_(
        PROCESSED,
        """SELECT 'scraped_articles' AS topic, to_json({'raw_id': raw_article_id, 'source': source,
             'title': title, 'content': content})::VARCHAR AS value FROM processed""",
    ),
    "sentiment_custom_scorer": """
      SELECT doc_id AS raw_id, CASE WHEN x > q THEN 'positive' WHEN x < q THEN 'negative'
               ELSE 'neutral' END AS sentiment
      FROM (SELECT doc_id, length(text) - length(replace(text, '!', '')) AS x,
                   length(text) - length(replace(text, '?', '')) AS q FROM documents)""",
    "sentiment_distribution": with_(
        SCORED, "SELECT sentiment, count(*) AS count FROM scored GROUP BY sentiment"
    ),
    "sentiment_lexicon": with_(
        ARTICLES + "," + sentiment("articles", "raw_id", modifiers=False),
        "SELECT raw_id, sentiment FROM labels_of",
    ),
    "sentiment_lexicon_join": with_(SCORED, "SELECT raw_id, sentiment FROM scored"),
    "sentiment_negation": with_(SCORED, "SELECT raw_id, sentiment FROM scored"),
    "sentiment_per_window": with_(
        SCORED + "," + FRAMED.format(source="scored"),
        "SELECT window_start, sentiment, count(*) AS count FROM framed GROUP BY ALL",
    ),
    "sentiment_share": with_(
        SCORED,
        """SELECT sentiment, count(*) AS count,
             round(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS share
           FROM scored GROUP BY sentiment""",
    ),
    "sentiment_threshold": with_(
        ARTICLES + "," + sentiment("articles", "raw_id", threshold=100),
        "SELECT raw_id, sentiment FROM labels_of",
    ),
    "source_avg_length": """SELECT source, round(CAST(sum(length(text)) AS DOUBLE) / count(*), 0) AS avg_length
      FROM documents GROUP BY source""",
    "source_statistics": """SELECT source, count(*) AS article_count,
        CAST(sum(length(text)) AS BIGINT) AS total_length FROM documents GROUP BY source""",
    "source_stats_per_window": with_(
        ARTICLES + "," + FRAMED.format(source="articles"),
        """SELECT window_start, source, count(*) AS article_count,
             CAST(sum(length(content)) AS BIGINT) AS total_length FROM framed GROUP BY ALL""",
    ),
    "stream_ingest": with_(
        SCORED,
        f"""SELECT CAST(raw_id AS BIGINT) AS raw_id, source, "timestamp", sentiment,
              {words_in('content')} AS word_count FROM scored""",
    ),
    "stream_metric_rows": with_(
        SCORED + "," + WINDOW_REPORT + "," + metric_rows("streaming"),
        "SELECT * FROM metric_rows",
    ),
    "stream_distinct_articles": with_(
        BODY + "," + FEED,
        "SELECT source, min(title) AS title, url FROM feed GROUP BY source, url",
    ),
    "stream_late_pages": with_(
        PROCESSED,
        """SELECT r.id AS raw_article_id, r.source,
             CASE WHEN p.id IS NULL OR r.page_id % 5 = 4 THEN 'rejected' ELSE 'processed' END AS outcome,
             CASE WHEN r.page_id % 5 <> 4 THEN p.word_count END AS word_count
           FROM raw r LEFT JOIN processed p ON p.raw_article_id = r.id""",
    ),
    "stream_late_counts": with_(
        ARTICLES
        + """,
        sent AS (
          SELECT "timestamp" AS sent_at, time_bucket(INTERVAL '15 minutes', "timestamp") AS window_start,
            epoch_us("timestamp" - TIMESTAMP '2024-01-01 00:00:00') AS since,
            (SELECT epoch_us(max("timestamp") - TIMESTAMP '2024-01-01 00:00:00') / 3 FROM articles) AS third
          FROM articles
        ),
        parted AS (
          SELECT *, CASE WHEN since / third < 1 AND epoch_us(sent_at) % 660000000 = 0 THEN 2
            WHEN since / third < 1 THEN 0 WHEN since / third < 2 THEN 1 ELSE 2 END AS part FROM sent
        ),
        marks AS (
          SELECT p.part, (SELECT max(sent_at) - INTERVAL '10 minutes' FROM parted b WHERE b.part < p.part) AS mark
          FROM (SELECT DISTINCT part FROM parted) p
        )""",
        """SELECT window_start, window_start + INTERVAL '15 minutes' AS window_end, CAST(count(*) AS BIGINT) AS count
           FROM parted JOIN marks USING (part) WHERE window_start + INTERVAL '15 minutes' <= mark
           GROUP BY window_start""",
    ),
    "rollup_top_words_exact": with_(ARTICLES, f"{WORD_COUNTS} {TOP.format(10)}"),
    "stream_metric_rows_partial": with_(
        SCORED + "," + WINDOW_REPORT + "," + metric_rows("streaming"),
        "SELECT * FROM metric_rows",
    ),
    "stream_from_ingest": with_(
        PROCESSED, "SELECT sentiment, CAST(count(*) AS BIGINT) AS count FROM processed GROUP BY sentiment"
    ),
    "stream_three_windows": with_(
        SCORED + "," + WINDOW_REPORT + "," + metric_rows("streaming"),
        """SELECT window_start, window_end, metric_name, metric_value FROM metric_rows
           WHERE window_start >= TIMESTAMP '2024-01-01 01:00:00'
             AND window_start < TIMESTAMP '2024-01-01 01:45:00'""",
    ),
    "stream_report": with_(
        SCORED + "," + WINDOW_REPORT,
        "SELECT window_start, metric_name, key, count, total_length FROM report",
    ),
    "three_windows": with_(
        SCORED,
        f"""SELECT CAST(i // {RUN_WINDOWS} + 1 AS INTEGER) AS run,
              CAST(i % {RUN_WINDOWS} + 1 AS INTEGER) AS window_no, sentiment, count(*) AS count
            FROM (SELECT sentiment, CAST(floor(epoch("timestamp" - TIMESTAMP '2024-01-01 00:00:00') / 900)
                         AS INTEGER) AS i FROM scored)
            GROUP BY ALL""",
    ),
    "throughput": """
      SELECT event_type, seconds,
             CASE WHEN seconds > 0 THEN CAST(n AS DOUBLE) / seconds ELSE 0.0 END AS records_per_second
      FROM (SELECT event_type, count(*) AS n,
                   CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000 AS seconds
            FROM events GROUP BY event_type)""",
    "timing_metrics": with_(RUNS, "SELECT * FROM timing"),
    "top_words": with_(ARTICLES, f"{WORD_COUNTS} {TOP.format(10)}"),
    "top_words_batch": with_(ARTICLES, f"{WORD_COUNTS_BATCH} {TOP.format(5)}"),
    "top_words_overall": with_(ARTICLES, f"{WORD_COUNTS} {TOP.format(10)}"),
    "top_words_per_window": with_(
        ARTICLES + "," + FRAMED.format(source="articles"),
        f"""SELECT window_start, word, count, CAST(rank AS INTEGER) AS rank FROM (
              SELECT window_start, word, count,
                     row_number() OVER (PARTITION BY window_start ORDER BY count DESC, word) AS rank
              FROM (SELECT window_start, word, count(*) AS count
                    FROM {long_words('framed', 'window_start,')} GROUP BY ALL))
            WHERE rank <= 10""",
    ),
    "tumbling_counts": """
      SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
             time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' AS window_end,
             count(*) AS count
      FROM events GROUP BY ALL""",
    "unprocessed_raw": with_(
        ARTICLES + "," + RAW_DOCUMENTS,
        """SELECT id, source, title, url FROM raw_documents
           WHERE id NOT IN (SELECT doc_id FROM labels)""",
    ),
    "word_count": f"SELECT doc_id AS raw_id, {words_in('text')} AS word_count FROM documents",
    "word_counts": with_(ARTICLES, WORD_COUNTS),
    "word_counts_batch": with_(ARTICLES, WORD_COUNTS_BATCH),
    "word_counts_stopwords": with_(
        ARTICLES,
        f"""SELECT word, count(*) AS count FROM (
              SELECT lower(unnest(regexp_split_to_array(content, '\\W+'))) AS word FROM articles)
            WHERE word <> '' AND word NOT IN ({stop_list()}) GROUP BY word""",
    ),
}

# The same checks over pages turned into cases that the table does not hold.
VARIED = """
pages AS (
  SELECT page_id, CASE WHEN page_id % 6 = 5 THEN url || '/videos/1' ELSE url END AS url,
    CASE page_id % 6
      WHEN 1 THEN '<html><head></head><body></body></html>'
      WHEN 2 THEN replace(html, '<article>', '<article><p style="display: none">unseen words</p>')
      WHEN 3 THEN replace(html, '</article>', '<p>End of Article</p><p>left out</p></article>')
      ELSE html END AS html
  FROM pages
),"""

SQL.update(
    {
        varied: "WITH " + VARIED + SQL[plain].removeprefix("WITH ")
        for varied, plain in (
            ("varied_rejected", "extract_rejected"),
            ("varied_end_marker", "page_end_marker"),
            ("varied_hidden", "page_hidden_removed"),
            ("varied_links", "filter_links"),
        )
    }
)
SQL["varied_headings"] = with_(
    """
pages AS (
  SELECT page_id, url, CASE page_id % 4
      WHEN 1 THEN replace(html, '<article>', '<h2>Heading &amp; more ' || page_id || '</h2><article>')
      WHEN 2 THEN replace(html, '<article>', '<h1>Old</h1><h3>First ' || page_id || '</h3><h1></h1><article>')
      WHEN 3 THEN replace(html, '</article>', '</article><h1>After</h1>')
      ELSE html END AS html
  FROM pages
),"""
    + BODY,
    """SELECT e.page_id, CASE WHEN a.page_id IS NOT NULL AND e.page_id % 4 = 1 THEN 'Heading & more ' || e.page_id
         WHEN a.page_id IS NOT NULL AND e.page_id % 4 = 2 THEN 'First ' || e.page_id ELSE e.title END AS title
       FROM extracted e LEFT JOIN article a ON a.page_id = e.page_id""",
)
SQL["varied_blocks"] = with_(
    """
pages AS (
  SELECT page_id, url, replace(replace(html, '<article>', '<div>'), '</article>', '</div>') AS html
  FROM pages WHERE page_id % 3 = 0
),"""
    + BODY
    + ","
    + TEXT_BLOCKS.replace("n.tag = 'article'", "n.tag IN ('article', 'div')")
    + """,
chosen AS (
  SELECT b.page_id, b.first, coalesce(b.last, 1000000000) AS last FROM blocks b
  JOIN ratios r ON r.page_id = b.page_id AND r.first = b.first JOIN limits l ON l.page_id = b.page_id
  WHERE r.ratio >= l.ratio
  UNION ALL
  SELECT page_id, -1, 1000000000 FROM limits l WHERE NOT EXISTS (
    SELECT 1 FROM ratios r WHERE r.page_id = l.page_id AND r.ratio >= l.ratio)
)""",
    f"""SELECT p.page_id, coalesce(t.text, '') AS content FROM pages p LEFT JOIN (
          SELECT page_id, string_agg(s, ' ' ORDER BY pos) AS text FROM (
            SELECT k.page_id, k.pos, {strip(entities('k.token'))} AS s FROM kept k WHERE k.kind = 'text'
              AND EXISTS (SELECT 1 FROM chosen c WHERE c.page_id = k.page_id AND k.pos > c.first AND k.pos < c.last))
          WHERE s <> '' GROUP BY page_id) t ON t.page_id = p.page_id""",
)
SQL["varied_cascade"] = with_(BODY, "SELECT page_id, title, content FROM extracted")
SQL["feed_without_results"] = with_(
    BODY + "," + FEED, "SELECT 'Guardian' AS source, title, url FROM feed WHERE page_id // 10 % 3 <> 0"
)
SQL["sentiment_without_text"] = with_(
    SCORED, "SELECT raw_id, CASE WHEN raw_id % 5 IN (0, 1) THEN 'neutral' ELSE sentiment END AS sentiment FROM scored"
)
SQL["window_clock"] = """
  SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
         strftime(time_bucket(INTERVAL '15 minutes', ts), '%H:%M') || '-'
           || strftime(time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes', '%H:%M') AS label,
         count(*) AS count
  FROM events GROUP BY ALL"""
SQL["varied_articles"] = with_(
    VARIED + BODY, "SELECT page_id, title, regexp_replace(content, ' +', ' ', 'g') AS content FROM extracted"
)
