"""Independent SQL (DuckDB dialect) for every query in ``shoprank.plans.registry``.

Written from the query semantics, not from the Spark plans. The mapping of test tables
is the same rule as ``shoprank.sources.testdata``. Float results are rounded to 6
places on both sides; ranks are computed on exact values with product-id tie-breaks.
"""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS productId,
         CAST((CAST(l.l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE) AS score,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS INTEGER) AS productId, p_name AS name, '' AS imageUrl,
         concat_ws('|', p_type, p_brand) AS categories,
         concat_ws('|', replace(p_name, ' ', '|'), p_brand, p_type) AS tags
  FROM part)"""

AVERAGES = """averages AS (
  SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)"""

EVENTS = """rating_events AS (
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
         CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events WHERE event_type = 'purchase')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _ym(col: str) -> str:
    return f"CAST(year(make_timestamp({col} * 1000000)) * 100 + month(make_timestamp({col} * 1000000)) AS INTEGER)"


SQL: dict[str, str] = {}

SQL["rate_more_products"] = with_(RATINGS) + """
SELECT productId, count(productId) AS count FROM ratings GROUP BY productId"""

SQL["rate_more_recently"] = with_(RATINGS) + f"""
SELECT productId, count(productId) AS count, {_ym('ts')} AS yearmonth
FROM ratings GROUP BY {_ym('ts')}, productId"""

SQL["average_products"] = with_(RATINGS) + """
SELECT productId, round(avg(score), 6) AS avg FROM ratings GROUP BY productId"""

COOC = """pc AS (SELECT productId, count(*) AS cnt FROM ratings GROUP BY productId),
rc AS (SELECT r.userId, r.productId, pc.cnt FROM ratings r JOIN pc USING (productId)),
co AS (
  SELECT a.productId AS product1, b.productId AS product2, count(*) AS cocount,
         max(a.cnt) AS count1, max(b.cnt) AS count2
  FROM rc a JOIN rc b ON a.userId = b.userId
  GROUP BY a.productId, b.productId)"""

SQL["item_cooccurrence"] = with_(RATINGS, COOC) + """
SELECT product1, product2, cocount, count1, count2 FROM co"""

ITEMCF = """itemcf AS (
  SELECT productId, CAST(rank AS INTEGER) AS rank, recProductId, score FROM (
    SELECT product1 AS productId, product2 AS recProductId,
           cocount / sqrt(count1 * count2) AS score,
           row_number() OVER (PARTITION BY product1
                              ORDER BY cocount / sqrt(count1 * count2) DESC, product2) AS rank
    FROM co WHERE product1 <> product2) WHERE rank <= 10)"""

SQL["itemcf_recs"] = with_(RATINGS, COOC, ITEMCF) + """
SELECT p.productId, i.rank, i.recProductId, round(i.score, 6) AS score
FROM (SELECT DISTINCT productId FROM ratings) p LEFT JOIN itemcf i USING (productId)"""

TOKENS = r"""toks0 AS (
  SELECT productId, lower(replace(tags, '|', ' ')) AS low FROM products),
toks1 AS (
  SELECT productId,
         CASE WHEN low = '' THEN ['']
              WHEN regexp_replace(low, '\s+$', '') = '' THEN []::VARCHAR[]
              ELSE string_split_regex(regexp_replace(low, '\s+$', ''), '\s') END AS l
  FROM toks0),
tokens AS (
  SELECT productId, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS term FROM toks1)"""

TFIDF = """tf AS (SELECT productId, term, count(*) AS tf FROM tokens GROUP BY productId, term),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
tfidf AS (
  SELECT productId, term, tf, df,
         tf * ln((CAST((SELECT count(*) FROM products) AS DOUBLE) + 1) / (CAST(df AS DOUBLE) + 1)) AS weight
  FROM tf JOIN dfreq USING (term))"""

CONTENT = """w AS (SELECT productId, term, weight FROM tfidf WHERE weight <> 0),
nrm AS (SELECT productId, sqrt(sum(weight * weight)) AS n FROM w GROUP BY productId),
dots AS (
  SELECT a.productId AS p1, b.productId AS p2, sum(a.weight * b.weight) AS d
  FROM w a JOIN w b ON a.term = b.term AND a.productId <> b.productId GROUP BY 1, 2),
content_sims AS (
  SELECT p1 AS productId, p2 AS recProductId, d / (n1.n * n2.n) AS score
  FROM dots JOIN nrm n1 ON n1.productId = p1 JOIN nrm n2 ON n2.productId = p2
  WHERE d / (n1.n * n2.n) > 0.4)"""

SQL["tag_tokens"] = with_(PRODUCTS, TOKENS) + "SELECT productId, pos, term FROM tokens"

SQL["tf_idf_weights"] = with_(PRODUCTS, TOKENS, TFIDF) + """
SELECT productId, term, tf, df, round(weight, 6) AS weight FROM tfidf"""

SQL["content_similarity"] = with_(PRODUCTS, TOKENS, TFIDF, CONTENT) + """
SELECT productId,
       CAST(row_number() OVER (PARTITION BY productId ORDER BY round(score, 6) DESC, recProductId) AS INTEGER) AS rank,
       recProductId, round(score, 6) AS score
FROM content_sims"""

SQL["vector_similarity"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (
  SELECT a.vec_id AS vecId, b.vec_id AS recVecId,
         list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT vecId,
       CAST(row_number() OVER (PARTITION BY vecId ORDER BY round(score, 6) DESC, recVecId) AS INTEGER) AS rank,
       recVecId, round(score, 6) AS score
FROM s WHERE score > 0.4"""


def _hash(col: str) -> str:
    """32-bit JVM string hash (code points of the BMP = UTF-16 units), sign-folded."""
    h = (f"list_reduce(list_transform(range(1, length({col}) + 1), "
         f"lambda i: CAST(unicode(substr({col}, i, 1)) AS BIGINT)), "
         f"lambda h, c: (h * 31 + c) % 4294967296, CAST(0 AS BIGINT))")
    return f"CAST(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END AS INTEGER)"


def _hydrate(src: str, key: str | None = None, item: str = "productId") -> str:
    """src has (key?, item, rank); duplicates keep the first rank."""
    k = f"{key}, " if key else ""
    ks = f"f.{key}, " if key else ""
    return f"""firsts AS (SELECT {k}{item} AS productId, min(rank) AS rank FROM {src} GROUP BY {k}{item})
SELECT {ks}CAST(f.rank AS INTEGER) AS rank, p.productId, p.name, p.imageUrl, p.categories, p.tags,
       round(coalesce(a.avg, 0.0), 6) AS score
FROM firsts f JOIN products p USING (productId) LEFT JOIN averages a USING (productId)"""


SQL["hot_products"] = with_(RATINGS, PRODUCTS, AVERAGES) + f""", recent AS (
  SELECT productId, count(*) AS count, {_ym('ts')} AS yearmonth FROM ratings GROUP BY {_ym('ts')}, productId),
top AS (SELECT productId, row_number() OVER (ORDER BY yearmonth DESC, count DESC, productId) AS rank
        FROM recent QUALIFY rank <= 20),
""" + _hydrate("top")

SQL["most_rated_products"] = with_(RATINGS, PRODUCTS, AVERAGES) + """, counts AS (
  SELECT productId, count(*) AS count FROM ratings GROUP BY productId),
top AS (SELECT productId, row_number() OVER (ORDER BY count DESC, productId) AS rank
        FROM counts QUALIFY rank <= 20),
""" + _hydrate("top")

SQL["product_info"] = with_(RATINGS, PRODUCTS, AVERAGES, EVENTS) + """
SELECT p.productId, p.name, p.imageUrl, p.categories, p.tags, round(coalesce(a.avg, 0.0), 6) AS score
FROM products p LEFT JOIN averages a USING (productId)
WHERE p.productId IN (SELECT productId FROM rating_events)"""

SQL["product_search"] = with_(RATINGS, PRODUCTS, AVERAGES) + """
SELECT p.productId, p.name, p.imageUrl, p.categories, p.tags, round(coalesce(a.avg, 0.0), 6) AS score
FROM products p LEFT JOIN averages a USING (productId)
WHERE regexp_matches(p.name, 'red|green')"""

SQL["itemcf_lookup"] = with_(RATINGS, PRODUCTS, AVERAGES, EVENTS, COOC, ITEMCF) + """,
req AS (SELECT productId AS requestKey, rank, recProductId FROM itemcf
        WHERE recProductId IS NOT NULL AND productId IN (SELECT productId FROM rating_events)),
""" + _hydrate("req", "requestKey", "recProductId")

SQL["content_lookup"] = with_(RATINGS, PRODUCTS, AVERAGES, EVENTS, TOKENS, TFIDF, CONTENT) + """,
ranked AS (SELECT productId AS requestKey, recProductId,
                  row_number() OVER (PARTITION BY productId ORDER BY round(score, 6) DESC, recProductId) AS rank
           FROM content_sims WHERE productId IN (SELECT productId FROM rating_events)),
""" + _hydrate("ranked", "requestKey", "recProductId")

SQL["recs_roundtrip"] = with_(RATINGS, COOC, ITEMCF) + """
SELECT productId, rank, recProductId, round(score, 6) AS score, round(score, 6) AS mapScore
FROM itemcf"""

SQL["resolve_users"] = f"""
WITH users AS (SELECT username, {_hash('username')} AS userId FROM (SELECT DISTINCT c_name AS username FROM customer))
SELECT username, min(userId) AS userId FROM users
WHERE username IN (SELECT c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events))
GROUP BY username"""

SQL["register_users"] = f"""
WITH buyers AS (SELECT DISTINCT c_name AS username FROM customer
                WHERE c_custkey IN (SELECT user_id FROM events)),
fresh AS (SELECT DISTINCT c_name AS username FROM customer
          WHERE c_name NOT IN (SELECT username FROM buyers))
SELECT {_hash('username')} AS userId, username, '' AS password, true AS first,
       CAST(1700000000000 AS BIGINT) AS timestamp
FROM fresh"""

SQL["update_user_preferences"] = f"""
WITH users AS (SELECT username, {_hash('username')} AS userId FROM (SELECT DISTINCT c_name AS username FROM customer)),
ch AS (SELECT {_hash('c.c_name')} AS userId,
              array_to_string(list_sort(list_distinct(list(e.event_type))), ',') AS prefs
       FROM events e JOIN customer c ON c.c_custkey = e.user_id GROUP BY c.c_name)
SELECT u.userId, u.username, ch.userId IS NULL AS first, coalesce(ch.prefs, '') AS prefs
FROM users u LEFT JOIN ch USING (userId)"""

SQL["ingest_ratings"] = with_(RATINGS, EVENTS) + """,
latest AS (SELECT userId, productId, arg_max(score, event_id) AS score, arg_min(ts, event_id) AS ts
           FROM rating_events GROUP BY userId, productId),
kept AS (SELECT r.userId, r.productId, coalesce(l.score, r.score) AS score, r.ts AS timestamp
         FROM ratings r LEFT JOIN latest l USING (userId, productId)),
ins AS (SELECT l.userId, l.productId, l.score, l.ts AS timestamp FROM latest l
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userId = l.userId AND r.productId = l.productId))
SELECT * FROM kept UNION ALL SELECT * FROM ins"""

ONLINE = """sims AS (SELECT productId, recProductId, round(score, 6) AS score FROM content_sims),
hist AS (SELECT userId, productId, score,
                row_number() OVER (PARTITION BY userId ORDER BY ts DESC, productId DESC, score DESC) AS pos
         FROM ratings QUALIFY pos <= 40),
q AS (SELECT userId, productId, score, 0 AS fresh, pos AS k FROM hist
      WHERE userId IN (SELECT userId FROM rating_events)
      UNION ALL SELECT userId, productId, score, 1 AS fresh, event_id AS k FROM rating_events),
recent AS (SELECT userId,
                  CAST(row_number() OVER (PARTITION BY userId
                       ORDER BY fresh DESC, CASE WHEN fresh = 1 THEN -k ELSE k END) AS INTEGER) AS pos,
                  productId, score
           FROM q QUALIFY pos <= 21),
last AS (SELECT userId, productId FROM rating_events
         QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) = 1),
rated AS (SELECT userId, productId FROM ratings UNION SELECT userId, productId FROM rating_events),
cands AS (SELECT l.userId, s.recProductId AS candidate, s.score AS sim
          FROM last l JOIN sims s ON s.productId = l.productId
          WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = l.userId AND r.productId = s.recProductId)),
topc AS (SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY sim DESC, candidate) AS INTEGER) AS rank,
                candidate, sim
         FROM cands QUALIFY rank <= 20),
pairs AS (SELECT c.userId, c.candidate, r.score AS rscore, s.score AS s
          FROM topc c JOIN recent r ON r.userId = c.userId
          JOIN sims s ON s.productId = c.candidate AND s.recProductId = r.productId
          WHERE s.score > 0.4),
scored AS (SELECT userId, candidate, round(sum(s * rscore), 6) / count(*) AS base,
                  count(*) FILTER (WHERE rscore > 3) AS incr, count(*) FILTER (WHERE rscore <= 3) AS decr
           FROM pairs GROUP BY userId, candidate)"""

_ONLINE_HEAD = with_(RATINGS, PRODUCTS, EVENTS, TOKENS, TFIDF, CONTENT, ONLINE)

SQL["recent_ratings"] = _ONLINE_HEAD + "SELECT userId, pos, productId, score FROM recent"

SQL["stream_candidates"] = _ONLINE_HEAD + "SELECT userId, rank, candidate AS productId, sim FROM topc"

SQL["stream_scores"] = _ONLINE_HEAD + """
SELECT userId, candidate AS productId,
       base + (log10(greatest(incr, 1)) - log10(greatest(incr, 1))) AS priority, incr, decr FROM scored"""


def _stream_recs(bonus: str) -> str:
    return _ONLINE_HEAD + f""",
pri AS (SELECT userId, candidate, base + {bonus} AS score FROM scored),
ranked AS (SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, candidate) AS INTEGER) AS rank,
                  candidate AS productId, score FROM pri)
SELECT l.userId, r.rank, r.productId, r.score FROM last l LEFT JOIN ranked r USING (userId)"""


SQL["stream_recs"] = _stream_recs("(log10(greatest(incr, 1)) - log10(greatest(incr, 1)))")
SQL["stream_recs_intended"] = _stream_recs("(log10(greatest(incr, 1)) - log10(greatest(decr, 1)))")

LOG_LINES = """lines AS (
  SELECT CASE WHEN event_type = 'purchase'
              THEN 'INFO PRODUCT_RATING_PREFIX:' || CAST(user_id AS INTEGER) || '|'
                   || CAST(json_extract_string(props, '$.k') AS INTEGER) || '|'
                   || CAST(CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS DOUBLE) AS VARCHAR) || '|'
                   || CAST(floor(epoch(ts)) AS BIGINT)
              ELSE 'INFO ' || event_type || ' user=' || CAST(user_id AS INTEGER) END AS value
  FROM events),
payloads AS (
  SELECT 'logProcessor' AS key, trim(split_part(value, 'PRODUCT_RATING_PREFIX:', 2)) AS value
  FROM lines WHERE contains(value, 'PRODUCT_RATING_PREFIX:')
    AND trim(split_part(value, 'PRODUCT_RATING_PREFIX:', 2)) <> '')"""

SQL["log_filter"] = with_(LOG_LINES) + "SELECT key, value FROM payloads"

SQL["parse_rating_events"] = with_(LOG_LINES) + """
SELECT CAST(split_part(value, '|', 1) AS INTEGER) AS userId, CAST(split_part(value, '|', 2) AS INTEGER) AS productId,
       CAST(split_part(value, '|', 3) AS DOUBLE) AS score, CAST(split_part(value, '|', 4) AS BIGINT) AS timestamp
FROM payloads"""

SQL["rating_log_lines"] = with_(RATINGS) + """
SELECT 'PRODUCT_RATING_PREFIX:' || userId || '|' || productId || '|' || CAST(score AS VARCHAR) || '|' || ts AS value
FROM ratings"""

SQL["prediction_rmse"] = with_(RATINGS) + """,
train AS (SELECT * FROM ratings WHERE ts < 946684800),
test AS (SELECT * FROM ratings WHERE ts >= 946684800),
pred AS (SELECT productId, avg(score) AS prediction FROM train GROUP BY productId)
SELECT round(sqrt(avg((t.score - p.prediction) * (t.score - p.prediction))), 6) AS rmse, count(*) AS n
FROM test t JOIN pred p USING (productId)"""

SQL["distinct_entities"] = with_(RATINGS) + """
SELECT 'user' AS kind, userId AS id FROM (SELECT DISTINCT userId FROM ratings)
UNION ALL
SELECT 'product' AS kind, productId AS id FROM (SELECT DISTINCT productId FROM ratings)"""

SQL["normalised_ui_ratings"] = """
SELECT CAST(user_id AS INTEGER) AS userId, CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
       round(CAST(CAST(floor(value) AS BIGINT) % 10 + 1 AS DOUBLE) / 2, 2) AS score
FROM events WHERE event_type = 'purchase'"""

SQL["stream_recs_lookup"] = with_(RATINGS, PRODUCTS, AVERAGES, EVENTS, TOKENS, TFIDF, CONTENT, ONLINE) + """,
pri AS (SELECT userId, candidate, base + (log10(greatest(incr, 1)) - log10(greatest(incr, 1))) AS score FROM scored),
ranked AS (SELECT userId, row_number() OVER (PARTITION BY userId ORDER BY score DESC, candidate) AS rank,
                  candidate FROM pri
           WHERE userId IN (SELECT CAST(user_id AS INTEGER) FROM events)),
""" + _hydrate("ranked", "userId", "candidate")

SQL["factor_top_n"] = """
WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
s AS (SELECT a.id AS userId, b.id AS productId, round(list_dot_product(a.f, b.f), 6) AS score FROM v a, v b),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT userId, productId, score, rank FROM k WHERE rank <= 20"""

SQL["factor_predictions"] = """
WITH e AS (SELECT event_id, CAST(user_id AS INTEGER) AS userId, CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId FROM events)
SELECT event_id, userId, productId, round(list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])), 6) AS prediction
FROM e JOIN embeddings u ON u.vec_id = userId JOIN embeddings p ON p.vec_id = productId"""

SQL["rejected_events"] = """
SELECT concat_ws('|', user_id, CASE WHEN event_type = 'view' THEN 'view' ELSE json_extract_string(props, '$.k') END,
  CASE WHEN event_type = 'error' THEN 'NaN' ELSE CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS VARCHAR) END,
  CASE WHEN event_type <> 'signup' THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END) AS value
FROM events WHERE event_type IN ('view', 'error', 'signup')"""
