"""DuckDB SQL for the queries that SQL can express, over whole tables and whole texts."""

WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WHITE}'), lambda x: x <> '') AS words
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
  END AS shingles
  FROM split
),
each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT e.b, r.root FROM reached r JOIN edges e ON e.a = r.node
),
least AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.node = s.doc_id
"""

OP8 = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hexed, payload, max(page_id) OVER (PARTITION BY payload) AS original
  FROM payloads
)
SELECT
  page_id,
  CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(
    list_transform(range(0, 32), lambda i: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((CAST('0x' || substr(hexed, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)),
    ''
  ) AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM digests
"""

OP10 = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WHITE}'), lambda x: x <> '') AS words FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 34], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM split)
),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE w IN (SELECT w FROM repeated))
),
places AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM split),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
  FROM places ANTI JOIN covered USING (doc_id, p)
  GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(len(s.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""

OP13 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{WHITE}'), lambda x: x <> '') AS words
  FROM documents
),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT s.part, coalesce(f.good, 0) AS good, coalesce(f.toxic, 0) AS toxic,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(translate(t, '{UPPER}', ''))) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN s.doc_id > min(s.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
  FROM split s LEFT JOIN flags f USING (doc_id)
),
patterns AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT '' AS filter_order, [] :: INT[] AS bits
  UNION ALL
  SELECT filter_order || letter, list_append(bits, bit) FROM orders JOIN letters ON NOT contains(filter_order, letter)
),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0) AS gone
  FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM orders WHERE length(filter_order) = 5)
),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (gone | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & gone > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT part, fails, n, good, toxic, filter_order, step, CAST(bit AS BIGINT) AS bit, CAST(gone AS BIGINT) AS gone FROM patterns CROSS JOIN steps)
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
