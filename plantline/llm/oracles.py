"""DuckDB texts of the queries that SQL can state, written from the contracts and not from the code."""

ORACLES: dict[str, str] = {}

# Targets: the level at which weight * level, held at three times a source's words, adds up to all words.
# Sources are full in the order of words / weight, so the number of full ones is found by trying each.
_MIX = r"""
WITH docs AS (
  SELECT doc_id, text, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS dealt
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM docs GROUP BY source
), ordered AS (
  SELECT *, CAST(sum(words) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
         CAST(coalesce(sum(words) OVER w, 0) AS BIGINT) AS full_words, CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS full_weight
  FROM sources
  WINDOW w AS (ORDER BY words / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  -- The first source, in that order, that the rest of the words doesn't fill sets the level.
  SELECT total - 3 * full_words AS rest, weights - full_weight AS left_weight
  FROM ordered WHERE weight * (total - 3 * full_words) <= 3 * words * (weights - full_weight)
  ORDER BY full_weight LIMIT 1
), targets AS (
  SELECT source, words,
         CASE WHEN weight * rest > 3 * words * left_weight THEN CAST(3 * words AS DOUBLE)
              ELSE CAST(weight * rest AS DOUBLE) / CAST(left_weight AS DOUBLE) END AS target
  FROM sources, level
), takes AS (
  SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * words) AS take FROM targets
), whole AS (
  -- A slot holds so many words that there are about 2^20 of them, 4096 at most (below 2^43 words in all).
  SELECT CAST(greatest(1, least(4096, ceil(sum(take) / 1048576))) AS BIGINT) AS length FROM takes
), edges AS (
  SELECT *, CAST(sum(take) OVER (ORDER BY source NULLS LAST) AS BIGINT) AS high, CAST(sum(take) OVER () AS BIGINT) AS total FROM takes, whole
), slots AS (
  -- Every place of the cumulative targets is met by one slot, whatever the order; the middle of the slot names its source.
  SELECT p * length + length // 2 AS point
  FROM (SELECT DISTINCT length, total FROM edges) AS e, range(0, CAST((total + length - 1 - length // 2) // length AS BIGINT)) AS r(p)
), counted AS (
  SELECT e.source, e.words, e.target, e.take, e.length, count(s.point) AS won
  FROM edges e LEFT JOIN slots s ON s.point >= e.high - e.take AND s.point < e.high
  GROUP BY ALL
), taken AS (
  SELECT source, words, target,
         CASE WHEN won <= 1 AND take <= length THEN take ELSE least(greatest(won, least(take, 1)) * length, 3 * words) END AS take
  FROM counted
), laid AS (
  SELECT d.doc_id, d.size, t.words AS source_size, t.target, t.take,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.dealt, d.doc_id, d.size, d.text ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM docs d JOIN taken t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE take // source_size * size + least(size, greatest(0, take % source_size - start)) END AS BIGINT) AS taken
FROM laid
"""

ORACLES["op2_mixing"] = _MIX

# All rows by brute force: no bound, no pivots.
ORACLES["op9_top_k"] = r"""
WITH held AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM held q JOIN held c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
