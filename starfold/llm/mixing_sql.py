"""DuckDB SQL for the mix: the same targets and order, and what whole passes and a rest take.

It knows no schedule: a source's blocks come in turn, so its slots take all of it so many
times, and the words before the rest of its target once more.
"""

from starfold.llm.mixing import MOST

TAKEN = f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM docs GROUP BY source),
ratios AS (
  SELECT *, CAST(source_size AS DOUBLE) * {MOST} AS cap,
         CAST(source_size AS DOUBLE) * {MOST} / weight AS ratio FROM sources),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM ratios
  WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT arg_min(level, ratio) AS free FROM levels WHERE ratio >= level),
targets AS (
  SELECT source, source_size,
         CASE WHEN free IS NULL OR ratio < free THEN cap ELSE weight * free END AS target
  FROM levels, free),
placed AS (
  SELECT d.*, source_size, target, CAST(round(target) AS BIGINT) AS words,
         greatest(source_size, 1) AS pass,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size, id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(words // pass * size + greatest(least(size, words % pass - before), 0) AS BIGINT) AS taken
FROM placed
"""
