"""The registered queries in SQL over the given tables."""

from __future__ import annotations

from checks.inputs import BLOCK_TYPES, LANDING
from checks.queries import ITEMS_PER_OBJECT, ROWS_PER_SHARD, SHARDS, STEP_EPOCH
from corpusflow.operators.projection import GOLDEN, PARTNERS, REPULSION, curve

SPLIT = "CASE lang WHEN 'en' THEN 'chat' ELSE 'multilingual_' || lang END"
SAMPLES = f"samples AS (SELECT source AS dataset, {SPLIT} AS split, doc_id, text FROM documents)"
COUNTS = f"{SAMPLES}, counts AS (SELECT dataset, split, count(*) AS n FROM samples GROUP BY ALL)"
KNOWN = """known AS (
  SELECT source AS dataset, 'now' AS grp FROM documents GROUP BY 1
  UNION ALL SELECT source || '-next', 'next' FROM documents GROUP BY 1)"""
BLANKED = f"""{SAMPLES}, blanked AS (
  SELECT dataset, split, doc_id,
    CASE WHEN doc_id % 13 IN (0, 1) THEN NULL ELSE text END AS text FROM samples)"""


def _sharded(source: str, k: str, key: str = "doc_id") -> str:
    """Contiguous shards and positions of ``source(dataset, split, key, …)``."""
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dataset, split ORDER BY {key}) - 1 AS idx,
    count(*) OVER (PARTITION BY dataset, split) AS n FROM {source}),
sized AS (SELECT *, {k} AS k FROM numbered),
cut AS (SELECT *, n // k AS base, n % k AS extra FROM sized),
placed AS (
  SELECT *, CAST(CASE WHEN idx < extra * (base + 1) THEN idx // (base + 1)
    ELSE extra + (idx - extra * (base + 1)) // greatest(base, 1) END AS BIGINT) AS shard_id FROM cut),
sharded AS (SELECT *, CAST(idx - (shard_id * base + least(shard_id, extra)) AS BIGINT) AS original_index FROM placed)"""


K_BY_SIZE = f"greatest(1, CAST(ceil(n / {ROWS_PER_SHARD}.0) AS BIGINT))"
RUN = f"""{BLANKED}, {_sharded('blanked', K_BY_SIZE)},
done AS (SELECT dataset, split, 0 AS shard_id, count(*) AS samples
  FROM samples WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY ALL)"""


def _embedding(texts: str, key: str = "doc_id", max_tokens: int | None = None) -> str:
    """``vec(key, component, x)``: token hashes of ``texts(key, text)`` summed and normalised."""
    tokens = "list_filter(string_split_regex(text, '[ \\n]+'), lambda t: t <> '')"
    if max_tokens:
        tokens = f"list_slice({tokens}, 1, {max_tokens})"
    nibble = "(instr('0123456789abcdef', substr(m, {at}, 1)) - 1)"
    byte = f"{nibble.format(at='2 * component + 1')} * 16 + {nibble.format(at='2 * component + 2')}"
    return f"""tokens AS (SELECT {key}, unnest({tokens}) AS t FROM {texts}),
counted AS (SELECT {key}, t, count(*) AS c FROM tokens GROUP BY ALL),
hashed AS (SELECT t, md5(t) AS m FROM (SELECT DISTINCT t FROM counted)),
bytes AS (SELECT t, component, 2 * ({byte}) - 255 AS b FROM hashed, (SELECT unnest(range(16)) AS component)),
summed AS (SELECT {key}, component, sum(c * b)::DOUBLE AS s FROM counted JOIN bytes USING (t) GROUP BY ALL),
vec AS (SELECT {key}, component, s / sqrt(sum(s * s) OVER (PARTITION BY {key})) AS x FROM summed)"""


ODD = f"""CASE vec_id % 50 WHEN 7 THEN list_concat(['NaN'::DOUBLE], list_slice(e, 2, 64))
  WHEN 8 THEN list_concat(['Infinity'::DOUBLE], list_slice(e, 2, 64))
  WHEN 9 THEN list_concat(['-Infinity'::DOUBLE], list_slice(e, 2, 64))
  WHEN 10 THEN list_slice(e, 1, 32) ELSE e END"""


def _tree(vector: str = "e") -> str:
    return f"""tree AS (SELECT 'd' || (vec_id % 3) AS dataset, 's' || label AS split,
  'd' || (vec_id % 3) || '-s' || label AS file, {vector} AS v, vec_id AS original_index
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings))"""


TREE, BROKEN = _tree(), _tree(ODD)
FILES = f"""{BROKEN}, files AS (
  SELECT dataset, split, file, count(*) AS rows, arg_min(len(v), original_index) AS dim,
    min(len(v)) AS min_dim, max(len(v)) AS max_dim,
    sum(len(list_filter(v, lambda x: isnan(x)))) AS nan_n,
    sum(len(list_filter(v, lambda x: isinf(x)))) AS inf_n
  FROM tree GROUP BY ALL)"""
MB = "1000000000.0 / (1024 * 1024)"
WARNED = f"""{FILES}, warned AS (
  SELECT dataset, split, file, 'Found ' || nan_n || ' NaN values' AS message FROM files WHERE nan_n > 0
  UNION ALL SELECT dataset, split, file, 'Found ' || inf_n || ' Inf values' FROM files WHERE inf_n > 0)"""

_KINDS = "[" + ", ".join(f"'{t}'" for t in BLOCK_TYPES) + "]"


def _at(a: int, b: int) -> str:
    return f"((page * {a} + block_id * {b}) % 130 - 10) / 100.0::DOUBLE"


BLOCKS = f"""lines AS (SELECT source AS document, doc_id AS page, unnest(string_split(text, chr(10))) AS text,
  unnest(range(len(string_split(text, chr(10))))) AS block_id FROM documents),
blocks AS (SELECT document, page, block_id, text,
  CASE WHEN block_id % 7 <> 0 THEN {_KINDS}[(block_id % 11 + 1)::INT] END AS type,
  {_at(37, 11)} AS rx0, {_at(41, 13)} AS ry0, {_at(53, 29)} AS rx1, {_at(59, 31)} AS ry1 FROM lines),
clamped AS (SELECT *, greatest(0, least(1, rx0)) AS cx0, greatest(0, least(1, ry0)) AS cy0,
  greatest(0, least(1, rx1)) AS cx1, greatest(0, least(1, ry1)) AS cy1 FROM blocks),
boxed AS (SELECT *, least(cx0, cx1) AS xmin, least(cy0, cy1) AS ymin,
  greatest(cx0, cx1) AS xmax, greatest(cy0, cy1) AS ymax FROM clamped)"""
PARSED = f"""{BLOCKS}, counted AS (SELECT document, page, count(*) AS n FROM blocks WHERE page % 11 <> 0 GROUP BY ALL),
docs AS (SELECT source AS document, count(*) FILTER (n > 0) AS processed, count(*) AS total,
    coalesce(sum(n), 0)::BIGINT AS blocks
  FROM documents LEFT JOIN counted ON source = document AND doc_id = page GROUP BY 1
  UNION ALL SELECT source || '-empty', 0, 0, 0 FROM documents GROUP BY 1)"""

_MARK = " ".join(
    f"WHEN {rest} THEN replace('{mark.replace(chr(39), 2 * chr(39))}', '{{id}}', page_id::VARCHAR)" for rest, mark in LANDING.items()
)
LANDED = f"""landed AS (SELECT page_id, url, html || CASE page_id % 8 {_MARK} END AS html FROM pages),
found AS (SELECT *, CASE page_id % 8 WHEN 0 THEN 'current' WHEN 1 THEN 'listed' WHEN 2 THEN 'frame'
    WHEN 3 THEN 'frame' WHEN 4 THEN 'attribute' WHEN 6 THEN 'frame' WHEN 7 THEN 'frame' END AS method,
  CASE page_id % 8 WHEN 0 THEN regexp_extract(html, '"sourceUrl":"(https://a[^"]*)"', 1)
    WHEN 1 THEN regexp_extract(html, 'DATASHEET [0-9]+","sourceUrl":"([^"]*)"', 1)
    WHEN 2 THEN replace(regexp_extract(html, 'src="(https://x.widen.net/v/[^"]*)"', 1), '&amp;', '&')
    WHEN 3 THEN regexp_extract(html, 'src="(https://y.widen.net/[^"]*)"', 1)
    WHEN 4 THEN regexp_extract(html, 'data-source-url="([^"]*)"', 1) WHEN 6 THEN 'https://x.widen.net/u/' || page_id
    WHEN 7 THEN 'https://x.widen.net/it''s/' || page_id || '?a&b' END AS link FROM landed)"""

FETCHED = """raw AS (SELECT page_id,
  CASE page_id % 5 WHEN 4 THEN url || '.pdf' WHEN 3 THEN 'https://x.widen.net/' || page_id ELSE url END AS url,
  CASE page_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/html; charset=utf-8'
    WHEN 2 THEN 'application/octet-stream' WHEN 3 THEN 'image/png' ELSE 'text/html' END AS kind,
  CASE WHEN page_id % 2 = 0 THEN '%PDF-' ELSE '' END || html AS body FROM pages),
fetched AS (SELECT page_id, url, strlen(body) AS n_bytes,
  CASE WHEN contains(kind, 'pdf') OR ends_with(url, '.pdf') THEN
      CASE WHEN starts_with(body, '%PDF') THEN 'direct' ELSE 'invalid' END
    WHEN contains(kind, 'html') THEN 'landing' ELSE 'unexpected' END AS first_class,
  CASE WHEN contains(kind, 'pdf') OR contains(kind, 'application/octet-stream') OR contains(url, 'widen.net') THEN
      CASE WHEN starts_with(body, '%PDF') THEN 'accepted' ELSE 'not_pdf' END
    ELSE 'wrong_type' END AS second_class,
  CASE WHEN contains(url, 'widen.net') THEN 'viewer' ELSE 'document' END AS route FROM raw)"""

LOG = """log AS (SELECT user_id % 3 AS run, ts, event_id, user_id % 8 AS worker,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' WHEN event_type = 'view' THEN 'skipped'
    WHEN event_type = 'click' THEN 'no_text' ELSE 'error' END AS status,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'saving' WHEN event_type = 'view' THEN 'loading'
    ELSE 'embedding' END AS stage,
  floor(value)::BIGINT AS samples, (1 + user_id % 5)::DOUBLE AS seconds,
  'corpus-with-a-long-name-' || event_type || '-' || lpad(event_id::VARCHAR, 12, '0') AS filename,
  floor(value)::BIGINT + user_id % 5 * 10 AS total FROM events),
counted AS (SELECT *, CASE WHEN status IN ('success', 'skipped') THEN samples ELSE 0 END AS c FROM log)"""
WORKERS = f"""{LOG}, last AS (SELECT worker, arg_max(struct_pack(stage := stage, f := filename, c := samples, t := total),
  (ts, event_id)) AS s FROM log GROUP BY 1)
SELECT worker, s.stage AS stage, CASE WHEN length(s.f) > 40 THEN '...' || right(s.f, 37) ELSE s.f END AS filename,
  s.c AS current, s.t AS total, round(CASE WHEN s.t > 0 THEN s.c / s.t * 100 ELSE 0 END, 6) AS pct FROM last"""
STATUS = f"WITH {LOG} SELECT status, count(*) AS n, sum(c)::BIGINT AS samples FROM counted GROUP BY 1"


def _knn(k: int) -> str:
    return f"""pairs AS (SELECT a.vec_id AS i, b.vec_id AS j,
  round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
knn AS (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rk, d FROM pairs QUALIFY rk <= {k})"""


FUZZY = f"""{_knn(14)},
        near AS (SELECT i, coalesce(min(d) FILTER (d > 0), 0) AS rho, sum(d) / (count(*) + 1) AS mean FROM knn GROUP BY 1),
        steps AS (SELECT i, 0 AS step, 0.0::DOUBLE AS low, 'Infinity'::DOUBLE AS high, 1.0::DOUBLE AS mid, false AS settled FROM near
          UNION ALL
          SELECT i, step + 1,
            CASE WHEN settled OR hit THEN low WHEN total > log2(15) THEN low ELSE mid END,
            CASE WHEN settled OR hit THEN high WHEN total > log2(15) THEN mid ELSE high END,
            CASE WHEN settled OR hit THEN mid WHEN total > log2(15) THEN (low + mid) / 2
              WHEN isinf(high) THEN mid * 2 ELSE (mid + high) / 2 END,
            settled OR hit
          FROM (SELECT s.i, any_value(step) AS step, any_value(low) AS low, any_value(high) AS high, any_value(mid) AS mid,
              bool_or(settled) AS settled, sum(CASE WHEN d > rho THEN exp(-(d - rho) / mid) ELSE 1 END) AS total,
              abs(sum(CASE WHEN d > rho THEN exp(-(d - rho) / mid) ELSE 1 END) - log2(15)) < 1e-5 AS hit
            FROM steps s JOIN knn USING (i) JOIN near USING (i) WHERE step < 64 GROUP BY s.i)),
        scale AS (SELECT s.i, rho, greatest(mid, 1e-3 * CASE WHEN rho > 0 THEN mean
            ELSE (SELECT sum(d) / (count(*) + count(DISTINCT i)) FROM knn) END) AS sigma
          FROM steps s JOIN near USING (i) WHERE step = 64),
        directed AS (SELECT i, j, exp(-greatest(d - rho, 0) / sigma) AS w FROM knn JOIN scale USING (i)),
        both_ways AS (SELECT i, j, w AS a, 0.0::DOUBLE AS b FROM directed UNION ALL SELECT j, i, 0.0::DOUBLE, w FROM directed),
        united AS (SELECT i, j, sum(a) AS a, sum(b) AS b FROM both_ways GROUP BY ALL),
        graph AS (SELECT i, j, round(a + b - a * b, 5) AS w FROM united WHERE a + b - a * b > 0)"""

# One epoch of the layout.
CURVE_A, CURVE_B = curve(0.1)


# Principal components by squaring the scaled covariance matrix until one direction is left.
_SQUARINGS = 30


def _leading(matrix: str, name: str) -> str:
    return f"""{name}_powers AS (
  SELECT 0 AS step, r, c, x / (SELECT sum(x) FROM {matrix} WHERE r = c) AS x FROM {matrix}
  UNION ALL
  SELECT step + 1, r, c, x / sum(x) FILTER (r = c) OVER () FROM (
    SELECT a.step AS step, a.r AS r, b.c AS c, sum(a.x * b.x) AS x
    FROM {name}_powers a JOIN {name}_powers b ON a.c = b.r WHERE a.step < {_SQUARINGS} GROUP BY ALL)),
{name}_column AS (SELECT r, x FROM {name}_powers WHERE step = {_SQUARINGS}
  AND c = (SELECT c FROM {name}_powers WHERE step = {_SQUARINGS} AND r = c ORDER BY x DESC LIMIT 1)),
{name} AS (SELECT r, x / sqrt((SELECT sum(x * x) FROM {name}_column))
  * sign((SELECT x FROM {name}_column ORDER BY abs(x) DESC LIMIT 1)) AS x FROM {name}_column)"""


PCA = f"""parts AS (SELECT vec_id, unnest(range(len(embedding))) AS r, unnest(embedding)::DOUBLE AS v FROM embeddings),
centred AS (SELECT vec_id, r, v - avg(v) OVER (PARTITION BY r) AS v FROM parts),
cov AS (SELECT a.r AS r, b.r AS c, sum(a.v * b.v) AS x FROM centred a JOIN centred b USING (vec_id) GROUP BY ALL),
{_leading('cov', 'first')},
rest AS (SELECT cov.r AS r, c, cov.x - (SELECT sum(m.x * p.x * q.x) FROM cov m JOIN first p ON m.r = p.r JOIN first q ON m.c = q.r)
  * u.x * w.x AS x FROM cov JOIN first u ON cov.r = u.r JOIN first w ON cov.c = w.r),
{_leading('rest', 'second')},
pca AS (SELECT vec_id, round(sum(v * f.x), 5) AS x, round(sum(v * s.x), 5) AS y
  FROM centred JOIN first f USING (r) JOIN second s USING (r) GROUP BY 1)"""
POINTS = f"""{PCA}, {TREE}, points AS (SELECT vec_id, x, y, split, dataset, left(coalesce(text, '-'), 100) AS text
  FROM pca JOIN tree ON vec_id = original_index LEFT JOIN documents ON doc_id = vec_id)"""


ORACLES: dict[str, str] = {
    "registry_groups": f"""WITH {KNOWN} SELECT grp, dataset, 'hub/' || dataset AS source_name FROM known
        WHERE grp = 'next' OR dataset = 'src0'""",
    "list_splits": f"""WITH {SAMPLES} SELECT DISTINCT dataset, split, contains(lower(split), 'multilingual') AS excluded
        FROM samples""",
    "absent_datasets": f"WITH {KNOWN} SELECT dataset, grp FROM known WHERE dataset NOT IN (SELECT source FROM documents)",
    "resolve_specs": """SELECT source || ':chat' AS spec, source AS dataset, 'chat' AS split,
          CASE WHEN bool_or(lang = 'en') THEN 'ok' ELSE 'split_not_found' END AS status FROM documents GROUP BY source
        UNION ALL SELECT DISTINCT source, '-', '-', 'bad_format' FROM documents
        UNION ALL SELECT DISTINCT 'no-' || source || ':chat', 'no-' || source, 'chat', 'unknown_dataset' FROM documents
        UNION ALL SELECT DISTINCT source || '-next:chat', source || '-next', 'chat', 'not_downloaded' FROM documents
        UNION ALL SELECT DISTINCT source || ':code:main', source, 'code:main', 'split_not_found' FROM documents""",
    "chosen_splits": f"""WITH {COUNTS} SELECT dataset, split, true AS take_all FROM counts
          WHERE split NOT LIKE '%multilingual%'
        UNION ALL SELECT dataset, split, false FROM counts""",
    "split_counts": f"WITH {COUNTS} SELECT dataset, split, n FROM counts",
    "dataset_summary": f"""WITH {COUNTS}, {KNOWN} SELECT k.dataset,
          coalesce(string_agg(split, ', ' ORDER BY split), '') AS splits, coalesce(sum(n), 0)::BIGINT AS n,
          sum(n) IS NOT NULL AS ok FROM known k LEFT JOIN counts USING (dataset) GROUP BY 1""",
    "shard_plan": f"""WITH {COUNTS}, sized AS (SELECT *, {K_BY_SIZE} AS k FROM counts),
        shards AS (SELECT *, unnest(range(k)) AS shard_id FROM sized)
        SELECT dataset, split, shard_id, k AS total_shards, dataset || ':' || split || ':shard' || shard_id AS spec,
          dataset || '-' || split || '-' || lpad(shard_id::VARCHAR, 5, '0') || '-of-' || lpad(k::VARCHAR, 5, '0')
          || '.parquet' AS file FROM shards""",
    "shards_from_files": f"""WITH {SAMPLES}, splits AS (SELECT DISTINCT dataset, split FROM samples),
        files AS (SELECT DISTINCT dataset, CASE doc_id % 3
          WHEN 0 THEN '/c/' || dataset || '/' || split || '/' || doc_id % 10
          WHEN 1 THEN '/c/' || dataset || '/h/x-' || split || '-' || doc_id % 10
          ELSE '/c/' || dataset || '/other/' || doc_id % 10 END AS path FROM samples)
        SELECT s.dataset, s.split, greatest(1, count(f.path)) AS total_shards
        FROM splits s LEFT JOIN files f ON s.dataset = f.dataset AND (contains(f.path, '/' || s.split || '/')
          OR contains(string_split(f.path, '/')[-1], '-' || s.split || '-')) GROUP BY ALL""",
    "union_catalog": f"""WITH {COUNTS} SELECT dataset, split, n FROM counts
        UNION ALL SELECT 'benchmark', 'part' || item_id % 3, count(*) FROM benchmark GROUP BY 2""",
    "shard_assign": f"WITH {SAMPLES}, {_sharded('samples', str(SHARDS))} SELECT doc_id, shard_id, original_index FROM sharded",
    "shard_assign_unnamed": f"""WITH {SAMPLES}, unnamed AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN dataset END AS dataset,
          CASE WHEN doc_id % 5 <> 0 THEN split END AS split FROM samples),
        {_sharded('unnamed', str(SHARDS))} SELECT doc_id, shard_id, original_index FROM sharded""",
    "numbered_instant": """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS idx,
        true AS bounded FROM events""",
    "shard_assign_text": f"""WITH {SAMPLES}, keyed AS (SELECT dataset, split, md5(doc_id::VARCHAR) AS uuid FROM samples),
        {_sharded('keyed', str(SHARDS), 'uuid')} SELECT uuid, shard_id, original_index FROM sharded""",
    "resume_pending": f"WITH {SAMPLES} SELECT dataset, split, doc_id FROM samples WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "resume_committed": f"""WITH {RUN} SELECT dataset, split, shard_id, any_value(k)::BIGINT AS total_shards FROM sharded
        GROUP BY dataset, split, shard_id
        HAVING count(text) > 0 AND (dataset = 'src2' OR dataset = 'src1' AND count(text) FILTER (original_index % 2 = 1) > 0)""",
    "resume_skipped": f"WITH {SAMPLES} SELECT dataset, split, doc_id FROM samples WHERE doc_id IN (SELECT doc_id FROM labels)",
    "shard_status": f"""WITH {RUN}, per_shard AS (SELECT dataset, split, shard_id, count(text) AS n,
          count(*) FILTER (length(text) % 97 = 0) AS e FROM sharded GROUP BY ALL)
        SELECT p.dataset, p.split, p.shard_id, p.dataset || ':' || p.split || ':shard' || p.shard_id AS shard,
          CASE WHEN d.samples IS NOT NULL THEN 'skipped' WHEN n = 0 THEN 'no_text' WHEN e > 0 THEN 'error' ELSE 'success' END AS status,
          coalesce(d.samples, n - e) AS samples FROM per_shard p LEFT JOIN done d USING (dataset, split, shard_id)""",
    "embed_shards": f"""WITH {RUN}, {_embedding('blanked')}
        SELECT dataset, split, shard_id, original_index, s.doc_id, round(x, 6) AS x0 FROM sharded s
        JOIN vec ON s.doc_id = vec.doc_id AND component = 0 ANTI JOIN done USING (dataset, split, shard_id)""",
    "embedding_report": f"""WITH {RUN}, files AS (SELECT dataset, split, shard_id, count(text) AS n FROM sharded
          GROUP BY ALL HAVING count(text) > 0)
        SELECT coalesce(dataset, '-') AS dataset, coalesce(split, '-') AS split, CASE grouping(dataset, split) WHEN 0 THEN 'split' WHEN 1 THEN 'dataset' ELSE 'all' END AS level,
          sum(n)::BIGINT AS samples, count(*) AS files, 0::BIGINT AS invalid FROM files GROUP BY ROLLUP (dataset, split)""",
    "text_messages": """SELECT conv_id, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn)
          FILTER ((conv_id + turn) % 17 <> 0), '') AS text FROM conversations GROUP BY ALL""",
    "text_turns": "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
    "text_field": "SELECT doc_id, text FROM documents WHERE doc_id % 13 NOT IN (0, 1) AND regexp_matches(text, '[^ \\n]')",
    "text_fallback": "SELECT page_id, concat_ws(chr(10) || chr(10), CASE WHEN length(url) > 10 THEN url END, CASE WHEN length(html) > 10 THEN html END) AS text FROM pages",
    "split_previews": f"""WITH {SAMPLES}, f AS (SELECT * FROM samples QUALIFY row_number() OVER (PARTITION BY dataset, split ORDER BY doc_id) = 1)
        SELECT dataset, split, 'doc_id' AS field, doc_id::VARCHAR AS value FROM f
        UNION ALL SELECT dataset, split, 'text', CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END FROM f""",
    "read_samples": f"""WITH {SAMPLES}, read AS (SELECT *, CASE WHEN split = 'chat' THEN 4 ELSE 2 END AS times FROM samples)
        SELECT dataset, split, sum(times)::BIGINT AS n, sum(times * length(text))::BIGINT AS n_chars FROM read GROUP BY ALL""",
    "validate_tree": f"""WITH {FILES}, odd AS (SELECT sum(rows)::BIGINT AS rows, sum(nan_n)::BIGINT AS nan_n, sum(inf_n)::BIGINT AS inf_n FROM files)
        SELECT 'odd' AS dataset, 's0' AS split, rows, nan_n, inf_n, true AS valid, '' AS errors, true AS warned FROM odd
        UNION ALL SELECT 'good', 's0', count(*), 0, 0, true, '', false FROM embeddings
        UNION ALL SELECT 'bare', 's0', count(*), 0, 0, false, 'Missing ''embeddings'' column', false FROM embeddings
        UNION ALL SELECT 'empty', 's0', 0, 0, 0, true, '', false""",
    "block_classes": f"""WITH {BLOCKS}, shown AS (SELECT document, page, block_id, type, coalesce(type, 'DEFAULT') AS class FROM blocks),
        classes AS (SELECT class, count(*) AS n FROM shown GROUP BY 1)
        SELECT document, page, block_id, coalesce(type, '-') AS type, n AS class_n
        FROM shown s JOIN classes c ON c.class = CASE WHEN s.class IN ('TOC', 'Footnote') THEN 'DEFAULT' ELSE s.class END""",
    "sample_preview": """WITH f AS (SELECT * FROM documents ORDER BY doc_id LIMIT 1),
        u AS (SELECT 'doc_id' AS field, doc_id::VARCHAR AS value FROM f UNION ALL SELECT 'text', text FROM f
          UNION ALL SELECT 'lang', lang FROM f UNION ALL SELECT 'source', source FROM f
          UNION ALL SELECT 'n_chars', n_chars::VARCHAR FROM f)
        SELECT field, CASE WHEN length(value) > 500 THEN left(value, 500) || '...' ELSE value END AS value FROM u""",
    "embed_documents": f"""WITH {_embedding('documents')}, n AS (SELECT doc_id, sum(c)::BIGINT AS n_tokens FROM counted GROUP BY 1)
        SELECT doc_id, n_tokens, 16::BIGINT AS dim, component, round(x, 6) AS x FROM vec JOIN n USING (doc_id)""",
    "embed_faulty": f"""WITH {_embedding('documents')}, judged AS (SELECT doc_id,
          length(text) % 11 = 0 OR length(text) % 13 = 0 OR length(text) % 17 = 0 AS failed FROM documents)
        SELECT doc_id, failed, CASE WHEN NOT failed THEN round(x::FLOAT::DOUBLE, 4) END AS x0
        FROM judged JOIN vec USING (doc_id) WHERE component = 0""",
    "embed_queries": f"""WITH asked AS (SELECT doc_id, 'query: ' || text AS text FROM documents),
        {_embedding('asked', max_tokens=8192)} SELECT doc_id, component, round(x, 6) AS x FROM vec""",
    "attach_source": f"""WITH {RUN}, {_embedding('blanked')}
        SELECT dataset, split, shard_id, original_index, left(text, 100) AS text, round(x, 6) AS x0 FROM sharded s
        JOIN vec ON s.doc_id = vec.doc_id AND component = 0""",
    "validate_files": f"""WITH {WARNED}
        SELECT dataset, split, file, rows, dim, min_dim, max_dim, nan_n::BIGINT AS nan_n, inf_n::BIGINT AS inf_n,
          true AS valid, '' AS errors,
          concat_ws('; ', CASE WHEN nan_n > 0 THEN 'Found ' || nan_n || ' NaN values' END,
            CASE WHEN inf_n > 0 THEN 'Found ' || inf_n || ' Inf values' END) AS warnings FROM files""",
    "validate_rollup": f"""WITH {FILES} SELECT coalesce(dataset, '-') AS dataset, coalesce(split, '-') AS split,
          CASE grouping(dataset, split) WHEN 0 THEN 'split' WHEN 1 THEN 'dataset' ELSE 'all' END AS level,
          sum(rows)::BIGINT AS samples, count(*) AS files, round(count(*) * {MB}, 6) AS size_mb, 0::BIGINT AS invalid
        FROM files GROUP BY ROLLUP (dataset, split)""",
    "validate_overall": f"""WITH {WARNED}
        SELECT true AS all_valid, (SELECT string_agg(dim::VARCHAR, ',' ORDER BY dim) FROM (SELECT DISTINCT dim FROM files)) AS dims,
          count(DISTINCT dataset) AS datasets, count(DISTINCT (dataset, split)) AS splits, count(*) AS files,
          sum(rows)::BIGINT AS samples, 0::BIGINT AS errors, (SELECT count(*) FROM warned) AS warnings FROM files""",
    "validation_issues": f"WITH {WARNED} SELECT dataset, split, file, 'warning' AS kind, message FROM warned",
    "split_dims": f"WITH {FILES} SELECT dataset, split, arg_max(dim, file) AS dim FROM files WHERE dim > 0 GROUP BY ALL",
    "size_labels": f"""WITH {TREE}, files AS (SELECT DISTINCT dataset, split, file FROM tree),
        sized AS (SELECT dataset, split, count(*) * {MB} AS mb FROM files GROUP BY ROLLUP (dataset, split))
        SELECT coalesce(dataset, '-') AS dataset, coalesce(split, '-') AS split, CASE WHEN mb >= 1024 THEN printf('%.2f GB', mb / 1024) ELSE printf('%.2f MB', mb) END AS label
        FROM sized""",
    "compare_source": f"""WITH {COUNTS}, embedded AS (SELECT dataset, split, count(*) AS embedded FROM samples
          WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY ALL),
        source AS (SELECT dataset, split, n AS source FROM counts WHERE dataset <> 'src1')
        SELECT dataset, split, embedded, coalesce(source, -1) AS source, coalesce(embedded - source, -1) AS diff,
          coalesce(round(embedded / source * 100, 6), -1) AS pct, coalesce(abs(embedded - source) <= 1, false) AS matches FROM embedded LEFT JOIN source USING (dataset, split)""",
    "vector_stats": f"""WITH {TREE} SELECT original_index, len(v) AS dim, round(list_min(v), 6) AS min,
          round(list_max(v), 6) AS max, round(list_avg(v), 6) AS mean, round(list_stddev_pop(v), 6) AS std,
          round(sqrt(list_dot_product(v, v)), 6) AS norm FROM tree""",
    "sample_vectors": f"""WITH {TREE}, first AS (SELECT * FROM tree
          WHERE (dataset, split, file) = (SELECT (dataset, split, file) FROM tree ORDER BY dataset, split, file LIMIT 1)
          ORDER BY original_index LIMIT 3)
        SELECT file, original_index, round(sqrt(list_dot_product(v, v)), 6) AS norm, component,
          round(v[component + 1], 6) AS x FROM first, (SELECT unnest(range(5)) AS component)""",
    "set_metadata": f"""WITH {TREE} SELECT count(*) AS total, arg_min(len(v), original_index) AS dim,
          string_agg(DISTINCT split, ',' ORDER BY split) AS splits,
          string_agg(DISTINCT dataset, ',' ORDER BY dataset) AS datasets FROM tree""",
    "knn_graph": f"WITH {_knn(15)} SELECT i, j, rk, d FROM knn",
    "knn_text_ids": f"""WITH {_knn(5).replace("a.vec_id AS i, b.vec_id AS j", "'v' || a.vec_id AS i, 'v' || b.vec_id AS j")}
        SELECT i, j, rk, d FROM knn""",
    "descent_recall": "SELECT count(*) * 15 AS n_pairs, true AS found FROM embeddings",
    "fuzzy_graph": f"WITH RECURSIVE {FUZZY} SELECT i, j, w FROM graph",
    "layout_step": f"""WITH RECURSIVE {FUZZY},
        spots AS (SELECT vec_id AS v, embedding[1]::DOUBLE * 10 AS x, embedding[2]::DOUBLE * 10 AS y FROM embeddings),
        degrees AS (SELECT i AS v, sum(w) AS degree FROM graph GROUP BY 1),
        draws AS (SELECT n, (43 + {STEP_EPOCH} * {PARTNERS} + s)::DOUBLE * {GOLDEN}::DOUBLE AS k
          FROM range({PARTNERS}) t(s), (SELECT count(*) AS n FROM embeddings)),
        others AS (SELECT i AS v, x AS xj, y AS yj, w, false AS push FROM graph JOIN spots ON j = spots.v
          UNION ALL SELECT (v - (1 + floor((n - 1) * (k - floor(k)))::BIGINT) + n) % n, x, y, 0, true FROM spots, draws),
        apart AS (SELECT v, x - xj AS dx, y - yj AS dy, w, push, degree, (x - xj) * (x - xj) + (y - yj) * (y - yj) AS d2
          FROM others JOIN spots USING (v) JOIN degrees USING (v)),
        strengths AS (SELECT v, dx, dy, CASE
            WHEN push THEN degree * {REPULSION / PARTNERS}::DOUBLE * {2 * CURVE_B}::DOUBLE
              / ((0.001::DOUBLE + d2) * (1 + {CURVE_A}::DOUBLE * pow(d2, {CURVE_B}::DOUBLE)))
            WHEN d2 > 0 THEN w * {-2 * CURVE_A * CURVE_B}::DOUBLE * pow(d2, {CURVE_B - 1}::DOUBLE)
              / (1 + {CURVE_A}::DOUBLE * pow(d2, {CURVE_B}::DOUBLE))
            ELSE 0 END AS f FROM apart),
        moved AS (SELECT v, sum(greatest(-4, least(4, f * dx))) AS fx, sum(greatest(-4, least(4, f * dy))) AS fy FROM strengths GROUP BY 1)
        SELECT v, round(x + (1 - {STEP_EPOCH}::DOUBLE / 200) * greatest(-4, least(4, fx)), 5) AS x,
          round(y + (1 - {STEP_EPOCH}::DOUBLE / 200) * greatest(-4, least(4, fy)), 5) AS y FROM spots JOIN moved USING (v)""",
    "pca_2d": f"WITH RECURSIVE {PCA} SELECT vec_id, x, y FROM pca",
    "plot_points": f"WITH RECURSIVE {POINTS} SELECT * FROM points",
    "roundtrip_points": f"""WITH RECURSIVE {POINTS} SELECT dataset, split, count(*) AS n, round(sum(x), 5) AS x,
          sum(length(text))::BIGINT AS n_chars FROM points GROUP BY ALL""",
    "roundtrip_structured": """SELECT doc_id::VARCHAR AS document, len(string_split(text, chr(10))) AS elements
        FROM documents WHERE doc_id % 10 NOT IN (0, 1, 2, 3)""",
    "roundtrip_preview": f"""WITH {BLOCKS} SELECT document, page, count(*) AS n,
          sum(CASE WHEN length(text) > 200 THEN 203 ELSE length(text) END)::BIGINT AS n_chars FROM blocks GROUP BY ALL""",
    "layout_records": f"""WITH {BLOCKS}, counted AS (SELECT page, count(*) AS n FROM blocks WHERE page % 6 IN (0, 1) GROUP BY 1)
        SELECT source AS document, count(n) AS processed, count(*) AS total, coalesce(sum(n), 0)::BIGINT AS blocks,
          count(n) = count(*) AS success FROM documents LEFT JOIN counted ON doc_id = page GROUP BY 1""",
    "decoded_pages": "SELECT page_id, html AS text FROM pages",
    "data_uris": "SELECT page_id, 'data:image/png;base64,' || base64(encode(html)) AS uri FROM pages",
    "legend": f"""WITH {TREE} SELECT split, dense_rank() OVER (ORDER BY split) - 1 AS slot, count(*) AS n FROM tree GROUP BY split""",
    "legend_slots": f"WITH {TREE} SELECT original_index, split, dense_rank() OVER (ORDER BY split) - 1 AS slot FROM tree",
    "block_records": f"""WITH {BLOCKS} SELECT document, page, block_id, coalesce(type, 'DEFAULT') AS type, text,
          round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmax, 6) AS xmax, round(ymax, 6) AS ymax,
          trunc(xmin * 1536)::BIGINT AS x0, trunc(ymin * 2048)::BIGINT AS y0,
          trunc(xmax * 1536)::BIGINT AS x1, trunc(ymax * 2048)::BIGINT AS y1,
          xmax > xmin AND ymax > ymin AS is_valid FROM boxed""",
    "block_preview": f"""WITH {BLOCKS} SELECT document, page, block_id AS id, coalesce(type, 'DEFAULT') AS type,
          CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS text,
          rx0 AS xmin, ry0 AS ymin, rx1 AS xmax, ry1 AS ymax FROM blocks""",
    "drawable_blocks": f"""WITH {BLOCKS} SELECT document, page, block_id, round(cx0 * 1536, 6) AS x0, round(cy0 * 2048, 6) AS y0,
          round(cx1 * 1536, 6) AS x1, round(cy1 * 2048, 6) AS y1, block_id || ': ' || coalesce(type, 'DEFAULT') AS label
        FROM clamped WHERE cx1 > cx0 + 0.001 AND cy1 > cy0 + 0.001
          AND cx1 * 1536 > cx0 * 1536 + 1 AND cy1 * 2048 > cy0 * 2048 + 1""",
    "parse_docs": f"WITH {PARSED} SELECT document, processed, total, blocks, processed = total AS success FROM docs",
    "parse_totals": f"""WITH {PARSED} SELECT count(*) AS documents, count(*) FILTER (processed = total) AS ok,
          sum(processed)::BIGINT AS processed, sum(total)::BIGINT AS pages, sum(blocks)::BIGINT AS blocks FROM docs""",
    "decode_responses": f"""WITH {BLOCKS} SELECT page, block_id,
          CASE WHEN block_id % 7 <> 0 THEN 'T' || block_id % 11 ELSE 'DEFAULT' END AS type,
          CASE WHEN block_id % 5 <> 0 THEN text ELSE '' END AS text, round(block_id / 100.0::DOUBLE, 6) AS xmin
        FROM lines WHERE page % 6 IN (0, 1)""",
    "archive_elements": """WITH counted AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE len(string_split(text, chr(10))) END AS n
        FROM documents WHERE doc_id % 10 NOT IN (1, 2, 3))
        SELECT doc_id::VARCHAR AS document, n AS elements, (n + 3) // 4 AS text_n, (n + 1) // 4 AS table_n FROM counted""",
    "extraction_totals": """SELECT count(*) FILTER (doc_id % 10 NOT IN (1, 2, 3)) AS ok,
          count(*) FILTER (doc_id % 10 IN (1, 2, 3)) AS failed FROM documents""",
    "landing_link": f"""WITH {LANDED} SELECT page_id, coalesce(method, '-') AS method, coalesce(link, '-') AS link,
          CASE WHEN contains(link, 'widen.net') THEN 'viewer' WHEN link IS NOT NULL THEN 'document' ELSE '-' END AS route FROM found""",
    "quarantine": f"WITH {LANDED} SELECT page_id, url, length(html) AS n_chars FROM found WHERE link IS NULL",
    "viewer_link": """SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/v/' || page_id
          WHEN 1 THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/content/q.pdf?u=' || page_id || '&download=true'
          WHEN 2 THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/content/p' || page_id || '.pdf?download=true'
          ELSE '-' END AS link FROM pages""",
    "classify_fetch": f"WITH {FETCHED} SELECT page_id, url, first_class, second_class, route FROM fetched",
    "fetch_summary": f"""WITH {FETCHED}, outcome AS (SELECT CASE WHEN page_id % 7 = 0 THEN 'skipped'
          WHEN second_class = 'accepted' THEN 'downloaded' ELSE 'failed' END AS status, n_bytes FROM fetched)
        SELECT status, count(*) AS n,
          round(CASE status WHEN 'failed' THEN 0 ELSE sum(n_bytes) / (1024.0 * 1024.0)::DOUBLE END, 6) AS mb FROM outcome GROUP BY 1""",
    "run_summary": f"""WITH {LOG} SELECT coalesce(status, 'all') AS status, count(*) AS shards, sum(c)::BIGINT AS samples,
          round(sum(c) / sum(seconds), 6) AS rate FROM counted GROUP BY ROLLUP (status)""",
    "run_totals": f"""WITH {LOG}, runs AS (SELECT run, count(*) AS shards, sum(c)::BIGINT AS samples,
          sum(CASE WHEN status = 'success' THEN samples ELSE 0 END)::BIGINT AS new_samples,
          (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed FROM counted GROUP BY 1)
        SELECT run, shards, samples, new_samples, round(elapsed, 6) AS elapsed, round(samples / elapsed, 6) AS rate FROM runs""",
    "run_progress": f"""WITH {LOG}, summed AS (SELECT run, event_id, ts, min(ts) OVER (PARTITION BY run) AS start,
          row_number() OVER w AS done, sum(c) OVER w AS s FROM counted
          WINDOW w AS (PARTITION BY run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
        SELECT run, event_id, done, s::BIGINT AS total_samples,
          round(CASE WHEN ts > start THEN s / ((epoch_us(ts) - epoch_us(start)) / 1e6) ELSE 0 END, 6) AS avg_rate FROM summed""",
    "worker_latest": f"WITH {WORKERS}",
    "roundtrip_shards": f"""WITH {TREE} SELECT dataset, split, original_index % 4 AS shard_id, count(*) AS n,
          round(sum(v[1]), 6) AS x0 FROM tree GROUP BY ALL""",
    "roundtrip_blocks": f"""WITH {BLOCKS} SELECT document, page, count(*) AS n,
          count(*) FILTER (xmax > xmin AND ymax > ymin) AS valid, sum(length(text))::BIGINT AS n_chars FROM boxed GROUP BY ALL""",
    "roundtrip_json": f"""WITH {TREE}, cut AS (SELECT dataset, split, count(*) AS items FROM tree
          GROUP BY dataset, split, original_index % 4, original_index // 4 // {ITEMS_PER_OBJECT}),
        objects AS (SELECT dataset, split, count(*) AS objects, max(items) AS largest FROM cut GROUP BY ALL)
        SELECT dataset, split, any_value(objects) AS objects, any_value(largest) AS largest, count(*) AS n, sum(length(left(text, 100)))::BIGINT AS n_chars,
          round(sum(v[2]), 6) AS x1 FROM tree JOIN objects USING (dataset, split) LEFT JOIN documents ON doc_id = original_index
        WHERE original_index % 6 <> 0 GROUP BY dataset, split""",
    "stream_embed": f"WITH {_embedding('documents')} SELECT doc_id, component, round(x, 6) AS x FROM vec",
    "stream_totals": STATUS,
    "stream_latest": f"WITH {WORKERS}",
}
ORACLES["read_archives"] = ORACLES["read_structured"] = ORACLES["archive_elements"]
ORACLES["read_block_pages"] = f"""WITH {BLOCKS} SELECT document, page, count(*) AS n, sum(length(text))::BIGINT AS n_chars
  FROM blocks GROUP BY ALL"""
ORACLES["validate_changed"] = ORACLES["validate_tree"]
ORACLES["roundtrip_block_store"] = f"""WITH {BLOCKS} SELECT document, page, count(*) AS n, sum(length(text))::BIGINT AS n_chars,
  (SELECT count(*) FROM blocks WHERE document = 'src1') AS n_src1 FROM blocks GROUP BY ALL"""
ORACLES["roundtrip_large_json"] = ORACLES["roundtrip_json"]
