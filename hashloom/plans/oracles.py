"""DuckDB SQL that says what the queries say, over the same tables."""

from __future__ import annotations

from ..operators import traversal

_OCC = "occ AS (SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(l_linenumber AS SMALLINT) AS ksize, l_partkey AS hash, CAST(l_partkey % 521 AS INTEGER) AS bucket FROM lineitem)"
_QUEUE = """q AS (
  SELECT event_id AS id, 'u' || user_id AS subdir, 'f' || event_id || '.fa.gz' AS filename, 'https://host/' || event_id AS url,
    CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'DOWNLOADING' WHEN 'view' THEN 'SKETCHING' ELSE 'DONE' END AS status,
    CAST(event_id % 25 AS INTEGER) AS tries, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(1750000000 - (event_id * 37) % 9000 AS DOUBLE) END AS updated_at
  FROM events)"""


def _sketch(table: str, sample: str, k: int, scaled: int) -> str:
    return (
        f"SELECT {sample} AS sample_id, CAST({k} AS SMALLINT) AS ksize, CAST('0x' || substr(md5(least(g, reverse(g))), 1, 15) AS BIGINT) AS hash"
        f" FROM (SELECT {sample}, substr(text, CAST(i AS BIGINT), {k}) AS g FROM (SELECT {sample}, text, unnest(range(1, length(text) - {k} + 2)) AS i FROM {table} WHERE length(text) >= {k}))"
        f" WHERE CAST('0x' || substr(md5(least(g, reverse(g))), 1, 15) AS BIGINT) < {(1 << 60) // scaled}"
    )


_SIDES = f"l AS (SELECT DISTINCT ksize, hash FROM ({_sketch('benchmark', 'item_id', 31, 20)})), r AS ({_sketch('documents', 'source', 31, 20)})"
_SETS = """s AS (
  SELECT DISTINCT lower(l_returnflag || l_linestatus) AS name, CAST(l_linenumber AS SMALLINT) AS ksize, l_partkey AS hash FROM lineitem
  UNION SELECT 'urgent', CAST(l_linenumber AS SMALLINT), l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'
), l AS (SELECT * FROM s WHERE name IN ('ro', 'urgent')), r AS (SELECT * FROM s WHERE name NOT IN ('ro', 'urgent'))"""
_LABEL_CASES = " ".join(f"WHEN regexp_matches(name, '^(?:{p})', 'i') THEN '{p}'" for p in traversal.SEQUENCE_PATTERNS)
_SKIPPED = " OR ".join(f"starts_with(path, '{p}')" for p in traversal.SKIP_PREFIXES)


def _shard(n: int, value: str, label: str) -> str:
    return f"SELECT page_id, CAST({value} AS INTEGER) AS shard, {label} AS dir FROM pages"


_SHA1 = "('0x' || right(sha1(url), 8))::UBIGINT % 4096"

ORACLES = {
    "sketch_documents": f"SELECT ksize, hash, CAST(hash % 521 AS INTEGER) AS bucket, count(DISTINCT sample_id) AS n_samples FROM ({_sketch('documents', 'source', 31, 1000)}) GROUP BY ksize, hash",
    "sketch_ksizes": "SELECT ksize, count(*) AS n_hashes, CAST(sum(hash % 1000003) AS BIGINT) AS sum_hashes FROM (SELECT DISTINCT ksize, hash FROM ("
    + " UNION ALL ".join(_sketch("documents", "source", k, 1000) for k in (15, 31, 33))
    + ")) GROUP BY ksize",
    "dedup_ksize_hash": f"WITH {_OCC} SELECT DISTINCT ksize, hash, bucket FROM occ",
    "dedup_hash": f"WITH {_OCC} SELECT DISTINCT hash, bucket FROM occ",
    "dedup_ksize_hash_counts": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "dedup_hash_counts": f"WITH {_OCC} SELECT hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "incremental_counts": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "bucket_histogram": f"WITH {_OCC} SELECT bucket, count(*) AS n_rows FROM occ GROUP BY bucket",
    "filter_ksizes": f"WITH {_OCC} SELECT ksize, count(*) AS n_rows FROM occ WHERE ksize IN (2, 4) GROUP BY ksize",
    "ingest_detect": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "union_by_name": f"WITH {_OCC} SELECT DISTINCT ksize, hash, bucket, CAST(-1 AS BIGINT) AS n_samples FROM occ WHERE ksize <= 3 UNION ALL SELECT ksize, hash, bucket, count(DISTINCT sample_id) FROM occ WHERE ksize > 3 GROUP BY ksize, hash, bucket",
    "merged_files": f"""WITH {_OCC}, u AS (
  SELECT DISTINCT ksize, hash, bucket, CAST(NULL AS BIGINT) AS n FROM occ WHERE ksize <= 3 UNION ALL SELECT ksize, hash, bucket, count(DISTINCT sample_id) FROM occ WHERE ksize > 3 GROUP BY ksize, hash, bucket)
SELECT bucket, count(*) AS n_rows, count(n) AS n_counted, CAST(coalesce(sum(n), 0) AS BIGINT) AS sum_samples FROM u GROUP BY bucket""",
    "bucket_tables": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "merged_buckets": f"WITH {_OCC} SELECT DISTINCT ksize, hash, bucket FROM occ",
    "folded_tables": """SELECT DISTINCT CAST(l_linenumber AS SMALLINT) AS ksize, l_partkey AS hash FROM lineitem l WHERE l_returnflag = 'R'
AND EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag <> 'R' AND r.l_linenumber = l.l_linenumber AND r.l_partkey = l.l_partkey)""",
    "list_buckets": f"WITH {_OCC} SELECT DISTINCT bucket FROM occ",
    "wgs_shards": f"""WITH {_OCC} SELECT CAST(31 AS SMALLINT) AS ksize, lpad(CAST(hash % 11 AS VARCHAR), 3, '0') || CASE WHEN hash % 3 = 0 THEN 'b' ELSE '' END AS part, count(*) AS n_rows, CAST(sum(hash % 1000003) AS BIGINT) AS sum_hashes
FROM (SELECT DISTINCT hash FROM occ) GROUP BY ALL""",
    "append_loads": f"WITH {_OCC} SELECT ksize, 2 * count(*) AS n_rows, count(DISTINCT hash) AS n_hashes FROM (SELECT DISTINCT ksize, hash FROM occ) GROUP BY ksize",
    "archive_rows": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "archive_faults": f"""WITH {_OCC}, o AS (SELECT *, CAST(sample_id AS BIGINT) AS n FROM occ WHERE CAST(sample_id AS BIGINT) % 5 <> 0), d AS (
  SELECT sample_id, CAST(CASE ksize WHEN 4 THEN 0 ELSE ksize END AS SMALLINT) AS ksize, hash FROM o
  WHERE ksize IN (1, 4, 5) OR ksize = 2 AND n % 2 = 1 OR ksize = 6 AND n % 3 <> 0)
SELECT ksize, count(*) AS n_rows, count(DISTINCT sample_id) AS n_samples, CAST(sum(hash) AS BIGINT) AS sum_hashes FROM d GROUP BY ksize""",
    "archive_sink": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL",
    "archive_source": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ WHERE ksize IN (2, 3, 5, 7) GROUP BY ALL",
    "tsv_sequences": "SELECT CAST(p_partkey AS VARCHAR) AS header, replace(p_name, ' ', '') AS sequence FROM part",
    "list_lines": "SELECT replace(s_name, '#', ' ') AS name, CASE s_suppkey % 3 WHEN 0 THEN 'dir' WHEN 1 THEN 'slink' ELSE 'file' END AS kind FROM supplier",
    "catalog_rows": """SELECT n_name AS name, lower(n_name) AS alias, '/db/' || n_name AS path, 'unique_hashes' AS "table", 'hash' AS "column",
  CASE WHEN n_nationkey % 2 = 0 THEN 'left' ELSE 'right' END AS set_id, CASE WHEN n_nationkey % 2 = 1 THEN 'ksize' END AS ksize FROM nation""",
    "ingest_modes": f"""WITH {_OCC}, u AS (SELECT DISTINCT ksize, hash FROM occ)
SELECT 'create' AS mode, count(*) AS n_rows FROM u UNION ALL SELECT 'append', count(*) + count(*) FILTER (ksize <= 3) FROM u UNION ALL SELECT 'replace', count(*) FROM u WHERE ksize = 2""",
    "ingest_statistics": f"""WITH {_OCC}, u AS (SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ GROUP BY ALL)
SELECT c AS "column", CAST(CASE c WHEN 'ksize' THEN min(ksize) WHEN 'hash' THEN min(hash) WHEN 'bucket' THEN min(bucket) ELSE min(n_samples) END AS VARCHAR) AS lo,
  CAST(CASE c WHEN 'ksize' THEN max(ksize) WHEN 'hash' THEN max(hash) WHEN 'bucket' THEN max(bucket) ELSE max(n_samples) END AS VARCHAR) AS hi, '0' AS n_null
FROM u, (VALUES ('ksize'), ('hash'), ('bucket'), ('n_samples')) t(c) GROUP BY c""",
    "index_probe": f"WITH {_OCC} SELECT ksize, hash, bucket, count(DISTINCT sample_id) AS n_samples FROM occ WHERE hash IN (SELECT o_orderkey FROM orders) GROUP BY ALL",
    "shards_ksize": f"WITH {_OCC} SELECT CAST(21 AS SMALLINT) AS ksize, lpad(CAST(hash % 7 AS VARCHAR), 3, '0') AS part, count(DISTINCT hash) AS n_rows FROM occ GROUP BY ALL",
    "queue_worker": f"""WITH {_QUEUE}, c AS (
  SELECT id FROM (SELECT *, CASE WHEN status = 'PENDING' THEN 0 ELSE 1 END AS class FROM q
    WHERE status = 'PENDING' OR status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= 1750000000 - 3600))
  ORDER BY class, CASE WHEN class = 0 THEN NULL ELSE updated_at END NULLS FIRST, id LIMIT 400
), w AS (
  SELECT q.*, c.id IS NOT NULL AS taken, c.id IS NOT NULL AND q.id % 11 <> 0 AND (q.id % 7 = 0 OR q.id % 5 = 0) AS bad FROM q LEFT JOIN c ON q.id = c.id)
SELECT id, CASE WHEN bad THEN 'ERROR' WHEN taken THEN 'DONE' ELSE status END AS status, CAST(tries + CASE WHEN bad THEN 3 ELSE 0 END AS INTEGER) AS tries,
  CASE WHEN taken AND NOT bad THEN CASE WHEN id % 11 = 0 THEN '/old' ELSE '/out/f' || id || '.fa.gz' END END AS out_path,
  CASE WHEN bad THEN CASE WHEN id % 7 = 0 THEN 'no result' ELSE 'broken' END END AS last_error FROM w""",
    "queue_worker_counts": f"""WITH {_QUEUE}, c AS (
  SELECT id FROM (SELECT *, CASE WHEN status = 'PENDING' THEN 0 ELSE 1 END AS class FROM q
    WHERE status = 'PENDING' OR status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= 1750000000 - 3600))
  ORDER BY class, CASE WHEN class = 0 THEN NULL ELSE updated_at END NULLS FIRST, id LIMIT 400
), o AS (
  SELECT id, CASE WHEN id % 11 = 0 THEN 'skipped' WHEN id % 7 = 0 OR id % 5 = 0 THEN 'error' ELSE 'done' END AS outcome, CASE WHEN id % 11 <> 0 THEN CASE WHEN id % 7 = 0 THEN 'no result' WHEN id % 5 = 0 THEN 'broken' END END AS error FROM c)
SELECT outcome, count(*) AS n, coalesce(string_agg(error, ',' ORDER BY id) FILTER (error IS NOT NULL AND place <= 20), '') AS examples
FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY id) AS place FROM o) GROUP BY outcome""",
    "queue_claim_errors": f"""WITH {_QUEUE} SELECT id, subdir, filename FROM q WHERE status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= 1750000000 - 3600)
ORDER BY updated_at NULLS FIRST, id LIMIT 400""",
    "queue_store": f"""WITH {_QUEUE}, s AS (
  SELECT * REPLACE (CASE WHEN stuck THEN 'PENDING' ELSE status END AS status, CASE WHEN stuck THEN 1750000000 ELSE updated_at END AS updated_at)
  FROM (SELECT *, status IN ('DOWNLOADING', 'SKETCHING') AND (updated_at IS NULL OR updated_at < 1750000000 - 3600) AS stuck FROM q)
), c AS (
  SELECT id, (row_number() OVER (ORDER BY class, CASE WHEN class = 0 THEN NULL ELSE updated_at END NULLS FIRST, id) - 1) // 200 AS claimer
  FROM (SELECT *, CASE WHEN status = 'PENDING' THEN 0 ELSE 1 END AS class FROM s WHERE status = 'PENDING' OR status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= 1750000000 - 3600))
  ORDER BY claimer LIMIT 600)
SELECT s.id, CASE WHEN claimer = 1 THEN 'ERROR' WHEN claimer IS NOT NULL THEN 'DOWNLOADING' ELSE status END AS status, CAST(tries + CASE WHEN claimer = 1 THEN 1 ELSE 0 END AS INTEGER) AS tries,
  CASE WHEN claimer = 1 THEN 'lost' END AS last_error, CAST(CASE claimer WHEN 0 THEN 1750000000 WHEN 1 THEN 1750000009 WHEN 2 THEN 1750000002 ELSE updated_at END AS DOUBLE) AS updated_at
FROM s LEFT JOIN c ON s.id = c.id""",
    "crawl_queue": """WITH f AS (
  SELECT 'r' || n_regionkey || '/n' || n_nationkey AS subdir, 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.fna.gz' AS filename FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 3 <> 0 AND c_custkey <> 1
), k AS (SELECT *, filename < 'c000000050' AS known FROM f)
SELECT row_number() OVER (ORDER BY known DESC, subdir, filename) AS id, subdir, filename, 'https://host/all/' || subdir || '/' || filename AS url, 'PENDING' AS status,
  CAST(1750000000 AS DOUBLE) AS updated_at, CASE WHEN known THEN 1749999991 ELSE 1750000000 END::DOUBLE AS created_at FROM k""",
    "infer_sample_id": "SELECT p_partkey AS id, 'GCA_' || p_partkey AS sample_id FROM part",
    "shard_md5": _shard(4096, "('0x' || right(md5(url), 8))::UBIGINT % 4096", "'bucket=' || lpad(CAST(('0x' || right(md5(url), 8))::UBIGINT % 4096 AS VARCHAR), 4, '0')"),
    "shard_sha1": _shard(4096, _SHA1, "'bucket=' || lpad(CAST(('0x' || right(sha1(regexp_extract(url, '[^/]*$')), 8))::UBIGINT % 4096 AS VARCHAR), 4, '0')"),
    "shard_sha256": _shard(512, "('0x' || right(sha256(url), 8))::UBIGINT % 512", "CAST(('0x' || right(sha256(url), 8))::UBIGINT % 512 AS VARCHAR)"),
    "u64_mod": """SELECT c_custkey, CAST(h % 521 AS INTEGER) AS m521, CAST(h % 512 AS INTEGER) AS m512, CAST(h % 64 AS INTEGER) AS m64, CAST(h AS VARCHAR) AS value
FROM (SELECT c_custkey, ('0x' || substr(md5(c_name), 1, 16))::UBIGINT AS h FROM customer)""",
    "u64_wrap": """SELECT o_orderkey, CAST(((v % 18446744073709551616::HUGEINT) + 18446744073709551616::HUGEINT) % 18446744073709551616::HUGEINT AS VARCHAR) AS value
FROM (SELECT o_orderkey, 9223372036854775807::HUGEINT * (o_orderkey % 5 - 2) + o_orderkey AS v FROM orders)""",
    "hrefs": "SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1, 'i')) AS href FROM pages) GROUP BY ALL",
    "hrefs_relative": """WITH h AS (SELECT page_id, split_part(trim(ltrim(unnest(regexp_extract_all(html, 'href="([^"]+)"', 1, 'i')), '/')), '?', 1) AS name FROM pages)
SELECT page_id, name, count(*) AS n FROM h
WHERE name NOT IN ('', '../', './') AND NOT starts_with(name, '/') AND NOT contains(name, '://') AND NOT contains(regexp_replace(name, '/+$', ''), '/') GROUP BY ALL""",
    "target_pages": """SELECT page_id, name FROM (SELECT page_id, regexp_extract(regexp_replace(url, '^https?://[^/]*', ''), '[^/]*$') AS name FROM pages)
WHERE NOT regexp_matches(name, '^(?:.*7)') AND regexp_matches(name, '^(?:[0-9]+)')""",
    "path_rules": f"""WITH p AS (
  SELECT doc_id, (['/genomes/', '/geo', '/pub/', '/sra/', '/refseq/./', '/blast/'])[doc_id % 6 + 1] || source || '/' AS dir, (['a.fna.gz', 'B.FA', 'c.txt', 'd_genomic.fna', 'e.fsa_nt.gz'])[doc_id % 5 + 1] AS name FROM documents
), f AS (SELECT doc_id, dir || name AS path, name FROM p)
SELECT doc_id, NOT contains(path, './') AND NOT ({_SKIPPED}) AS walkable, CASE {_LABEL_CASES} ELSE NULL END AS label FROM f""",
    "subtree_examples": """WITH f AS (
  SELECT doc_id, '/' || source || '/' AS subtree, '/' || source || CASE WHEN doc_id % 3 = 0 THEN '/' || lang ELSE '' END || '/seq ' || doc_id || '~.fna.gz' AS path FROM documents WHERE doc_id % 2 = 0)
SELECT subtree, 'https://host.example' || replace(arg_min(path, [lpad(CAST(len(string_split(path, '/')) AS VARCHAR), 3, '0'), path]), ' ', '%20') AS url FROM f GROUP BY subtree""",
    "quoted_urls": "SELECT p_partkey, replace(p_type, ' ', '%20') || '/~a%2Ab%2Bc/' || replace(p_name, ' ', '%20') AS quoted FROM part",
    "file_list": """SELECT '' AS subdir, 'k' || page_id || '.fa.gz' AS filename, 'https://bucket-a.s3.eu-west-2.amazonaws.com/k' || page_id || '.fa.gz' AS url,
  CASE WHEN page_id % 5 = 0 THEN -1 ELSE CAST(length(html) AS BIGINT) END AS size, '2024-01-01T00:00:00Z' AS mtime FROM pages WHERE page_id % 9 <> 0 AND page_id % 4 <> 0""",
    "first_files": """SELECT 'k' || page_id || '.fa.gz' AS filename, 'https://bucket-a.s3.eu-west-2.amazonaws.com/k' || page_id || '.fa.gz' AS url FROM pages WHERE page_id % 9 <> 0 AND page_id % 4 <> 0 ORDER BY filename LIMIT 50""",
    "file_list_queue": """WITH f AS (SELECT page_id, 'k' || page_id || '.fa.gz' AS filename, html FROM pages WHERE page_id % 9 <> 0 AND page_id % 4 <> 0)
SELECT row_number() OVER (ORDER BY filename) AS id, '' AS subdir, filename, 'https://bucket-a.s3.eu-west-2.amazonaws.com/' || filename AS url, CASE WHEN page_id % 5 = 0 THEN -1 ELSE CAST(length(html) AS BIGINT) END AS size,
  '2024-01-01T00:00:00Z' AS mtime, 'PENDING' AS status, 0 AS tries, CAST(1750000000 AS DOUBLE) AS created_at FROM f""",
    "fasta_files": """SELECT 'n' || s_nationkey || '/s' || s_suppkey || (['.fa', '.FNA', '.fasta.gz', '.txt', '.fa.bak', '.Fa.gz'])[s_suppkey % 6 + 1] AS name, CAST(strlen(s_name) AS BIGINT) AS length
FROM supplier WHERE s_suppkey % 6 NOT IN (3, 4)""",
    "subtree_report": """WITH f AS (
  SELECT doc_id, '/' || source || '/' AS subtree, '/' || source || CASE WHEN doc_id % 3 = 0 THEN '/' || lang ELSE '' END || '/seq ' || doc_id || '~.fna.gz' AS path FROM documents WHERE doc_id % 2 = 0)
SELECT subtree || chr(9) || 'https://host.example' || replace(arg_min(path, [lpad(CAST(len(string_split(path, '/')) AS VARCHAR), 3, '0'), path]), ' ', '%20') AS line FROM f GROUP BY subtree
UNION ALL SELECT '#subtree' || chr(9) || 'url'""",
    "queue_pending_work": f"WITH {_QUEUE} SELECT count(*) AS n FROM q WHERE status <> 'DONE'",
    "crawl_depth": """WITH RECURSIVE e AS (
  SELECT 'r' || r_regionkey AS child, 'root' AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation
), w(node, depth) AS (SELECT 'root', 0 UNION SELECT e.child, w.depth + 1 FROM w JOIN e ON e.parent = w.node WHERE w.depth < 4)
SELECT depth, count(*) AS n_nodes FROM (SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY node) GROUP BY depth""",
    "queue_stats": f"WITH {_QUEUE} SELECT status, count(*) AS n FROM q GROUP BY status UNION ALL SELECT 'total', count(*) FROM q",
    "queue_latest_state": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "queue_claim": f"""WITH {_QUEUE}, c AS (
  SELECT *, CASE WHEN status = 'PENDING' THEN 0 ELSE 1 END AS class FROM q
  WHERE status = 'PENDING' OR status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= 1750000000 - 3600))
SELECT id, subdir, filename FROM c ORDER BY class, CASE WHEN class = 0 THEN NULL ELSE updated_at END NULLS FIRST, id LIMIT 400""",
    "queue_timers": """WITH l AS (
  SELECT 'u' || user_id AS subdir, event_id AS id, CAST(event_id % 25 AS INTEGER) AS tries, ts, max(ts) OVER () AS now,
    CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'DOWNLOADING' WHEN 'view' THEN 'SKETCHING' ELSE 'DONE' END AS status
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
), s AS (
  SELECT *, status IN ('DOWNLOADING', 'SKETCHING') AND date_trunc('milliseconds', ts) < date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 1 DAY AS stuck FROM l)
SELECT subdir, id, CASE WHEN stuck THEN 'PENDING' ELSE status END AS status, tries,
  stuck OR status = 'PENDING' OR status = 'ERROR' AND tries < 20 AND date_trunc('milliseconds', ts) <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR AS claimable FROM s""",
    "queue_requeue": f"""WITH {_QUEUE}, s AS (SELECT *, status IN ('DOWNLOADING', 'SKETCHING') AND (updated_at IS NULL OR updated_at < 1750000000 - 3600) AS stuck FROM q)
SELECT id, CASE WHEN stuck THEN 'PENDING' ELSE status END AS status, tries, CASE WHEN stuck THEN CAST(1750000000 AS DOUBLE) ELSE updated_at END AS updated_at FROM s""",
    "queue_upsert": f"""WITH {_QUEUE}
SELECT id, subdir, filename, url || CASE WHEN id % 3 = 0 THEN '?v=2' ELSE '' END AS url, CASE WHEN id % 3 = 0 THEN id ELSE -1 END AS size, CASE WHEN id % 3 = 0 THEN 'm' END AS mtime, status, tries FROM q
UNION ALL SELECT (SELECT max(id) FROM q) + row_number() OVER (ORDER BY page_id), 'p', 'page' || lpad(CAST(page_id AS VARCHAR), 9, '0'), url, -1, NULL, 'PENDING', 0 FROM pages""",
    "queue_mark": f"""WITH {_QUEUE}
SELECT id, CASE WHEN status = 'SKETCHING' THEN CASE WHEN id % 2 = 0 THEN 'DONE' ELSE 'ERROR' END ELSE status END AS status, tries + CASE WHEN status = 'SKETCHING' AND id % 2 = 1 THEN 1 ELSE 0 END AS tries,
  CASE WHEN status = 'SKETCHING' AND id % 2 = 0 THEN '/out/' || filename END AS out_path, CASE WHEN status = 'SKETCHING' AND id % 2 = 1 THEN 'failed' END AS last_error FROM q""",
    "queue_verify": f"""WITH {_QUEUE}, p AS (SELECT *, status = 'PENDING' AND id % 4 IN (0, 3) AS bad FROM q)
SELECT id, CASE WHEN bad THEN 'ERROR' ELSE status END AS status, tries, CASE WHEN bad THEN 'probe: ' || CASE WHEN id % 4 = 0 THEN '404' ELSE 'no answer' END END AS last_error FROM p""",
    "queue_unfinished": f"WITH {_QUEUE} SELECT id, subdir, filename, url, status FROM q WHERE status <> 'DONE' ORDER BY id LIMIT 100",
    "queue_next_batch": f"WITH {_QUEUE} SELECT id, subdir, filename, url FROM q WHERE status IN ('PENDING', 'ERROR') AND id > 100 ORDER BY id LIMIT 200",
    "even_chunks": "SELECT CAST(w - 1 AS INTEGER) AS worker, count(*) AS n_rows, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) AS w FROM orders) GROUP BY w",
    "backoff": "SELECT DISTINCT CAST(l_quantity AS INTEGER) AS tries, CAST(least(300, pow(2, CAST(l_quantity AS INTEGER))) AS DOUBLE) AS seconds FROM lineitem",
    "rna_to_dna": "SELECT doc_id, md5(replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'U', 'T')) AS digest FROM documents",
    "known_hashes": f"WITH {_SIDES} SELECT ksize, hash FROM l WHERE EXISTS (SELECT 1 FROM r WHERE r.ksize = l.ksize AND r.hash = l.hash)",
    "novel_hashes": f"WITH {_SIDES} SELECT ksize, hash FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.ksize = l.ksize AND r.hash = l.hash)",
    "containment": f"""WITH {_SIDES}, m AS (SELECT l.ksize, EXISTS (SELECT 1 FROM r WHERE r.ksize = l.ksize AND r.hash = l.hash) AS k FROM l)
SELECT ksize, count(*) AS n_left, count(*) FILTER (k) AS n_known, count(*) FILTER (k) / CAST(count(*) AS DOUBLE) AS containment FROM m GROUP BY ksize""",
    "cross_catalog_coverage": f"WITH {_SIDES} SELECT sample_id, count(*) AS n_known FROM (SELECT DISTINCT r.sample_id, r.ksize, r.hash FROM r JOIN l ON r.ksize = l.ksize AND r.hash = l.hash) GROUP BY sample_id",
    "catalog_overlaps": f"""WITH {_SETS}, nl AS (SELECT ksize, name AS left_set, count(*) AS n_left FROM l GROUP BY ALL), nr AS (SELECT ksize, name AS right_set, count(*) AS n_right FROM r GROUP BY ALL),
b AS (SELECT l.ksize, l.name AS left_set, r.name AS right_set, count(*) AS n_shared FROM l JOIN r ON l.ksize = r.ksize AND l.hash = r.hash GROUP BY ALL)
SELECT nl.ksize, nl.left_set, nr.right_set, n_left, n_right, coalesce(n_shared, 0) AS n_shared, coalesce(n_shared, 0) / CAST(n_left AS DOUBLE) AS containment
FROM nl JOIN nr ON nl.ksize = nr.ksize LEFT JOIN b ON b.ksize = nl.ksize AND b.left_set = nl.left_set AND b.right_set = nr.right_set""",
    "catalog_coverage": f"""WITH {_SETS} SELECT ksize, name AS left_set, count(*) AS n_left, count(*) FILTER (k) AS n_known, count(*) FILTER (NOT k) AS n_novel
FROM (SELECT l.*, EXISTS (SELECT 1 FROM r WHERE r.ksize = l.ksize AND r.hash = l.hash) AS k FROM l) GROUP BY ksize, name""",
    "point_lookup": f"WITH {_OCC} SELECT ksize, count(DISTINCT sample_id) AS n_samples FROM occ WHERE hash = 42 GROUP BY ksize",
    "stream_dedup": f"WITH {_OCC} SELECT DISTINCT ksize, hash, bucket FROM occ",
}
