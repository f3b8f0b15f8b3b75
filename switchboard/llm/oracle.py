"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

from .oracle_codes import OP11, OP12, OP13

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, text: str = "text") -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_AZ}), '{pattern}')"


def near_dup(source: str, k: int, threshold: int = 80) -> str:
    """CTEs ending in classes(doc_id, n, component): components of the documents of ``source``."""
    return f"""
words AS (SELECT doc_id, {_words(_SPACED)} AS w FROM {source}),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
                ELSE list_distinct([array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k} + 2)]) END AS s FROM words),
sized AS (SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(list_sort(s), chr(10))) AS f, s FROM sets),
classes AS (SELECT f, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM sized WHERE n > 0 GROUP BY f),
toks AS (SELECT rep, n, unnest(s) AS t FROM classes),
links AS (SELECT a.rep AS a, b.rep AS b FROM toks a JOIN toks b ON a.t = b.t AND a.rep < b.rep
            AND a.n * 100 >= b.n * {threshold} AND b.n * 100 >= a.n * {threshold}
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {threshold} * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
roots AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a),
members AS (SELECT s.doc_id, s.n, coalesce(r.component, s.doc_id) AS component
            FROM sized s LEFT JOIN classes c ON s.f = c.f AND s.n > 0 LEFT JOIN roots r ON r.rep = c.rep)"""


OP1 = f"""WITH RECURSIVE {near_dup('documents', 2)}
SELECT doc_id, n AS n_shingles, component AS component_id, doc_id = component AS kept FROM members"""

OP4 = f"""WITH d AS (SELECT doc_id, {_words(_ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words(_ALNUM)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS t, least(len(w), 10) AS size
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
runs AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS t
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT DISTINCT doc_id, i, runs.size, item_id FROM runs JOIN win USING (t, size)),
n_hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP6 = """WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, len(embedding) AS d,
         label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
           AND len([x FOR x IN embedding IF x <> 0]) > 0 AS ok FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.d = b.d AND a.vec_id <> b.vec_id
          WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
root AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN root ON root.a = vec_id LEFT JOIN n ON n.a = vec_id"""

OP8 = """WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY pos) AS turns FROM p GROUP BY conv_id),
whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n) AS n FROM c GROUP BY turns),
parts AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM whole WHERE n > 1)),
kept AS (SELECT * FROM whole ANTI JOIN parts USING (turns))
SELECT conv_id, n AS n_turns, n_copies, array_to_string([
  '<|im_start|>' || replace(coalesce(x.r, 'unknown'), '<|', '< |') || chr(10) || replace(coalesce(x.t, ''), '<|', '< |') || '<|im_end|>' || chr(10)
  FOR x IN turns], '') AS chat FROM kept"""

ORACLE = {"op11_vector_codes": OP11, "op12_merkle_manifest": OP12, "op13_quality_rules": OP13, "op1_minhash_near_dedup": OP1, "op4_benchmark_decontamination": OP4, "op6_embedding_near_dedup": OP6, "op8_chat_formatting": OP8}
