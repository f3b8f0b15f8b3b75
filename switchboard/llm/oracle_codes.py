"""DuckDB SQL for the vector codes, the manifest and the quality rules, written from the contracts."""

from . import rules

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _codes() -> str:
    ctes = ["""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
       WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)""",
            "w AS (SELECT len(q) // 8 AS w FROM v WHERE r = 1)",
            "parts AS (SELECT r, p, q[p * w + 1:p * w + w] AS x FROM v, w, range(8) t(p))",
            "b0 AS (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16)"]
    distance = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(parts.x, b.x)])::BIGINT"
    for k in range(7):
        ctes.append(f"a{k} AS (SELECT r, p, any_value(parts.x) AS x, min({{'d': {distance}, 'e': b.e}}) AS m FROM parts JOIN b{k} b USING (p) GROUP BY r, p)")
        if k < 6:
            ctes.append(f"s{k} AS (SELECT p, m.e AS e, i, sum(x[i]) AS s, count(*) AS c FROM a{k}, w, range(1, w + 1) t(i) GROUP BY p, m.e, i)")
            ctes.append(f"m{k} AS (SELECT p, e, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS x FROM s{k} GROUP BY p, e)")
            ctes.append(f"b{k + 1} AS (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (p, e))")
    return "WITH " + ",\n".join(ctes) + """,
coded AS (SELECT r, string_agg(format('{:02x}', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a6 GROUP BY r),
book AS (SELECT sha256(string_agg(x[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b6, w, range(1, w + 1) t(i))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN coded USING (r), book"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _manifest(levels: int = 6) -> str:
    """Trees of up to 16 ** levels leaves."""
    ctes = ["crc(b, c, k) AS (SELECT b, b, 0 FROM range(256) t(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8)",
            "tab AS (SELECT list(c ORDER BY b) AS t FROM crc WHERE k = 8)",
            f"""d AS (SELECT *, row_number() OVER () AS id, {_leaf('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
                  lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0
             THEN {_leaf(f'translate(text, {_AZ})')} END AS other FROM documents, tab)""",
            "l0 AS (SELECT id, source, leaf AS h, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d)"]
    for k in range(levels):
        ctes.append(f"l{k + 1} AS (SELECT source, i // 16 AS i, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (n + 15) // 16 AS n FROM l{k} GROUP BY source, i // 16, n)")
    ctes.append(f"r0 AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM l{levels})")
    for k in range(levels):
        ctes.append(f"r{k + 1} AS (SELECT i // 16 AS i, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (n + 15) // 16 AS n FROM r{k} GROUP BY i // 16, n)")
    ctes.append("f0 AS (SELECT id, source, i, n, coalesce(other, leaf) AS x, '' AS proof FROM d JOIN l0 USING (id, source) UNION ALL SELECT id, d.source, i, n, coalesce(other, leaf), '' FROM d JOIN l0 USING (id) WHERE d.source IS NULL)")

    def up(name: str, was: str, level: str, same: str) -> str:
        return f"""{name} AS (SELECT f.id, f.source, f.i // 16 AS i, (f.n + 15) // 16 AS n,
        CASE WHEN f.n = 1 THEN f.x ELSE sha256(string_agg(CASE WHEN s.i = f.i THEN f.x ELSE s.h END, '' ORDER BY s.i)) END AS x,
        f.proof || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i <> f.i), '') AS proof
        FROM {was} f JOIN {level} s ON {same} s.i // 16 = f.i // 16 GROUP BY f.id, f.source, f.i, f.n, f.x, f.proof)"""
    for k in range(levels):
        ctes.append(up(f"f{k + 1}", f"f{k}", f"l{k}", "s.source IS NOT DISTINCT FROM f.source AND"))
    ctes.append(f"g0 AS (SELECT f.id, f.source, r0.i, r0.n, f.x, f.proof FROM f{levels} f JOIN r0 ON r0.source IS NOT DISTINCT FROM f.source)")
    for k in range(levels):
        ctes.append(up(f"g{k + 1}", f"g{k}", f"r{k}", ""))
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT d.doc_id, d.leaf, r0.h AS subroot, r{levels}.h AS root, sha256(g.proof) AS proof_sha256, g.x AS folded_root, g.x = r{levels}.h AS verified
FROM d JOIN g{levels} g USING (id) JOIN r0 ON r0.source IS NOT DISTINCT FROM d.source, r{levels}"""


def _rules() -> str:
    names = sorted(rules.COMMON_WORDS)
    listed = ", ".join(f"('{n}', {i}, '{w}')" for n in names for i, w in enumerate(rules.COMMON_WORDS[n]))
    classes = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[ \t]", r"[\n\x0B\f\r]", r"[.,]", r"[!?;:''\"()\-]", None, r"[^\x00-\x7F]"]
    counts = [f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" if c else "0" for c in classes]

    def distances(k: int, docs: str) -> str:
        """CTEs c{k}(r, char_distance), w{k}(r, word_distance): from the means over ``docs``."""
        out = []
        for kind, shares in (("c", "char_shares"), ("w", "word_shares")):
            name = {"c": "char_distance", "w": "word_distance"}[kind]
            out.append(f"""{kind}ref{k} AS (SELECT lang, bin, avg(share) AS q FROM {shares} JOIN {docs} USING (r) GROUP BY lang, bin),
{kind}{k} AS (SELECT r, sqrt(greatest(sum(CASE WHEN share > 0 THEN share * log2(2 * share / (share + q)) ELSE 0 END
                          + CASE WHEN q > 0 THEN q * log2(2 * q / (share + q)) ELSE 0 END) / 2, 0)) AS {name}
          FROM {shares} s JOIN {kind}ref{k} ref ON ref.bin = s.bin AND ref.lang IS NOT DISTINCT FROM s.lang GROUP BY r)""")
        return ",\n".join(out)

    def near(k: int) -> str:
        return (f"coalesce(char_distance <= {rules.CHAR_LIMIT} + {rules.CHAR_WIDER} / sqrt(n_points), true)"
                f" AND coalesce(word_distance <= {rules.WORD_LIMIT} + {rules.WORD_WIDER} / sqrt(n_listed), true)")
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang AS given, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS a FROM documents),
runs AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n_repeat FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
base AS (SELECT d.*, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, length(t) AS n_points, len(a) AS n_tokens FROM d LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
listed(lang, bin, word) AS (VALUES {listed}),
tokens AS (SELECT r, unnest(a) AS word FROM d),
hits AS (SELECT r, lang, bin, count(*) AS c FROM tokens JOIN listed USING (word) GROUP BY r, lang, bin),
cover AS (SELECT r, lang, sum(c) AS c FROM hits GROUP BY r, lang),
best AS (SELECT r, lang FROM cover QUALIFY row_number() OVER (PARTITION BY r ORDER BY c DESC, lang) = 1),
told AS (SELECT base.*, CASE WHEN given IN ({', '.join(f"'{n}'" for n in names)}) THEN given ELSE best.lang END AS lang,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base LEFT JOIN best USING (r)),
classes AS (SELECT r, lang, n_points, unnest([{', '.join(counts)}]) AS c, generate_subscripts([{', '.join('0' for _ in counts)}], 1) - 1 AS bin FROM told WHERE n_points >= {rules.LEAST_CHARS}),
char_shares AS (SELECT r, lang, bin, CASE WHEN bin = 7 THEN n_points - sum(c) OVER (PARTITION BY r) ELSE c END / n_points AS share FROM classes),
known AS (SELECT r, told.lang, listed.bin, n_tokens, coalesce(hits.c, 0) AS c FROM told JOIN listed USING (lang)
          LEFT JOIN hits USING (r, lang, bin) WHERE n_tokens >= {rules.LEAST_WORDS}),
word_shares AS (SELECT r, lang, bin, c / n_tokens AS share FROM known
          UNION ALL SELECT r, lang, -1, (any_value(n_tokens) - sum(c)) / any_value(n_tokens) FROM known GROUP BY r, lang),
told2 AS (SELECT r, n_points, n_tokens AS n_listed FROM told),
fine AS (SELECT r FROM told WHERE NOT base_failed),
{distances(1, 'fine')},
sound AS (SELECT r FROM fine JOIN told2 USING (r) LEFT JOIN c1 USING (r) LEFT JOIN w1 USING (r) WHERE {near(1)}),
{distances(2, 'sound')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {near(2)} AS kept
FROM told JOIN (SELECT r, n_tokens AS n_listed FROM told) USING (r) LEFT JOIN c2 USING (r) LEFT JOIN w2 USING (r)"""


OP11, OP12, OP13 = _codes(), _manifest(), _rules()
