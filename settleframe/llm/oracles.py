"""SQL (DuckDB) that says the same as registered queries, written from their
contracts. Queries with random draws, trained models, tokenizers or a ring have
none: their tests hold them against plain versions."""

from __future__ import annotations

# A-Z to a-z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STOP_WORDS = (
    "the of and to in a is that it on was with as be by for at from or an are "
    "der die und das in den von zu mit ist des auf ein eine dem im nicht als "
    "le la les de et des en un une du est dans que pour qui sur par au "
    "el los las y del se una por con para al lo como su mi").split()

OP3 = r"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digests AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM payloads),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM digests WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM digests LEFT JOIN firsts USING (payload_digest)"""

OP4 = r"""
WITH hashed AS (SELECT doc_id, length(coalesce(text, '')) AS points,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
ordered AS (SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM hashed
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM ordered"""

OP5 = rf"""
WITH RECURSIVE split_words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM split_words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce((SELECT min(y) FROM reached WHERE x = doc_id), doc_id)) AS component_id FROM sets"""

OP9 = rf"""
WITH split_words AS (SELECT doc_id, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT *, row_number() OVER () AS id,
  [array_to_string(w[i:i + 7], ' ') FOR i IN range(1, greatest(len(w) - 6, 1))] AS win FROM split_words),
placed AS (SELECT id, unnest(win) AS g, generate_subscripts(win, 1) AS i FROM windows),
again AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, g) AS n FROM placed) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT i + d) AS n_repeat_words FROM again, range(8) AS r(d) GROUP BY id),
measured AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in sorted(set(_STOP_WORDS)))}))) AS n_stop_words
  FROM windows LEFT JOIN covered USING (id)),
judged AS (SELECT *, concat_ws(',',
  CASE WHEN n_words < 20 THEN 'min_words' END,
  CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 'repeated_windows' END,
  CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 'mean_word_length' END,
  CASE WHEN 4 * n_symbols > n_words THEN 'symbols_per_word' END,
  CASE WHEN 50 * n_stop_words < n_words THEN 'stop_words' END,
  CASE WHEN 2 * n_dup_lines > n_lines THEN 'duplicate_lines' END) AS failed_rules FROM measured)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed_rules = '' AS kept, failed_rules FROM judged"""

OP11 = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
totals AS (SELECT lang, CAST(count(*) AS HUGEINT) AS n FROM placed GROUP BY lang),
counted AS (SELECT lang, p, len(p) AS k, CAST(count(*) AS HUGEINT) AS a
  FROM (SELECT lang, w[i:i + d] AS p FROM placed, range(5) AS r(d) WHERE i + d <= len(w)) GROUP BY lang, p HAVING count(*) >= 100),
candidates AS (SELECT * FROM counted WHERE k > 1),
inside AS (SELECT DISTINCT s.lang, s.p FROM candidates s JOIN
  (SELECT lang, a, k, p[i:i + d - 1] AS part FROM candidates, range(1, 5) AS x(i), range(2, 5) AS y(d) WHERE d < k AND i + d - 1 <= k) c
  ON c.lang = s.lang AND c.part = s.p AND 100 * c.a >= 100 * s.a),
cuts AS (SELECT c.lang, c.p, c.a, t.n, x.k, l.a AS l, r.a AS r, 1000 * c.a * t.n // (l.a * r.a) AS score
  FROM candidates c JOIN totals t USING (lang) JOIN range(1, 5) AS x(k) ON x.k < c.k
  JOIN counted l ON l.lang = c.lang AND l.p = c.p[1:x.k] JOIN counted r ON r.lang = c.lang AND r.p = c.p[x.k + 1:]),
lowest AS (SELECT *, array_to_string(p, ' ') AS phrase FROM cuts WHERE (lang, p) NOT IN (SELECT (lang, p) FROM inside)
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

# A tree's nodes of level k are the runs of eight of level k - 1, as long as there are several.
_LEAF_LEVELS, _LANG_LEVELS = 8, 4   # enough for 8**8 rows of a language and 8**4 languages


def _tree(prefix: str, source: str, key: str, depth: int) -> str:
    """CTEs {prefix}0..depth (key, pos, h): the levels; {prefix}_path: the digests
    before and after each node of level 0, level by level."""
    ctes = [f"{prefix}0 AS ({source})"]
    for k in range(1, depth + 1):
        ctes.append(f"""{prefix}{k} AS (SELECT {key}, pos // 8 AS pos, CASE WHEN max(size) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS size FROM {prefix}{k - 1}) GROUP BY {key}, pos // 8)""")
    steps = " UNION ALL ".join(
        f"SELECT o.{key}, o.pos, {k} AS level, "
        f"coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos < o.pos // {8 ** k}), '') AS b, "
        f"coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos > o.pos // {8 ** k}), '') AS a "
        f"FROM {prefix}0 o JOIN {prefix}{k} n ON o.{key} = n.{key} AND n.pos // 8 = o.pos // {8 ** (k + 1)} "
        f"WHERE (SELECT count(*) FROM {prefix}{k} x WHERE x.{key} = o.{key}) > 1 GROUP BY o.{key}, o.pos" for k in range(depth))
    ctes.append(f"{prefix}_path AS (SELECT {key}, pos, list({{'b': b, 'a': a}} ORDER BY level) AS path FROM ({steps}) GROUP BY {key}, pos)")
    return ",\n".join(ctes)


def _counted(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"


_CRC32 = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
    lambda a, i: xor(a >> 1, 3988292384::UBIGINT * (a & 1))))"""

OP13 = f"""
WITH rows_ AS (SELECT *, coalesce('=' || lang, '') AS tree, sha256({" || ".join(map(_counted, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
  CASE WHEN xor({_CRC32}, 4294967295::UBIGINT) % 3 = 0 AND text IS NOT NULL
    THEN sha256({" || ".join(map(_counted, ("doc_id", "source", "lang", "n_chars")))} || {_counted(_LOWER.replace("coalesce(text, '')", "text"))}) END AS other FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_),
{_tree("t", "SELECT tree, pos, leaf AS h FROM ranked", "tree", _LEAF_LEVELS)},
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM t{_LEAF_LEVELS}),
{_tree("r", "SELECT 0 AS k, pos, h FROM subroots", "k", _LANG_LEVELS)},
proved AS (SELECT r.doc_id, r.leaf, r.other, s.h AS subroot, (SELECT h FROM r{_LANG_LEVELS}) AS root,
  list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path
  FROM ranked r JOIN subroots s USING (tree) LEFT JOIN t_path p ON p.tree = r.tree AND p.pos = r.pos LEFT JOIN r_path q ON q.pos = s.pos),
folded AS (SELECT *, list_reduce(list_prepend(coalesce(other, leaf), list_transform(path, lambda x: x.b || ' ' || x.a)),
  lambda acc, x: sha256(split_part(x, ' ', 1) || acc || split_part(x, ' ', 2))) AS folded_root FROM proved)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded"""

ORACLE_SQL = {
    "op3_warc": OP3,
    "op4_exact_dedup": OP4,
    "op5_jaccard_join": OP5,
    "op9_quality_rules": OP9,
    "op11_phrases": OP11,
    "op13_merkle_manifest": OP13,
}
