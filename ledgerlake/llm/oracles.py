"""DuckDB SQL of the collocations, the secret scans and the manifest, written from their definitions."""

from __future__ import annotations

from ledgerlake.llm import secret_scan

# ------------------------------------------------------------------ collocations

_OP11 = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
f AS (SELECT lang, k, g, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, range(1, 6) t(k) WHERE len(w) >= k) GROUP BY lang, k, g),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k >= 2 AND f >= 100),
cut AS (SELECT c.lang, c.g, c.a, h.f AS l, t.f AS r, n.n, j, (1000::hugeint * c.a * n.n) // (h.f::hugeint * t.f) AS score
    FROM c JOIN range(1, 5) x(j) ON j < c.k JOIN f h ON h.lang = c.lang AND h.g = c.g[1:j] JOIN f t ON t.lang = c.lang AND t.g = c.g[j + 1:] JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inside AS (SELECT lang, part, max(a) AS longer FROM (SELECT c.lang, c.a, c.g[i:i + s - 1] AS part FROM c JOIN range(2, 5) y(s) ON s < c.k JOIN range(1, 5) z(i) ON i + s - 1 <= c.k) GROUP BY lang, part),
kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.g WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::bigint AS n, score::bigint AS score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) WHERE rank <= 2000"""

# ------------------------------------------------------------------ secret scans


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(rank: int, rule: secret_scan.Rule) -> str:
    """Matches of one rule with their places: the pieces between the matches and the matches
    themselves, in turn, make up the text."""
    p = _quoted(f"({rule.pattern})")
    return f"""
SELECT row, {rank} AS rank, '{rule.kind}' AS kind, begins AS start, begins + length(m[i]) AS stop FROM (
    SELECT *, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS begins FROM (
        SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT row, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {rule.group + 1 if rule.group else 0}) AS v, string_split_regex(t, {_quoted(rule.pattern)}) AS g FROM d)))
WHERE length(v[i]) >= {rule.least}"""


_BASE = ", ".join(f"'{r.kind}'" for r in secret_scan.BASE_RULES)
_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_spans(k, r) for k, r in enumerate(secret_scan.RULES))}),
l AS (SELECT *, concat(kind, ':', start::bigint, ':', stop::bigint) AS one FROM s),
per AS (SELECT row, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE_RULES)},
    string_agg(one, ',' ORDER BY start, rank) FILTER (WHERE kind IN ({_BASE})) AS base, string_agg(one, ',' ORDER BY start, rank) AS spans FROM l GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (row)"""

# ------------------------------------------------------------------ manifest


def _field(value: str) -> str:
    return f"coalesce(concat(strlen({value}::varchar), ':', {value}::varchar), '-')"


#: The remainder of the polynomial division, bit by bit (there is no such function).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length(i) + 1), lambda k: ascii(i[k])::ubigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::ubigint[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::ubigint) ELSE c >> 1 END)))"""


def _tree(name: str, leaves: str) -> str:
    """All nodes of all trees: (tree, level, place, h), from leaves of level 0."""
    return f"""
{name} AS ({leaves} UNION ALL
    SELECT tree, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, level, place // 3)"""


def _folded(tree: str, up: str) -> str:
    """Follows a node up its tree: the siblings met and the node folded from them."""
    return f"""
{up} AS (SELECT row, tree, 0 AS level, place, folded, proof FROM {up}_from UNION ALL
    SELECT u.row, u.tree, u.level + 1, u.place // 3, sha256(string_agg(CASE WHEN n.place = u.place THEN u.folded ELSE n.h END, '' ORDER BY n.place)),
        u.proof || coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (WHERE n.place <> u.place), '')
    FROM {up} u JOIN {tree} n ON n.tree = u.tree AND n.level = u.level AND n.place // 3 = u.place // 3
    WHERE u.level < (SELECT max(level) FROM {tree} t WHERE t.tree = u.tree) GROUP BY u.row, u.tree, u.level, u.place, u.proof)"""


_OP13 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, *, doc_id::varchar AS i FROM documents),
e AS (SELECT *, sha256(concat({", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))})) AS leaf,
        sha256(concat({", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))}, {_field("CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END").replace("{crc}", _CRC32)})) AS tampered FROM d),
p AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM e),
{_tree("t", "SELECT tree, 0 AS level, place, leaf AS h FROM p")},
subroots AS (SELECT tree AS place, arg_max(h, level) AS h FROM t GROUP BY tree),
{_tree("s", "SELECT 0::bigint AS tree, 0 AS level, place, h FROM subroots")},
top AS (SELECT arg_max(h, level) AS root FROM s),
low_from AS (SELECT row, tree, place, tampered AS folded, '' AS proof FROM p),
{_folded("t", "low")},
high_from AS (SELECT row, 0::bigint AS tree, arg_max(tree, level) AS place, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM low GROUP BY row),
{_folded("s", "high")},
done AS (SELECT row, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM high GROUP BY row)
SELECT p.doc_id, leaf, subroots.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM p JOIN done USING (row) JOIN subroots ON subroots.place = p.tree, top"""

ORACLE = {"op11_phrase_collocations": _OP11, "op12_secret_scans": _OP12, "op13_merkle_dataset_manifest": _OP13}
