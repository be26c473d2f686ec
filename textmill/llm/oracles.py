"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# The rules written out once more, in the dialect of the checking engine: kind, pattern
# with the measured part as the first group, least characters of it.
_SECRETS = (
    (
        "assign",
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
    ),
    ("access", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"([0-9a-f]+)", 24),
    ("forge", r"(gh[oprsu]_[A-Za-z0-9]{36,})", 1),
    ("chat", r"(xox[abeoprs]-[A-Za-z0-9-]{10,})", 1),
    ("maps", r"(AIza[A-Za-z0-9_-]{35})", 1),
    ("payment", r"([rs]k_(?:live|test)_[A-Za-z0-9]{16,})", 1),
    ("webtoken", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1),
    ("keyblock", r"(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)", 1),
)


def _secret_sql() -> str:
    parts = []
    for k, (kind, pattern, least) in enumerate(_SECRETS):
        q = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"""SELECT r, {k} AS k, '{kind}' AS kind, unnest(list_transform(list_filter(range(1, len(m) + 1),
                     lambda i: length(g[i]) >= {least}),
                     lambda i: {{'b': list_sum(list_transform(p[1:i], lambda x: length(x)))
                                + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
                           'n': length(m[i])}})) AS s
                FROM (SELECT r, regexp_extract_all(t, {q}, 0) AS m, regexp_extract_all(t, {q}, 1) AS g,
                             string_split_regex(t, {q}) AS p FROM d WHERE regexp_matches(t, {q}))"""
        )
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
spans AS (SELECT r, k, kind, CAST(s.b AS BIGINT) AS b, CAST(s.b + s.n AS BIGINT) AS e FROM found),
said AS (
  SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h,
         string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, k) AS everything
  FROM spans GROUP BY r)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access,
       CAST(coalesce(h, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(everything, '') AS spans
FROM d LEFT JOIN said USING (r)
"""


def _level_sql(base: str, level: int) -> str:
    """CTEs of one level of a tree: ``{base}{level}`` has (g, pos, h, m), m nodes in all."""
    under = f"{base}{level - 1}"
    return f"""
{base}runs{level} AS MATERIALIZED (SELECT g, m, pos // 16 AS pos, list(h ORDER BY pos) AS hs FROM {under} GROUP BY g, m, pos // 16),
{base}{level} AS MATERIALIZED (SELECT g, pos, CASE WHEN m > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
  (m + 15) // 16 AS m FROM {base}runs{level})"""


def _merkle_sql(levels: int = 6) -> str:
    """The same tree level by level, siblings looked up by joins. Six levels hold 16 million rows."""

    def said(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"

    head = " || ".join(said(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)"
    shifts = "list_reduce(range(8), lambda a, i: xor(a >> 1, (a & 1) * 3988292384), xor(c, b))"
    crc = f"xor(list_reduce({codes}, lambda c, b: {shifts}, 4294967295::BIGINT), 4294967295)"
    # A level is part of a proof if there was more than one node below it.
    joins = [
        f"JOIN {base}runs{k} AS {base}{k}r ON {base}{k}r.g = {group} AND {base}{k}r.pos = {pos} // {16 ** k}"
        for base, group, pos in (("t", "d.g", "d.pos"), ("u", "''", "w.pos"))
        for k in range(1, levels + 1)
    ]
    steps, source = [], "ways"
    columns = ", ".join(
        f"CASE WHEN {b}{k}r.m > 1 THEN array_to_string({b}{k}r.hs[1:(({p} // {16 ** (k - 1)}) % 16)], '') END AS l_{b}{k}, "
        f"CASE WHEN {b}{k}r.m > 1 THEN array_to_string({b}{k}r.hs[(({p} // {16 ** (k - 1)}) % 16) + 2:], '') END AS r_{b}{k}"
        for b, p in (("t", "d.pos"), ("u", "w.pos"))
        for k in range(1, levels + 1)
    )
    for b in "tu":
        for k in range(1, levels + 1):
            name = f"f_{b}{k}"
            steps.append(
                f"{name} AS (SELECT * EXCLUDE (f), CASE WHEN l_{b}{k} IS NULL THEN f ELSE sha256(l_{b}{k} || f || r_{b}{k}) END AS f FROM {source})"
            )
            source = name
    everything = " || ".join(f"coalesce(l_{b}{k} || r_{b}{k}, '')" for b in "tu" for k in range(1, levels + 1))
    return f"""
WITH leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS g, sha256({head} || {said('text')}) AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {said(lower)}) END AS tampered FROM documents),
d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
t0 AS MATERIALIZED (SELECT g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS m FROM d),{','.join(_level_sql('t', k) for k in range(1, levels + 1))},
w AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM t{levels}),
u0 AS (SELECT '' AS g, pos, subroot AS h, count(*) OVER () AS m FROM w),{','.join(_level_sql('u', k) for k in range(1, levels + 1))},
ways AS (SELECT d.doc_id, d.leaf, w.subroot, (SELECT h FROM u{levels}) AS root, coalesce(d.tampered, d.leaf) AS f, {columns}
  FROM d JOIN w ON w.g = d.g {' '.join(joins)}),
{', '.join(steps)}
SELECT doc_id, leaf, subroot, root, sha256({everything}) AS proof_sha256, f AS folded_root, f = root AS verified FROM {source}
"""


_COLLOCATIONS = r"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
suffixes AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i + 2])) AS s FROM listed),
grouped AS MATERIALIZED (SELECT lang, s, count(*) AS c FROM suffixes GROUP BY ALL),
one AS MATERIALIZED (SELECT lang, s[1] AS a1, sum(c)::BIGINT AS f FROM grouped GROUP BY ALL),
two AS MATERIALIZED (SELECT lang, s[1] AS a1, s[2] AS a2, sum(c)::BIGINT AS f FROM grouped WHERE len(s) >= 2 GROUP BY ALL HAVING sum(c) >= 10),
three AS MATERIALIZED (SELECT lang, s[1] AS a1, s[2] AS a2, s[3] AS a3, c::BIGINT AS f FROM grouped WHERE len(s) = 3 AND c >= 10),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
cuts AS (
  SELECT t.lang, t.a1 || ' ' || t.a2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM two t JOIN one x ON x.lang = t.lang AND x.a1 = t.a1 JOIN one y ON y.lang = t.lang AND y.a1 = t.a2
    WHERE NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.a1 = t.a1 AND h.a2 = t.a2 AND 100 * h.f >= 50 * t.f)
      AND NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.a2 = t.a1 AND h.a3 = t.a2 AND 100 * h.f >= 50 * t.f)
  UNION ALL SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3, t.f, 1, x.f, y.f
    FROM three t JOIN one x ON x.lang = t.lang AND x.a1 = t.a1 JOIN two y ON y.lang = t.lang AND y.a1 = t.a2 AND y.a2 = t.a3
  UNION ALL SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3, t.f, 2, x.f, y.f
    FROM three t JOIN two x ON x.lang = t.lang AND x.a1 = t.a1 AND x.a2 = t.a2 JOIN one y ON y.lang = t.lang AND y.a1 = t.a3),
scored AS (SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


ORACLES: dict[str, str] = {
    "op10_secret_scan": _secret_sql(),
    "op11_collocations": _COLLOCATIONS,
    "op13_merkle_manifest": _merkle_sql(),
}
