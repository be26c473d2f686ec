"""DuckDB SQL for the registered queries, written against the plain tables.

Shared with the engine are only word lists and the fragments that inputs are made of;
patterns, suffixes and guard rules are written out once more, and the algorithms are
the plain ones (global ranks, recursive folds).
"""

from __future__ import annotations

from textmill import rules
from textmill.checks.inputs import ANSWER_WRAPS, PROMPT_WRAPS, REQUESTS_SQL
from textmill.operators.noise import CLASS_NAMES, CLASSES, rate_bound


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def texts(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


# RE2 has an ASCII word edge and no look-around: edges are spelled as neighbours.
SP = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CTRL = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}"
BEFORE, AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
D = r"\p{Nd}"
PII = {
    "email": (
        rf"(?:{BEFORE}[A-Za-z0-9_]|[\p{{L}}\p{{N}}_][.%+-])[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\."
        rf"(?:[A-Z|a-z]+[A-Za-z]{AFTER}|[A-Z|a-z]+\|[\p{{L}}\p{{N}}_])"
    ),
    "ssn": rf"{BEFORE}{D}{{3}}-{D}{{2}}-{D}{{4}}{AFTER}",
    "phone": rf"{BEFORE}{D}{{3}}[-.{SP}]?{D}{{3}}[-.{SP}]?{D}{{4}}{AFTER}",
    "card": rf"{BEFORE}{D}{{4}}[{SP}]?{D}{{4}}[{SP}]?{D}{{4}}[{SP}]?{D}{{4}}{AFTER}",
    "dob": rf"(?i){BEFORE}dob[{SP}]*:[{SP}]*{D}{{2}}/{D}{{2}}/{D}{{4}}{AFTER}",
    "mrn": rf"(?i){BEFORE}mrn[{SP}]*:[{SP}]*{D}+{AFTER}",
    "ssn_label": rf"(?i){BEFORE}ssn[{SP}]*:[{SP}]*{D}{{3}}-{D}{{2}}-{D}{{4}}{AFTER}",
}


def found(pattern: str, column: str = "t") -> str:
    return f"regexp_matches({column}, {q(pattern)})"


def stripped(column: str) -> str:
    return f"regexp_replace({column}, '^[{SP}]+|[{SP}]+$', '', 'g')"


TAG, ENTITY = found("<[^>]+>"), found(rf"&[a-zA-Z]+;|&#{D}+;")
HTML = f"({TAG} OR {ENTITY})"
HAS_PII = "(" + " OR ".join(found(p) for p in PII.values()) + ")"
KINDS = "concat_ws(',', " + ", ".join(f"CASE WHEN {found(p)} THEN '{k}' END" for k, p in PII.items()) + ")"
BROKEN = "contains(t, chr(65533))"
OUTSIDE = "(length(t) > 2000 OR length(t) < 20)"
SCORE = "(" + " + ".join(f"contains(lower(t), {q(s)})::BIGINT" for s in rules.BOILERPLATE_SIGNALS) + ")"
NORM = stripped(f"regexp_replace(nfc_normalize(text), '[{CTRL}]', '', 'g')")


# --- Derived inputs -----------------------------------------------------------
def noise_sql(name: str, rate: float | None = None) -> str:
    c = CLASSES[name]
    rate = c.rate if rate is None else rate
    h = f"md5('{name}:{rules.SPLIT_SEED}:' || doc_id)"

    def pick(n: int) -> str:
        return f"1 + ('0x' || substr({h}, 5, 4))::INT % {n}"

    if c.repeats:
        times = f"{list(c.repeats)}[{pick(len(c.repeats))}]"
        line = "'Entry ' || doc_id || ' says the same thing over and over.'"
        text = f"array_to_string(list_transform(range({times}), lambda i: {line}), ' ')"
    else:
        n = len(c.wraps)
        inner = "doc_id::VARCHAR" if c.replaces else "text"
        text = f"{texts(w[0] for w in c.wraps)}[{pick(n)}] || {inner} || {texts(w[1] for w in c.wraps)}[{pick(n)}]"
    where = "" if rate >= 1 else f" WHERE substr({h}, 1, 4) < '{rate_bound(rate)}'"
    return (
        f"SELECT doc_id * 16 + {CLASS_NAMES.index(name)} AS doc_id, {text} AS text, "
        f"{q(c.source)} AS source, {q(c.label)} AS label FROM documents{where}"
    )


NOISY = " UNION ALL ".join(f"({noise_sql(name)})" for name in CLASS_NAMES)
CORPUS = f"corpus AS (SELECT doc_id, text FROM ({NOISY}) UNION ALL SELECT page_id * 16 + 15, html FROM pages)"
NORMED = f"{CORPUS}, normed AS (SELECT doc_id, md5(text) AS content_key, {NORM} AS t FROM corpus)"
JUDGED = f"""{NORMED}, judged AS (
  SELECT doc_id, content_key, t, CASE
    WHEN row_number() OVER (PARTITION BY content_key ORDER BY doc_id) > 1 THEN 'duplicate'
    WHEN {BROKEN} THEN 'unicode' WHEN {HTML} THEN 'html' WHEN {HAS_PII} THEN 'pii'
    WHEN {OUTSIDE} THEN 'length' WHEN {SCORE} >= 2 THEN 'boilerplate' ELSE 'keep' END AS reason
  FROM normed)"""
KEYED = f"""{JUDGED}, keyed AS (
  SELECT doc_id, t AS text, sha256('42:' || doc_id) AS order_key FROM judged WHERE reason = 'keep')"""
SPLIT = f"""{KEYED}, placed AS (
  SELECT *, row_number() OVER (ORDER BY order_key, doc_id) AS place, count(*) OVER () AS n FROM keyed),
split AS (SELECT *, CASE WHEN place <= floor(n * 0.8::DOUBLE) THEN 'train'
  WHEN place <= floor(n * 0.9::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM placed)"""
# The same, where a row's key is that of its raw text.
SPLIT_BY_TEXT = SPLIT.replace(
    "SELECT doc_id, t AS text, sha256('42:' || doc_id)", "SELECT content_key AS doc_id, t AS text, sha256('42:' || content_key)"
)
COUNTS = f"""SELECT count(*) AS total_input,
  {', '.join(f"count(*) FILTER (reason = '{r}') AS removed_{r}" for r in rules.REASONS)},
  count(*) FILTER (reason = 'keep') AS total_output,
  floor(count(*) FILTER (reason = 'keep') * 0.8::DOUBLE)::BIGINT AS train_count,
  (floor(count(*) FILTER (reason = 'keep') * 0.9::DOUBLE) - floor(count(*) FILTER (reason = 'keep') * 0.8::DOUBLE))::BIGINT AS val_count,
  (count(*) FILTER (reason = 'keep') - floor(count(*) FILTER (reason = 'keep') * 0.9::DOUBLE))::BIGINT AS test_count
FROM judged"""
LANES = ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT)::VARCHAR" for i in range(4))
DIGEST = f"left(sha256(concat_ws(':', count(*)::VARCHAR, {LANES})), 16)"


def hashed(source: str) -> str:
    return f"SELECT sha256(order_key || ':' || sha256(text)) AS h FROM {source}"


def words(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({column}), '[{SP}]+'), lambda x: x <> '')"


EVAL = """evals AS (SELECT doc_id, substr(text, 1, 50) AS prompt, substr(text, 51) AS reference
  FROM documents WHERE length(text) >= 60)"""
PAIRS = f"""{EVAL}, pairs AS (SELECT doc_id, reference, CASE WHEN doc_id % 7 = 0 THEN '' ELSE
  array_to_string(list_concat(list_filter(w, lambda x, i: i % 5 <> 0), w[1:3]), ' ') END AS prediction
  FROM (SELECT *, {words('reference')} AS w FROM evals))"""


def overlap(tokens: str) -> str:
    """Clipped overlap per pair from a query of (doc_id, side, token)."""
    return f"""toks AS ({tokens}),
per_token AS (SELECT doc_id, token, count(*) FILTER (side = 'p') AS p, count(*) FILTER (side = 'r') AS r
  FROM toks GROUP BY ALL),
per_pair AS (SELECT doc_id, sum(least(p, r))::DOUBLE AS o, greatest(sum(p), 1)::DOUBLE AS np, greatest(sum(r), 1)::DOUBLE AS nr
  FROM per_token GROUP BY doc_id),
scores AS (SELECT doc_id, CASE WHEN coalesce(o, 0) = 0 THEN 0.0::DOUBLE
  ELSE 2 * (o / np) * (o / nr) / ((o / np) + (o / nr)) END AS f FROM pairs LEFT JOIN per_pair USING (doc_id))"""


F1 = overlap(
    f"SELECT doc_id, 'p' AS side, unnest({words('prediction')}) AS token FROM pairs "
    f"UNION ALL SELECT doc_id, 'r', unnest({words('reference')}) FROM pairs"
)

# --- Stems --------------------------------------------------------------------
V, C = "[aeiouy]", "[^aeiouy]"
M0, M1 = f"^{C}*{V}+{C}", f"^{C}*{V}+{C}+{V}+{C}"
MEASURE_IS_1 = f"^{C}*{V}+{C}+{V}*$"
CVC = f"({C}{V}[^aeiouywxY]$|^{V}{C}$)"


# --- Fixed values: suffix and replacement, by step; the measure that a step asks for ----
SUFFIXES_1A = "sses>ss ies>i ss>ss s>"
SUFFIXES_2 = (
    "ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize "
    "ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble fulli>ful"
)
SUFFIXES_3 = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
SUFFIXES_4 = "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>"
IRREGULAR = (
    "skies>sky dying>die lying>lie tying>tie news>news innings>inning inning>inning outings>outing outing>outing "
    "cannings>canning canning>canning howe>howe proceed>proceed exceed>exceed succeed>succeed"
)


def _suffix_case(table: str, measure: str = "") -> str:
    whens = []
    for suffix, into in (entry.split(">") for entry in table.split()):
        stem = f"left(w, length(w) - {len(suffix)})"
        test = found(measure, stem) if measure else "true"
        if suffix == "ion":
            test += f" AND {found('[st]$', stem)}"
        whens.append(f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {test} THEN {stem} || '{into}' ELSE w END")
    return "CASE " + " ".join(whens) + " ELSE w END"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


DOUBLE = "(yY|" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx0123456789") + ")$"
_STEPS = (
    "regexp_replace(regexp_replace(w, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')",
    f"CASE WHEN ends_with(w, 'ies') AND length(w) = 4 THEN {_cut(1)} ELSE {_suffix_case(SUFFIXES_1A)} END",
    f"""CASE WHEN ends_with(w, 'ied') THEN {_cut(3)} || CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END
      WHEN ends_with(w, 'eed') THEN CASE WHEN {found(M0, _cut(3))} THEN {_cut(1)} ELSE w END
      WHEN ends_with(w, 'ed') AND {found(V, _cut(2))} THEN {_cut(2)} || '+'
      WHEN ends_with(w, 'ing') AND {found(V, _cut(3))} THEN {_cut(3)} || '+' ELSE w END""",
    f"""CASE WHEN NOT ends_with(w, '+') THEN w
      WHEN {found('(at|bl|iz)$', _cut(1))} THEN {_cut(1)} || 'e'
      WHEN {found(DOUBLE, _cut(1))} THEN {_cut(2)}
      WHEN {found('(ll|ss|zz)$', _cut(1))} THEN {_cut(1)}
      WHEN {found(MEASURE_IS_1, _cut(1))} AND {found(CVC, _cut(1))} THEN {_cut(1)} || 'e' ELSE {_cut(1)} END""",
    f"CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND {found(C + '$', _cut(1))} THEN {_cut(1)} || 'i' ELSE w END",
    f"CASE WHEN ends_with(w, 'alli') AND {found(M0, _cut(4))} THEN {_cut(2)} ELSE w END",
    f"""CASE WHEN ends_with(w, 'logi') THEN CASE WHEN {found(M0, _cut(3))} THEN {_cut(1)} ELSE w END
      ELSE {_suffix_case(SUFFIXES_2, M0)} END""",
    _suffix_case(SUFFIXES_3, M0),
    _suffix_case(SUFFIXES_4, M1),
    f"""CASE WHEN ends_with(w, 'e') THEN CASE WHEN {found(M1, _cut(1))}
        OR ({found(MEASURE_IS_1, _cut(1))} AND NOT {found(CVC, _cut(1))}) THEN {_cut(1)} ELSE w END
      WHEN ends_with(w, 'll') AND {found(M1, _cut(1))} THEN {_cut(1)} ELSE w END""",
)


def stems(vocabulary: str) -> str:
    """Column ``stem`` for a query of distinct ``token``."""
    sql = f"SELECT token, token AS w FROM ({vocabulary})"
    for step in _STEPS:
        sql = f"SELECT token, {step} AS w FROM ({sql})"
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (entry.split(">") for entry in IRREGULAR.split()))
    return (
        f"stems AS MATERIALIZED (SELECT token, CASE WHEN length(token) <= 3 THEN token "
        f"ELSE CASE token {irregular} ELSE lower(w) END END AS stem FROM ({sql}))"
    )


def ascii_words(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({column}), '[^a-z0-9]+'), lambda x: x <> '')"


def _sided(side: str, column: str) -> str:
    return (
        f"SELECT doc_id, '{side}' AS side, unnest({ascii_words(column)}) AS token, "
        f"generate_subscripts({ascii_words(column)}, 1) AS pos FROM pairs"
    )


STEMMED = f"""{PAIRS}, sided AS ({_sided('p', 'prediction')} UNION ALL {_sided('r', 'reference')}),
{stems('SELECT DISTINCT token FROM sided')},
stemmed AS (SELECT doc_id, side, pos, stem FROM sided JOIN stems USING (token))"""
ROUGE1 = STEMMED + ", " + overlap("SELECT doc_id, side, stem AS token FROM stemmed")
BIGRAMS = """SELECT doc_id, side, stem || ' ' || next AS token FROM (
  SELECT *, lead(stem) OVER (PARTITION BY doc_id, side ORDER BY pos) AS next FROM stemmed) WHERE next IS NOT NULL"""
ROUGE2 = STEMMED + ", " + overlap(BIGRAMS)


# The longest common subsequence by bit rows (Crochemore et al., 2001), in chunks of 60 bits:
# a row is a list of chunks; its sum with the places that match carries from chunk to chunk.
_CHUNK = f"{(1 << 60) - 1}"
_CARRIED = f"""list_reduce(list_transform(range(1, len(v) + 1), lambda k: [v[k], v[k] & m[k]]),
    lambda a, e: list_append([(e[1] + e[2] + a[1]) >> 60] || a[2:], ((e[1] + e[2] + a[1]) & {_CHUNK}) | (e[1] - e[2])), [0::BIGINT])[2:]"""
ROUGE_L = f"""{STEMMED.replace('stemmed AS (', 'stemmed AS MATERIALIZED (')},
placed AS (SELECT doc_id, side, stem, row_number() OVER (PARTITION BY doc_id, side ORDER BY pos) - 1 AS tok FROM stemmed),
sizes AS (SELECT doc_id, count(*) FILTER (side = 'p') AS np, count(*) FILTER (side = 'r') AS nr FROM placed GROUP BY doc_id),
chunks AS (SELECT doc_id, stem, tok // 60 AS c, sum(1::BIGINT << (tok % 60))::BIGINT AS bits FROM placed WHERE side = 'r' GROUP BY ALL),
masks AS MATERIALIZED (SELECT doc_id, stem, list_transform(range((nr + 59) // 60), lambda k: coalesce(m[k], 0)) AS m
  FROM (SELECT doc_id, stem, map(list(c), list(bits)) AS m FROM chunks GROUP BY ALL) JOIN sizes USING (doc_id)),
steps AS (SELECT doc_id, list(m ORDER BY tok) AS steps FROM (SELECT doc_id, stem, tok FROM placed WHERE side = 'p') JOIN masks USING (doc_id, stem)
  GROUP BY doc_id),
ends AS (SELECT doc_id, np, nr, full_row, list_reduce(steps, lambda v, m: {_CARRIED}, full_row) AS v
  FROM steps JOIN (SELECT *, list_transform(range((nr + 59) // 60), lambda k: (1::BIGINT << least(60, nr - 60 * k)) - 1) AS full_row FROM sizes) USING (doc_id)),
common AS (SELECT doc_id, np, nr, nr - list_sum(list_transform(range(1, len(v) + 1), lambda k: bit_count(v[k] & full_row[k]))) AS l FROM ends),
scores AS (SELECT doc_id, CASE WHEN coalesce(l, 0) = 0 THEN 0.0::DOUBLE
  ELSE 2 * (l / np) * (l / nr) / ((l / np) + (l / nr)) END AS f FROM pairs LEFT JOIN common USING (doc_id))"""


# --- Language model -----------------------------------------------------------
def losses(train: str, test: str, order: int) -> str:
    """CTEs up to ``lost(doc_id, loss, n_tokens)``, for queries of (doc_id, text)."""

    def placed(source: str) -> str:
        before = ", ".join(f"CASE WHEN i > {k} THEN array_to_string(w[i - {k}:i - 1], ' ') ELSE '' END AS h{k}" for k in range(1, order))
        return f"""SELECT doc_id, i, w[i] AS word, {before} FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM ({source})))"""

    ctes = [
        f"tr AS MATERIALIZED ({placed(train)})",
        f"te AS MATERIALIZED ({placed(test)})",
        "g1 AS MATERIALIZED (SELECT word, count(*) AS n FROM tr GROUP BY word)",
        "vocabulary AS (SELECT coalesce(sum(n), 0) + count(*) + 1 AS size FROM g1)",
        """p1 AS (SELECT te.*, (coalesce(n, 0) + 1) / (SELECT size FROM vocabulary)::DOUBLE AS p FROM te LEFT JOIN g1 USING (word)
  WHERE i > 1)""",
    ]
    for k in range(1, order):
        ctes += [
            f"g{k + 1} AS MATERIALIZED (SELECT h{k}, word, count(*) AS n FROM tr WHERE h{k} <> '' GROUP BY ALL)",
            f"c{k + 1} AS MATERIALIZED (SELECT h{k}, sum(n)::DOUBLE AS total, count(*) AS kinds FROM g{k + 1} GROUP BY ALL)",
            f"""p{k + 1} AS (SELECT p{k}.* EXCLUDE (p), CASE WHEN total > 0 THEN greatest(coalesce(n, 0) - 0.75::DOUBLE, 0) / total
    + 0.75::DOUBLE * kinds / total * p ELSE p END AS p
  FROM p{k} LEFT JOIN g{k + 1} USING (h{k}, word) LEFT JOIN c{k + 1} USING (h{k}))""",
        ]
    ctes.append(
        f"""lost AS (SELECT doc_id, loss, n_tokens FROM (SELECT doc_id, len({words("coalesce(text, '')")}) AS n_tokens FROM ({test}))
  LEFT JOIN (SELECT doc_id, sum(-ln(p)) / count(*) AS loss FROM p{order} GROUP BY doc_id) USING (doc_id))"""
    )
    return ",\n".join(ctes)


PERPLEXITY = """CASE WHEN coalesce(sum(n_tokens - 1) FILTER (n_tokens >= 2), 0) = 0 THEN 'inf'::DOUBLE
  ELSE exp(sum(loss * (n_tokens - 1)) FILTER (n_tokens >= 2) / sum(n_tokens - 1) FILTER (n_tokens >= 2)) END"""
_TRAIN, _TEST = (f"SELECT doc_id, text FROM split WHERE split = '{name}'" for name in ("train", "test"))


# --- Exchanges and requests ---------------------------------------------------
def _wrap(column: str, wraps) -> str:
    n = f"1 + k % {len(wraps)}"
    return f"{texts(w[0] for w in wraps)}[{n}] || {column} || {texts(w[1] for w in wraps)}[{n}]"


REPEATED = "array_to_string(list_transform(range(120), lambda i: asked), ' ')"
EXCHANGES = f"""turns AS (
  SELECT conv_id, turn, role, text AS asked, conv_id * 31 + turn AS k,
    lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
made AS (
  SELECT conv_id, turn, k,
    CASE WHEN k % 17 = 3 THEN ' Hi' || chr(8195) WHEN k % 17 = 7 THEN {REPEATED} ELSE {_wrap('asked', PROMPT_WRAPS)} END AS prompt,
    CASE WHEN k % 13 = 5 THEN ' ' || chr(12288) || chr(10)
      ELSE {_wrap("(CASE WHEN next_role = 'assistant' THEN next_text ELSE '' END)", ANSWER_WRAPS)} END AS answer
  FROM turns WHERE role = 'user'),
exchanges AS (
  SELECT conv_id, turn, prompt, CASE WHEN k % 2 = 0 THEN prompt || answer ELSE answer END AS generated,
    k % 4 <> 1 AS safe_mode FROM made)"""
# Guard pattern and category, first match first.
_GUARD_RULES = (
    ("ignore previous instructions", "prompt_injection"),
    ("you are now", "jailbreak"),
    ("pretend you are", "jailbreak"),
    ("invent a citation", "hallucination_trap"),
    ("make up a reference", "hallucination_trap"),
    ("write malware", "harmful_content"),
    ("how to hack", "harmful_content"),
    ("give me someone's ssn", "pii_extraction"),
    ("what is [^\\n]* personal", "pii_extraction"),
)
GUARDS = " ".join(f"WHEN {found('(?i)' + p, 'prompt')} THEN '{c}'" for p, c in _GUARD_RULES)
PATTERN_CATEGORY = f"CASE {GUARDS} END"
SHORT, LONG = f"length({stripped('prompt')}) < 3", "length(prompt) > 2000"
ANSWER = stripped("CASE WHEN starts_with(generated, prompt) THEN substr(generated, length(prompt) + 1) ELSE generated END")


def leaks(column: str) -> str:
    return f"({found(PII['ssn'], column)} OR {found(PII['card'], column)})"


def input_check(safe: str) -> str:
    """Columns ic (category or null), ir (reason)."""
    return f"""CASE WHEN {SHORT} OR {LONG} THEN 'validation' WHEN {safe} THEN {PATTERN_CATEGORY} END AS ic,
      CASE WHEN {SHORT} THEN 'Input too short' WHEN {LONG} THEN 'Input exceeds 2000 characters'
        WHEN {safe} THEN 'Matched safety pattern: ' || {PATTERN_CATEGORY} END AS ir"""


def output_check(column: str, safe: str) -> str:
    empty = f"{stripped(column)} = ''"
    return f"""CASE WHEN {empty} THEN 'output_validation' WHEN {safe} AND {leaks(column)} THEN 'pii_leakage' END AS oc,
      CASE WHEN {empty} THEN 'Empty model output' WHEN {safe} AND {leaks(column)} THEN 'Output contains potential PII' END AS orr"""


MODERATED = f"""{EXCHANGES}, answered AS (SELECT *, {ANSWER} AS a FROM exchanges),
checked AS (SELECT *, {input_check('safe_mode')}, {output_check('a', 'safe_mode')} FROM answered),
moderated AS (SELECT conv_id, turn,
    CASE WHEN ic IS NOT NULL THEN 'input_blocked' WHEN oc IS NOT NULL THEN 'output_blocked' ELSE 'generate_request' END AS event,
    coalesce(CASE WHEN ic IS NOT NULL THEN ir ELSE orr END, '') AS reason, coalesce(ic, oc, '') AS category,
    CASE WHEN ic IS NOT NULL OR oc IS NOT NULL THEN {q(rules.REFUSAL)} ELSE a END AS generated_text, ic
  FROM checked),
counted AS (SELECT *, CASE WHEN ic IS NOT NULL THEN 0 ELSE len({words('generated_text')}) END::BIGINT AS token_count FROM moderated)"""

PARSED = f"""requests AS ({REQUESTS_SQL}),
bodies AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS v FROM requests),
fields AS (SELECT request_id, client, ts, model_loaded,
    CASE WHEN json_type(v, '$.prompt') = 'VARCHAR' THEN v ->> '$.prompt' END AS prompt,
    json_type(v, '$.max_tokens') AS tt, try_cast(v ->> '$.max_tokens' AS DOUBLE) AS tv,
    json_type(v, '$.temperature') AS ft, try_cast(v ->> '$.temperature' AS DOUBLE) AS fv,
    json_type(v, '$.safe_mode') AS bt, lower(v ->> '$.safe_mode') AS bv FROM bodies),
typed AS (SELECT request_id, client, ts, model_loaded, prompt,
    CASE WHEN tt IS NULL THEN 128 WHEN tv = floor(tv) AND tv BETWEEN 1 AND 512 THEN tv::BIGINT END AS max_tokens,
    CASE WHEN ft IS NULL THEN 0.7::DOUBLE WHEN fv BETWEEN 0 AND 2 THEN fv END AS temperature,
    CASE WHEN bt IS NULL THEN true WHEN bv IN ('1','true','t','yes','y','on') THEN true
      WHEN bv IN ('0','false','f','no','n','off') THEN false END AS safe_mode FROM fields),
parsed AS (SELECT *, concat_ws(',', CASE WHEN coalesce(length(prompt), 0) NOT BETWEEN 1 AND 2000 THEN 'prompt' END,
    CASE WHEN max_tokens IS NULL THEN 'max_tokens' END, CASE WHEN temperature IS NULL THEN 'temperature' END,
    CASE WHEN safe_mode IS NULL THEN 'safe_mode' END) AS errors FROM typed)"""
SCREENED = f"""WITH {PARSED}, checked AS (SELECT *, {input_check('safe_mode')} FROM parsed)
SELECT request_id::VARCHAR AS request_id, coalesce(client, 'unknown') AS client, CASE WHEN errors <> '' THEN 'invalid' WHEN ic IS NULL THEN 'admitted' ELSE 'input_blocked' END AS event,
  CASE WHEN errors <> '' THEN errors ELSE coalesce(ir, '') END AS reason,
  CASE WHEN errors <> '' THEN 'validation' ELSE coalesce(ic, '') END AS category,
  coalesce(safe_mode::VARCHAR, '') AS safe_mode FROM checked"""


def limited(source: str, limit: int, seconds: int) -> str:
    """CTEs up to ``decided(request_id, client, accepted)``; needs RECURSIVE."""
    window = seconds * 1_000_000
    kept = f"list_filter(log, lambda x: n.us - x < {window})"
    return f"""numbered AS (SELECT request_id, coalesce(client, 'unknown') AS client, epoch_us(ts) AS us,
    row_number() OVER (PARTITION BY coalesce(client, 'unknown') ORDER BY ts, request_id) AS rn FROM {source}),
decided AS (
  SELECT request_id, client, rn, true AS accepted, [us] AS log FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.request_id, n.client, n.rn, len({kept}) < {limit},
    CASE WHEN len({kept}) < {limit} THEN list_append({kept}, n.us) ELSE {kept} END
  FROM decided d JOIN numbered n ON n.client = d.client AND n.rn = d.rn + 1)"""


RESPONSES = f"""{PARSED}, valid AS (SELECT * FROM parsed WHERE errors = ''),
{limited('valid', 3, 86400)}, judged_requests AS (
  SELECT p.*, coalesce(p.client, 'unknown') AS caller, CASE WHEN errors <> '' THEN 422 WHEN NOT accepted THEN 429 WHEN NOT model_loaded THEN 503 ELSE 200 END AS status,
    CASE WHEN request_id % 2 = 0 THEN coalesce(prompt, '') ELSE '' END || CASE request_id % 7 WHEN 0 THEN ''
      WHEN 1 THEN 'Her card is 4111 1111 1111 1111' ELSE 'Number ' || request_id || ' it is.' END AS generated
  FROM parsed p LEFT JOIN (SELECT request_id, accepted FROM decided) USING (request_id)),
given AS (SELECT *, {ANSWER} AS a FROM judged_requests WHERE status = 200),
looked AS (SELECT *, {input_check('safe_mode')}, {output_check('a', 'safe_mode')} FROM given),
texted AS (SELECT *, CASE WHEN ic IS NOT NULL OR oc IS NOT NULL THEN {q(rules.REFUSAL)} ELSE a END AS generated_text FROM looked),
hashed_documents AS (SELECT dataset_hash FROM (__MANIFEST__)),
responses AS (SELECT request_id, caller AS client, generated_text, prompt, 'stand-in' AS model_version, dataset_hash,
    CASE WHEN ic IS NOT NULL THEN 0 ELSE len({words('generated_text')}) END::BIGINT AS token_count,
    round((request_id % 9973) * 130 / 1000, 2) AS latency_ms, safe_mode, ic, ir, oc, orr FROM texted, hashed_documents)"""
EVENT_LIMIT = f"""WITH RECURSIVE source AS (SELECT event_id AS request_id, user_id::VARCHAR AS client, ts FROM events),
{limited('source', 3, 86400)} SELECT request_id, client, accepted FROM decided"""

HISTORY = """history AS (
  SELECT event_id::VARCHAR AS run_id, position, kind,
    CASE kind WHEN 'eval' THEN k::DOUBLE WHEN 'step' THEN 2.5::DOUBLE ELSE 3.0::DOUBLE END AS epoch,
    CASE kind WHEN 'eval' THEN 4 * k WHEN 'step' THEN 10 ELSE 12 END::INT AS step,
    CASE kind WHEN 'eval' THEN 3.5::DOUBLE + ((event_id * k) % 7) / 8::DOUBLE END AS eval_loss,
    CASE kind WHEN 'step' THEN value / 2 END AS loss,
    CASE kind WHEN 'summary' THEN value / 8 END AS train_loss,
    CASE kind WHEN 'summary' THEN value END AS train_runtime
  FROM events, (VALUES (0, 'eval', 1), (1, 'eval', 2), (2, 'step', 0), (3, 'eval', 3), (4, 'summary', 0)) AS e(position, kind, k))"""


def _over(source: str, ctes: str, columns: str) -> str:
    return f"WITH {ctes} SELECT {columns} FROM {source}"


def _rule(hit: str) -> str:
    return _over("normed", NORMED, f"doc_id, {hit} AS hit")


def _turns(columns: str) -> str:
    return _over("exchanges", EXCHANGES, f"conv_id, turn, {columns}")


_CHECKED_IN = f"WITH {EXCHANGES}, checked AS (SELECT *, {input_check('true')} FROM exchanges)"
_CHECKED_OUT = f"WITH {EXCHANGES}, checked AS (SELECT *, {output_check('generated', 'true')} FROM exchanges)"
_RULE_HITS = {**{k: found(p) for k, p in PII.items()}, **{s: f"contains(lower(t), {q(s)})" for s in rules.BOILERPLATE_SIGNALS}}

_MANIFEST = f"""WITH {KEYED.replace(CORPUS, 'corpus AS (SELECT doc_id, text FROM documents)')}
SELECT {DIGEST} AS dataset_hash FROM ({hashed('keyed')})"""
RESPONSES = RESPONSES.replace("__MANIFEST__", _MANIFEST)

def _leaves(source: str) -> str:
    digest = f"sha256(concat_ws(':', count(*)::VARCHAR, {LANES}))"
    return f"""SELECT left(order_key, 4) AS bucket, count(*) AS n_rows, {digest} AS hash
  FROM (SELECT order_key, sha256(order_key || ':' || sha256(text)) AS h FROM {source}) GROUP BY ALL"""


def _over_nodes(source: str, digits: int) -> str:
    return f"""SELECT left(bucket, {digits}) AS bucket, sum(n_rows)::BIGINT AS n_rows,
  sha256(string_agg(bucket || '=' || hash, ',' ORDER BY bucket)) AS hash FROM {source} GROUP BY left(bucket, {digits})"""


_VERSIONS = f"""{KEYED}, later AS (SELECT doc_id, text, sha256('42:' || doc_id) AS order_key FROM (
  SELECT CASE WHEN doc_id % 101 = 7 THEN -doc_id ELSE doc_id END AS doc_id,
    CASE WHEN doc_id % 97 = 3 THEN text || ' (edited)' ELSE text END AS text FROM keyed WHERE doc_id % 89 <> 5))"""
_MEANS = ", ".join(
    f'round((SELECT coalesce(avg(f), 0) FROM (WITH {ctes} SELECT f FROM scores)), 4) AS "{name}"'
    for name, ctes in (("rouge1", ROUGE1), ("rouge2", ROUGE2), ("rougeL", ROUGE_L))
)
_EVALUATION = f"""WITH {losses("SELECT doc_id, text FROM documents", "SELECT doc_id, text FROM documents", 2)}
SELECT 'bigrams' AS model_path, 'documents' AS data_path, (SELECT count(*) FROM documents) AS num_samples,
  (SELECT round({PERPLEXITY}, 2) FROM lost) AS perplexity, {_MEANS},
  (SELECT coalesce(round(avg(round(f, 4)), 4), 0.0::DOUBLE) FROM (WITH {PAIRS}, {F1} SELECT f FROM scores)) AS token_f1"""

_RESPONSE_ROWS = f"""WITH RECURSIVE {RESPONSES} SELECT request_id, client, generated_text, prompt, model_version,
  dataset_hash, token_count, latency_ms, safe_mode FROM responses"""
_SERVED_LOG = f"""WITH RECURSIVE {RESPONSES}, log AS (
  SELECT request_id, 'rate_limited' AS event, caller AS client, '' AS reason, '' AS category, -1::BIGINT AS token_count,
    -1.0::DOUBLE AS latency_ms, '' AS model_version, '' AS dataset_hash, '' AS safe_mode FROM judged_requests WHERE status = 429
  UNION ALL SELECT request_id, 'input_blocked', client, ir, ic, -1, -1.0, '', '', '' FROM responses WHERE ic IS NOT NULL
  UNION ALL SELECT request_id, 'output_blocked', '', orr, '', -1, -1.0, '', '', '' FROM responses WHERE ic IS NULL AND oc IS NOT NULL
  UNION ALL SELECT request_id, 'generate_request', client, '', '', token_count, latency_ms, model_version, dataset_hash,
    safe_mode::VARCHAR FROM responses WHERE ic IS NULL)
SELECT request_id::VARCHAR AS request_id, event, client, reason, category, token_count, latency_ms, model_version, dataset_hash, safe_mode FROM log"""

ORACLES: dict[str, str] = {
    "s08_served_log": _SERVED_LOG,
    "w03_served_log_stream": _SERVED_LOG,
    "g11_response_rows": _RESPONSE_ROWS,
    "g11_response_stream": _RESPONSE_ROWS,
    "s01_jsonl_scan": NOISY,
    "s02_split_scan": _over("split", SPLIT, "doc_id, text, split") + " WHERE split <> 'test'",
    "s03_split_sink": _over("split", SPLIT, "doc_id, text, split"),
    "s03_split_order": _over(
        "split", SPLIT, "split, doc_id, row_number() OVER (PARTITION BY split ORDER BY order_key, doc_id) - 1 AS place"
    ),
    "s03_splits_without_ids": _over("split", SPLIT_BY_TEXT, "text, split"),
    "s04_manifest": f"""WITH {KEYED}, fp AS (SELECT {DIGEST} AS dataset_hash FROM ({hashed('keyed')}))
SELECT '1.0.0' AS cleaning_rules_version, 42 AS split_seed, dataset_hash, 'corpus' AS input_file, c.* FROM fp, ({COUNTS}) AS c""",
    "s05_manifest_lookup": f"""WITH {KEYED.replace(CORPUS, 'corpus AS (SELECT doc_id, text FROM documents)')},
fp AS (SELECT {DIGEST} AS dataset_hash FROM ({hashed('keyed')})) SELECT conv_id, turn, dataset_hash FROM conversations, fp""",
    "s07_run_log_scan": """SELECT s_suppkey::VARCHAR AS run_id, 42 AS seed, s_acctbal / 8 AS train_loss,
  3 AS num_epochs, 8 AS lora_r, 5::BIGINT AS n_history FROM supplier""",
    "s08_decision_log": SCREENED,
    "f01_nfc": _over("corpus", CORPUS, "doc_id, nfc_normalize(text) AS nfc_text"),
    "f02_valid_utf8": "SELECT doc_id, chr(65533) || text AS repaired FROM documents",
    "f03_strip_control": _over("corpus", CORPUS, f"doc_id, regexp_replace(text, '[{CTRL}]', '', 'g') AS stripped"),
    "f04_strip_space": _over("corpus", CORPUS, f"doc_id, {stripped('text')} AS trimmed"),
    "f05_normalize": _over("normed", NORMED, "doc_id, t AS norm"),
    "f06_content_key": _over("corpus", CORPUS, "doc_id, md5(text) AS content_key"),
    "f07_lower": _over("corpus", CORPUS, "doc_id, lower(text) AS lowered"),
    "f08_length": _over("corpus", CORPUS, "doc_id, length(text) AS n_chars"),
    "f09_prompt_slices": "SELECT doc_id, substr(text, 1, 50) AS prompt, substr(text, 51) AS reference FROM documents",
    "f10_strip_prompt": _turns(f"{ANSWER} AS answer"),
    "f11_prompt_template": f"""SELECT conv_id, turn, {q(rules.SYSTEM_PROMPT)} || chr(10) || chr(10) || 'User: ' || text
  || chr(10) || 'Assistant:' AS modified_prompt FROM conversations""",
    "f12_words": _over("corpus", CORPUS, f"doc_id, array_to_string({words('text')}, ' ') AS words"),
    "f13_truncated_tokens": _over("corpus", CORPUS, f"doc_id, array_to_string(({words('text')})[1:256], ' ') AS words"),
    "f14_response_tokens": _over("counted", MODERATED, "conv_id, turn, token_count"),
    "p01_html_tag": _rule(TAG),
    "p02_html_entity": _rule(ENTITY),
    "p03_html": _rule(HTML),
    "p04_pii_email": _rule(found(PII["email"])),
    "p05_pii_ssn": _rule(found(PII["ssn"])),
    "p06_pii_phone": _rule(found(PII["phone"])),
    "p07_pii_card": _rule(found(PII["card"])),
    "p08_pii_dob": _rule(found(PII["dob"])),
    "p09_pii_mrn": _rule(found(PII["mrn"])),
    "p10_pii_ssn_label": _rule(found(PII["ssn_label"])),
    "p11_pii_kinds": _over("normed", NORMED, f"doc_id, {HAS_PII} AS hit, {KINDS} AS kinds"),
    "p12_broken_unicode": _rule(BROKEN),
    "p13_length_band": _rule(OUTSIDE),
    "p14_boilerplate": _over("normed", NORMED, f"doc_id, {SCORE} AS score, {SCORE} >= 2 AS hit"),
    "p15_eval_eligible": "SELECT doc_id FROM documents WHERE length(text) >= 60",
    "p16_scorable": f"WITH {CORPUS} SELECT * FROM (SELECT doc_id, len({words('text')}) AS n_tokens FROM corpus) WHERE n_tokens >= 2",
    "d01_drop_duplicates": f"""WITH {CORPUS} SELECT doc_id, md5(text) AS content_key, text FROM corpus
  QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
    "c01_classify": _over("judged", JUDGED, "doc_id, reason"),
    "c02_clean": _over("judged", JUDGED, "doc_id, t AS text") + " WHERE reason = 'keep'",
    "a01_cleaning_stats": f"WITH {JUDGED} {COUNTS}",
    "a02_cleaning_report": f"""WITH {JUDGED}, c AS ({COUNTS}) SELECT *, total_input - total_output AS total_removed,
  round((1 - total_output / greatest(total_input, 1)) * 100, 1) AS reduction_pct FROM c""",
    "a03_split_counts": f"""WITH {SPLIT} SELECT s AS split, count(doc_id) AS n_rows
  FROM (VALUES ('train'), ('val'), ('test')) AS v(s) LEFT JOIN split ON split.split = s GROUP BY s""",
    "a04_dataset_fingerprint": f"WITH {KEYED} SELECT count(*) AS n_rows, {DIGEST} AS dataset_hash FROM ({hashed('keyed')})",
    "a04_hash_tree": f"""WITH {KEYED}, leaves AS ({_leaves('keyed')}), parents AS ({_over_nodes('leaves', 2)})
SELECT 0 AS level, * FROM ({_over_nodes('parents', 0)}) UNION ALL SELECT 1, * FROM parents UNION ALL SELECT 2, * FROM leaves""",
    "a04_changed_buckets": f"""WITH {_VERSIONS}, old AS ({_leaves('keyed')}), new AS ({_leaves('later')})
SELECT bucket, coalesce(old.n_rows, 0) AS n_before, coalesce(new.n_rows, 0) AS n_after FROM old FULL JOIN new USING (bucket)
WHERE old.hash IS DISTINCT FROM new.hash""",
    "a04_changed_rows": f"""WITH {_VERSIONS} SELECT doc_id::VARCHAR AS row_key,
  CASE WHEN k.text IS NULL THEN 'added' WHEN l.text IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM keyed k FULL JOIN later l USING (doc_id) WHERE k.text IS DISTINCT FROM l.text""",
    "k01_seeded_order": _over("keyed", KEYED, "doc_id, order_key"),
    "k02_split": _over("split", SPLIT, "doc_id, split"),
    "e01_eval_head": """SELECT doc_id, substr(text, 1, 50) AS prompt, substr(text, 51) AS reference
  FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100) WHERE length(text) >= 60""",
    "e02_pairs": _over("pairs", PAIRS, "doc_id, prediction, reference"),
    "e02_positional_pairs": _over(
        "pairs", PAIRS, "row_number() OVER (ORDER BY doc_id) - 1 AS ordinal, prediction, reference"
    ),
    "e03_token_f1": f"WITH {PAIRS}, {F1} SELECT doc_id, round(f, 4) AS token_f1 FROM scores",
    "e04_mean_token_f1": f"WITH {PAIRS}, {F1} SELECT coalesce(round(avg(round(f, 4)), 4), 0.0::DOUBLE) AS token_f1 FROM scores",
    "e05_rouge1": f"WITH {ROUGE1} SELECT doc_id, f AS rouge1 FROM scores",
    "e06_rouge2": f"WITH {ROUGE2} SELECT doc_id, f AS rouge2 FROM scores",
    "e08_stems": f"""WITH {CORPUS}, {stems(f"SELECT DISTINCT unnest({ascii_words('text')}) AS token FROM corpus")}
SELECT token, stem FROM stems""",
    "e07_rouge_l": f"WITH {ROUGE_L} SELECT doc_id, f AS \"rougeL\" FROM scores",
    "e09_corpus_rouge": f"SELECT {_MEANS}",
    "e11_eval_result": _EVALUATION,
    "s06_eval_result_sink": _EVALUATION,
    "e10_perplexity": f"WITH {SPLIT.replace('split AS (', 'split AS MATERIALIZED (')}, {losses(_TRAIN, _TEST, 2)} SELECT round({PERPLEXITY}, 6) AS perplexity FROM lost",
    "e10_token_losses": f"""WITH {SPLIT.replace('split AS (', 'split AS MATERIALIZED (')}, {losses(_TRAIN, _TEST, 3)}
SELECT doc_id, round(coalesce(loss, -1), 6) AS loss, n_tokens FROM lost""",
    "g01_request_validation": _over("parsed", PARSED, "request_id, prompt, coalesce(max_tokens, -1) AS max_tokens, temperature, coalesce(safe_mode::VARCHAR, '') AS safe_mode, errors"),
    "g02_input_too_short": _turns(f"{SHORT} AS hit"),
    "g03_input_too_long": _turns(f"{LONG} AS hit"),
    "g04_guard_category": _turns(f"coalesce({PATTERN_CATEGORY}, '') AS category"),
    "g05_check_input": f"""{_CHECKED_IN} SELECT conv_id, turn, ic IS NULL AS allowed, coalesce(ir, '') AS reason, coalesce(ic, '') AS category,
  CASE WHEN ic IS NULL THEN {q(rules.SYSTEM_PROMPT)} || chr(10) || chr(10) || 'User: ' || prompt || chr(10) || 'Assistant:' ELSE '' END AS modified_prompt FROM checked""",
    "g06_empty_output": _turns(f"{stripped('generated')} = '' AS hit"),
    "g07_output_pii": _turns(f"{leaks('generated')} AS hit"),
    "g08_check_output": f"{_CHECKED_OUT} SELECT conv_id, turn, oc IS NULL AS allowed, coalesce(orr, '') AS reason, coalesce(oc, '') AS category FROM checked",
    "g09_safe_mode": f"""WITH {EXCHANGES}, checked AS (SELECT *, {input_check('safe_mode')}, {output_check('generated', 'safe_mode')} FROM exchanges)
SELECT conv_id, turn, coalesce(ic, '') AS input_category, coalesce(oc, '') AS output_category FROM checked""",
    "g10_refusal": f"{_CHECKED_OUT} SELECT conv_id, turn, CASE WHEN oc IS NULL THEN generated ELSE {q(rules.REFUSAL)} END AS final_text FROM checked",
    "g11_moderated_exchanges": _over("counted", MODERATED, "conv_id, turn, event, reason, category, generated_text, token_count"),
    "g12_request_status": f"""WITH RECURSIVE {PARSED}, valid AS (SELECT * FROM parsed WHERE errors = ''),
{limited('valid', 3, 86400)} SELECT p.request_id, CASE WHEN errors <> '' THEN 422 WHEN NOT accepted THEN 429
  WHEN NOT model_loaded THEN 503 ELSE 200 END AS status FROM parsed p LEFT JOIN decided USING (request_id)""",
    "g13_latency": "SELECT event_id, round(floor(value * 1000) / 1000, 2) AS latency_ms FROM events",
    "w01_rate_limit": EVENT_LIMIT,
    "w02_rate_limit_stream": EVENT_LIMIT,
    "w03_guard_stream": SCREENED,
    "t01_run_history": _over("history", HISTORY, "run_id, position, kind, epoch, step, eval_loss, loss, train_loss, train_runtime"),
    "t02_best_checkpoint": f"""WITH {HISTORY} SELECT run_id, step AS best_step, epoch AS best_epoch, eval_loss AS best_metric
  FROM history WHERE kind = 'eval' QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1""",
    "t03_training_samples": f"""WITH {SPLIT} SELECT count(*) FILTER (split = 'train') AS train_samples,
  count(*) FILTER (split = 'val') AS val_samples FROM split""",
    "n01_clean_draws": noise_sql("clean", 0.5),
    "n02_duplicates": noise_sql("duplicate"),
    "n03_html": noise_sql("html"),
    "n04_unicode": noise_sql("unicode"),
    "n05_pii": noise_sql("pii"),
    "n06_long_lines": noise_sql("long"),
    "n07_boilerplate": noise_sql("boilerplate"),
    "n08_noisy_corpus": f"SELECT *, sha256('42:' || doc_id) AS order_key FROM ({NOISY})",
    "u02_rule_book": f"""WITH {EXCHANGES}, parts AS (
  SELECT doc_id, coalesce(lang, 'und') AS category, regexp_extract(text, '([A-Za-z]{{2,}}) ([A-Za-z]{{4,}})', 1) AS a,
    regexp_extract(text, '([A-Za-z]{{2,}}) ([A-Za-z]{{4,}})', 2) AS b FROM documents),
book AS (SELECT doc_id, category, '(?i)' || a || '[^a-z]{{1,3}}' || b AS pattern FROM parts WHERE a <> ''),
hits AS (SELECT conv_id, turn, doc_id, category FROM exchanges, book WHERE regexp_matches(prompt, pattern))
SELECT conv_id, turn, count(doc_id) AS n_rules, coalesce(min(doc_id), -1) AS rule, coalesce(min_by(category, doc_id), '') AS category
FROM exchanges LEFT JOIN hits USING (conv_id, turn) GROUP BY conv_id, turn""",
    "u02_rule_hits": f"WITH {NORMED} "
    + " UNION ALL ".join(f"SELECT {q(n)} AS rule, count(*) FILTER ({hit}) AS n_rows FROM normed" for n, hit in _RULE_HITS.items()),
}
