"""DuckDB SQL of the registered queries, written from their definitions."""

from __future__ import annotations

from tidemark.llm.parsed_phrases import PRODUCTION as PHRASES
from tidemark.llm.periodic_runs import PRODUCTION as RUNS
from tidemark.llm.quality_lines import PRODUCTION
from tidemark.llm.secret_scan import PRODUCTION as SECRETS
from tidemark.llm.water_filling import PRODUCTION as MIX


def _literals(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_RULES = PRODUCTION


def quality_ctes(table: str = "documents", key: str = "doc_id") -> str:
    """Common tables ending in ``verdicts``, one row for each row of ``table``."""
    boilerplate = " OR ".join(f"contains(lower(trimmed), {_literals([p])})" for p in _RULES.boilerplate)
    return f"""
texts AS (SELECT {key} AS k, coalesce(text, '') AS t FROM {table}),
worded AS (SELECT k, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM texts),
windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, g) AS times FROM (
    SELECT k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
    FROM (SELECT k, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM worded))),
repeated AS (
  SELECT k, count(DISTINCT i + j) AS n_repeat_words
  FROM windows, (VALUES (0), (1), (2)) AS o(j) WHERE times >= 2 GROUP BY k),
lines AS (
  SELECT k, line, trim(line, ' ' || {_SPACES}) AS trimmed
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM texts)),
judged_lines AS (
  SELECT k, line, trimmed, trimmed <> '' AND (
      (length(trimmed) - length(replace(trimmed, ' ', '')) >= {_RULES.prose_words - 1}
        AND right(rtrim(trimmed, {_literals([_RULES.closing])}), 1) NOT IN ({_literals(_RULES.sentence_end)}))
      OR (length(trimmed) - length(replace(trimmed, ' ', '')) < {_RULES.prose_words - 1}
        AND lower(trim(trimmed, {_literals([_RULES.menu_marks])})) IN ({_literals(_RULES.menu)}))
      OR (length(trimmed) - length(translate(trimmed, '#*$%&|<>', ''))) * 100
        > (length(trimmed) - length(replace(trimmed, ' ', '')) + 1) * {_RULES.max_symbol_percent}
      OR length(trimmed) - length(translate(trimmed, {_literals([_RULES.separators])}, '')) >= {_RULES.min_separators}
      OR {boilerplate}) AS fails
  FROM lines),
by_line AS (
  SELECT k, count(*) FILTER (WHERE fails) AS n_removed_lines,
         count(*) FILTER (WHERE trimmed <> '') - count(DISTINCT line) FILTER (WHERE trimmed <> '') AS n_dup_lines,
         coalesce(sum(length(translate(line, ' ' || {_SPACES}, ''))) FILTER (WHERE NOT fails), 0) AS kept_chars
  FROM judged_lines GROUP BY k),
measured AS (
  SELECT worded.k, len(ws) AS n_words, length(translate(t, ' ' || {_SPACES}, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_dup_lines, n_removed_lines, kept_chars
  FROM worded JOIN by_line USING (k) LEFT JOIN repeated USING (k)),
verdicts AS (
  SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed
  FROM measured)"""


OP9 = f"""
WITH {quality_ctes()}
SELECT k AS doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND (word_chars - kept_chars) * 100 <= word_chars * {_RULES.max_lost_percent} AS kept,
       n_removed_lines::BIGINT AS n_removed_lines, kept_chars::BIGINT AS kept_chars
FROM verdicts"""

OP10 = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
numbered AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place
  FROM texts)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, sha256(t) AS text_sha256
FROM numbered"""

OP6 = """
WITH split AS (
  SELECT page_id, coalesce(contains(url, '://'), false) AS whole,
         substr(url, strpos(url, '://') + 3) AS rest FROM pages),
parts AS (
  SELECT page_id,
         CASE WHEN whole THEN translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN whole THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM split),
flags AS (
  SELECT *, '.' || host AS h, host || path AS a FROM parts),
decided AS (
  SELECT *, CASE
      WHEN h LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN h LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN h LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN h LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN h LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule,
    CASE
      WHEN regexp_matches(a, '(^|[.])(track|click)[.].*[/]redirect') THEN 'tracker'
      WHEN regexp_matches(a, '/(?:phpsessid|jsessionid)[/=-]') THEN 'session'
      WHEN regexp_matches(a, '(^|[./-])payday-loans?([./-]|$)') THEN 'payday-loans'
      WHEN regexp_matches(a, '(^|[./-])online-casino([./-]|$)') THEN 'online-casino'
      WHEN regexp_matches(a, '(^|[./-])free-downloads?([./-]|$)') THEN 'free-download'
      WHEN regexp_matches(a, '(^|[.-])cheap-pills([.-]|/|$)') THEN 'cheap-pills'
      WHEN regexp_matches(a, '(^|[./-])(xxx|porn|adult)[.-]') THEN 'adult' END AS spam
  FROM flags)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN spam END AS pattern,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL OR spam IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM decided"""


def _secrets() -> str:
    word = "|".join(
        "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
        for w in ("password", "passwd", "secret", "token")
    ) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    value = "[A-Za-z0-9+/_.=-]+"
    assign = rf"""(?:{word})["']?\x20*[:=]\x20*["']?({value})""".replace("'", "''")
    kinds = {"assign": assign, "access": "(AKIA[A-Z0-9]+)", "hex": "([0-9a-f]+)"}
    kinds["entropy"] = f"({SECRETS.candidate})"
    least = {"assign": 6, "access": 20, "hex": 24, "entropy": SECRETS.window}
    matches = " UNION ALL ".join(
        f"""SELECT {n} AS kind, doc_id, unnest(regexp_extract_all(t, '([\\s\\S]*?)({p})', 1)) AS gap,
        unnest(regexp_extract_all(t, '([\\s\\S]*?)({p})', 2)) AS hit,
        unnest(regexp_extract_all(t, '([\\s\\S]*?)({p})', 3)) AS value,
        unnest(range(len(regexp_extract_all(t, '([\\s\\S]*?)({p})', 1)))) AS i, {least[k]} AS least FROM texts"""
        for n, (k, p) in enumerate(kinds.items())
    )
    form = " OR ".join(f"regexp_matches(value, '{p}')" for p in SECRETS.allowed_patterns)
    part = " OR ".join(f"contains(hot_text, '{p}')" for p in SECRETS.allowed_parts)
    plain = "regexp_matches(value, '^[0-9A-Za-z]+$')"
    digits, lower, upper = (f"regexp_matches(value, '[{c}]')" for c in ("0-9", "a-z", "A-Z"))
    w = SECRETS.window
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({matches}),
placed AS (
  SELECT kind, doc_id, value, least,
         sum(length(gap) + length(hit)) OVER (PARTITION BY kind, doc_id ORDER BY i) AS stop, length(hit) AS n
  FROM matches),
spans AS (
  SELECT kind, doc_id, value, stop - n AS start, stop FROM placed WHERE length(value) >= least),
base AS (SELECT kind, doc_id, start, stop FROM spans WHERE kind < 3),
candidates AS (
  SELECT row_number() OVER () AS c, doc_id, start, value,
    CASE WHEN regexp_matches(value, '^[0-9a-fA-F]+$') THEN {SECRETS.hex_bits}
         WHEN {plain} AND {digits} AND {lower} AND {upper} THEN {SECRETS.both_cases_and_digits_bits}
         WHEN {plain} AND {digits} THEN {SECRETS.one_case_and_digits_bits}
         WHEN {plain} AND {lower} AND {upper} THEN {SECRETS.both_cases_bits}
         WHEN {digits} AND ({lower} OR {upper}) THEN {SECRETS.mixed_bits}
         ELSE {SECRETS.letters_bits} END AS bits
  FROM spans WHERE kind = 3 AND NOT ({form})),
windows AS (
  SELECT c, bits, s, unnest(string_split(substr(value, s + 1, {w}), '')) AS ch
  FROM (SELECT *, unnest(range(length(value) - {w - 1})) AS s FROM candidates)),
entropies AS (
  SELECT c, s, any_value(bits) AS bits, log2({w}) - sum(n * log2(n)) / {w} AS h
  FROM (SELECT c, s, any_value(bits) AS bits, count(*) AS n FROM windows GROUP BY c, s, ch) GROUP BY c, s),
hot AS (SELECT c, min(s) AS first, max(s) AS last FROM entropies WHERE h >= bits GROUP BY c),
added AS (
  SELECT c, doc_id, start + first AS start, start + last + {w} AS stop,
         substr(value, (first + 1)::BIGINT, (last - first + {w})::BIGINT) AS hot_text
  FROM hot JOIN candidates USING (c)),
sought AS (SELECT * FROM added WHERE NOT (length(hot_text) <= {SECRETS.allowed_length} AND ({part}))),
-- Parts between the base spans that touch a span; its own end closes the last part.
cuts AS (
  SELECT a.c, a.doc_id, a.start AS lo, b.start AS cut, b.stop AS resume
  FROM sought a JOIN base b ON b.doc_id = a.doc_id AND b.start < a.stop AND a.start < b.stop
  UNION ALL SELECT c, doc_id, start, stop, stop FROM sought),
free AS (
  SELECT 3 AS kind, doc_id, greatest(lo, coalesce(max(resume) OVER (
           PARTITION BY c ORDER BY cut, resume ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)) AS start, cut AS stop
  FROM cuts QUALIFY start < stop),
everything AS (SELECT kind, doc_id, start, stop FROM base UNION ALL SELECT * FROM free),
listed AS (
  SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS item
  FROM everything),
by_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
         count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(item, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3) AS base,
         string_agg(item, ',' ORDER BY start, kind, stop) AS spans
  FROM listed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN by_doc USING (doc_id)"""


OP7 = _secrets()

_SIZES = ", ".join(f"({k})" for k in range(1, PHRASES.max_words + 1))
_CUTS = ", ".join(f"({k})" for k in range(1, PHRASES.max_words))

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
occurrences AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM worded, (VALUES {_SIZES}) AS sizes(k) WHERE len(ws) >= k),
counts AS MATERIALIZED (SELECT lang, words, phrase, count(*) AS f FROM occurrences GROUP BY lang, words, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE words >= 2 AND f >= {PHRASES.min_count}),
cuts AS (
  SELECT lang, words, phrase, f, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM candidates, (VALUES {_CUTS}) AS cut(k) WHERE k < words),
cut_scores AS (
  SELECT cuts.*, a.f AS l, b.f AS r, ({PHRASES.scale}::HUGEINT * cuts.f) // (a.f + b.f) AS score
  FROM cuts JOIN counts a ON a.lang = cuts.lang AND a.phrase = first AND a.words = k
            JOIN counts b ON b.lang = cuts.lang AND b.phrase = rest AND b.words = cuts.words - k),
lowest AS (
  SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
left_over AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM candidates longer WHERE longer.lang = c.lang AND longer.words > c.words
      AND contains(' ' || longer.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100::HUGEINT * longer.f >= {PHRASES.contained_percent}::HUGEINT * c.f)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM left_over)
SELECT lang, rank::BIGINT AS rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {PHRASES.top}"""


def _mix() -> str:
    up, down = MIX.share
    weights = ", ".join(map(str, MIX.weights))
    cap = f"{MIX.max_epochs} * source_size"
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::HUGEINT AS size,
         md5('{MIX.seed}|' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [{weights}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(MIX.weights)}]::HUGEINT AS weight
  FROM sized GROUP BY source),
-- A source is clamped if its cap is below its share of what sources of no higher cap per weight leave.
levels AS (
  SELECT *, (SELECT sum(source_size) FROM sources)::HUGEINT * {up}
           - coalesce((SELECT sum({cap}) FROM sources b WHERE b.source_size * a.weight < a.source_size * b.weight), 0) * {down} AS rest,
         (SELECT sum(weight) FROM sources b WHERE b.source_size * a.weight >= a.source_size * b.weight)::HUGEINT AS weights
  FROM sources a),
clamped AS (SELECT *, weight * rest > {cap} * weights * {down} AS full_ FROM levels),
level AS (
  SELECT (SELECT sum(source_size) FROM sources)::HUGEINT * {up} - coalesce(sum({cap}) FILTER (WHERE full_), 0)::HUGEINT * {down} AS rest,
         greatest(coalesce(sum(weight) FILTER (WHERE NOT full_), 0), 1)::HUGEINT * {down} AS below
  FROM clamped),
goals AS (
  SELECT source, source_size,
         CASE WHEN full_ THEN ({cap})::DOUBLE ELSE (weight * rest)::DOUBLE / below::DOUBLE END AS target,
         CASE WHEN full_ THEN {cap} ELSE (2 * weight * rest + below) // (2 * below) END AS goal
  FROM (SELECT source, source_size, weight, full_ FROM clamped), level),
keyed AS (SELECT source, key, sum(size)::HUGEINT AS at_key FROM sized GROUP BY source, key),
placed AS (
  SELECT source, key, at_key, sum(at_key) OVER (PARTITION BY source ORDER BY key)::HUGEINT - at_key AS ahead FROM keyed)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE
         size * (goal // source_size)
         + CASE WHEN ahead + at_key <= goal % source_size THEN size
                WHEN ahead >= goal % source_size THEN 0
                ELSE size * (goal % source_size - ahead) // at_key END END)::BIGINT AS taken
FROM sized s JOIN goals g ON g.source IS NOT DISTINCT FROM s.source
JOIN placed p ON p.source IS NOT DISTINCT FROM s.source AND p.key = s.key"""


OP12 = _mix()


def _runs(levels: int = 20) -> str:
    """Runs by the next occurrence of word windows.

    A run of period q has length 3q at least, so its windows of m words, q <= m <= 2q, occur
    again after exactly q words and not before.  Windows double from level to level.
    """
    least = RUNS.window
    steps, found, m = [], [], 1
    for k in range(levels):
        if m >= least:
            # The shortest windows also stand for all shorter periods.
            shortest = 1 if m == least else m // 2 + 1
            found.append(f"""
  SELECT d, min(i) AS start, max(i) - min(i) + 1 + {m - 1} + q AS length, q FROM (
    SELECT d, i, q, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM (
      SELECT d, i, lead(i) OVER (PARTITION BY d, g ORDER BY i) - i AS q FROM w{k} WHERE n_words >= 3 * {shortest})
    WHERE q BETWEEN {shortest} AND {m}) GROUP BY d, q, island""")
        steps.append(
            f"""w{k + 1} AS MATERIALIZED (
  SELECT a.d, a.i, dense_rank() OVER (ORDER BY a.d, a.g, b.g) AS g, a.n_words
  FROM w{k} a JOIN w{k} b ON b.d = a.d AND b.i = a.i + {m} WHERE a.n_words >= {3 * max(m // 2, 1)})"""
        )
        m *= 2
    crc = """list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: ascii(c)::UBIGINT)), lambda crc, byte: list_reduce(list_concat([xor(crc, byte)],
        list_transform(range(8), lambda z: 0::UBIGINT)), lambda r, z:
          CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END))"""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         CASE WHEN doc_id IS NULL THEN 1 ELSE xor({crc}, 4294967295::UBIGINT) END::BIGINT AS h FROM documents),
shaped AS (
  SELECT d, doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS tiled,
         CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS parts FROM texts),
words AS (
  SELECT d, i, CASE WHEN tiled AND i >= a THEN ws[1 + a + (i - a) % (1 + (n - a) // parts)] ELSE ws[1 + i] END AS w, n
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)),
w0 AS MATERIALIZED (SELECT d, i, dense_rank() OVER (ORDER BY d, w) AS g, n AS n_words FROM words),
{", ".join(steps)},
stretches AS ({" UNION ALL ".join(found)}),
runs AS MATERIALIZED (
  SELECT d, start, length, q FROM stretches WHERE length >= greatest({RUNS.min_length}, {RUNS.min_exponent} * q)),
dropped AS (SELECT DISTINCT d, unnest(range(start + q, start + length)) AS i FROM runs),
rest AS (
  SELECT d, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (d, i) GROUP BY d),
listed AS (
  SELECT d, count(*) AS n_runs,
         string_agg(start::BIGINT || ',' || length::BIGINT || ',' || q::BIGINT || chr(10), '' ORDER BY start, q) AS listed
  FROM runs GROUP BY d),
best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.d = r.d AND (o.length * r.q > r.length * o.q
      OR (o.length * r.q = r.length * o.q AND (o.start < r.start OR (o.start = r.start AND o.q < r.q))))))
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
       q::BIGINT AS period, (1000 * length // q)::BIGINT AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM shaped LEFT JOIN listed USING (d) LEFT JOIN best USING (d) LEFT JOIN rest USING (d)"""


OP13 = _runs()

ORACLES = {
    "op11_parsed_phrases": OP11,
    "op12_capped_water_filling": OP12,
    "op13_maximal_pair_runs": OP13,
    "op6_rarest_token_url_filter": OP6,
    "op7_entropy_secret_scan": OP7,
    "op9_line_first_quality": OP9,
    "op10_streaming_exact_dedup": OP10,
}
