"""The queries of this subpackage in DuckDB SQL, where SQL can express them.

Sharding needs CRC-32, and neighbours, language models, secret lexing, token merges, passages of whole texts and SimHash
components have no usable SQL; tests hold those against plain versions.
"""

from __future__ import annotations

from .licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS
from .mixing import BUDGET, LIMIT, WEIGHTS
from .quality import FENCES, LEAST, LEAST_WORDS, MOST_REPEATED, OUTER_HIGH, OUTER_LOW, SHARES, SPREAD

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _mixing() -> str:
    weights = ", ".join(map(str, WEIGHTS))
    return f"""WITH sized AS (SELECT doc_id, source, COALESCE(len({WORDS}), 0) AS size FROM documents),
    per AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, {LIMIT}::DOUBLE * source_size AS cap,
        ([{weights}]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM per),
    levels AS (SELECT *, ({BUDGET}::DOUBLE * SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / SUM(weight) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
    chosen AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
    targets AS (SELECT source, source_size, least(cap, COALESCE((SELECT level FROM chosen) * weight, cap)) AS target FROM levels),
    rated AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        (CAST('0x' || substr(md5(COALESCE('mix/k' || doc_id, 'mix/n')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496 AS u
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
        CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM rated"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', chr(10), 'g')"
    for pattern, replacement in SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{replacement.replace('$1', chr(92) + '1')}', 'g')"
    return f"md5(trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g')))"


def _licenses() -> str:
    known = ", ".join("('{}', '{}')".format(name, body.replace("'", "''")) for name, body in KNOWN)
    return f"""WITH known AS (SELECT DISTINCT license, {_canonical('body')} AS digest FROM (VALUES {known}) v(license, body)),
    units AS (SELECT doc_id, 0 AS line_no, text AS unit FROM documents UNION ALL
        SELECT doc_id, generate_subscripts(lines, 1), unnest(lines) FROM (
            SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) WHERE len(lines) > 1),
    found AS (SELECT doc_id, line_no, license FROM (SELECT *, {_canonical('unit')} AS digest FROM units) JOIN known USING (digest))
    SELECT doc_id, license, bool_or(line_no = 0) AS whole_text, COUNT(*) FILTER (line_no > 0) AS n_lines,
        CAST(MIN(line_no) AS INTEGER) AS first_line FROM found GROUP BY doc_id, license"""


def _cell(value: str) -> str:
    return f"({value} - {value} % CAST(pow(2, greatest(length(bin({value})) - 5, 0)) AS BIGINT))"


def _quality() -> str:
    values = {"word_length": "(1000 * word_chars) // n_words", "symbols": "(1000 * n_symbols) // n_words",
              "dup_lines": "(1000 * n_dup_lines) // n_lines", "repeats": "(1000 * n_repeat_words) // n_words"}
    failed = f"(n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)"
    rows = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {_cell(v)} AS cell FROM base WHERE NOT {failed}" for m, v in values.items())

    def level(keys: str) -> str:
        group = f"{keys}, metric" if keys else "metric"
        high = " ".join(f"WHEN '{m}' THEN {up}" for m, (up, _) in FENCES.items())
        low = " ".join(f"WHEN '{m}' THEN q50 - greatest({SPREAD} * least(qh - q50, q50 - ql), {down})" for m, (_, down) in FENCES.items() if down)
        shares = ", ".join(f"'{m}'" for m in SHARES)
        return f"""(SELECT {group}, n, least(q50 + greatest({SPREAD} * least(qh - q50, q50 - ql), CASE metric {high} END),
        CASE WHEN metric IN ({shares}) THEN 1000 ELSE 1000000000000 END) AS high, CASE metric {low} ELSE -1 END AS low
        FROM (SELECT {group}, MAX(total) AS n, MIN(cell) FILTER (running * 100 >= total * {OUTER_LOW}) AS ql,
        MIN(cell) FILTER (running * 100 >= total * 50) AS q50, MIN(cell) FILTER (running * 100 >= total * {OUTER_HIGH}) AS qh
        FROM (SELECT *, SUM(n) OVER (PARTITION BY {group} ORDER BY cell) AS running, SUM(n) OVER (PARTITION BY {group}) AS total
        FROM (SELECT {group}, cell, COUNT(*) AS n FROM rows GROUP BY ALL)) GROUP BY {group}))"""

    checks = " UNION ALL ".join(f"SELECT i, lang, source, '{m}' AS metric, {_cell(v)} AS cell FROM base WHERE n_words > 0" for m, v in values.items())
    return f"""WITH docs AS (SELECT row_number() OVER () AS i, doc_id, lang, source, COALESCE(text, '') AS text FROM documents),
    split AS (SELECT *, {WORDS} AS words, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM docs),
    grams AS (SELECT i, p, array_to_string(words[p:p + 4], ' ') AS gram FROM (
        SELECT i, words, unnest(range(1, len(words) - 3)) AS p FROM split WHERE len(words) >= 5)),
    again AS (SELECT i, p FROM (SELECT *, COUNT(*) OVER (PARTITION BY i, gram) AS n FROM grams) WHERE n > 1),
    covered AS (SELECT i, COUNT(DISTINCT p + k) AS n FROM again, range(5) r(k) GROUP BY i),
    base AS (SELECT i, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(n, 0) AS BIGINT) AS n_repeat_words
        FROM split LEFT JOIN covered USING (i)),
    rows AS ({rows}), fine AS {level('lang, source')}, middle AS {level('lang')}, top AS {level('')},
    verdict AS (SELECT c.i, bool_and(CASE WHEN f.n >= {LEAST} THEN c.cell BETWEEN f.low AND f.high
        WHEN m.n >= {LEAST} THEN c.cell BETWEEN m.low AND m.high ELSE c.cell BETWEEN t.low AND t.high END) AS within FROM ({checks}) c
        JOIN fine f ON f.metric = c.metric AND f.lang IS NOT DISTINCT FROM c.lang AND f.source IS NOT DISTINCT FROM c.source
        JOIN middle m ON m.metric = c.metric AND m.lang IS NOT DISTINCT FROM c.lang JOIN top t ON t.metric = c.metric GROUP BY c.i)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND COALESCE(within, FALSE) AS kept FROM (SELECT *,
        {failed} AS base_failed FROM base) LEFT JOIN verdict USING (i)"""


ORACLE: dict[str, str] = {"op6_mixing": _mixing(), "op9_licenses": _licenses(), "op10_quality": _quality()}
