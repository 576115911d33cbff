"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from statlake.llm import collocations
from statlake.llm.quality_sketch import GRID, RATIOS, Rules

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SUBSTRING = f"""WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)),
early AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN early USING (k), range(13) AS t(j) WHERE first_doc < doc_id),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.p) AS txt, count(*) AS n FROM word
  LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.txt, '')) AS kept_sha256 FROM docs d LEFT JOIN kept ON kept.doc_id = d.doc_id"""


def _quality(rules: Rules = Rules()) -> str:
    cells = "\nUNION ALL\n".join(
        f"SELECT lang, source, '{k}' AS ratio, CASE WHEN {b} > 0 THEN CAST(floor({a} * {GRID} / {b}) AS BIGINT) ELSE 0 END AS cell FROM counts"
        for k, (a, b) in RATIOS.items())

    def fence(level, keys):
        part = "".join(f"{k}, " for k in keys) + "ratio"
        return f"""{level} AS (SELECT {part}, n, q1 - wide AS low, q3 + wide AS high FROM (
  SELECT {part}, max(total) AS n, min(cell) FILTER (WHERE below * 4 >= total) AS q1, min(cell) FILTER (WHERE below * 4 >= total * 3) AS q3,
    greatest((min(cell) FILTER (WHERE below * 4 >= total * 3) - min(cell) FILTER (WHERE below * 4 >= total)) * {rules.reach},
      CASE ratio {' '.join(f"WHEN '{k}' THEN {int(v * GRID)}" for k, v in rules.slack.items())} END) AS wide
  FROM (SELECT {part}, cell, sum(count(*)) OVER (PARTITION BY {part} ORDER BY cell) AS below, sum(count(*)) OVER (PARTITION BY {part}) AS total
    FROM cells GROUP BY {part}, cell) GROUP BY {part}))"""

    def pick(k, side):
        level = lambda t: f"max({t}.{side}) FILTER (WHERE f.ratio = '{k}')"
        return (f"CASE WHEN max(f.n) >= {rules.min_group} THEN {level('f')} WHEN max(c.n) >= {rules.min_group} THEN {level('c')} ELSE {level('w')} END AS {k}_{side}")

    limits = ", ".join(pick(k, side) for k in RATIOS for side in ("low", "high"))
    cell = lambda k: f"(CASE WHEN {RATIOS[k][1]} > 0 THEN CAST(floor({RATIOS[k][0]} * {GRID} / {RATIOS[k][1]}) AS BIGINT) ELSE 0 END)"
    good = " AND ".join([f"{cell(k)} <= {k}_high" for k in RATIOS] + [f"{cell(k)} >= {k}_low" for k in rules.two_sided])
    failed = f"(n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.most_repeats} * n_words)"
    return f"""WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs)),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win), range(5) AS t(j)
  WHERE c > 1 GROUP BY doc_id),
counts AS (SELECT d.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM docs d LEFT JOIN rep ON rep.doc_id = d.doc_id),
cells AS ({cells}),
{fence('f0', ['lang', 'source'])},
{fence('c0', ['lang'])},
{fence('w0', [])},
limits AS (SELECT f.lang, f.source, {limits} FROM f0 f JOIN c0 c ON c.lang IS NOT DISTINCT FROM f.lang AND c.ratio = f.ratio
  JOIN w0 w ON w.ratio = f.ratio GROUP BY f.lang, f.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, NOT {failed} AND {good} AS kept
FROM counts JOIN limits ON limits.lang IS NOT DISTINCT FROM counts.lang AND limits.source IS NOT DISTINCT FROM counts.source"""


QUALITY = _quality()


def _collocations(rules: collocations.Rules = collocations.Rules()) -> str:
    grams = "\nUNION ALL\n".join(
        f"SELECT lang, {n} AS m, ws[i:i + {n - 1}] AS p FROM (SELECT lang, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM pieces)" for n in range(1, rules.longest + 1))
    return f"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(t, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM piece),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
f AS (SELECT lang, m, p, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, m, p HAVING count(*) >= {rules.least}),
cuts AS (SELECT c.lang, c.p, c.m, c.f AS a, k, x.f AS l, y.f AS r, {rules.scale} * c.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c JOIN f x ON x.lang = c.lang AND x.m = k AND x.p = c.p[1:k]
  JOIN f y ON y.lang = c.lang AND y.m = c.m - k AND y.p = c.p[k + 1:c.m]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, f, p[i:i + n - 1] AS p FROM (SELECT *, unnest(range(1, m - n + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS n FROM f WHERE m > 2))),
gone AS (SELECT DISTINCT b.lang, b.p FROM best b JOIN inner_parts q ON q.lang = b.lang AND q.p = b.p WHERE 100 * q.f >= {rules.subsumed} * b.a),
ranked AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, score FROM best b ANTI JOIN gone g ON g.lang = b.lang AND g.p = b.p)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) JOIN totals USING (lang) WHERE rank <= {rules.top}"""


COLLOCATIONS = _collocations()
