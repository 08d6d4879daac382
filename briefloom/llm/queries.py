"""Named queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from briefloom.llm.chat_format import CONTROL, END, START, TURN, op8_chat_format
from briefloom.llm.context_tree import op12_context_tree
from briefloom.llm.decontamination import op7_decontamination
from briefloom.llm.helpers import table
from briefloom.llm.html_extract import op2_html_extract
from briefloom.llm.jaccard_join import op9_jaccard_join
from briefloom.llm.language_id import op4_language_id
from briefloom.llm.mixing import op1_mix_sources
from briefloom.llm.periodic_runs import op13_periodic_runs
from briefloom.llm.quality_classifier import op3_quality_classifier
from briefloom.llm.quality_rules import op6_quality_rules
from briefloom.llm.spelling_variants import op11_spelling_variants
from briefloom.llm.substring_dedup import op5_substring_dedup
from briefloom.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_mix_sources": lambda spark, d: op1_mix_sources(table(spark, d, "documents")),
    "op2_html_extract": lambda spark, d: op2_html_extract(table(spark, d, "pages")),
    "op3_quality_classifier": lambda spark, d: op3_quality_classifier(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_language_id": lambda spark, d: op4_language_id(table(spark, d, "documents")),
    "op6_quality_rules": lambda spark, d: op6_quality_rules(table(spark, d, "documents")),
    "op7_decontamination": lambda spark, d: op7_decontamination(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op8_chat_format": lambda spark, d: op8_chat_format(table(spark, d, "conversations")),
    "op5_substring_dedup": lambda spark, d: op5_substring_dedup(table(spark, d, "documents")).drop("removed"),
    "op9_jaccard_join": lambda spark, d: op9_jaccard_join(table(spark, d, "documents")),
    "op10_toxicity": lambda spark, d: op10_toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op11_spelling_variants": lambda spark, d: op11_spelling_variants(table(spark, d, "documents")),
    "op12_context_tree": lambda spark, d: op12_context_tree(table(spark, d, "documents")),
    "op13_periodic_runs": lambda spark, d: op13_periodic_runs(table(spark, d, "documents")),
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {}

ORACLE["op5_substring_dedup"] = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k
  FROM w, unnest(range(1, len(ws) - 33)) AS t(i)
),
rep AS (SELECT k FROM wins GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM wins WHERE k IN (SELECT k FROM rep)),
cov AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, unnest(range(35)) AS t(j)),
pos AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS txt, count(*) AS n
  FROM pos ANTI JOIN cov USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLE["op9_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 3], ' ')) AS s
  FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS t(i) WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b USING (s) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * least(na.n, nb.n) >= 85 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.c
)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

ORACLE["op1_mix_sources"] = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest FROM documents
),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS most,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INTEGER) + 1] AS weight
  FROM s
),
l AS (
  SELECT *, row_number() OVER before AS place, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - CAST(coalesce(sum(most) OVER before, 0) AS DOUBLE))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM w
  WINDOW before AS (
    ORDER BY CAST(most AS DOUBLE) / weight, weight, source IS NULL, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  )
),
f AS (SELECT *, (SELECT arg_min(level, place) FROM l WHERE level * weight <= most) AS found FROM l),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN found IS NULL THEN CAST(most AS DOUBLE) ELSE least(found * weight, CAST(most AS DOUBLE)) END AS target
  FROM f
),
c AS (
  SELECT doc_id, d.source, size, source_size, target, epoch,
    sum(size) OVER (
      PARTITION BY d.source ORDER BY epoch, md5(concat_ws(':', '17', epoch, coalesce(CAST(doc_id AS VARCHAR), ''), digest)), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    ) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, unnest(range(1, 3)) AS e(epoch)
)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
  CAST(sum(greatest(0, least(size, floor(target) - (upto - size)))) AS BIGINT) AS taken
FROM c GROUP BY doc_id
"""

ORACLE["op6_quality_rules"] = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS t(i)
),
hit AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM hit, unnest(range(8)) AS t(j) GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(ws) AS n_words, array_to_string(ws, '') AS body, coalesce(n_repeat_words, 0) AS n_repeat_words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w LEFT JOIN rep USING (doc_id)
),
c AS (
  SELECT doc_id, n_words, n_repeat_words, length(body) AS word_chars, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(body) - length(regexp_replace(body, '\p{{L}}', '', 'g')) AS n_letters,
    length(body) - length(regexp_replace(body, '\p{{Lu}}', '', 'g')) AS n_upper,
    length(body) - length(replace(body, '!', '')) AS n_exclamations
  FROM m
),
b AS (
  SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
    + 4 * (100 * n_symbols > 25 * n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
    + 16 * (word_chars > 25 * n_words)::INT + 32 * (word_chars < 2 * n_words)::INT
    + 64 * (100 * n_upper > 60 * n_letters AND n_letters > 0)::INT + 128 * (100 * n_letters < 50 * word_chars)::INT
    + 256 * (100 * n_exclamations > 30 * n_words)::INT AS fail_bits
  FROM c
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept,
  CAST(fail_bits AS BIGINT) AS fail_bits
FROM b
"""


def _escaped(column: str) -> str:
    """The chat template's escape as nested SQL replacements."""
    sql = rf"replace({column}, '\', '\\')"
    for mark in CONTROL:
        sql = f"replace({sql}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return sql


ORACLE["op8_chat_format"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
),
m AS (
  SELECT *, {_escaped("text")} AS body, {_escaped("role")} AS name,
    coalesce(lag(role) OVER o <> role, TRUE) AS opens, row_number() OVER o AS k
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, {_escaped("text")})
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(body) + {len(TURN)} + CASE WHEN opens THEN length(name) + {len(START + END)} ELSE 0 END) AS BIGINT)
    AS formatted_chars
FROM m GROUP BY conv_id
"""

# crc32 byte by byte, with its table made from the polynomial; code points up to U+00FF are one or two bytes
ORACLE["op11_spelling_variants"] = r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
  ) GROUP BY doc_id, run HAVING length(run) >= 7
),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
        ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, tab
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
cuts AS MATERIALIZED (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS cut FROM words, unnest(range(1, length(word) + 1)) AS t(i)
),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (cut, i) WHERE a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
),
f AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
    CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
),
way AS (
  SELECT word, word AS here, 0 AS steps FROM f
  UNION ALL
  SELECT way.word, f.form, steps + 1 FROM way JOIN f ON f.word = way.here WHERE f.form IS NOT NULL
)
SELECT f.word, n, n_near, form, form_n, root
FROM f JOIN (SELECT word, arg_max(here, steps) AS root FROM way GROUP BY word) USING (word)
"""
