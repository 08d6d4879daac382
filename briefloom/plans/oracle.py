"""Independent DuckDB SQL for the named queries, over the same whole tables."""

from __future__ import annotations

from briefloom.operators.validate import NA_VALUES
from briefloom.plans.queries import PIECES, TOP_SENTENCES, VOCAB

NL = "chr(10)"


def sents(text: str) -> str:
    marked = rf"regexp_replace({text}, '([.!?])\s+', '\1' || {NL}, 'g')"
    return (
        f"list_filter(list_transform(string_split({marked}, {NL}), lambda s: trim(s)), "
        "lambda s: s <> '')"
    )


def words(text: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'), ' '), "
        "lambda w: w <> '')"
    )


def key(row_id: str) -> str:
    return f"md5({row_id}::VARCHAR || ':42')"


def ranked_split(source: str, row_id: str, stratum: str = "") -> str:
    """Rows with their rank in the seeded order and the split that follows from it."""
    over = f"PARTITION BY {stratum}" if stratum else ""
    return f"""
    SELECT *, CASE WHEN rnk <= ceil(0.5 * held) THEN 'test' WHEN rnk <= held THEN 'val'
              ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER ({over} ORDER BY {key(row_id)}, {row_id}) AS rnk,
                 ceil((1.0::DOUBLE - 0.8::DOUBLE) * count(*) OVER ({over})) AS held FROM {source})
    """


PAIRS_DOCS = f"""
SELECT doc_id::VARCHAR AS id, array_to_string(s[2:], ' ') AS dialogue, s[1] AS summary
FROM (SELECT doc_id, {sents('text')} AS s FROM documents) WHERE len(s) >= 2
"""

PAIRS_CONV = f"""
SELECT id, string_agg(role || ': ' || text, {NL} ORDER BY turn) AS dialogue, any_value(last) AS summary
FROM (SELECT conv_id::VARCHAR AS id, turn, role, text,
             max(turn) OVER (PARTITION BY conv_id) AS final,
             last_value(text) OVER (PARTITION BY conv_id ORDER BY turn
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
      FROM conversations) WHERE turn < final GROUP BY id
"""

VOCAB_SQL = f"""
SELECT word, n AS count, (row_number() OVER (ORDER BY n DESC, word) + 105)::INTEGER AS id
FROM (SELECT word, count(*) AS n FROM (SELECT unnest({words('text')}) AS word FROM documents)
      GROUP BY word ORDER BY n DESC, word LIMIT {VOCAB})
"""

WITH_GAPS = """
SELECT doc_id, CASE substr(md5(doc_id::VARCHAR), 1, 1) WHEN '0' THEN 'NA' WHEN '1' THEN 'null' WHEN '2' THEN '' ELSE text END AS text
FROM documents
"""

NA_LIST = ", ".join(f"'{v}'" for v in NA_VALUES)

NORMALISED = f"SELECT doc_id, CASE WHEN text IN ({NA_LIST}) THEN NULL ELSE text END AS text FROM ({WITH_GAPS})"

ADDRESSES = r"""
SELECT page_id, unnest([url, regexp_replace(url, '^https?://[^/]+/([a-z]+)/', 'https://github.com/\1/blob/'),
   regexp_replace(url, '^https?://', 's3://'),
   regexp_replace(regexp_replace(url, '^https?://', 's3://'), '^(s3://[^/]*)/.*$', '\1')]) AS url
FROM pages
"""


def coded(source: str, row_id: str, text: str, limit: int) -> str:
    """Unpadded ids of every row, without the end mark."""
    return f"""
    SELECT t.{row_id}, coalesce(c.ids, []) AS ids
    FROM {source} t LEFT JOIN (
      SELECT e.{row_id}, list(coalesce(v.id, 105) ORDER BY pos) AS ids
      FROM (SELECT {row_id}, unnest(w) AS word, generate_subscripts(w, 1) AS pos
            FROM (SELECT {row_id}, ({words(text)})[1:{limit - 1}] AS w FROM {source})) e
      LEFT JOIN vocab v USING (word) GROUP BY e.{row_id}) c USING ({row_id})
    """


def repeat(value: str, n: str) -> str:
    return f"list_transform(range({n}), lambda x: {value})"


def padded(ids: str, limit: int, pad: int = 0) -> str:
    return f"list_concat(list_concat({ids}, [1]), {repeat(str(pad), f'{limit - 1} - len({ids})')})"


def mask(ids: str, limit: int) -> str:
    return f"list_concat({repeat('1', f'len({ids}) + 1')}, {repeat('0', f'{limit - 1} - len({ids})')})"


def md5_list(values: str) -> str:
    return f"md5(array_to_string({values}, ','))"


LEAD = f"array_to_string(s[1:{TOP_SENTENCES}], ' ')"


def tfidf(source: str, row_id: str, text: str) -> str:
    """(row_id, prediction): the best sentences by mean idf, in text order."""
    return f"""
    SELECT d.{row_id}, coalesce(array_to_string(list_transform(chosen, lambda p: d.s[p]), ' '), '') AS prediction
    FROM (SELECT {row_id}, {sents(text)} AS s FROM {source}) d LEFT JOIN (
      SELECT {row_id}, list(pos ORDER BY pos) AS chosen FROM (
        SELECT {row_id}, pos, row_number() OVER (PARTITION BY {row_id} ORDER BY score DESC, pos) AS r
        FROM (SELECT {row_id}, pos, round(avg(idf), 6) AS score
              FROM (SELECT {row_id}, pos, unnest({words('sentence')}) AS word
                    FROM (SELECT {row_id}, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos
                          FROM (SELECT {row_id}, {sents(text)} AS s FROM {source})))
              JOIN (SELECT word, ln(((SELECT count(*) FROM {source}) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf
                    FROM (SELECT unnest(list_distinct({words(text)})) AS word FROM {source})
                    GROUP BY word) USING (word)
              GROUP BY {row_id}, pos))
      WHERE r <= {TOP_SENTENCES} GROUP BY {row_id}) c USING ({row_id})
    """


LEAD_PREDICTIONS = f"""
SELECT id, 'lead' AS model, {LEAD} AS prediction, summary AS reference
FROM (SELECT id, {sents('dialogue')} AS s, summary FROM pairs)
"""

TFIDF_PREDICTIONS = f"""
SELECT id, 'tfidf' AS model, prediction, summary AS reference
FROM pairs JOIN ({tfidf('pairs', 'id', 'dialogue')}) USING (id)
"""

ROWS_LEAD = f"WITH pairs AS ({PAIRS_DOCS}), preds AS ({LEAD_PREDICTIONS})"
ROWS_WHOLE = f"""WITH pairs AS ({PAIRS_DOCS}),
preds AS (SELECT id, 'whole' AS model, dialogue AS prediction, summary AS reference FROM pairs)"""
ROWS_BOTH = (
    f"WITH pairs AS ({PAIRS_DOCS}), preds AS ({LEAD_PREDICTIONS} UNION ALL {TFIDF_PREDICTIONS})"
)


def grams(tokens: str, n: int) -> str:
    return (
        f"list_transform(range(1, len({tokens}) - {n} + 2), "
        f"lambda i: array_to_string(({tokens})[i:i + {n - 1}], ' '))"
    )


def overlaps(tokenised: str, n: int) -> str:
    """(model, id, m, a, b): clipped n-gram matches and the two n-gram counts."""

    def counted(side: str) -> str:
        return (
            f"SELECT model, id, g, count(*) AS c FROM (SELECT model, id, unnest({grams(side, n)}) AS g "
            f"FROM {tokenised}) GROUP BY ALL"
        )

    return f"""
    SELECT model, id, coalesce(m, 0) AS m, greatest(len(h) - {n - 1}, 0) AS a, greatest(len(r) - {n - 1}, 0) AS b
    FROM {tokenised} LEFT JOIN (
      SELECT model, id, sum(least(x.c, y.c))::BIGINT AS m
      FROM ({counted('h')}) x JOIN ({counted('r')}) y USING (model, id, g) GROUP BY ALL) USING (model, id)
    """


TOKENISED = f"SELECT model, id, {words('prediction')} AS h, {words('reference')} AS r FROM preds"


def rouge(n: int) -> str:
    return f"""
    SELECT model, id, CASE WHEN m = 0 THEN 0.0 ELSE m::DOUBLE / a END AS p,
           CASE WHEN m = 0 THEN 0.0 ELSE m::DOUBLE / b END AS r,
           CASE WHEN m = 0 THEN 0.0 ELSE 2.0 * (m::DOUBLE / a) * (m::DOUBLE / b) / (m::DOUBLE / a + m::DOUBLE / b) END AS f
    FROM ({overlaps('toks', n)})
    """


def rouge_rows(source: str) -> str:
    return (
        "SELECT id, round(p::DOUBLE, 6) AS p, round(r::DOUBLE, 6) AS r, round(f::DOUBLE, 6) AS f "
        f"FROM ({source})"
    )


SYNONYM_KEY = "CASE WHEN len(word) >= 5 THEN 'key:' || substr(word, 1, 4) ELSE 'word:' || word END"


def _left_over(name: str, other: str) -> str:
    """Words of one side that equal words leave over, numbered by key."""
    return f"""
  {name}_over AS (SELECT model, id, pos, {SYNONYM_KEY} AS key,
      row_number() OVER (PARTITION BY model, id, {SYNONYM_KEY} ORDER BY pos) AS k
    FROM {name} ANTI JOIN {other} USING (model, id, word, k))"""


def _numbered(name: str, words_of: str) -> str:
    return f"""
  {name} AS (SELECT model, id, word, pos, row_number() OVER (PARTITION BY model, id, word ORDER BY pos) AS k
    FROM (SELECT model, id, unnest({words_of}) AS word, generate_subscripts({words_of}, 1) AS pos FROM toks))"""


METEOR_SYNONYMS = f"""
WITH {_numbered('hw', 'h')}, {_numbered('rw', 'r')}, {_left_over('hw', 'rw')}, {_left_over('rw', 'hw')},
  pairs AS (
    SELECT hw.model, hw.id, hw.pos AS hp, rw.pos AS rp FROM hw JOIN rw USING (model, id, word, k)
    UNION ALL SELECT a.model, a.id, a.pos, b.pos FROM hw_over a JOIN rw_over b USING (model, id, key, k)),
  counted AS (
    SELECT model, id, count(*)::DOUBLE AS m,
      (count(*) FILTER (WHERE NOT coalesce(hp = ph + 1 AND rp = pr + 1, FALSE)))::DOUBLE AS chunks
    FROM (SELECT *, lag(hp) OVER w AS ph, lag(rp) OVER w AS pr FROM pairs WINDOW w AS (PARTITION BY model, id ORDER BY hp))
    GROUP BY model, id)
SELECT model, id, CASE WHEN m IS NULL THEN 0.0 ELSE
  (10 * (m / len(h)) * (m / len(r)) / (m / len(r) + 9 * (m / len(h)))) * (1 - 0.5 * (chunks / m) ** 3) END AS meteor
FROM toks LEFT JOIN counted USING (model, id)
"""


METEOR = """
SELECT model, id, CASE WHEN m = 0 THEN 0.0 ELSE
  (10 * (m / h) * (m / r) / (m / r + 9 * (m / h))) * (1 - 0.5 * (chunks / m) ** 3) END AS meteor
FROM (
  SELECT t.model, t.id, len(h)::DOUBLE AS h, len(r)::DOUBLE AS r, coalesce(m, 0)::DOUBLE AS m, chunks::DOUBLE AS chunks
  FROM toks t LEFT JOIN (
    SELECT model, id, count(*) AS m, count(*) FILTER (WHERE NOT coalesce(hp = ph + 1 AND rp = pr + 1, FALSE)) AS chunks
    FROM (SELECT model, id, hp, rp, lag(hp) OVER w AS ph, lag(rp) OVER w AS pr
          FROM (SELECT model, id, word, pos AS hp, row_number() OVER (PARTITION BY model, id, word ORDER BY pos) AS k
                FROM (SELECT model, id, unnest(h) AS word, generate_subscripts(h, 1) AS pos FROM toks))
          JOIN (SELECT model, id, word, pos AS rp, row_number() OVER (PARTITION BY model, id, word ORDER BY pos) AS k
                FROM (SELECT model, id, unnest(r) AS word, generate_subscripts(r, 1) AS pos FROM toks))
          USING (model, id, word, k) WINDOW w AS (PARTITION BY model, id ORDER BY hp))
    GROUP BY ALL) USING (model, id))
"""

LCS_STEP = """
list_reduce(list_concat([[0]], list_transform(range(1, len(r) + 1),
  lambda k: [CASE WHEN r[k] = h[j + 1] THEN d[k] + 1 ELSE d[k + 1] END])),
  lambda acc, x: list_concat(acc, [greatest(acc[-1], x[1])]))
"""

# The LCS table of every row, one prediction word per round.
LCS_CTES = f"""
steps AS (
  SELECT model, id, 0 AS j, h, r, list_transform(range(len(r) + 1), lambda x: 0) AS d FROM toks
  UNION ALL
  SELECT model, id, j + 1, h, r, {LCS_STEP} FROM steps WHERE j < len(h)),
lcs AS (SELECT model, id, d[-1]::DOUBLE AS m, len(h) AS a, len(r) AS b FROM steps WHERE j = len(h)),
rouge_l AS (SELECT model, id, CASE WHEN m = 0 THEN 0 ELSE m / a END AS p, CASE WHEN m = 0 THEN 0 ELSE m / b END AS r,
                   CASE WHEN m = 0 THEN 0 ELSE 2 * m / (a + b) END AS f FROM lcs)
"""

ROUGE_L = f"""
WITH RECURSIVE pairs AS ({PAIRS_DOCS}), preds AS ({LEAD_PREDICTIONS}), toks AS ({TOKENISED}), {LCS_CTES}
{rouge_rows("SELECT * FROM rouge_l")}
"""


def bleu_tokens(text: str) -> str:
    """13a tokens."""
    literals = [
        ("'<skipped>'", "''"),
        (f"'-' || {NL}", "''"),
        (NL, "' '"),
        ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"),
        ("'&lt;'", "'<'"),
        ("'&gt;'", "'>'"),
    ]
    out = text
    for old, new in literals:
        out = f"replace({out}, {old}, {new})"
    out = f"' ' || {out} || ' '"
    patterns = [
        (r"([\{-~\[-` -&\(-\+:-@/])", r" \1 "),
        (r"([^0-9])([.,])", r"\1 \2 "),
        (r"([.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ]
    for old, new in patterns:
        out = f"regexp_replace({out}, '{old}', '{new}', 'g')"
    return f"list_filter(string_split_regex({out}, '\\s+'), lambda w: w <> '')"


BLEU_TOKENISED = (
    f"SELECT model, id, {bleu_tokens('prediction')} AS h, {bleu_tokens('reference')} AS r FROM preds"
)

_SUMS = ", ".join(
    f"(SELECT sum(m) FROM ({overlaps('btoks', n)}) o WHERE o.model = g.model)::BIGINT AS match{n}, "
    f"(SELECT sum(a) FROM ({overlaps('btoks', n)}) o WHERE o.model = g.model)::BIGINT AS total{n}"
    for n in range(1, 5)
)


def _log_precisions() -> str:
    terms, zeros = [], []
    for n in range(1, 5):
        zeros.append(f"CASE WHEN match{n} = 0 THEN 1 ELSE 0 END")
        terms.append(
            f"ln(CASE WHEN match{n} > 0 THEN 100.0 * match{n} / greatest(total{n}, 1) "
            f"ELSE 100.0 / (2.0 ** ({' + '.join(zeros)}) * greatest(total{n}, 1)) END)"
        )
    return " + ".join(terms)


BLEU = f"""
SELECT *, CASE WHEN match1 + match2 + match3 + match4 = 0 OR least(total1, total2, total3, total4) = 0 THEN 0.0
  ELSE (CASE WHEN sys_len < ref_len THEN exp(1 - ref_len::DOUBLE / sys_len) ELSE 1.0 END)
       * exp(({_log_precisions()}) / 4) END AS bleu
FROM (SELECT model, sys_len, ref_len, {_SUMS}
      FROM (SELECT model, sum(len(h))::BIGINT AS sys_len, sum(len(r))::BIGINT AS ref_len FROM btoks GROUP BY model) g)
"""

REPORT_ROWS = f"""
SELECT model, 'rouge1' AS metric, round(avg(f)::DOUBLE, 6) AS value FROM ({rouge(1)}) GROUP BY model
UNION ALL SELECT model, 'rouge2', round(avg(f)::DOUBLE, 6) FROM ({rouge(2)}) GROUP BY model
UNION ALL SELECT model, 'meteor', round(avg(meteor)::DOUBLE, 6) FROM ({METEOR}) GROUP BY model
UNION ALL SELECT model, 'bleu', round(bleu::DOUBLE, 6) FROM ({BLEU})
"""

REPORT = f"{ROWS_BOTH}, toks AS ({TOKENISED}), btoks AS ({BLEU_TOKENISED}) {REPORT_ROWS}"

SPLIT_DOCS = ranked_split("documents", "doc_id")

FEATURES = f"""
WITH pairs AS ({PAIRS_DOCS}), vocab AS ({VOCAB_SQL}),
inputs AS ({coded('pairs', 'id', 'dialogue', 1024)}), targets AS ({coded('pairs', 'id', 'summary', 128)}),
parted AS ({{split}})
SELECT id, split, {md5_list(padded('i.ids', 1024))} AS input_ids_md5, 1024::BIGINT AS input_ids_size,
  {md5_list(mask('i.ids', 1024))} AS attention_mask_md5, 1024::BIGINT AS attention_mask_size,
  {md5_list(padded('o.ids', 128))} AS labels_md5, 128::BIGINT AS labels_size,
  (len(i.ids) + 1)::BIGINT AS n_real
FROM parted JOIN inputs i USING (id) JOIN targets o USING (id)
"""


def hash_split(source: str, row_id: str) -> str:
    unit = f"('0x' || substr({key(row_id)}, 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    return (
        f"SELECT {row_id}, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.9::DOUBLE THEN 'val' "
        f"ELSE 'test' END AS split FROM (SELECT {row_id}, {unit} AS u FROM {source})"
    )


def padded_rows(rows: str, pad: str) -> str:
    widest = f"list_max(list_transform({rows}, lambda q: len(q)))"
    return (
        f"list_transform({rows}, lambda z: array_to_string(list_concat(z, "
        f"list_transform(range({widest} - len(z)), lambda y: {pad})), ','))"
    )


def rows_md5(rows: str, pad: str) -> str:
    return f"md5(array_to_string({padded_rows(rows, pad)}, ';'))"


ONES = "list_transform(ins, lambda v: list_transform(v, lambda t: 1))"

def textrank(source: str, row_id: str, text: str) -> str:
    """CTEs ending in ``ranked(row_id, prediction)``: edges between sentence pairs, 20 rounds."""
    return f"""
    d AS (SELECT {row_id} AS doc, {sents(text)} AS s FROM {source}),
    sent AS (SELECT doc, pos, {words('sentence')} AS w
             FROM (SELECT doc, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM d)),
    word AS (SELECT DISTINCT doc, pos, len(w) AS n, unnest(w) AS word FROM sent WHERE len(w) > 1),
    edge AS (SELECT a.doc, a.pos AS i, b.pos AS j, count(*) / (ln(any_value(a.n)) + ln(any_value(b.n))) AS weight
             FROM word a JOIN word b ON a.doc = b.doc AND a.word = b.word AND a.pos <> b.pos GROUP BY ALL),
    flow AS (SELECT doc, i, j, weight / sum(weight) OVER (PARTITION BY doc, j) AS share FROM edge),
    rounds AS (
      SELECT doc, pos, 0 AS t, 1.0::DOUBLE AS score FROM sent
      UNION ALL
      SELECT r.doc, r.pos, r.t + 1, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(g.given, 0)
      FROM rounds r LEFT JOIN (
        SELECT f.doc, f.i, sum(f.share * q.score) AS given
        FROM flow f JOIN rounds q ON f.doc = q.doc AND f.j = q.pos GROUP BY f.doc, f.i) g
      ON r.doc = g.doc AND r.pos = g.i WHERE r.t < 20),
    best AS (SELECT doc, pos, row_number() OVER (PARTITION BY doc ORDER BY round(score, 6) DESC, pos) AS r
             FROM rounds WHERE t = 20),
    ranked AS (SELECT d.doc AS {row_id}, coalesce(array_to_string(list_transform(c.chosen, lambda p: d.s[p]), ' '), '') AS prediction
               FROM d LEFT JOIN (SELECT doc, list(pos ORDER BY pos) AS chosen FROM best
                                 WHERE r <= {TOP_SENTENCES} GROUP BY doc) c USING (doc))
    """


TEXTRANK_PREDICTIONS = (
    "SELECT id, 'textrank' AS model, prediction, summary AS reference FROM pairs JOIN ranked USING (id)"
)

# Predictions and references are single lines here, where rougeLsum is rougeL by definition.
FULL_REPORT = f"""
WITH RECURSIVE pairs AS MATERIALIZED ({PAIRS_DOCS}), {textrank('pairs', 'id', 'dialogue')},
preds AS MATERIALIZED ({LEAD_PREDICTIONS} UNION ALL {TFIDF_PREDICTIONS} UNION ALL {TEXTRANK_PREDICTIONS}),
toks AS MATERIALIZED ({TOKENISED}), btoks AS MATERIALIZED ({BLEU_TOKENISED}), {LCS_CTES}
{REPORT_ROWS}
UNION ALL SELECT model, unnest(['rougeL', 'rougeLsum']), round(avg(f)::DOUBLE, 6) FROM rouge_l GROUP BY model
"""


PIECES_SQL = f"""
WITH w AS (SELECT word, count(*) AS n FROM (SELECT unnest({words('text')}) AS word FROM documents) GROUP BY word),
p AS (SELECT piece, sum(n)::BIGINT AS count FROM (
        SELECT n, unnest(flatten(list_transform(range(1, len(word) + 1), lambda i: list_transform(
          range(1, least(8, len(word) - i + 1) + 1), lambda k: substr(word, i, k))))) AS piece FROM w)
      GROUP BY piece),
kept AS (SELECT piece, count FROM (SELECT *, row_number() OVER (ORDER BY count DESC, piece) AS r FROM p)
         WHERE r <= {PIECES} OR len(piece) = 1)
SELECT piece, count, round(ln(count::DOUBLE / (SELECT sum(count) FROM kept)), 6) AS logp,
       (row_number() OVER (ORDER BY count DESC, piece) + 105)::INTEGER AS id FROM kept
"""

# Best segmentation of every distinct word, one end position per round: ``best`` holds the
# best score up to each position, ``codes`` the piece ids of that best segmentation.
UNIGRAM = f"""
WITH RECURSIVE pieces AS MATERIALIZED ({PIECES_SQL}),
distinct_words AS MATERIALIZED (SELECT DISTINCT unnest({words('text')}) AS word FROM documents),
cuts AS MATERIALIZED (
  SELECT word, e, list(struct_pack(start := c.start, logp := p.logp, id := p.id) ORDER BY c.start) AS options
  FROM (SELECT word, e, unnest(range(greatest(0, e - 8), e)) AS start
        FROM (SELECT word, unnest(range(1, len(word) + 1)) AS e FROM distinct_words)) c
  JOIN pieces p ON p.piece = substr(c.word, c.start::INTEGER + 1, (c.e - c.start)::INTEGER) GROUP BY word, e),
steps AS (
  SELECT word, 0::BIGINT AS e, [0.0::DOUBLE] AS best, [[]::INTEGER[]] AS codes FROM distinct_words
  UNION ALL
  SELECT word, e, list_append(best, sums[pick]),
         list_append(codes, list_append(codes[options[pick].start + 1], options[pick].id))
  FROM (SELECT *, list_position(sums, list_max(sums)) AS pick
        FROM (SELECT s.word, c.e, s.best, s.codes, c.options,
                     list_transform(c.options, lambda o: s.best[o.start + 1] + o.logp) AS sums
              FROM steps s JOIN cuts c ON s.word = c.word AND c.e = s.e + 1))),
coded AS (SELECT word, codes[-1] AS ids FROM steps WHERE e = len(word)),
c AS (
  SELECT doc_id, flatten(list(ids ORDER BY pos))[1:1023] AS ids
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT doc_id, ({words('text')})[1:1023] AS w FROM documents)) JOIN coded USING (word) GROUP BY doc_id),
filled AS (SELECT d.doc_id, coalesce(c.ids, []) AS ids FROM documents d LEFT JOIN c USING (doc_id))
SELECT doc_id, {md5_list(padded('ids', 1024))} AS input_ids_md5, 1024::BIGINT AS input_ids_size,
  {md5_list(mask('ids', 1024))} AS attention_mask_md5, 1024::BIGINT AS attention_mask_size,
  (len(ids) + 1)::BIGINT AS n_real FROM filled
"""

# Union LCS: fill the table of every (reference line, hypothesis line) pair row by row, walk
# back from its corner, then count the covered reference words.
ROUGE_LSUM = f"""
WITH RECURSIVE pairs AS ({PAIRS_CONV}),
preds AS (SELECT id, summary AS reference, array_to_string(({sents('dialogue')})[1:{TOP_SENTENCES}], {NL}) AS prediction FROM pairs),
ref AS (SELECT id, i, {words('line')} AS r FROM (
  SELECT id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT id, string_split(reference, {NL}) AS l FROM preds))),
hyp AS (SELECT id, k, {words('line')} AS h FROM (
  SELECT id, unnest(l) AS line, generate_subscripts(l, 1) AS k FROM (SELECT id, string_split(prediction, {NL}) AS l FROM preds))),
steps AS (
  SELECT id, i, k, r, h, 0 AS j, d, [d] AS rows
  FROM (SELECT *, list_transform(range(len(r) + 1), lambda x: 0) AS d FROM ref JOIN hyp USING (id) WHERE len(r) > 0 AND len(h) > 0)
  UNION ALL
  SELECT id, i, k, r, h, j + 1, e, list_append(rows, e) FROM (SELECT *, {LCS_STEP} AS e FROM steps WHERE j < len(h))),
walk AS (
  SELECT id, i, k, r, h, rows, len(r) AS x, len(h) AS y, []::BIGINT[] AS found FROM steps WHERE j = len(h)
  UNION ALL
  SELECT id, i, k, r, h, rows, CASE WHEN r[x] = h[y] OR NOT left_is_better THEN x - 1 ELSE x END,
         CASE WHEN r[x] = h[y] OR left_is_better THEN y - 1 ELSE y END,
         CASE WHEN r[x] = h[y] THEN list_append(found, x) ELSE found END
  FROM (SELECT *, rows[y][x + 1] > rows[y + 1][x] AS left_is_better FROM walk WHERE x > 0 AND y > 0)),
covered AS (SELECT DISTINCT id, i, unnest(found) AS x FROM walk WHERE x = 0 OR y = 0),
hits AS (
  SELECT id, sum(least(a.n, b.n)) AS m
  FROM (SELECT id, r[x] AS word, count(*) AS n FROM covered JOIN ref USING (id, i) GROUP BY ALL) a
  JOIN (SELECT id, word, count(*) AS n FROM (SELECT id, unnest(h) AS word FROM hyp) GROUP BY ALL) b USING (id, word) GROUP BY id),
scored AS (
  SELECT id, coalesce(m, 0)::DOUBLE AS m, len({words('prediction')}) AS a, len({words('reference')}) AS b
  FROM preds LEFT JOIN hits USING (id))
{rouge_rows("SELECT id, CASE WHEN m = 0 THEN 0 ELSE m / a END AS p, CASE WHEN m = 0 THEN 0 ELSE m / b END AS r, CASE WHEN m = 0 THEN 0 ELSE 2 * m / (a + b) END AS f FROM scored")}
"""

ORACLE: dict[str, str] = {
    "textrank": f"WITH RECURSIVE {textrank('documents', 'doc_id', 'text')} SELECT doc_id, prediction FROM ranked",
    "encode_unigram": UNIGRAM,
    "encode_unigram_join": UNIGRAM,
    "rougeLsum": ROUGE_LSUM,
    "select_pair_columns": "SELECT doc_id::VARCHAR AS id, text AS dialogue, source AS summary FROM documents",
    "assemble_dialogue": f"""
        SELECT conv_id::VARCHAR AS id, string_agg(role || ': ' || text, {NL} ORDER BY turn) AS dialogue,
               count(*) AS n_turns FROM conversations GROUP BY conv_id""",
    "make_pairs_conv": PAIRS_CONV,
    "make_pairs_docs": PAIRS_DOCS,
    "na_normalise": NORMALISED,
    "valid_pairs": f"SELECT * FROM ({NORMALISED}) WHERE length(trim(text)) > 0",
    "validate_pairs": """
        WITH g AS (SELECT md5(text) AS id, CASE WHEN n_chars >= 100 THEN text END AS dialogue,
                          CASE WHEN lang = 'es' THEN '  ' ELSE text END AS summary FROM documents)
        SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE length(trim(dialogue)) > 0 AND length(trim(summary)) > 0) AS n_valid,
          count(*) FILTER (WHERE dialogue IS NULL) AS null_dialogue,
          count(*) FILTER (WHERE trim(dialogue) = '') AS blank_dialogue,
          count(*) FILTER (WHERE summary IS NULL) AS null_summary,
          count(*) FILTER (WHERE trim(summary) = '') AS blank_summary,
          count(DISTINCT id) AS n_ids, count(id) - count(DISTINCT id) AS n_duplicate_rows FROM g""",
    "schema_check": """
        WITH t AS (SELECT count(*) AS n, count(*) - count(doc_id) AS a, count(*) - count(text) AS b,
          count(*) - count(lang) AS c, count(*) - count(source) AS d, count(*) - count(n_chars) AS e,
          count(*) FILTER (WHERE source IS NOT NULL AND try_cast(source AS INTEGER) IS NULL) AS lost FROM documents)
        SELECT 'doc_id' AS column_name, 'bigint' AS expected, 'bigint' AS actual, TRUE AS ok, n AS n_rows, a AS n_null,
               NULL::BIGINT AS n_not_castable FROM t
        UNION ALL SELECT 'text', 'string', 'string', TRUE, n, b, NULL FROM t
        UNION ALL SELECT 'lang', 'string', 'string', TRUE, n, c, NULL FROM t
        UNION ALL SELECT 'source', 'int', 'string', FALSE, n, d, lost FROM t
        UNION ALL SELECT 'n_chars', 'string', 'bigint', FALSE, n, e, 0 FROM t
        UNION ALL SELECT 'title', 'string', NULL, FALSE, n, NULL, NULL FROM t""",
    "source_manifest": f"""
        SELECT url, count(*) AS n_sources FROM (
          SELECT CASE WHEN contains(url, 'github.com') AND contains(url, '/blob/')
                      THEN replace(url, '/blob/', '/raw/') ELSE url END AS url FROM ({ADDRESSES})) GROUP BY url""",
    "uri_parse": rf"""
        SELECT page_id, url, CASE WHEN ok THEN regexp_extract(url, '^s3://([^/]*)/([\s\S]*)$', 1) END AS bucket,
               CASE WHEN ok THEN regexp_extract(url, '^s3://([^/]*)/([\s\S]*)$', 2) END AS key, ok AS is_valid
        FROM (SELECT *, regexp_matches(url, '^s3://[^/]*/') AS ok FROM ({ADDRESSES}))""",
    "split_exact": f"SELECT doc_id, split FROM ({SPLIT_DOCS})",
    "split_hash": hash_split("documents", "doc_id"),
    "split_stratified": f"SELECT doc_id, lang, split FROM ({ranked_split('documents', 'doc_id', 'lang')})",
    "shuffle_rank": f"SELECT doc_id, row_number() OVER (ORDER BY {key('doc_id')}, doc_id) AS rank FROM documents",
    "split_manifest": f"""
        SELECT coalesce(split, 'total') AS split, count(*) AS num_examples,
          sum(strlen(text) + strlen(doc_id::VARCHAR))::BIGINT AS num_bytes,
          (sum(('0x' || substr(md5(doc_id::VARCHAR || chr(31) || text), 1, 15))::BIGINT::HUGEINT) % 1152921504606846976)::BIGINT AS fingerprint
        FROM ({SPLIT_DOCS}) GROUP BY ROLLUP (split)""",
    "word_tokens": f"""
        SELECT doc_id, len(w)::BIGINT AS n_tokens, {md5_list('w')} AS tokens_md5
        FROM (SELECT doc_id, {words('text')} AS w FROM documents)""",
    "vocab_top": VOCAB_SQL,
    "encode_inputs": f"""
        WITH vocab AS ({VOCAB_SQL}), c AS ({coded('documents', 'doc_id', 'text', 1024)})
        SELECT doc_id, {md5_list(padded('ids', 1024))} AS input_ids_md5, 1024::BIGINT AS input_ids_size,
          {md5_list(mask('ids', 1024))} AS attention_mask_md5, 1024::BIGINT AS attention_mask_size,
          (len(ids) + 1)::BIGINT AS n_real FROM c""",
    "encode_labels": f"""
        WITH vocab AS ({VOCAB_SQL}), c AS ({coded('documents', 'doc_id', 'text', 128)})
        SELECT doc_id, {md5_list(padded('ids', 128))} AS labels_md5,
               {md5_list(padded('ids', 128, -100))} AS ignored_pad_md5 FROM c""",
    "encode_join": f"""
        WITH vocab AS ({VOCAB_SQL}), c AS ({coded('documents', 'doc_id', 'text', 1024)})
        SELECT doc_id, {md5_list(padded('ids', 1024))} AS input_ids_md5 FROM c""",
    "feature_table_join": f"""
        WITH vocab AS ({VOCAB_SQL}), i AS ({coded('documents', 'doc_id', 'text', 1024)}),
        o AS (SELECT doc_id, ids AS out FROM ({coded('documents', 'doc_id', 'text', 128)}))
        SELECT CASE WHEN substr(md5(doc_id::VARCHAR), 1, 1) <> '0' THEN (doc_id % 20)::VARCHAR END AS id, doc_id,
          {md5_list(padded('ids', 1024))} AS input_ids_md5, 1024::BIGINT AS input_ids_size,
          {md5_list(mask('ids', 1024))} AS attention_mask_md5, 1024::BIGINT AS attention_mask_size,
          {md5_list(padded('out', 128))} AS labels_md5, 128::BIGINT AS labels_size, (len(ids) + 1)::BIGINT AS n_real
        FROM i JOIN o USING (doc_id)""",
    "feature_table": FEATURES.replace("{split}", f"SELECT id, split FROM ({ranked_split('pairs', 'id')})"),
    "stream_features": FEATURES.replace("{split}", hash_split("pairs", "id")),
    "piece_vocab": PIECES_SQL,
    "length_profile": f"""
        SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE n > 1023) AS n_cut, max(n)::BIGINT AS max_tokens,
          round(quantile_cont(n, 0.5)::DOUBLE, 6) AS p50, round(quantile_cont(n, 0.95)::DOUBLE, 6) AS p95,
          round(quantile_cont(n, 0.99)::DOUBLE, 6) AS p99
        FROM (SELECT split, len({words('text')}) AS n FROM ({SPLIT_DOCS})) GROUP BY split""",
    "collate_batches": f"""
        WITH pairs AS ({PAIRS_DOCS}), vocab AS ({VOCAB_SQL}),
        inputs AS ({coded('pairs', 'id', 'dialogue', 1024)}), targets AS ({coded('pairs', 'id', 'summary', 128)}),
        parted AS (SELECT id, split FROM ({ranked_split('pairs', 'id')})),
        placed AS (SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY {key('id')}, id) AS rnk FROM parted),
        grouped AS (SELECT split, ((rnk - 1) // 2)::BIGINT AS batch, list(id ORDER BY rnk) AS ids,
            list(list_concat(i.ids, [1]) ORDER BY rnk) AS ins, list(list_concat(o.ids, [1]) ORDER BY rnk) AS outs
          FROM placed JOIN inputs i USING (id) JOIN targets o USING (id) GROUP BY ALL)
        SELECT split, batch, array_to_string(ids, ',') AS ids, {rows_md5('ins', '0')} AS input_ids_md5,
          {rows_md5(ONES, '0')} AS attention_mask_md5, {rows_md5('outs', '-100')} AS labels_md5 FROM grouped""",
    "map_batched": f"""
        SELECT doc_id, length(text)::BIGINT AS n_chars, len(string_split(text, {NL}))::BIGINT AS n_lines FROM documents""",
    "batch_infer": "SELECT doc_id, string_split(text, ' ')[1] || ' ' || len(string_split(text, ' ')) || ' ' || string_split(text, ' ')[-1] AS prediction FROM documents",
    "lead_k": f"SELECT doc_id, {LEAD} AS prediction FROM (SELECT doc_id, {sents('text')} AS s FROM documents)",
    "tfidf_extract": tfidf("documents", "doc_id", "text"),
    "tfidf_extract_join": tfidf("documents", "doc_id", "text"),
    "rouge1": f"{ROWS_WHOLE}, toks AS ({TOKENISED}) {rouge_rows(rouge(1))}",
    "rouge2": f"{ROWS_WHOLE}, toks AS ({TOKENISED}) {rouge_rows(rouge(2))}",
    "rougeL": ROUGE_L,
    "meteor_exact": f"{ROWS_LEAD}, toks AS ({TOKENISED}) SELECT id, round(meteor::DOUBLE, 6) AS meteor FROM ({METEOR})",
    "bleu_corpus": f"""{ROWS_WHOLE}, btoks AS ({BLEU_TOKENISED})
        SELECT * EXCLUDE (model) REPLACE (round(bleu::DOUBLE, 6) AS bleu) FROM ({BLEU})""",
    "evaluation_report": REPORT,
    "evaluation_report_full": FULL_REPORT,
    "leaderboard": f"""
        SELECT model, metric, value, rank() OVER (PARTITION BY metric ORDER BY value DESC)::INTEGER AS rank
        FROM ({REPORT})""",
    "array_roundtrip": """
        SELECT vec_id, len(embedding)::BIGINT AS dim,
          round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings""",
    "npy_scan": """
        SELECT vec_id, len(embedding)::BIGINT AS dim,
          round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS sum FROM embeddings""",
    "npy_ranges": """
        SELECT vec_id, len(embedding)::BIGINT AS dim,
          round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS sum FROM embeddings""",
    "csv_roundtrip": """
        SELECT doc_id, text, len(string_split(text, ' '))::BIGINT AS n_words FROM documents""",
    "csv_columns_by_name": "SELECT doc_id, text FROM documents",
    "csv_split_large": """
SELECT doc_id, md5('"' || text || '"' || chr(10) || lang) AS text_md5, length(text) + length(lang) + 3 AS n_chars FROM documents
""",
    "ingest_twice": """
        SELECT CASE WHEN lang = 'en' THEN 1 ELSE 2 END::INTEGER AS run, count(*) AS n_rows,
          sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY ALL""",
    "split_dataset_alias": f"""
        SELECT doc_id, split, md5(text) AS text_md5 FROM ({SPLIT_DOCS}) WHERE split = 'val'""",
    "zip_ingest": "SELECT doc_id, text FROM documents",
    "zip_files_scan": "SELECT doc_id, md5(text) AS text_md5, count(*) OVER () AS n_landed FROM documents",
    "split_dataset_scan": f"""
        SELECT doc_id, split, md5(text) AS text_md5 FROM ({SPLIT_DOCS}) WHERE split IN ('val', 'test')""",
    "incremental_scan": """
        SELECT lang, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM documents
        WHERE lang NOT IN ('de', 'fr') GROUP BY lang""",
    "sync_plan": """
        SELECT lang, CASE lang WHEN 'de' THEN 'copy' WHEN 'en' THEN 'replace' ELSE 'same' END AS action,
               'backup/lang=' || lang AS folder FROM (SELECT DISTINCT lang FROM documents)
        UNION ALL SELECT lang, 'extra', 'backup/withdrawn/lang=' || lang FROM (SELECT DISTINCT lang FROM documents)""",
    "sync_content": """
        SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 'same' WHEN 1 THEN 'replace' WHEN 2 THEN 'duplicate' ELSE 'copy' END AS action,
          vec_id % 4 = 2 AS renamed FROM embeddings
        UNION ALL SELECT -1 - vec_id, 'extra', FALSE FROM embeddings WHERE vec_id % 4 = 2""",
    "multi_sink_manifest": f"""
        SELECT 'data_transformation' AS stage, 'splits' AS artifact, target, written, split, n_rows
        FROM (SELECT split, count(*) AS n_rows FROM ({SPLIT_DOCS}) GROUP BY split)
        CROSS JOIN (SELECT unnest(['parquet', 'csv']) AS target, TRUE AS written)
        UNION ALL SELECT 'data_transformation', 'splits', 'backup', FALSE, NULL, NULL""",
    "multi_sink_commit": """
        SELECT doc_id, md5(text) AS text_md5, lang, unnest(['parquet', 'csv']) AS target, 'v2' AS version FROM documents""",
    "vocab_incremental": f"""
        SELECT word, v.count, docs, id FROM ({VOCAB_SQL}) v JOIN (
          SELECT word, count(*) AS docs FROM (SELECT unnest(list_distinct({words('text')})) AS word FROM documents) GROUP BY word
        ) USING (word)""",
    "stream_targets": """
        SELECT doc_id, md5(text) AS text_md5, unnest(['parquet', 'csv']) AS target FROM documents WHERE doc_id % 10 <> 0
        UNION ALL SELECT doc_id, NULL, 'quarantine' FROM documents WHERE doc_id % 10 = 0""",
    "meteor_whole": f"{ROWS_WHOLE}, toks AS ({TOKENISED}) SELECT id, round(meteor::DOUBLE, 6) AS meteor FROM ({METEOR})",
    "meteor_synonyms": f"{ROWS_WHOLE}, toks AS ({TOKENISED}) SELECT id, round(meteor::DOUBLE, 6) AS meteor FROM ({METEOR_SYNONYMS})",
    "evaluation_whole": f"{ROWS_WHOLE}, toks AS ({TOKENISED}), btoks AS ({BLEU_TOKENISED}) {REPORT_ROWS}",
    "report_roundtrip": f"""
        SELECT coalesce(split, 'total') AS split, unnest(['num_examples', 'num_bytes']) AS metric,
               unnest([count(*), sum(strlen(text))::BIGINT]) AS value
        FROM ({SPLIT_DOCS}) GROUP BY ROLLUP (split)""",
    "stream_ingest": "SELECT doc_id, text FROM documents",
}
