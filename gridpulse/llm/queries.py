"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm import (
    batched_bpe,
    binary_packing,
    byte_cnn,
    collocations,
    divergence,
    feast,
    jaccard_tiles,
    oneperm,
    pii,
    ppm,
    quality_net,
    site_tree,
    zip_warc,
)
from gridpulse.llm.common import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DUPLICATES = jaccard_tiles.Rule(width=3, num=90, den=100)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.extract(pages(spark, sf_dir))


def op2_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_packing.pack(documents(spark, sf_dir), BYTE_BPE)


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(documents(spark, sf_dir))


def op4_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir)).drop("char_distance", "word_distance", "word_limit")


def op5_oneperm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oneperm.compare_edits(documents(spark, sf_dir))


def op6_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = quality_net.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_net.score_quality(docs, net).select("doc_id", quality_net.held_out().alias("held_out"), "score", "predicted")


def op7_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.jaccard_components(documents(spark, sf_dir), DUPLICATES)


def op8_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched_bpe.round_trip(documents(spark, sf_dir), WORD_BPE)


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.round_trip(pages(spark, sf_dir))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = byte_cnn.fit(docs.where(~byte_cnn.held_out()))
    return byte_cnn.identify(docs, net).select("doc_id", byte_cnn.held_out().alias("held_out"), "lang_pred", "score")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op12_feast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_site_tree,
        op2_binary_packing,
        op3_ppm,
        op4_divergence,
        op5_oneperm,
        op6_quality_net,
        op7_jaccard_tiles,
        op8_batched_bpe,
        op9_zip_warc,
        op10_byte_cnn,
        op11_pii,
        op12_feast,
        op13_collocations,
    )
    return {f.__name__: f for f in found}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP7_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^ \\t-\\r]+') AS w FROM documents
), grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS g
  FROM words
), sizes AS (SELECT doc_id, len(g) AS n FROM grams),
flat AS (SELECT doc_id, unnest(g) AS gram FROM grams),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM flat a JOIN flat b ON a.gram = b.gram AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS seen FROM sizes UNION SELECT r.doc_id, l.b FROM reached r JOIN pairs l ON l.a = r.seen)
SELECT s.doc_id, s.n AS n_shingles, min(r.seen) AS component_id
FROM sizes s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(h, 1 + (i // 4) * 5, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

D = divergence
OP4_SQL = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, t, regexp_extract_all(t, '[^ \\t-\\r]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls
  FROM d
), grams AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM grams),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM again WHERE times > 1) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) AS n_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    length(t) - length(regexp_replace(t, '[0-9.,;:!?''"()-]', '', 'g')) AS n_marks,
    list_transform(list_filter(ws, lambda x: strlen(x) <= {D.COMMON_BYTES}), lambda x: lower(x)) AS short
  FROM w LEFT JOIN covered USING (doc_id)
), k AS (
  SELECT *, [n_chars - word_chars, n_upper, n_marks, n_symbols, word_chars - n_upper - n_marks - n_symbols] AS classes FROM c
), large AS (
  SELECT lang FROM k WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {D.LEAST_REFERENCE_WORDS}
), parts AS (
  SELECT k.*, lang AS ref FROM k WHERE lang IN (SELECT lang FROM large) UNION ALL SELECT k.*, NULL AS ref FROM k
), chars AS (
  SELECT ref, i, sum(v) / sum(sum(v)) OVER (PARTITION BY ref) AS q
  FROM (SELECT ref, unnest(classes) AS v, unnest(range(1, 6)) AS i FROM parts) GROUP BY ref, i
), counts AS (SELECT ref, word, count(*) AS n FROM (SELECT ref, unnest(short) AS word FROM parts) GROUP BY ref, word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY n DESC, word) AS i FROM counts),
totals AS (SELECT ref, sum(n_words) AS n FROM parts GROUP BY ref),
common AS (
  SELECT r.ref, r.word, r.n / t.n AS q FROM ranked r JOIN totals t ON r.ref IS NOT DISTINCT FROM t.ref WHERE i <= {D.COMMON_WORDS}
), own AS (SELECT *, CASE WHEN lang IN (SELECT lang FROM large) THEN lang END AS ref FROM k),
char_terms AS (
  SELECT o.doc_id, v / n_chars AS p, q
  FROM (SELECT doc_id, ref, n_chars, unnest(classes) AS v, unnest(range(1, 6)) AS i FROM own WHERE n_chars > 0) o
  JOIN chars c ON c.i = o.i AND c.ref IS NOT DISTINCT FROM o.ref
), found AS (SELECT doc_id, word, count(*) AS v FROM (SELECT doc_id, unnest(short) AS word FROM own) GROUP BY doc_id, word),
bins AS (
  SELECT o.doc_id, o.n_words, c.q, coalesce(f.v, 0) AS v FROM own o JOIN common c ON c.ref IS NOT DISTINCT FROM o.ref
  LEFT JOIN found f ON f.doc_id = o.doc_id AND f.word = c.word WHERE o.n_words > 0
), word_terms AS (
  SELECT doc_id, v / n_words AS p, q FROM bins
  UNION ALL SELECT doc_id, (n_words - sum(v)) / n_words, 1 - sum(q) FROM bins GROUP BY doc_id, n_words
), distances AS (
  SELECT kind, doc_id, sqrt(greatest(0, sum(
    ((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2))) AS js
  FROM (SELECT 'c' AS kind, * FROM char_terms UNION ALL SELECT 'w', * FROM word_terms) GROUP BY kind, doc_id
), bare_terms AS (
  SELECT ref, 0 AS p, q FROM common UNION ALL SELECT ref, 1, 1 - sum(q) FROM common GROUP BY ref
), bare AS (
  SELECT ref, sqrt(greatest(0, sum(
    ((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2))) AS far
  FROM bare_terms GROUP BY ref
), steps AS (
  SELECT ref, CAST(ceil(greatest(0, js - {D.NOISE} * sqrt({D.COMMON_WORDS + 1} / (8 * n_words))) * {D.STEPS}) AS BIGINT) AS step
  FROM own JOIN distances USING (doc_id) WHERE kind = 'w' AND n_words >= {D.LEAST_WORDS}
), medians AS (
  SELECT ref, min(step) AS step FROM (
    SELECT ref, step, sum(count(*)) OVER (PARTITION BY ref ORDER BY step) AS below, sum(count(*)) OVER (PARTITION BY ref) AS n
    FROM steps GROUP BY ref, step) WHERE 2 * below >= n GROUP BY ref
), limits AS (
  SELECT m.ref, least(greatest(step / {D.STEPS} * CAST({D.WORD_SPREAD} AS DOUBLE), {D.WORD_LEAST}), far * {D.WORD_SHARE}) AS most
  FROM medians m JOIN bare b ON b.ref IS NOT DISTINCT FROM m.ref
), judged AS (
  SELECT o.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_chars < {D.LEAST_CHARS} OR coalesce(c.js <= {D.CHAR_LIMIT} + {D.NOISE} * sqrt({len(D.CLASSES)} / (8 * n_chars)), true) AS char_ok,
    n_words < {D.LEAST_WORDS} OR coalesce(x.js <= l.most + {D.NOISE} * sqrt({D.COMMON_WORDS + 1} / (8 * n_words)), true) AS word_ok
  FROM own o LEFT JOIN distances c ON c.kind = 'c' AND c.doc_id = o.doc_id LEFT JOIN distances x ON x.kind = 'w' AND x.doc_id = o.doc_id
  LEFT JOIN limits l ON l.ref IS NOT DISTINCT FROM o.ref
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND char_ok AND word_ok AS kept
FROM judged
"""


P = pii
PII_PATTERNS = {"email": P.EMAIL, "ip": P.IP, "card": P.CARD, "phone": P.PHONE, "national": P.NATIONAL, "iban": P.IBAN, "ssn": P.SSN}


def spots_sql(source: str, text: str, pattern: str, kind: str) -> str:
    """Matches of a pattern with their places and neighbours, from what lies between them."""
    split = f"SELECT *, regexp_split_to_array({text}, '{pattern}') AS gaps, regexp_extract_all({text}, '{pattern}', 0) AS ms FROM {source}"
    some = f"SELECT * FROM ({split}) WHERE len(ms) > 0"
    return f"""SELECT * EXCLUDE (gaps, ms), '{kind}' AS kind, ms[i] AS m, gaps[i] AS gap, gaps[i + 1] AS gap_after,
    list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) AS pos
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM ({some}))"""


def luhn_sql(d: str) -> str:
    return f"""length({d}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({d}) + 1), lambda i:
      CAST(CASE WHEN i % 2 = 0 THEN translate(reverse({d})[i], '0123456789', '0246813579') ELSE reverse({d})[i] END AS INT))) % 10 = 0"""


def points_sql(kind: str, least: int) -> str:
    """Points of spans of a kind from their form and the words in ``near``."""
    said = lambda words, n: f"CASE WHEN regexp_matches(near, '(?:^|[^a-z])(?:{words})(?:[^a-z]|$)') THEN {n} ELSE 0 END"
    n = P.WORD_POINTS[kind]
    made = f"{least} + {said(P.FOR[kind], n)}"
    return f"{made} - {said(P.AGAINST[kind], n)}" if kind in P.AGAINST else made


CARD_POINTS = f"{points_sql('card', P.POINTS['card'])} + CASE WHEN regexp_matches(digits, '{P.ISSUER}') THEN {P.ISSUER_POINTS} ELSE 0 END"
IBAN_LENGTHS = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in P.IBAN_LENGTH.items()) + "}"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(spots_sql("d", "t", p.plain, kind) for kind, p in PII_PATTERNS.items())}),
spots AS (
  SELECT r, kind, m, CAST(pos AS INT) AS pos, right(gap, 1) AS lead_char, regexp_replace(m, '[^0-9]+', '', 'g') AS digits,
    translate(concat(right(gap, {P.BEFORE}), ' ', left(gap_after, {P.AFTER})), '{UPPER}', '{LOWER}') AS near FROM raw
), checked AS (SELECT *, {luhn_sql("digits")} AS real FROM spots WHERE kind = 'card'),
runs AS (SELECT r, m AS run, pos AS run_pos, near AS run_near FROM checked WHERE NOT real),
inner_spots AS ({spots_sql("runs", "run", P.GROUP.plain, "card")}),
groups AS (SELECT r, m, CAST(run_pos + pos AS INT) AS pos, run_near AS near, m AS digits FROM inner_spots WHERE {luhn_sql("m")}),
heads AS (SELECT *, left(m, {P.MOST_CODES + 1}) AS head, {IBAN_LENGTHS}[left(m, 2)] AS size FROM spots WHERE kind = 'iban' AND length(m) >= 15),
ended AS (
  SELECT *, list_filter(range(15, least({P.MOST_CODES}, length(head)) + 1), lambda n: length(replace(left(head, n), ' ', '')) = size)[1] AS n FROM heads
), accounts AS (
  SELECT *, left(head, n) AS whole, replace(substr(replace(left(head, n), ' ', ''), 5) || left(head, 4), ' ', '') AS turned
  FROM ended WHERE n IS NOT NULL AND head[n + 1] IN ('', ' ')
), valid AS (
  SELECT * FROM accounts WHERE list_reduce(list_prepend(0, list_transform(range(1, length(turned) + 1), lambda i: CAST(ascii(turned[i]) AS BIGINT))),
    lambda a, c: CASE WHEN c >= 65 THEN a * 100 + c - 55 ELSE a * 10 + c - 48 END % 97) = 1
), spans AS (
  SELECT r, pos, 0 AS ord, length(m) AS n, kind, {points_sql("email", P.POINTS["email"])} AS score, true AS base FROM spots WHERE kind = 'email'
  UNION ALL SELECT r, pos, 1, length(m), kind, {points_sql("ip", P.POINTS["ip"])}, true FROM spots WHERE kind = 'ip' AND regexp_matches(m, '{P.IP_FORM}')
  UNION ALL SELECT r, pos, 2, length(m), kind, {CARD_POINTS}, true FROM checked WHERE real
  UNION ALL SELECT r, pos, 2, length(m), 'card', {CARD_POINTS}, false FROM groups
  UNION ALL SELECT r, pos, 3, length(m), kind, {points_sql("phone", P.POINTS["phone"])}, true FROM spots WHERE kind = 'phone' AND length(digits) BETWEEN 9 AND 15
  UNION ALL SELECT r, pos, 3, length(m), 'phone', {points_sql("phone", P.NATIONAL_POINTS)}, false FROM spots
    WHERE kind = 'national' AND lead_char <> '+' AND regexp_matches(m, '{P.NATIONAL_FORM}')
  UNION ALL SELECT r, pos, 4, n, kind, {points_sql("iban", P.POINTS["iban"])}, false FROM valid
  UNION ALL SELECT r, pos, 5, length(m), kind, {points_sql("ssn", P.POINTS["ssn"])}, false FROM spots WHERE kind = 'ssn' AND regexp_matches(m, '{P.SSN_FORM}')
), kept AS (SELECT *, concat_ws(':', kind, pos, pos + n) AS span FROM spans WHERE base OR score >= {P.LEAST_SCORE}),
all_of AS (
  SELECT r, count(*) FILTER (base AND ord = 0) AS n_email, count(*) FILTER (base AND ord = 1) AS n_ip, count(*) FILTER (base AND ord = 2) AS n_card,
    count(*) FILTER (base AND ord = 3) AS n_phone, string_agg(span, ',' ORDER BY pos, ord, n) FILTER (base) AS base_spans,
    string_agg(span, ',' ORDER BY pos, ord, n) AS spans, string_agg(CAST(score AS VARCHAR), ',' ORDER BY pos, ord, n) AS scores
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN all_of USING (r)
"""

C = collocations
OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\n-\\r]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
spots AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, {C.LONGEST + 1})) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM spots GROUP BY ALL HAVING count(*) >= {C.LEAST}
), c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut, x.f AS l, y.f AS r,
    CAST(({C.SCALE} * CAST(c.f AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
subs AS (SELECT lang, w, k, f, unnest(range(2, k)) AS width FROM c),
inner_spots AS (SELECT *, unnest(range(1, k - width + 2)) AS i FROM subs),
longer AS (SELECT lang, array_to_string(w[i : i + width - 1], ' ') AS phrase, max(f) AS f FROM inner_spots GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE 100 * coalesce(g.f, 0) < {C.CONTAINED} * a
)
SELECT r.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {C.MOST_RANKED}
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_divergence": OP4_SQL, "op7_jaccard_tiles": OP7_SQL, "op9_zip_warc": OP9_SQL, "op11_pii": OP11_SQL, "op13_collocations": OP13_SQL}
