"""The dealt operators as queries over whole tables, with SQL where it can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmesh.llm import bpe, conversations, decontaminate, language, line_dedup, near_dedup, pii, quality, resample, secrets, sharding, url_filter, warc
from fitmesh.llm.storage import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


WORD_LIST = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORD_LIST.format(text=LOWERED)} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id
      GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
u AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents WHERE doc_id IS NOT NULL
      UNION SELECT u.b, r.reach FROM r JOIN u ON u.a = r.node AND r.reach < u.b),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id, coalesce(s.doc_id = c.component_id, true) AS kept
FROM s LEFT JOIN c ON c.node = s.doc_id
"""


@query("op1_minhash_near_dedup", NEAR_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=4, percent=80)


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=False, digests=True)


def _grams_sql(n: int) -> str:
    return f"""g{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d) t) t),
r{n} AS (SELECT doc_id, count(*) AS words, sum(chars) AS chars FROM p SEMI JOIN (SELECT DISTINCT doc_id AS o, unnest(range(i, i + {n})) AS j FROM g{n} WHERE c > 1) h
  ON h.o = p.doc_id AND h.j = p.i GROUP BY doc_id)"""


QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, text, {WORD_LIST.format(text="coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, i, length(w[i]) AS chars FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) t),
l AS (SELECT doc_id, line, count(*) AS c, any_value(list_sum(list_transform({WORD_LIST.format(text="line")}, lambda x: length(x)))) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) t WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
b AS (SELECT doc_id, sum(c - 1) AS n, sum((c - 1) * chars) AS chars FROM l GROUP BY doc_id),
{", ".join(_grams_sql(n) for n in sorted({*quality.COVERAGE, 8}))},
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(b.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r8.words, 0) AS BIGINT) AS n_repeat_words, coalesce(b.chars, 0) AS line_chars,
  {", ".join(f"coalesce(r{n}.chars, 0) AS c{n}" for n in quality.COVERAGE)}
  FROM d LEFT JOIN b USING (doc_id) {" ".join(f"LEFT JOIN r{n} USING (doc_id)" for n in sorted({*quality.COVERAGE, 8}))}),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (
  line_chars > {quality.LINES}::DOUBLE * word_chars OR n_symbols > {quality.SYMBOLS}::DOUBLE * n_words OR
  {" OR ".join(f"c{n} > {share}::DOUBLE * word_chars" for n, share in quality.COVERAGE.items())}) AS kept FROM f
"""


@query("op8_repetition_quality", QUALITY_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_B32 = " || ".join(f"substr('{warc._BASE32}', CAST((('0x' || substr(sha1(coalesce(html, '')), {10 * k + 1}, 10))::BIGINT >> {s}) & 31 AS INTEGER) + 1, 1)"
                   for k in range(4) for s in range(35, -1, -5))
WARC_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, {_B32} AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM m
"""


@query("op10_warc_index", WARC_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).drop("url", "payload")


LINE_SQL = """
WITH l AS (SELECT doc_id, text, pos, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) t),
n AS (SELECT doc_id, pos, line, len(w) AS words, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS c1 FROM l WHERE len(w) > 0),
s AS (SELECT doc_id, list(line) OVER f AS ls, sum(words) OVER f AS t, min(pos) OVER f AS lo, max(pos) OVER f AS hi FROM n
    WINDOW f AS (PARTITION BY doc_id ORDER BY c1 - words RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL SELECT doc_id, list(line) OVER f, sum(words) OVER f, min(pos) OVER f, max(pos) OVER f FROM n
    WINDOW f AS (PARTITION BY doc_id ORDER BY c1 RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (SELECT *, min((doc_id, lo)) OVER (PARTITION BY ls) AS first FROM s WHERE t >= 50),
x AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM r WHERE first <> (doc_id, lo)),
k AS (SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.pos) AS text, count(*) FILTER (l.real) AS left_lines
  FROM (SELECT doc_id, pos, len(w) > 0 AS real, string_split(text, chr(10))[pos] AS raw FROM l) l LEFT JOIN x USING (doc_id, pos) WHERE x.pos IS NULL OR NOT l.real GROUP BY l.doc_id),
c AS (SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_lines FROM l GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n FROM x JOIN n USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(g.n, 0) = 0 THEN d.text WHEN g.n = c.n_lines THEN '' ELSE k.text END AS text,
  CAST(coalesce(c.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@query("op6_line_winnowing", LINE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"), min_words=50)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("op7_url_equivalence")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url", "html"), RULES)


@query("op9_label_propagation_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents", "doc_id", "text"), shards=40)


@query("op2_language_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labelled = docs.where(~F.coalesce(held_out, F.lit(False))).select(F.col("doc_id").alias("id"), "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), labelled)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "item_id", "score", "n_items", (~F.col("kept")).alias("contaminated"))


@query("op4_semi_markov_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit."""
    data = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {bits}), 4294967295)"


RESAMPLE_SQL = fr"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT unnest(list_filter(string_split_regex({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS f FROM benchmark),
e AS (SELECT doc_id, len(w) AS n, unnest(w) AS f FROM d),
k AS (SELECT f, {_crc32_sql("f")} % 10000 AS bucket FROM (SELECT f FROM e UNION SELECT f FROM b) t),
s AS (SELECT bucket, count(*) AS s FROM e JOIN k USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (f) GROUP BY bucket),
a AS (SELECT (SELECT count(*) FROM e)::DOUBLE AS s, (SELECT count(*) FROM b)::DOUBLE AS t),
g AS (SELECT f, floor(1000 * ln((coalesce(t.t, 0) + 1) * (a.s + 10000) / ((coalesce(s.s, 0) + 1) * (a.t + 10000))))::BIGINT AS gain
  FROM k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket) CROSS JOIN a),
w AS (SELECT doc_id, sum(gain) AS weight FROM e JOIN g USING (f) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(w.weight, 0)::BIGINT AS weight,
  coalesce(w.weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 10 // 100 AS drawn FROM c WHERE n_features >= 20)
SELECT c.*, CASE WHEN r.rank <= r.drawn THEN r.rank END AS rank FROM c LEFT JOIN r USING (doc_id)
"""


@query("op11_importance_resampling", RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return resample.resample(docs, target, longest=1, buckets=10_000, min_words=20, percent=10, seed=2024).drop("n_words")


CONVERSATION_SQL = fr"""
WITH RECURSIVE m AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d FROM conversations),
h AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) FROM m WHERE d <> 0) t),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM h) t),
x AS (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS q, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM o),
z AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (p IS NOT NULL AND p || q NOT IN ('su', 'ua', 'au')) AS illegal
  FROM x GROUP BY conv_id),
step(state, q, nxt) AS (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
front AS (SELECT state AS f, state AS t, '' AS letters, 0 AS cost, []::VARCHAR[] AS turns FROM (VALUES ('-'), ('s'), ('u'), ('a')) v(state)
  UNION ALL SELECT state, nxt, 'I', 5, [CASE q WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM step WHERE q <> 's'),
edit AS (SELECT x.conv_id, x.i, f.f, coalesce(s.nxt, f.t) AS t, f.letters || k.letter AS letters,
    f.cost + k.cost + CASE WHEN k.letter <> 'D' AND x.fault = 't' THEN 5 ELSE 0 END AS cost,
    f.turns || CASE k.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [x.role || ':' || x.text] ELSE [CASE s.q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || x.text] END AS turns
  FROM x CROSS JOIN front f CROSS JOIN (VALUES ('D', 2), ('K', 0), ('R', 1)) k(letter, cost)
  LEFT JOIN step s ON s.state = f.t AND ((k.letter = 'K' AND s.q = x.q) OR (k.letter = 'R' AND s.q <> 's'))
  WHERE k.letter = 'D' OR (x.fault NOT IN ('b', 'd') AND s.q IS NOT NULL)),
path AS (SELECT conv_id, 0 AS i, '-' AS state, (0, '', []::VARCHAR[]) AS best FROM z
  UNION ALL SELECT p.conv_id, p.i + 1, e.t, min((p.best[1] + e.cost, p.best[2] || e.letters, p.best[3] || e.turns)) FROM path p
  JOIN edit e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.f = p.state GROUP BY p.conv_id, p.i, e.t),
final AS (SELECT p.conv_id, min((p.best[1] + f.cost, p.best[2] || f.letters, p.best[3] || f.turns)) AS best FROM path p
  JOIN z ON z.conv_id IS NOT DISTINCT FROM p.conv_id AND z.n = p.i JOIN front f ON f.f = p.state AND f.t IN ('-', 'a') GROUP BY p.conv_id)
SELECT c.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0)::BIGINT AS blank, coalesce(z.duplicate, 0)::BIGINT AS duplicate,
  coalesce(z.truncated, 0)::BIGINT AS truncated, coalesce(z.illegal, 0)::BIGINT AS illegal, coalesce(f.best[1], 0)::BIGINT AS cost,
  coalesce(f.best[2], '') AS audit, sha256(coalesce(array_to_string(f.best[3], chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op12_conversation_repair", CONVERSATION_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    rows = conversations.damage(given)
    report = stored(conversations.repair(rows), "repairs")
    digests = conversations.repaired_digests(rows, report)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = report.join(digests.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")), "left").select("conv", *numbers, "audit", "sha256")
    ids = given.select(F.col("conv_id").cast("long")).distinct()
    out = ids.join(found, ids["conv_id"].eqNullSafe(found["conv"]), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _secret_sql(k: int, rule: secrets.Rule) -> str:
    either = lambda m: re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1])
    pattern = "'" + re.sub(r"\(\?i:([^)]*)\)", lambda m: f"(?:{either(m)})", rule.regex).replace("'", "''") + "'"
    part = f"regexp_extract_all(text, {pattern}, {rule.group})"
    return f"""SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS lo,
  length(m[i]) AS n FROM (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, p, string_split_regex(text, {pattern}) AS g
  FROM (SELECT doc_id, text, regexp_extract_all(text, {pattern}) AS m, {part} AS p FROM documents) t WHERE len(m) > 0) t WHERE length(p[i]) >= {rule.at_least}"""


SECRET_SQL = f"""
WITH s AS ({" UNION ALL ".join(_secret_sql(k, r) for k, r in enumerate(secrets.BASE + secrets.ADDED))}),
f AS (SELECT doc_id, {", ".join(f"count(*) FILTER (k = {k}) AS n_{r.kind}" for k, r in enumerate(secrets.BASE))},
  string_agg(kind || ':' || lo::BIGINT || ':' || (lo + n)::BIGINT, ',' ORDER BY lo, k) FILTER (k < {len(secrets.BASE)}) AS base,
  string_agg(kind || ':' || lo::BIGINT || ':' || (lo + n)::BIGINT, ',' ORDER BY lo, k) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(f.n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)},
  sha256(coalesce(f.base, '')) AS base_sha256, coalesce(f.spans, '') AS spans FROM documents d LEFT JOIN f USING (doc_id)
"""


@query("op13_secret_index", SECRET_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    spelled = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("secrets", lambda x: x["kind"].isin(*kinds))
    kinds = [r.kind for r in secrets.BASE]
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
                        F.sha2(spelled(of(*kinds)), 256).alias("base_sha256"), spelled(F.col("secrets")).alias("spans"))
