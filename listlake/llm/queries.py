"""One query per text operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.llm import chat, decontam, langid, mixing, near_dup, quality, repair, repeats, resample, token_store, topk, urls, warc
from listlake.llm.common import saved, table

END_ID = 2
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = token_store.TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


@query
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_output(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


@query
def op3_typed_part_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = F.lit(CONTROL_TEXT)
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"), own.alias("text"))
    return chat.digests(chat.read_chats(saved(chat.format_chats(given.unionByName(added)), "chats")))


ORACLE["op3_typed_part_chat"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, r, '{CONTROL_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(%*)\|', '<\1%|', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op4_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"))


@query
def op6_induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


#: All 100-byte strings as hex digits, told apart by their md5; a string that came before marks its bytes, and marks that touch are one run.
ORACLE["op6_induced_suffix_dedup"] = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM b),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY md5_number(substr(h, 2 * i + 1, 200)) ORDER BY doc_id, i) > 1 AS again FROM s),
m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM f WHERE again),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM m),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER w, 0) AS kept_from, lead(a) OVER w IS NULL AS last FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
kept AS (
  SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || CASE WHEN last THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS k
  FROM gaps JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""


@query
def op7_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


#: All products of the queries with all rows.
ORACLE["op7_block_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


@query
def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


#: Words of whole texts, 2-word shingles, all linked pairs, and the smallest document reachable.
ORACLE["op8_bottom_k_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 2
           THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
         WHEN len(w) = 1 THEN w ELSE [] END AS s FROM w),
n AS (SELECT doc_id, coalesce(len(s), 0) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS v FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.v = b.v AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS r FROM n UNION SELECT two_way.b, reach.r FROM reach JOIN two_way ON two_way.a = reach.a)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id, n.doc_id = min(r) AS kept
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""


@query
def op10_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op10_seekable_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
r AS (SELECT digest, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM d LEFT JOIN r USING (digest)
"""


#: Host, path and verdict of each rule.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


ORACLE["op11_url_rules"] = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
r AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
f AS (
  SELECT p.page_id, p.host, p.path, max(CASE WHEN rules.host IS NOT NULL THEN {{'n': length(rules.host || rules.path), 'rule': rules.host || rules.path, 'verdict': rules.verdict}} END) AS best
  FROM p LEFT JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)
  GROUP BY ALL)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM f
"""

#: The table of crc32, one entry a byte, and the unsigned crc32 of a text's UTF-8 bytes.
CRC_TABLE = """
SELECT list(list_reduce(list_prepend(i, [0, 1, 2, 3, 4, 5, 6, 7]),
  lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entries
FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
"""


def crc32_sql(text: str) -> str:
    """SQL for the crc32 of ``text`` beside a table with ``entries``."""
    digits = f"hex(encode({text}))"
    data = f"list_transform(range(length({digits}) // 2), lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}),"
        f" lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
    )


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_importance_resampling"] = rf"""
WITH e AS MATERIALIZED ({CRC_TABLE}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT row, unnest(w) AS w FROM d), bw AS (SELECT unnest(w) AS w FROM b),
distinct_words AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
words AS MATERIALIZED (SELECT w, {crc32_sql("w")} % 10000 AS bucket FROM distinct_words, e),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN words USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN words USING (w) GROUP BY bucket),
gain AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM dw) + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST((SELECT count(*) FROM bw) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT row, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN words USING (w) JOIN gain USING (bucket) GROUP BY row),
noise AS (
  SELECT row, doc_id, len(w) AS n_features, CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d),
scored AS (
  SELECT row, doc_id, n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (row)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS n,
    count(*) OVER (PARTITION BY n_features >= 20) AS all_able FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN n_features >= 20 AND n <= all_able * 10 // 100 THEN n END AS rank
FROM placed
"""


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


_SPACE = r"[\x20\x09-\x0D]"


def _edits(state: str) -> str:
    """SQL for the cheapest edit of a row in a state of the grammar; ``v`` holds the best of the row behind."""
    after = {"s": {"0": "v.s1"}, "u": {"0": "v.u", "1": "v.u", "a": "v.u"}, "a": {"u": "v.a"}}
    name = {"0": "s0", "1": "s1", "u": "u", "a": "a"}[state]
    rerole = "v.a" if state == "u" else "v.u"
    options = [f"{{'c': 2 + v.{name}.c, 'a': 'D' || v.{name}.a}}"]
    for role, states in after.items():
        if state in states:
            to = states[state]
            options.append(f"CASE WHEN NOT gone AND initial = '{role}' THEN {{'c': extra + {to}.c, 'a': 'K' || {to}.a}} END")
    options.append(f"CASE WHEN NOT gone THEN {{'c': 1 + extra + {rerole}.c, 'a': 'R' || {rerole}.a}} END")
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


ORACLE["op13_conversation_repair"] = rf"""
WITH RECURSIVE e AS MATERIALIZED ({CRC_TABLE}),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
k AS (SELECT c.*, {crc32_sql("name")} % 20 AS k FROM c, e),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM k),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM d),
f AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) || substr(role, 1, 1) AS pair,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?]{_SPACE}*\z') THEN 'truncated' END AS fault,
    coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM n),
g AS (
  SELECT conv_id, count(*) AS rows, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list(role ORDER BY n) AS roles, list(text ORDER BY n) AS texts
  FROM f GROUP BY conv_id),
v AS (
  SELECT conv_id, CAST(rows AS BIGINT) + 1 AS n, {{'c': 0, 'a': ''}} AS s0, {{'c': 10, 'a': 'II'}} AS s1, {{'c': 5, 'a': 'I'}} AS u, {{'c': 0, 'a': ''}} AS a FROM g
  UNION ALL
  SELECT conv_id, n, list_min([s0, {{'c': 5 + u.c, 'a': 'I' || u.a}}]), list_min([s1, {{'c': 5 + u.c, 'a': 'I' || u.a}}]), u, a
  FROM (
    SELECT conv_id, n, s0, s1, list_min([u, {{'c': 5 + a.c, 'a': 'I' || a.a}}]) AS u, list_min([a, {{'c': 5 + u.c, 'a': 'I' || u.a}}]) AS a
    FROM (
      SELECT v.conv_id, f.n, {_edits("0")} AS s0, {_edits("1")} AS s1, {_edits("u")} AS u, {_edits("a")} AS a
      FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.n = v.n - 1))),
best AS (
  SELECT g.*, v.s0.c AS cost, v.s0.a AS audit,
    list_reduce(list_prepend({{'q': 's', 'i': 1, 'out': CAST([] AS VARCHAR[])}}, list_transform(string_split(v.s0.a, ''), lambda m: {{'q': m, 'i': 0, 'out': CAST([] AS VARCHAR[])}})),
      lambda x, m: {{
        'q': CASE m.q WHEN 'D' THEN x.q WHEN 'K' THEN substr(g.roles[x.i], 1, 1) ELSE CASE x.q WHEN 'u' THEN 'a' ELSE 'u' END END,
        'i': x.i + CASE m.q WHEN 'I' THEN 0 ELSE 1 END,
        'out': CASE m.q WHEN 'D' THEN x.out WHEN 'K' THEN list_append(x.out, g.roles[x.i] || ':' || g.texts[x.i])
          ELSE list_append(x.out, CASE x.q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || CASE m.q WHEN 'R' THEN g.texts[x.i] ELSE '' END) END}}).out AS out
  FROM v JOIN g ON v.n = 1 AND g.conv_id IS NOT DISTINCT FROM v.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(CASE WHEN audit = '' THEN '' ELSE array_to_string(out, chr(10)) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
