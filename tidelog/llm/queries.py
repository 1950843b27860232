"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, mixing, neighbours, secrets, simhash, suffix_dedup, tokens_orc, toxicity, url_filter
from .common import table

# The rules of the url query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2)
    model = language.train(docs.where(~F.col("held_out")))
    return language.predict(docs, model, keep=("doc_id", "held_out"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES)


def op4_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_orc.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 9).alias("probability"), "sampled")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_suffix_dedup, op2_language_id, op3_url_filter, op4_token_orc, op5_secret_scan, op6_nearest, op7_decontaminate, op8_simhash, op9_toxicity, op10_mixing)
}

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _op3_sql() -> str:
    rules = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    return f"""
WITH rules(action, rhost, rpath) AS (VALUES {rules}),
parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, {_LOW.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM parts),
fit AS (SELECT page_id, action, rhost || rpath AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS n
        FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.action, 'allow') AS verdict FROM cut c LEFT JOIN fit f ON f.page_id = c.page_id AND f.n = 1"""


def _op7_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS win
         FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, p.n, item FROM places p JOIN wins v ON v.n = p.n AND v.win = p.win),
words_hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY doc_id),
tw AS (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM d),
pick AS (SELECT item, term, row_number() OVER (PARTITION BY item ORDER BY n, term) AS k FROM (SELECT DISTINCT item, unnest(w) AS term FROM b) JOIN (SELECT term, count(*) AS n FROM tw GROUP BY term) USING (term)),
near AS (SELECT x.doc_id, count(DISTINCT p.item) AS n_near FROM pick p JOIN pick q ON q.item = p.item AND p.k = 1 AND q.k = 2 JOIN tw x ON x.term = p.term JOIN tw y ON y.term = q.term AND y.doc_id = x.doc_id AND abs(x.pos - y.pos) <= {decontaminate.NEAR} GROUP BY x.doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)"""


def _op10_sql() -> str:
    has = lambda needles: " OR ".join(f"contains(t, '{n}')" for n in needles)
    topic = "CASE " + " ".join(f"WHEN {has(needles)} THEN '{name}'" for name, needles in mixing.TOPICS) + " ELSE 'prose' END"
    steps = [
        f"""d AS (SELECT doc_id, source, lang, {topic} AS topic, CAST(len(regexp_extract_all(t, '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens
  FROM (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents))""",
        "c AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM d GROUP BY ALL)",
        *(
            f"""a_{x} AS (SELECT {x}, mass, mass / (sum(mass) OVER () * {mixing.RATE}) AS high, pow(CAST(mass AS DOUBLE), {mixing.TEMPERATURE}) AS part FROM (SELECT {x}, sum(tokens) AS mass FROM c GROUP BY ALL) WHERE mass > 0),
l_{x} AS (SELECT *, (1.0 - coalesce(sum(high) OVER (ORDER BY mass RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(part) OVER (ORDER BY mass RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM a_{x}),
m_{x} AS (SELECT {x}, CASE WHEN reached IS NULL THEN high ELSE least(high, reached * part) END AS want_{x} FROM (SELECT *, min_by(level, mass) FILTER (level * part <= high) OVER () AS reached FROM l_{x}))"""
            for x in mixing.DIMENSIONS
        ),
        "r0 AS MATERIALIZED (SELECT c.*, CAST(tokens AS DOUBLE) AS weight, CAST((SELECT sum(tokens) FROM c) AS DOUBLE) AS total, coalesce(want_source, 0) AS want_source, coalesce(want_lang, 0) AS want_lang, coalesce(want_topic, 0) AS want_topic FROM c LEFT JOIN m_source USING (source) LEFT JOIN m_lang USING (lang) LEFT JOIN m_topic USING (topic))",
    ]
    n = 0
    for _ in range(mixing.ROUNDS):
        for x in mixing.DIMENSIONS:
            n += 1
            steps.append(f"r{n} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {x}) > 0 THEN least(tokens / {mixing.RATE}, weight * (want_{x} * total / sum(weight) OVER (PARTITION BY {x}))) ELSE 0 END AS weight) FROM r{n - 1})")
    return (
        "WITH " + ",\n".join(steps) + f""",
p AS (SELECT source, lang, topic, least(1.0, {mixing.RATE} * coalesce(weight / nullif(CAST(tokens AS DOUBLE), 0), 1.0)) AS probability FROM r{n})
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 9) AS probability,
       CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < probability AS sampled
FROM d JOIN p USING (source, lang, topic)"""
    )


def _op5_sql() -> str:
    """Places are counted off the parts between matches. The checksum is worked out bit by bit over the few tokens that have one."""
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api")).replace("[Aa][Pp][Ii]", "[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
    assign = f"({words})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    kinds = [
        ("assign", assign, f"length(regexp_extract(m, '{assign}', 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"), ("hex", "[0-9a-f]+", "length(m) >= 24"),
        ("github", "gh[pousr]_[A-Za-z0-9]{36}", "TRUE"), ("npm", "npm_[A-Za-z0-9]{36}", "TRUE"),
    ]
    found = " UNION ALL ".join(f"SELECT doc_id, row_no, '{k}' AS kind, {n} AS k, string_split_regex(t, '{p}') AS parts, regexp_extract_all(t, '{p}') AS ms, t FROM d" for n, (k, p, _) in enumerate(kinds))
    keep = " OR ".join(f"(kind = '{k}' AND {test})" for k, _, test in kinds[:3])
    digits = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
found AS ({found}),
places AS (SELECT doc_id, row_no, kind, k, t, ms, parts, unnest(range(1, len(ms) + 1)) AS i FROM found),
spans AS (SELECT doc_id, row_no, kind, k, t, ms[i] AS m, CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a FROM places),
checked AS (SELECT *, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, 31), lambda i: CAST(ord(substr(right(m, 36), i, 1)) AS BIGINT))), lambda c, x: list_reduce(list_concat([xor(c, x)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda y, z: xor(y >> 1, CASE WHEN y % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))) AS crc FROM spans WHERE k >= 3 AND NOT regexp_matches(substr(t, a + length(m) + 1, 1), '[A-Za-z0-9]')),
fits AS (SELECT * FROM checked WHERE right(m, 6) = array_to_string(list_transform(range(5, -1, -1), lambda e: substr({digits}, CAST((xor(crc, CAST(4294967295 AS BIGINT)) // CAST(pow(62, e) AS BIGINT)) % 62 + 1 AS BIGINT), 1)), '')),
every AS (SELECT doc_id, row_no, kind, k, a, a + length(m) AS b FROM spans WHERE {keep} UNION ALL SELECT doc_id, row_no, kind, k, a, a + length(m) FROM fits),
told AS (SELECT row_no, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k < 3), '') AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans FROM every GROUP BY row_no)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (row_no)"""


def _op1_sql() -> str:
    """Windows of the texts as hexadecimal, by a 64-bit hash each: the small table that the SQL check reads has 2 million."""
    return """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)),
least_of AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM w JOIN least_of USING (s) WHERE first_id < doc_id),
stepped AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER o <= 50 THEN 0 ELSE 1 END AS starts FROM gone WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (SELECT doc_id, p, sum(starts) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM stepped) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (SELECT g.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


ORACLES: dict[str, str] = {"op1_suffix_dedup": _op1_sql(), "op3_url_filter": _op3_sql(), "op5_secret_scan": _op5_sql(), "op7_decontaminate": _op7_sql(), "op10_mixing": _op10_sql()}
