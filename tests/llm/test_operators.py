"""The corpus operators against brute force on small and awkward tables: nulls, empty and long texts, ties, clashing columns, no rows."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF
from tidelog.llm import decontaminate, language, mixing, near_copies, neighbours, queries, secrets, simhash, suffix_dedup, tokens_orc, toxicity, url_filter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("spans", T.StringType()), ("fp", T.LongType()), ("row", T.LongType()))])


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that every operator must stand, with extra columns that are named like the operators' own."""
    base = "the quick brown fox jumps over the lazy dog while éàü seventeen wizards quietly play chess and drink tea at noon "
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(20_000))
    texts = [base * 3, base * 3, base * 2 + "tail", None, "", " \n\t", "x", "ab cd", long, long + " end", "İstanbul toKen=abcdefg TOKEN = 'zzzzzz' token:short", "aaaa" * 200, "1 2 3\0 4", base * 3]
    rows = [(i if i != 11 else None, t, [None, "en", "fr"][i % 3], ["s", None][i % 2], 1, "x", 2, 3) for i, t in enumerate(texts)]
    rows += [(2, base * 2 + "tail", "en", "s", 1, "x", 2, 3)]  # a repeated row
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


# --- 1


@pytest.mark.parametrize(("n", "letters"), [(1, 2), (9, 1), (40, 2), (600, 3), (900, 256), (500, 1)])
def test_suffix_array_and_prefixes(n, letters):
    data = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    raw, order = data.tobytes(), suffix_dedup.suffix_array(data)
    expected = sorted(range(n), key=lambda i: raw[i:])
    assert order.tolist() == expected
    shared = [0]
    for a, b in zip(expected, expected[1:], strict=False):
        k = 0
        while k < n - max(a, b) and raw[a + k] == raw[b + k]:
            k += 1
        shared.append(k)
    assert suffix_dedup.common_prefixes(data, order).tolist() == shared


def brute_dedup(rows):
    seen, out = {}, []
    for i, text in rows:
        data, key = (text or "").encode(), float("inf") if i is None else i
        for p in range(len(data) - 49):
            w = data[p : p + 50]
            seen[w] = min(seen.get(w, float("inf")), key)
    for i, text in rows:
        data, key = (text or "").encode(), float("inf") if i is None else i
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if seen[data[p : p + 50]] < key:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "run", "frequent"), [(8 << 20, 1 << 20, 20_000), (30_000, 1_500, 1)])
def test_dedup_is_brute_force(odd, monkeypatch, block, run, frequent):
    for name, value in (("BLOCK_BYTES", block), ("RUN_BYTES", run), ("FREQUENT", frequent)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = odd
    found = suffix_dedup.dedup_substrings(rows)
    got = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found.collect()]
    assert sorted(got, key=str) == brute_dedup(pairs(rows))
    assert suffix_dedup.dedup_substrings(odd.limit(0)).count() == 0


# --- 2


def test_language(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = queries.op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 20 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found) and all(0 <= r.score <= 1 for r in found)
    model = language.train(docs)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (12, "und")} <= got
    assert language.train(odd.limit(0)).predict("word") == ("und", 0.0)
    word = next(iter(model.words))  # a known word scores by its own frequencies, an unknown one by its longest known n-grams
    assert (model.word(word) == model.words[word]).all()
    assert (model.word("zzqj") == np.sum([model.grams[n][g] for n in (next(n for n in range(5, 0, -1) if any(g in model.grams[n] for g in language.grams("zzqj", n))),) for g in language.grams("zzqj", n) if g in model.grams[n]], 0)).all()


def brute_language(train, texts):
    """The model of the docstring written again: words, then n-grams of falling size, add-half smoothing."""
    import unicodedata

    def split(text):
        out, inside = [], False
        for c in (text or "").lower():
            letter, mark = c.isalpha(), unicodedata.category(c)[0] == "M"
            if letter and not inside:
                out.append("")
            inside = letter or inside and mark
            if inside:
                out[-1] += c
        return out

    langs = sorted({lang for lang, _ in train})
    counts = {n: {lang: {} for lang in langs} for n in range(6)}
    for lang, text in train:
        for w in split(text):
            for n in range(6):
                for g in [w] if n == 0 else [w] if n == 1 and len(w) == 1 else (lambda p: [p[i : i + n] for i in range(len(p) - n + 1)])(w if n == 1 else f"_{w}_"):
                    counts[n][lang][g] = counts[n][lang].get(g, 0) + 1
    kinds = {n: {g for c in by.values() for g in c} for n, by in counts.items()}
    logs = lambda n, g: [np.log(counts[n][lang].get(g, 0) + 0.5) - np.log(sum(counts[n][lang].values()) + 0.5 * len(kinds[n])) for lang in langs]
    out = []
    for text in texts:
        total, any_letter = np.zeros(len(langs)), False
        for w in split(text):
            any_letter = True
            if w in kinds[0]:
                total += logs(0, w)
                continue
            for n in range(min(5, len(w) + 2), 0, -1):
                padded = f"_{w}_" if n > 1 else w
                known = [g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in kinds[n]]
                if known:
                    total += np.sum([logs(n, g) for g in known], 0)
                    break
        out.append(langs[int(np.argmax(total))] if any_letter else "und")
    return out


def test_language_is_its_description(spark, odd):
    train = [("en", "the cat sat on the mat"), ("de", "die katze sa\u00df auf der matte"), ("fr", "le chat \u00e9tait assis"), ("hi", "\u0939\u093f\u0928\u094d\u0926\u0940 \u092d\u093e\u0937\u093e")] * 2 + [("en", "a hat"), (None, "xyz"), ("fr", None)]
    docs = spark.createDataFrame([(i % 9, lang, text) for i, (lang, text) in enumerate(train)], "doc_id long, lang string, text string")
    model = language.train(docs)
    assert model.langs == ["de", "en", "fr", "hi"] and "\u0939\u093f\u0928\u094d\u0926\u0940" in model.words
    texts = ["the hats", "katzen", "chats \u00e9t\u00e9", "\u00b2 \u00bd \u2460 \u2167 12_", "\u0939\u093f", "zzz", None, "", "\u0130stanbul catatat", "Ma\u00df"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("language_text", F.lit(1))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(asked, model).collect()}
    seen = list(dict.fromkeys((lang, t) for lang, t in train if lang and t))
    assert [got[i][0] for i in range(len(texts))] == brute_language(seen, texts)
    assert all((p == "und") == (s == 0) for p, s in got.values()) and language.predict(asked.limit(0), model).count() == 0
    assert len(language.predict(odd, model).collect()) == odd.count()


def test_language_learns_all_languages_within_its_bound(spark, monkeypatch):
    letters = lambda i: "abcdefghijklmnop"[i // 16] + "abcdefghijklmnop"[i % 16]
    docs = spark.createDataFrame([(i, f"l{i:03d}", f"word{letters(i)} common thing{letters(i)} only{letters(i)}") for i in range(250)], "doc_id long, lang string, text string")
    for cells in (language.CELLS, 6 * 250 * 250 * 3):
        monkeypatch.setattr(language, "CELLS", cells)
        model = language.train(docs)
        assert len(model.langs) == 250 and sum(v.size for _, v in model.tables.values()) <= cells
        assert model.predict("onlyah wordah thingah")[0] == "l007"


def test_held_out_rows_do_not_train(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("text", F.when(held, F.concat(F.lit("qqq "), "text")).otherwise(F.col("text"))).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op2_language_id(spark, str(tmp_path)).collect()
    assert any(r.held_out for r in found) and not any(r.lang_pred == "xx" for r in found)


# --- 3


def test_urls(spark):
    urls = ["http://Example.org/en/12", "http://a.example.org/es/x?q", "http://example.org", "ftp://x.com/fr/", "http://com/de/", "http://b.org/", "http://borg/", "http://example.org/es", None, "no", "http://u@h.com:80/de/", "x://.org/a#b", "http://org?x/", "://ORG/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    for r in url_filter.filter_urls(pages, queries.RULES).collect():
        url = urls[r.page_id]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(LOW)
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h), len(p), h + p, a) for a, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *(max(fits)[2:] if fits else (None, "allow")))
    assert url_filter.filter_urls(pages.limit(0), queries.RULES).count() == 0


# --- 4


def test_tokens_round_trip(spark, odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    more = odd.union(spark.createDataFrame([(50, "it's a\x1c!\x1f? <|endoftext|>x\u00a0y\u0301 ΣΑΣ", None, None, 0, None, 0, 0)], DOCS))
    got = sorted(tokens_orc.encode_documents(more, queries.tokenizer_path()).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == [None] + sorted(i for i in ids if i is not None)
    at, expected = 0, {}
    for i, text in pairs(more):
        data = np.asarray([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.setdefault(i, []).append((len(data), zlib.crc32(data.tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in expected[r.doc_id]
        at += r.n_tokens
    assert tokens_orc.encode_documents(odd.limit(0), queries.tokenizer_path()).count() == 0


def test_encoder_forgets_and_learns_again():
    from tokenizers import Tokenizer

    plain, mine = Tokenizer.from_file(queries.tokenizer_path()), tokens_orc.WordEncoder(queries.tokenizer_path())
    texts = ["don't 'S 'll''re l'\u00e9t\u00e9 o'reilly's \"'s '' x", "a\tb\x0bc\x0cd  e", "caf\u00e9\u00b2 \u00bd a\x1cb <|endoftext|> c", "\u0153uvre \u2013 \u201cq\u201d \u65e5\u672c e\u0301", "", " \n", "\u00c0\u00d6\u00d8\u00f6\u00ff\u00df\u00d7\u00f7", "1a2b 33\x00\x7f\u0085 \u0301x"]
    for size in (1, 3, len(texts)):
        for at in range(0, len(texts), size):
            mine.old, mine.new = mine.new, {"": b""}  # as if the newer generation were full
            for text, ids in zip(texts[at : at + size], mine.encode(pa.array(texts[at : at + size])), strict=True):
                assert np.frombuffer(ids, mine.kind).tolist() == plain.encode(text, add_special_tokens=False).ids


def scanned(frame):
    """(files read, rows that the scan handed on) of a frame over one scan."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame.sparkSession.sparkContext._jvm.org.apache.spark.sql.execution.SparkPlan  # the plan's metrics are filled by this very plan
    plan.executeCollect()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numFiles").value(), leaf.metrics().apply("numOutputRows").value()


def test_reading_some_ids_skips_files_and_row_groups(spark, tmp_path):
    from pyarrow import orc

    docs = spark.range(0, 200_000, 2).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "t")
    tokens_orc.write_tokens(docs.orderBy(F.xxhash64("doc_id")), path, queries.tokenizer_path(), files=4, stripe_bytes=1 << 14)
    files = sorted(tmp_path.glob("t/*.orc"))
    assert len(files) == 4 and all(orc.ORCFile(f).nstripes > 1 for f in files)
    read = tokens_orc.read_tokens(spark, path)
    for found, most in ((read.where("doc_id = 24680"), 1_024), (read.where("doc_id = 24681"), 0), (read.where("doc_id in (2, 199998)"), 2_048)):
        rows = scanned(found.select("doc_id", "n_tokens"))[1]
        assert rows <= most, rows  # row indexes leave one group of 1,000 rows; the odd id is in range but in no Bloom filter
    assert [r.doc_id for r in read.where("doc_id = 24680").collect()] == [24680]
    # Stripes are read one by one, each on its own, and give the file's rows in order.
    one = orc.ORCFile(files[1])
    ids = [i for n in range(one.nstripes) for i in one.read_stripe(n, columns=["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(ids) and len(ids) == one.nrows
    # And Spark deals a file's stripes over tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert tokens_orc.read_tokens(spark, path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- 5


def brute_spans(text):
    text, out = text or "", []
    patterns = [("assign", re.compile(secrets.ASSIGN.pattern, re.I | re.A), lambda m: len(m[2]) >= 6), ("access", secrets.ACCESS, lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    patterns += [("github", secrets.GITHUB, lambda m: secrets.checksum(m[1]) == m[2]), ("npm", secrets.NPM, lambda m: secrets.checksum(m[1]) == m[2])]
    for k, (kind, pattern, fits) in enumerate(patterns):
        out += [(m.start(), k, kind, m.end()) for m in pattern.finditer(text) if fits(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_secrets(spark, odd):
    body = "0123456789abcdefghijABCDEFGHIJ"
    extra = [f"ghp_{body}{secrets.checksum(body)} npm_{body}{secrets.checksum(body)}", f"ghp_{body}AAAAAA", "AKIA" + "Q" * 16 + " AKIA" + "Q" * 15, "f" * 24 + "g" + "0" * 23, "api_key=token=secret: abcdef", "PASSWORD\"  :  'a/b+c=d'", "tokentoken=abcdef token=short token=longer1", "ſecret=abcdef toKen=abcdef"]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")).union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.spans]) for r in secrets.scan_secrets(docs).collect())
    assert got == sorted((str(i), brute_spans(t)) for i, t in pairs(docs)) and sum(bool(s) for _, s in got) > 5
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


# --- 6


def test_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((900, 12)) * rng.uniform(0.5, 2, (900, 1))
    v[200:500] = v[200]  # a third are one vector
    rows = [(i, x.astype(np.float32).tolist(), 0) for i, x in enumerate(v)]
    rows += [(2000, None, 0), (2020, [0.0] * 12, 0), (2040, [float("nan")] * 12, 0), (2060, [None] * 12, 0), (2080, [1.0], 0), (None, [1.0] * 12, 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    monkeypatch.setattr(neighbours, "LEAST_FOUND", 250)
    monkeypatch.setattr(neighbours, "ROWS_A_LIST", 64)
    monkeypatch.setattr(neighbours, "LIST_ROWS", 50)
    found = neighbours.search(vectors, F.col("id") % 20 == 0).collect()
    m, hits = np.asarray([r[1] for r in rows[:900]], np.float32).astype(float), 0
    for q in range(0, 900, 20):
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [g[0] for g in got] == list(range(1, 21)) and all(abs(m[q] @ m[i] - s) < 1e-9 for _, i, s in got)
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        scores = m @ m[q]
        scores[q] = -np.inf
        best = set(np.lexsort((np.arange(900), -scores))[:20].tolist())
        hits += len(best & {i for _, i, _ in got})
    assert {r.query_id for r in found} == set(range(0, 900, 20)) and hits >= 0.9 * 20 * 45
    twice = neighbours.search(vectors.where("vec_id < 30").union(vectors.where("vec_id < 30")), F.col("id") % 20 == 0).collect()
    assert len(twice) == 40 and len({(r.query_id, r.vec_id) for r in twice}) == 40 and all(sorted(r.rank for r in twice if r.query_id == q) == list(range(1, 21)) for q in (0, 20))
    few = neighbours.search(vectors.where("vec_id < 5"), F.col("id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert neighbours.search(vectors.limit(0), F.col("id") % 20 == 0).count() == 0


def test_neighbours_where_most_lists_would_be_skipped(spark, monkeypatch):
    v = np.random.default_rng(8).standard_normal((6_000, 32)).astype(np.float32)  # no structure: neighbours lie in many lists
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(4)
    for name, value in (("LEAST_FOUND", 1), ("ROWS_A_LIST", 16), ("LIST_ROWS", 700)):
        monkeypatch.setattr(neighbours, name, value)
    found = {}
    for r in neighbours.search(vectors, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = v[::20].astype(float) @ v.astype(float).T
    scores[np.arange(300), np.arange(0, 6_000, 20)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len(found[20 * i] & set(row.tolist())) for i, row in enumerate(best))
    assert hits >= 0.95 * 20 * 300 and all(len(f) == 20 for f in found.values())


@pytest.mark.parametrize("clusters", [0, 300])
def test_recall_where_part_of_the_lists_is_probed(spark, monkeypatch, clusters):
    """With the shipped constants; Gaussian vectors, the hardest kind, and clustered ones."""
    rng, n, size = np.random.default_rng(4), 16_000, 48
    v = rng.standard_normal((n, size)).astype(np.float32)
    if clusters:
        v = (rng.standard_normal((clusters, size))[rng.integers(0, clusters, n)] + 0.3 * v).astype(np.float32)
    probed = []
    needed = neighbours.probes_needed
    monkeypatch.setattr(neighbours, "probes_needed", lambda *args: probed.append((needed(*args), len(args[3]))) or probed[-1][0])
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(8)
    found = {}
    for r in neighbours.search(vectors, F.col("id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = v[::100].astype(float) @ v.astype(float).T
    scores[np.arange(n // 100), np.arange(0, n, 100)] = -np.inf
    hits = sum(len(found[100 * i] & set(row.tolist())) for i, row in enumerate(np.argsort(-scores, axis=1)[:, :20]))
    assert hits >= 0.9 * 20 * (n // 100)
    assert max(probed[0][0], neighbours.PROBES) < probed[0][1]  # some lists are skipped


# --- 7


def brute_hits(text, items):
    w, hit, found = words(text), set(), set()
    for item, iw in items:
        n = min(10, len(iw))
        windows = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                found.add(item)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_decontamination(spark, odd, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
    texts = ["quick brown fox jumps over the lazy dog while éàü seventeen wizards", "Tea at Noon", "aaaa x y", None, "...", "w0 w2916", "tea at noon the quick brown fox jumps over the lazy dog while", "x", "fox quietly"]
    bench = spark.createDataFrame([(i * 9, t, "x") for i, t in enumerate(texts)] + [(9, "Tea at Noon", "x"), (9, "play chess", "x"), (None, "lazy dog", "x")], "item_id long, text string, words string")
    items = [(str(i * 9), words(t)) for i, t in enumerate(texts)] + [("9", ["play", "chess"]), ("", ["lazy", "dog"])]
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.n_near) for r in decontaminate.decontaminate(odd, bench).collect())
    rows = pairs(odd)
    of = {}
    for _, t in rows:
        for w in words(t):
            of[w] = of.get(w, 0) + 1
    rare = [sorted({w for i, ws in items if i == item for w in ws if w in of}, key=lambda w: (of[w], w))[:2] for item in {i for i, _ in items}]

    def near(t):
        places = {}
        for n, w in enumerate(words(t)):
            places.setdefault(w, []).append(n)
        return sum(len(two) == 2 and any(abs(p - q) <= decontaminate.NEAR for p in places.get(two[0], ()) for q in places.get(two[1], ())) for two in rare)

    expected = sorted((str(i), *brute_hits(t, items), near(t)) for i, t in rows)
    assert got == expected and any(g[2] for g in got) and any(g[4] for g in got)
    assert decontaminate.decontaminate(odd, bench.limit(0)).where("n_hit + n_near > 0").count() == 0 and decontaminate.decontaminate(odd.limit(0), bench).count() == 0
    kept = decontaminate.drop_contaminated(odd.withColumn("bad_id", F.lit(1)), bench)
    assert kept.columns == [*odd.columns, "bad_id"] and sorted(map(str, pairs(kept))) == sorted(str((i, t)) for i, t in rows if not brute_hits(t, items)[1])


def test_rows_are_judged_by_id_and_text(spark):
    docs = spark.createDataFrame([(None, "tea at noon"), (1, "tea at noon"), (1, "clean"), (None, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "tea at noon")], "item_id long, text string")
    assert sorted(map(str, pairs(decontaminate.drop_contaminated(docs, bench)))) == ["(1, 'clean')", "(None, 'clean')"]


def test_proximity_of_any_terms(spark):
    docs = spark.createDataFrame([(1, "tea x noon y y y y tea"), (2, "noon tea"), (3, "tea")], "doc_id long, text string")
    held, postings = decontaminate.build_index(docs)
    assert sorted(map(tuple, decontaminate.find_near(held, postings, "tea", "noon", 2).collect())) == [(1, 0, 2), (2, 1, 0)]
    assert sorted(map(tuple, decontaminate.find_near(held, postings, "x", "tea", 6).collect())) == [(1, 1, 0), (1, 1, 7)]
    assert postings.count() == 11 and sorted(r.pos for r in postings.where("term = 'y'").collect()) == [3, 4, 5, 6]


# --- 8


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash(odd):
    rows = pairs(odd)
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(fps)
    least = {g: min((i for (i, _), h in zip(rows, groups, strict=True) if h == g and i is not None), default=None) for g in groups}
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(odd).collect())
    assert got == sorted((str(i), f"{f:016x}", str(least[g])) for (i, _), f, g in zip(rows, fps, groups, strict=True))
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_linked_fingerprints_share_a_key():
    rng = np.random.default_rng(9)
    fps = np.concatenate([np.array([0, 2**64 - 1], np.uint64), rng.integers(0, 2**64 - 1, 300, dtype=np.uint64, endpoint=True)])
    for a, b in [(0, 0), (0, 1), *rng.integers(0, 64, (200, 2)).tolist()]:
        other = fps ^ np.uint64((1 << a) | (1 << b))
        sets = []
        for side in (fps, other):
            keys, rows = simhash.pivot_keys(side)
            assert len(set(zip(keys.tolist(), rows.tolist(), strict=True))) == len(keys) <= 39 * len(side)
            sets.append([set(keys[rows == i].tolist()) for i in range(len(side))])
        assert all(x & y for x, y in zip(*sets, strict=True))


@pytest.mark.parametrize("small", [500_000, 0])
def test_links_of_a_dense_ball_and_a_chain(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_GRAPH", small)
    rng = np.random.default_rng(5)
    centre, chain = int(rng.integers(0, 1 << 63)), [int(rng.integers(0, 1 << 63))]
    fps = {centre ^ (1 << a) ^ (1 << b) for a in range(24) for b in range(24)}
    for step in range(31):
        chain.append(chain[-1] ^ (3 << (2 * step)))
    fps = sorted(fps | set(chain) | {int(x) for x in rng.integers(0, 1 << 63, 60)})
    roots = brute_components(fps)
    signed = np.asarray(fps, np.uint64).view(np.int64).tolist()
    links = simhash.link_table(spark.createDataFrame([(f,) for f in signed], "fp long"))
    found = dict(map(tuple, simhash.components(links).collect()))
    label = [found.get(f, f) for f in signed]
    assert len({(a, b) for a, b in zip(roots, label, strict=True)}) == len(set(roots)) == len(set(label))


def brute_near(rows):
    """The smallest id of each id's group under a similarity of 0.8 of five-word sets."""
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
        sets.append((i, {" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)}))
    least = {i: i for i, _ in sets}
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if 5 * len(a & b) >= 4 * len(a | b) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = {k: low if v == high else v for k, v in least.items()}
    return least


def edited(rng, words_of, changes):
    out = list(words_of)
    for at in rng.choice(len(out), changes, replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return " ".join(out)


def test_near_copies(spark, odd):
    rng = np.random.default_rng(11)
    rows, base = [], [f"w{rng.integers(1 << 40)}" for _ in range(300)]
    for n in range(60):  # one large group whose members are seldom similar to its smallest id
        rows.append((int(rng.integers(1 << 40)), edited(rng, base, 1 + n % 12)))
    chain = list(base)
    for _ in range(12):  # and a chain that leaves it step by step
        chain = edited(rng, chain, 6).split(" ")
        rows.append((int(rng.integers(1 << 40)), " ".join(chain)))
    for _ in range(30):
        alone = [f"w{rng.integers(1 << 40)}" for _ in range(80)]
        rows += [(int(rng.integers(1 << 40)), edited(rng, alone, k)) for k in (1, 1, 9)]
    found = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_near(rows)


@pytest.mark.parametrize("group", [200_000, 200])
def test_near_copies_of_odd_rows(odd, monkeypatch, group):
    monkeypatch.setattr(near_copies, "GROUP_SHINGLES", group)
    rows = pairs(odd)
    by_place = brute_near([(n, t) for n, (_, t) in enumerate(rows)])
    order = lambda n: (rows[n][0] is None, rows[n][0], hashlib.md5((rows[n][1] or "").encode()).hexdigest())
    best = {n: min((m for m in by_place if by_place[m] == by_place[n]), key=order) for n in by_place}
    found = near_copies.near_copies(odd).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == sorted((str(rows[n][0]), str(rows[best[n]][0])) for n in best)
    kept = near_copies.keep_representatives(odd.withColumn("near_id", F.lit(1)).withColumn("same", F.lit(2)))
    assert kept.columns == [*odd.columns, "near_id", "same"]
    assert sorted(map(str, pairs(kept))) == sorted(str(rows[n]) for n in set(best.values()))
    assert near_copies.near_copies(odd.limit(0)).count() == near_copies.keep_representatives(odd.limit(0)).count() == 0


def test_near_copies_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(None, text), (None, text), (None, text + " more"), (None, "other words"), (5, "x y"), (5, "z"), (5, "z")], "doc_id long, text string")
    kept = sorted(map(str, pairs(near_copies.keep_representatives(docs))))
    assert kept[:2] == ["(5, 'x y')", "(5, 'z')"] and len(kept) == 4 and "(None, 'other words')" in kept


# --- 9


def test_toxicity(spark, odd):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0)
    chain = toxicity.train(docs, seen)
    assert chain.names == ["low_quality", "toxic"] and len(chain.models[1].weights) == len(chain.models[0].weights) - len(chain.models[0].words) + len(chain.models[1].words) + 1
    held = toxicity.predict(docs, chain).join(labels.withColumnRenamed("toxic", "y"), "doc_id").join(seen.select("doc_id"), "doc_id", "left_anti").collect()
    clean = [r for r in held if not r.y]
    assert sum(r.toxic == bool(r.y) for r in held) >= 0.9 * len(held) and sum(r.toxic for r in clean) <= 0.02 * len(clean)
    got = toxicity.predict(odd, chain).collect()
    assert len(got) == odd.count() and all(0 <= p <= 1 for r in got for p in (r.p_low_quality, r.p_toxic))
    named = lambda t: t.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))  # noqa: E731  ids of another type, labels that repeat
    text_ids = toxicity.train(named(docs.limit(300)), named(labels.union(labels.withColumn("toxic", F.lit(1)))))
    assert toxicity.predict(named(docs.limit(20)), text_ids).count() == 20
    none = toxicity.train(docs, labels.limit(0))
    assert not any(r.toxic for r in toxicity.predict(odd, none).collect())
    assert toxicity.drop_toxic(odd, labels.limit(0)).count() == odd.count() and toxicity.predict(odd.limit(0), chain).count() == 0


def test_toxic_stems_by_language(spark):
    """Held-out recall a language, where toxic words share stems but seldom repeat."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    chain = toxicity.train(docs, labels.where(part != 0))
    held = labels.where(part == 0).join(docs.select("doc_id", "text", "lang"), "doc_id")
    rows = toxicity.predict(held, chain).join(held.select("doc_id", "lang", F.col("toxic").alias("y")), "doc_id").collect()
    for lang in ("en", "fr", "de", "es"):
        bad, clean = ([r.toxic for r in rows if r.lang == lang and r.y == y] for y in (1, 0))
        assert len(bad) >= 5 and sum(bad) >= 0.8 * len(bad) and sum(clean) <= 0.03 * len(clean), lang


# --- 10


def water_filled(mass, rate):
    """Tempered shares under the caps mass / rate, by bisection of the level."""
    share, part = mass / mass.sum(), mass ** mixing.TEMPERATURE
    low, high = 0.0, 1e9
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(share / rate, mid * part).sum() < 1 else (low, mid)
    return np.minimum(share / rate, low * part)


@pytest.mark.parametrize("one_task", [200_000, 0])
def test_mixing(spark, odd, monkeypatch, one_task):
    monkeypatch.setattr(mixing, "ONE_TASK", one_task)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix(docs).toPandas()
    cells = found.groupby(["source", "lang", "topic"]).agg(tokens=("n_tokens", "sum"), p=("probability", "first")).reset_index()
    w, total = cells.tokens.astype(float), cells.tokens.sum()
    want = {d: water_filled(cells.groupby(d).tokens.sum().astype(float), mixing.RATE) for d in mixing.DIMENSIONS}
    for _ in range(mixing.ROUNDS):
        for d in mixing.DIMENSIONS:
            w = np.minimum(cells.tokens / mixing.RATE, w * cells[d].map(want[d]) * total / w.groupby(cells[d]).transform("sum"))
    assert np.allclose(cells.p, mixing.RATE * w / cells.tokens, atol=1e-6) and (cells.p <= 1).all()
    assert abs(found.sampled.mean() - found.probability.mean()) < 0.05 and not found.sampled.all()
    assert len(mixing.mix(odd).collect()) == odd.count() and mixing.mix(odd.limit(0)).count() == 0
    clash = odd.withColumn("mix_source", F.lit(1)).withColumn("mix_tokens", F.lit(2))
    assert mixing.sample_documents(clash, rate=1.0).columns == clash.columns and mixing.sample_documents(clash, rate=1.0).count() == odd.count()


@pytest.mark.parametrize("rate", [0.5, 0.9])
def test_sampled_tokens_have_the_target_shares(spark, rate):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = mixing.mix(docs, rate=rate).toPandas()
    for d in mixing.DIMENSIONS:
        mass = found.groupby(d).n_tokens.sum().astype(float)
        want = water_filled(mass, rate)
        expected = (found.n_tokens * found.probability).groupby(found[d]).sum()
        assert (abs(expected / expected.sum() - want) <= 0.01).all()
        sampled = found[found.sampled].groupby(d).n_tokens.sum() / found[found.sampled].n_tokens.sum()
        assert (abs(sampled.reindex(want.index).fillna(0) - want) <= 0.03).all()  # 10,000 documents of very different lengths
    assert abs((found.n_tokens * found.probability).sum() / found.n_tokens.sum() - rate) <= 0.01 * rate


def test_given_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = docs.select("source", "lang", F.lit("t").alias("topic"), F.length("text").alias("n")).groupBy("source", "lang", "topic").agg(F.sum("n").alias("tokens"))
    aim = {"lang": spark.createDataFrame([("en", 0.25), ("fr", 0.25), ("de", 0.25), ("es", 0.25)], "value string, share double")}
    raked = mixing.rake(cells, aim, 30, rate=0.2)
    assert np.allclose([r.expected for r in mixing.marginals(raked).where("dimension = 'lang'").collect()], 0.25, atol=0.01)
    greedy = {"lang": spark.createDataFrame([("fr", 1.0)], "value string, share double")}
    told = {r.value: r for r in mixing.marginals(mixing.rake(cells, greedy, 10, rate=0.9)).where("dimension = 'lang'").collect()}
    assert told["fr"].wanted == 1 and told["fr"].expected == 1 and told["en"].expected == 0
    got = mixing.mix(docs, topics=(("law", ("icense",)),)).select("topic").distinct().collect()
    assert {r.topic for r in got} == {"law", "prose"}
