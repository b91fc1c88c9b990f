"""The training-text operators against brute force, on edge cases and on the smallest tables."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lifespans.llm import components, decontaminate, licences, media, mixing, oracle, pseudo_lm, quality, queries, simhash, storage, tokens, toxicity, urlgraph

from ..conftest import DATA

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))
#: Nulls everywhere, empty and very long texts, ties, repeated rows, an id with two texts; extra columns with clashing names.
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "s1"), (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "s1"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "s1"), (3, "", "s2"), (4, None, "s2"), (None, "no id here at all", None), (None, None, None),
    (5, " \n\t ", ""), (6, LONG, "s1"), (7, "ÄÖ ümlaut　wide <|endoftext|> don't 12,000!", "s3"), (8, "one", None), (8, "one two three four", "s3"), (9, "a  b\n\nc \r\n d", "s3"),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(0).alias(c) for c in ("key", "id", "row", "fingerprint", "n", "rep", "bad", "kept", "tokens", "seed", "block", "severity", "label", "lang", "n_chars")])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    if not shingles:
        return 0
    bits = np.zeros(64, np.int64)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        bits += [(h >> b) & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def brute_components(prints):
    """Smallest id reachable, by rows of (id, fingerprint)."""
    group = list(range(len(prints)))
    values = np.array([p for _, p in prints], np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3)
            low = min(group[j] for j in near)
            for j in near:
                if group[j] != low:
                    group[j], changed = low, True
    least = {}
    for (key, _), g in zip(prints, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    return [least.get(g) for g in group]


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_simhash(request, which):
    df = request.getfixturevalue(which)
    rows = [(r.doc_id, brute_print(r.text if len(r.text or "") < 50_000 else r.text)) for r in df.select("doc_id", "text").collect()]
    want = collections.Counter((k, f"{p:016x}", c) for (k, p), c in zip(rows, brute_components(rows)))
    assert collections.Counter(map(tuple, simhash.near_duplicates(df).collect())) == want


def test_links_keep_components_of_large_buckets(spark):
    """Chunks of a bucket are compared with each other, so a small chunk size loses nothing."""
    r = random.Random(1)
    values = [r.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << r.randrange(64) for _ in range(r.randrange(1, 5))) for v in values for _ in range(6)]
    signed = [v - (1 << 64) if v >> 63 else v for v in set(values)]
    classes = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fingerprint long, rep long")
    want = brute_components([(i, v % (1 << 64)) for i, v in enumerate(signed)])
    for chunk in (3, 4096):
        scratch = storage.Scratch(spark, "t")
        roots = dict(map(tuple, components.connected_components(simhash.links(classes, chunk=chunk), scratch).collect()))
        assert [roots.get(i, i) for i in range(len(signed))] == want


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long"), storage.Scratch(spark, "t")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long"), storage.Scratch(spark, "t")).count() == 0


def test_keep_one(edge):
    got = simhash.keep_one(edge)
    assert got.columns == edge.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect())
    assert kept == [(False, 1), (False, 3), (False, 6), (False, 7), (False, 8), (False, 9), (True, 0), (True, 0)]


def brute_matches(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for key, text in items:
        w = split(text)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + min(10, len(w))])].add(str(key))
    out = collections.Counter()
    for key, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if items_ := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= items_
        out[(key, len(w), len(hit), tuple(sorted(found)))] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"block_words": 60, "shard_words": 40}])
def test_decontamination(spark, edge, docs, options):
    items = [(1, "quick brown fox jumps over the lazy dog near the old river"), (2, "The LAZY dog"), (3, None), (4, "..."), (2, "The LAZY dog"), (5, "word5"), (6, " ".join(f"word{i % 977} x{i}" for i in range(100, 130)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for df, b in ((edge, bench), (docs, spark.read.parquet(f"{DATA}/benchmark.parquet"))):
        got = decontaminate.benchmark_matches(df, b, **options).select("doc_id", "n_words", "n_hit", "item_ids").collect()
        want = brute_matches([tuple(r) for r in df.select("doc_id", "text").collect()], [tuple(r) for r in b.collect()])
        assert collections.Counter((r[0], r[1], r[2], tuple(r[3])) for r in got) == want
    clean = decontaminate.remove_contaminated(edge, bench)
    assert clean.columns == edge.columns and {r.doc_id for r in clean.collect()} == {3, 4, 5, 7, 8, 9, None}
    assert decontaminate.remove_contaminated(edge, bench.where("false")).count() == len(EDGE)


def test_longest_match_is_found(spark):
    df = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(40)) + " z")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "q " + " ".join(f"w{i}" for i in range(5, 35)))], "item_id long, text string")
    (m,) = decontaminate.benchmark_matches(df, bench).first()["matches"]
    assert (m.start, m.words, m.item_id, m.item_start) == (7, 30, 1, 1)


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_media_round_trip(request, which):
    df = request.getfixturevalue(which)
    want = collections.Counter()
    for r in df.select("doc_id", "text").collect():
        data = (r.text or "").encode()
        padded = data + b" " * (-len(data) % 192 if data else 192)
        want[(r.doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))] += 1
    got = media.media_columns(df)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32").collect()) == want
    row = got.where("doc_id = 1").first()
    system, path = storage.open_fs(row.shard)
    with system.open_input_file(path) as f:
        f.seek(row.offset)
        stored = f.read(row.length)
    assert hashlib.sha256(stored).hexdigest() == row.media_sha256 and len(stored) == row.media_bytes
    assert got.groupBy("payload_sha256").agg(F.countDistinct("media_sha256", "feature", "shard", "offset").alias("n")).where("n > 1").count() == 0


def test_quality_learns_and_scores_edges(spark, edge):
    sf = DATA.replace("sf0.001", "sf0.01")
    got = queries.op4_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
    scores = quality.score(edge, (np.zeros(quality.BUCKETS, np.float32), 0.0)).collect()
    assert len(scores) == len(EDGE) and all(r.score == 0.5 for r in scores)
    model = quality.fit(edge.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, quality int"))
    assert not model[0].any()


def test_held_out_labels_are_never_used(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x, use=~quality.held_out()) for x in (labels, flipped))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_toxicity_model():
    r = random.Random(3)
    rows = []
    for k in range(600):
        words = {f"w{r.randrange(500)}".encode() for _ in range(40)}
        if k % 5 == 0:
            words |= {f"bad{r.randrange(6)}".encode() for _ in range(3)}
        rows.append((toxicity.buckets(words), 40, int(k % 5 == 0)))
    w, theta = toxicity.train_ordinal(rows)
    assert (np.diff(theta) > 0).all()
    s = toxicity.expected_grade(np.array([w[i].sum() for i, _, _ in rows]), theta)
    y = np.array([t for *_, t in rows])
    assert (s[y == 1] >= 0.5).mean() > 0.95 and (s[y == 0] < 0.5).mean() > 0.98


def test_toxicity_holds_out(spark):
    """Fitted on one half of the labels, judged on the other."""
    sf = DATA.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    got = toxicity.severity(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    flagged = got.severity >= queries.TOXIC_FROM
    assert flagged[got.toxic == 1].mean() > 0.7 and (~flagged)[got.toxic == 0].mean() > 0.98  # some 220 toxic rows to learn from


def test_toxicity_edges(spark, edge):
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    weights[toxicity.buckets({b"one"})] = 50
    got = {(r.doc_id, r.severity > 2.9) for r in toxicity.severity(edge, (weights, np.array([1.0, 2.0, 3.0]))).collect()}
    assert (8, True) in got and (8, False) not in got and (3, False) in got and (None, False) in got
    kept = toxicity.drop_toxic(edge, spark.createDataFrame([], "doc_id long, toxic int"), threshold=99.0)
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


def test_urls(spark):
    pages = [
        (1, "https://A.Example.org/es/x?q", '<a href="http://bad.example.net/">x</a>'), (2, "http://bad.example.net", "www.good.example.net"), (3, "https://x.com/de/1", '<a href=http://feeds.bad.net/x>'),
        (4, None, None), (5, "no scheme", "<p>"), (6, "http://q.org?x", ""), (7, "http://q.org/#f", ""), (8, "://", ""), (8, "://", ""), (9, "ftp://example.org/en/12#", 'src="https://x.com/a"'), (10, "https://feeds.bad.net/p", "<a href='https://x.com/z'>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(1))
    got = {(r.page_id, r.host, r.path, r.rule) for r in urlgraph.judge_urls(df, queries.RULES).collect()}
    assert got == {(1, "a.example.org", "/es/x", "example.org/es/"), (2, "bad.example.net", "", None), (3, "x.com", "/de/1", "com/de/"), (4, "", "", None), (5, "", "", None), (6, "q.org", "", None),
                   (7, "q.org", "/", "org/"), (8, "", "", None), (9, "example.org", "/en/12", "example.org/en/1"), (10, "feeds.bad.net", "/p", None)}
    verdicts = {r.page_id: r.verdict for r in urlgraph.judge_urls(df, queries.RULES).collect()}
    assert verdicts[10] == "block" and verdicts[4] == "allow" and verdicts[7] == "allow"
    assert urlgraph.judge_urls(df.where("false"), queries.RULES).count() == 0


def test_propagation_matches_the_dense_solution(spark):
    r = random.Random(5)
    pairs = {(f"h{r.randrange(12)}", f"h{r.randrange(12)}") for _ in range(40)}
    edges = [(a, b, float(1 + len(a + b) % 3)) for a, b in sorted(pairs) if a != b]
    seeds = [(f"h{i}", float(i % 3 == 0), float(i % 4 == 1)) for i in range(12)]
    got = urlgraph.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "host string, trust double, distrust double"), storage.Scratch(spark, "t"))
    got = {x.host: (x.trust, x.distrust) for x in got.collect()}
    names = [s[0] for s in seeds]
    m = np.zeros((12, 12))
    for a, b, w in edges:
        m[names.index(a), names.index(b)] = w
    for col, matrix in ((1, m), (2, m.T)):
        p = matrix / np.maximum(matrix.sum(1, keepdims=True), 1e-300)
        s = np.array([x[col] for x in seeds])
        s = s / s.sum()
        v = 0.15 * np.linalg.solve(np.eye(12) - 0.85 * p.T, s)  # the ranks that a step doesn't change
        assert all(abs(got.get(n, (0, 0))[col - 1] - x) < 1e-9 for n, x in zip(names, v))


def test_mixing(spark, edge, docs):
    for df, target in ((edge, mixing.Target(repeats=2.0)), (docs, mixing.Target(repeats=1.5)), (docs, mixing.Target(entropy=2.97))):
        source = [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]
        count = lambda t: max(1, len(re.findall(r"[^\x09-\x0d\x20]+", t or "")))
        tokens_of = collections.Counter()
        for _, t, s in source:
            tokens_of[s] += count(t)
        rows = mixing.mixture(df, target).collect()
        epochs = {r.source: r.epochs for r in rows}
        weight = {r.source: r.weight for r in rows}
        assert abs(sum(weight.values()) - 1) < 1e-6
        if target.repeats:
            assert max(epochs.values()) <= target.repeats + 1e-6
        else:
            h = -sum(w * np.log(w) for w in weight.values())
            assert h <= target.entropy + 1e-3
        taken = collections.Counter()
        for r in rows:
            taken[r.source] += r.n_tokens
        biggest = max(count(t) for _, t, _ in source)
        for s, n in tokens_of.items():
            assert epochs[s] * n - biggest * 2 - 1 <= taken[s] <= epochs[s] * n + 1
        block0 = collections.Counter(r.doc_id for r in rows if r.block == 0)
        assert block0 == collections.Counter(d for d, _, _ in source)
    mixed = mixing.mixed_documents(edge, mixing.Target(repeats=2.0))
    assert mixed.columns == edge.columns and mixed.count() == len(mixing.mixture(edge, mixing.Target(repeats=2.0)).collect())
    assert mixing.mixture(edge.where("false"), mixing.Target(repeats=2.0)).count() == 0


def test_the_cut_is_the_longest_prefix_of_the_permutation(docs):
    rows = mixing.mixture(docs, mixing.Target(repeats=1.5)).toPandas()
    text = {r.doc_id: r.text for r in docs.collect()}

    def place(doc, block):
        seed = hashlib.md5(f"{doc}:{text[doc]}".encode()).hexdigest()[:15]
        return int(hashlib.md5(f"{seed}:{block}".encode()).hexdigest()[:15], 16)

    for _, g in rows.groupby("source"):
        n = g[g.block == 0].n_tokens.sum()
        last = int(g.epochs.iloc[0])
        rest, total, want = round(g.epochs.iloc[0] * n) - last * n, 0, set()
        for d, t in sorted(zip(g[g.block == 0].doc_id, g[g.block == 0].n_tokens), key=lambda x: place(x[0], last)):
            if total + t > rest:
                break
            total += t
            want.add(d)
        assert set(g[g.block == last].doc_id) == want


def test_licences(spark):
    files = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/c.txt", "plain text"), (3, "a/b/d.txt", "x\nReleased under the MIT License.\n" + "filler words " * 50),
        (4, "z/q.txt", "nothing"), (5, None, None), (6, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (7, "a/b/e/f.txt", ""), (7, "a/b/e/f.txt", ""), (None, "a/n.txt", "x"),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").withColumn("line", F.lit(1)).withColumn("licence", F.lit(1))
    got = {(r.doc_id, r.licence, r.origin, r.from_dir) for r in licences.scan(df).collect()}
    assert got == {(1, "Apache-2.0", "own", None), (2, "GPL-3.0", "inherited", "a/b"), (3, "MIT", "own", None), (4, None, None, None), (5, None, None, None), (6, "GPL-3.0", "own", None),
                   (7, "GPL-3.0", "inherited", "a/b"), (None, "Apache-2.0", "inherited", "a")}
    assert licences.scan(df.where("false")).count() == 0


def test_anchors_lose_nothing():
    idf = {w: 1.0 + len(w) for _, t in licences.TEMPLATES for w in licences._python_terms(t)}
    for (_, text), anchors in zip(licences.TEMPLATES, licences.anchor_terms(licences.TEMPLATES, idf, 0.8)):
        words = licences._python_terms(text)
        square = {w: (words.count(w) * idf[w]) ** 2 for w in set(words)}
        assert sum(v for w, v in square.items() if w not in anchors) < 0.64 * sum(square.values())


@pytest.mark.parametrize("options", [{}, {"file_tokens": 50}])
def test_tokens(spark, edge, docs, options):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (edge, docs):
        rows = [(r.doc_id, r.text or "", r.h) for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
        want, start = collections.Counter(), 0
        for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
            ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
            want[(key, start, len(ids), zlib.crc32(ids.tobytes()))] += 1
            start += len(ids)
        assert collections.Counter(map(tuple, tokens.token_files(df, **options).collect())) == want
    assert tokens.token_files(edge.where("false")).count() == 0


def test_packing_round_trip():
    r = np.random.default_rng(0)
    for n, top in ((0, 5), (1, 5), (3, 300), (70_000, 70_000), (1001, 10)):
        ids = (r.zipf(1.3, n) % top).astype(np.int64)
        table, control, data = tokens.pack(ids)
        assert len(control) == -(-n // 4) and np.array_equal(tokens.unpack(table, control, data, n), ids)


def test_pseudo_likelihood(spark, edge, docs):
    got = {(r.doc_id, r.n_tokens, r.log_likelihood == 0) for r in pseudo_lm.pseudo_likelihood(edge).collect()}
    assert {(3, 0, True), (4, 0, True), (None, 0, True)} <= got and len(pseudo_lm.pseudo_likelihood(edge).collect()) == len(EDGE)
    assert pseudo_lm.pseudo_likelihood(docs.where("false")).count() == 0


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, after = docs, stage(spark, docs, DATA)
        assert set(after.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
        docs = storage.Scratch(spark, "t").table(after, str(k))
    # the mixing stage takes every document as often as plain SQL over its input does
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    taken = con.execute(f"SELECT doc_id, count(*) AS n FROM ({oracle.mixing(queries.MIX.repeats)}) GROUP BY 1").fetchall()
    assert dict(taken) == collections.Counter(r.doc_id for r in docs.collect())
    # the token stage has the library's ids of every copy, one after another
    library, want, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out)) == sorted(want)
    empty = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0


def test_a_plan_of_many_sources_gives_the_same_mix(monkeypatch, docs):
    want = sorted(map(tuple, mixing.mixture(docs, queries.MIX).collect()))
    monkeypatch.setattr(mixing, "SENT", 2)
    assert sorted(map(tuple, mixing.mixture(docs, queries.MIX).collect())) == want


def test_every_query_is_registered():
    import __spark_entry__

    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
