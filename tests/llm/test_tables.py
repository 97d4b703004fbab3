"""Operators on whole tables: mixing, vector searches, lattice scores, near-duplicates, pipeline."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import helpers
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from pacecast.llm import bpe, components, kdtree, lattice, lsh_forest, mixing, neardup, queries, vectors

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall((text or "").encode()))


# ------------------------------------------------------------- mixing ---------

def filled(sizes, weights, share, most):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in target]
        left = total - sum(target.values())
        now = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if now[s] > most * sizes[s]]
        if not above:
            return target | now
        target |= {s: most * sizes[s] for s in above}


def test_mix_of_awkward_documents(spark, folder):
    docs = helpers.awkward_docs()
    rows = queries.op1_entropy_mix(spark, folder).collect()
    assert len(rows) == len(docs)
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += size(d[1])
    want = filled(sizes, (3, 1, 2), 1.5, 2)
    source = {d[0]: d[3] for d in docs}
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(d[0]), size(d[1])) for d in docs)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken in (0, r.size, 2 * r.size) and r.rate <= 2
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        # a source of short documents and one of 6,000 words can't be met any better
        assert abs(taken[s] - t) <= (0.02 * t + 3 if s != "src3" else 1_200), s
    assert sorted(map(str, queries.op1_entropy_mix(spark, folder).collect())) == sorted(map(str, rows))


def test_rates_are_exponentially_tilted_and_meet_the_targets(spark):
    rng = random.Random(2)
    docs = [(i, " ".join("w" * rng.randint(1, 50)), "abc"[i % 3]) for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(frame, weights=(1.0, 6.0, 2.0)).collect()
    for s in "abc":
        own = [r for r in rows if r.mix_source == s]
        assert abs(sum(r.rate * r.size for r in own) - own[0].target) <= 1e-5 * own[0].target
        free = [r for r in own if 0 < r.rate < 2]
        tilt = {round(math.log(r.rate) / r.size, 9) for r in free if abs(math.log(r.rate)) > 1e-3}
        assert len(tilt) <= 1
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2


def test_mix_of_one_size_and_a_hot_source(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                     F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("source"))
    rows = mixing.mix(frame, keep=["doc_id"]).groupBy("mix_source").agg(
        F.sum("taken").alias("t"), F.max("target").alias("g"), F.max("copies").alias("c")).collect()
    assert all(abs(r.t - r.g) <= 2 and r.c <= 2 for r in rows)


# ------------------------------------------------------------ vectors ---------

def exact(rows, top=20):
    vec = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(64 * x) for x in v]
            vec[i] = min(v, vec.get(i, v))
    out = []
    for q in vec:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vec[q], v)), i) for i, v in vec.items()
                            if i != q and len(v) == len(vec[q]))
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(vectors.SHARD_ROWS, vectors.BLOCK_ROWS), (50, 4)])
def test_exact_search(spark, folder, monkeypatch, shard, block):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted(map(tuple, queries.op6_kd_tree(spark, folder).collect()))
    assert got == exact(rows)


def test_tree_search_against_all_products():
    rng = np.random.default_rng(3)
    x = rng.integers(-20, 20, (3000, 6))
    ids = rng.permutation(3000)
    asked = rng.integers(-20, 20, (40, 6))
    found = kdtree.search(x, ids, asked, np.full(40, -np.inf), 10)
    scores = asked @ x.T
    for s, (rows, got) in zip(scores, found):
        assert rows.tolist() == np.lexsort((ids, -s))[:10].tolist() and got.tolist() == s[rows].tolist()
    limits = np.sort(scores, axis=1)[:, -3].astype(float)
    for s, t, (rows, got) in zip(scores, limits, kdtree.search(x, ids, asked, limits, 10)):
        assert rows.tolist() == np.lexsort((ids, -s))[:(s >= t).sum()].tolist()[:10]


def test_large_components_stay_exact():
    x = np.array([[2 ** 30, 1], [2 ** 30, 2], [2 ** 30, 3]], np.int64)
    rows, scores = kdtree.search(x, np.arange(3), x[:1], np.array([-np.inf]), 2)[0]
    assert rows.tolist() == [2, 1] and scores.tolist() == [2 ** 60 + 3, 2 ** 60 + 2]
    with pytest.raises(OverflowError):
        kdtree.search(x * 2 ** 3, np.arange(3), x[:1], np.array([-np.inf]), 2)


def test_forest_recall_and_scores(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 24)).astype("float32") * rng.uniform(0.5, 2, (2000, 1)).astype("float32")
    path = helpers.write(spark, tmp_path, embeddings=([(i, v.tolist(), 0) for i, v in enumerate(x)],
                                                      helpers.EMBEDDINGS))
    rows = queries.op2_lsh_forest(spark, path).collect()
    scores = x[::20].astype(float) @ x.astype(float).T
    hits = 0
    for k, s in enumerate(scores):
        s[20 * k] = -np.inf
        own = sorted((r for r in rows if r.query_id == 20 * k), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(math.isclose(r.score, s[r.vec_id], rel_tol=1e-12) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & set(np.argsort(-s)[:20].tolist()))
    assert hits / (20 * len(scores)) >= 0.9


def test_forest_on_awkward_vectors(spark, folder):
    rows = queries.op2_lsh_forest(spark, folder).collect()
    assert {r.query_id for r in rows} == {i for i in range(0, 340, 20)} | {440}
    assert [(r["rank"], r.vec_id, r.score) for r in rows if r.query_id == 440] == [(1, 441, 6.0)]
    # 41 rows share one vector: they follow each other, smallest ids first
    own = [r.vec_id for r in sorted((r for r in rows if r.query_id == 320), key=lambda r: r["rank"])]
    copies = [i for i in own if i == 7 or i >= 300]
    assert len(copies) > 3 and copies == [7, *(i for i in range(300, 340) if i != 320)][:len(copies)]
    assert own[own.index(7):own.index(7) + len(copies)] == copies


def test_forest_prefix_ranges():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 4))
    forest = lsh_forest.Forest(x, 5.0, trees=3, bits=6)
    start, end = forest.ranges(x[:5])
    strings = forest.strings(x, np.sqrt(25.0 - (x * x).sum(axis=1)))
    asked = forest.strings(x[:5], np.zeros(5))
    for length, t, q in itertools.product(range(7), range(3), range(5)):
        rows = set(forest.order[t, start[length, t, q]:end[length, t, q]].tolist())
        assert rows == set(np.flatnonzero(strings[:, t] >> (6 - length) == asked[q, t] >> (6 - length)).tolist())


# ------------------------------------------------------------ lattice ---------

def test_lattice_base_scores(spark, folder):
    docs = helpers.awkward_docs()
    rows = queries.op4_lattice_lm(spark, folder).collect()
    tokens = [(d[0], [*WORD.findall((d[1] or "").encode().lower()), "end"]) for d in docs]
    learned = [t for i, t in tokens if i is not None and zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in learned for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in tokens)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    for r in rows:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.score < 0 and math.isfinite(r.score)


@pytest.fixture(scope="module")
def model():
    return lattice.initial_model(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def segmentations(model, word):
    """(probability, pieces) of every way to cut the word, without the stop."""
    number = model.trie.number
    if not word:
        yield 1.0, ()
    for k in range(1, len(word) + 1):
        if word[:k] in number:
            p = math.exp(model.logs[number[word[:k]]])
            for q, rest in segmentations(model, word[k:]):
                yield p * q, (word[:k], *rest)


def test_lattice_by_enumeration(model, monkeypatch):
    words = [b"the", b"station", "été".encode(), b"zzzz", b"x", b"\xff\xfe"]
    times = np.array([1.0, 2.0, 1.0, 3.0, 1.0, 1.0])
    for limit in (lattice.SIDE_BY_SIDE, 0):
        monkeypatch.setattr(lattice, "SIDE_BY_SIDE", limit)
        logs = lattice.word_logs(words, model)
        uses = lattice.expected_uses(words, times, model)
        want = np.zeros(len(uses))
        for w, t, log in zip(words, times, logs):
            ways = list(segmentations(model, b" " + w))
            total = sum(p for p, _ in ways)
            assert math.isclose(log, math.log(total) + model.stop, rel_tol=1e-9)
            for p, pieces in ways:
                for piece in pieces:
                    want[model.trie.number[piece]] += t * p / total
        assert np.allclose(uses, want)


def test_model_is_a_distribution(model):
    first = np.array([p[0] == 32 for p in model.pieces])
    p = np.exp(model.logs)
    assert math.isclose(p[first].sum() + math.exp(model.end), 1)
    assert math.isclose(p[~first].sum() + math.exp(model.stop), 1)


def test_rounds_raise_the_likelihood(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    total = [lattice.score(docs, F.lit(True), vocab, rounds=k).agg(F.sum("score")).first()[0] for k in (0, 1, 2)]
    assert total[0] < total[1] < total[2]


# ------------------------------------------------------ near-duplicates -------

def by_brute_force(docs, width, share=80):
    """(id, set size, component, kept) by comparing all pairs."""
    sets = []
    for d in docs:
        w = [x for x in WORD.findall((d[1] or "").encode().lower())]
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width
                    else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    live = [k for k, s in enumerate(sets) if s and docs[k][0] is not None]
    for a, b in itertools.combinations(live, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k in live:
        least[find(k)] = min(least.get(find(k), docs[k][0]), docs[k][0])
    out = []
    for k, d in enumerate(docs):
        c = least[find(k)] if k in live else d[0]
        out.append((d[0], len(sets[k]), c, d[0] is None or c == d[0]))
    return sorted(out, key=str)


def families(rng, groups, copies, length, changes):
    docs, n = [], 0
    for _ in range(groups):
        base = helpers.words(rng, length)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, changes)):
                w[rng.randrange(len(w))] = "".join(helpers.words(rng, 2))
            docs.append((n, " ".join(w), "en", "s", 1))
            n += 1
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_of_awkward_documents(spark, folder, width):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, neardup.near_duplicates(docs, width=width).collect()), key=str)
    assert got == by_brute_force(helpers.awkward_docs(), width)


@pytest.mark.parametrize("block", [neardup.BLOCK, 7])
def test_near_duplicate_families(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    docs = families(random.Random(11), 6, 30, 60, 9) + [(1000 + i, "shared words only here", "en", "s", 1)
                                                        for i in range(40)]
    frame = spark.createDataFrame(docs, helpers.DOCS)
    got = sorted(map(tuple, neardup.near_duplicates(frame, width=2).collect()), key=str)
    assert got == by_brute_force(docs, 2)


def test_near_duplicate_sql(spark, folder):
    """The query's SQL against the brute force, on rows with ids and without repeated rows."""
    docs = list({d[0]: d for d in helpers.awkward_docs() if d[0] is not None}.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [d[:2] for d in docs])
    assert sorted(con.execute(queries.ORACLE_SQL["op9_hyperminhash"]).fetchall(), key=str) == by_brute_force(docs, 2)


def test_register_estimates():
    rng = np.random.default_rng(6)
    everything = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    for shared, only in ((400, 50), (400, 200), (10, 500), (0, 600)):
        a = np.unique(everything[:shared + only])
        b = np.unique(np.concatenate((everything[:shared], everything[2000:2000 + only])))
        ra, rb = neardup.registers([a, b])
        truth = shared / (shared + 2 * only)
        by_chance = neardup.collisions(np.array(len(a), float), np.array(len(b), float))
        assert abs(((ra == rb).mean() - by_chance) / (1 - by_chance) - truth) < 0.13


def test_compressed_registers_keep_order():
    value = np.array([0, 1, 2, 3, 5, 1023, 1024, 2 ** 31, 2 ** 32 - 1], np.uint32)
    got = neardup.compress(value)
    zeros, mantissa = got >> 10, got & 1023
    assert zeros.tolist() == [32 - int(v).bit_length() for v in value.tolist()]
    for v, m in zip(value.tolist(), mantissa.tolist()):
        rest = f"{v:b}"[1:] if v else ""
        assert m == int((rest + "0" * 10)[:10], 2)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    links += [(900, 901 + i) for i in range(50)] + [(5, 5), (None, 3)]
    parent = {}

    def find(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: find(k) for k in list(parent)}


# ----------------------------------------------------------- pipeline ---------

def test_pipeline_stages(spark, folder, tmp_path):
    """Each stage on what the one before kept, against brute force; the tokens against the library."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.Vocabulary(bpe._read(corpus_pipeline.VOCABULARY)).ranks)
    before = helpers.awkward_docs()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        rows = [tuple(r) for r in after.collect()]
        if k < 4:
            assert after.columns == docs.columns and after.schema == docs.schema
        if k == 0:
            assert Counter(map(str, rows)) == Counter(str(d) for d in before if any(map(str.isalpha, d[1] or "")))
        elif k == 1:
            kept = {x[0] for x in by_brute_force(before, 5) if x[3]}
            assert sorted((str(r[0]) for r in rows)) == sorted(map(str, kept))
        elif k == 2:
            assert sorted(map(str, rows)) == sorted(
                str((*d[:1], corpus_pipeline.pii.redact_text(d[1]), *d[2:4],
                     len(corpus_pipeline.pii.redact_text(d[1])))) for d in before)
        elif k == 3:
            assert set(map(str, rows)) <= set(map(str, before))
            assert max(Counter(map(str, rows)).values()) <= 2
            sizes = Counter()
            for d in before:
                sizes[d[3]] += size(d[1])
            for s, t in filled(sizes, (3, 1, 2), 1.5, 2).items():
                assert abs(sum(size(r[1]) for r in rows if r[3] == s) - t) <= (0.02 * t + 3 if s != "src3" else 1_200)
        else:
            want = [np.array(library.encode_ordinary(d[1]), "<u4").tobytes() for d in before]
            assert Counter(bytes(r["ids"]) for r in after.collect()) == Counter(want)
            assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in after.collect())
        docs, before = after, rows


def test_near_dedup_does_not_rest_on_ids(spark):
    """An id given to unlike texts links nothing; copies without an id are copies."""
    rng = random.Random(6)
    a, b, c, d = (" ".join(helpers.words(rng, 60)) for _ in range(4))
    rows = [(1, a), (1, b), (2, a), (3, b + " more"), (None, c), (None, c), (None, d), (4, d), (5, ""), (5, ""),
            (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], helpers.DOCS)
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(1, a), (1, b), (None, c), (4, d), (5, ""), (None, None), (None, None)])


def test_pipeline_run_is_the_stages_in_turn(spark, folder):
    first, second = ([hashlib.sha256(str(r).encode()).hexdigest() for r in corpus_pipeline.run(spark, folder).collect()]
                     for _ in range(2))
    assert first and sorted(first) == sorted(second)


@pytest.mark.parametrize("name", ["op1_entropy_mix", "op2_lsh_forest", "op4_lattice_lm", "op6_kd_tree",
                                  "op9_hyperminhash"])
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


def test_pipeline_on_an_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
