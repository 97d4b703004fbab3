"""License scans, Merkle manifests and phrase mining against brute-force versions."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from pacecast.llm import collocations, licenses, merkle, queries

LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)
NOTICES = [
    "Some words. Licensed under CC BY-NC 4.0. More words follow here.", "ALL RIGHTS\nRESERVED, all rights reserved",
    "This work is licensed under the GNU General Public License, version 3", "general public licence",
    "the license is under mit. Released by them!", "Released under the MIT License\nReleased under the mIt license.",
    "licensed under the apache license version 2 and 0 more", "cc  by cc-by CC, BY", "ſoftware K K cc by é cc byé",
    " ".join(["filler"] * 60 + "this is free and unencumbered software released into the public domain".split()
             + ["filler"] * 200),
    " ".join(f"w{i} " + w for i, w in enumerate("released x1 x2 under x3 the x4 mit x5 license".split() * 30)),
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in it freely",
]


@pytest.fixture(scope="module")
def scan_folder(spark, tmp_path_factory):
    """The awkward documents, license notices, and texts with repeated phrases and stops."""
    rng = random.Random(11)
    docs = [*helpers.awkward_docs(), *[(1000 + i, t, "en", "src1", len(t)) for i, t in enumerate(NOTICES)]]
    vocabulary = ["Alpha", "beta", "gamma", "delta", "épsilon", "x\x0by", "zeta eta"]
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ";", " \r\n"]) for w in words)
        docs.append((2000 + i, text + " new york city hall", [None, "en", "und", "fr"][i % 4], None, None))
    docs += [docs[-1]] * 40
    folder = tmp_path_factory.mktemp("scans")
    frame = spark.createDataFrame(docs, helpers.DOCS)
    clash = frame.withColumns({c: F.lit(1) for c in ("leaf", "root", "n_words", "labels", "phrase", "word", "_pos",
                                                     "_group", "a", "key", "f")})
    clash.repartition(5).write.parquet(str(folder / "documents.parquet"))
    return str(folder), docs


def sql(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con.sql(queries.ORACLE_SQL[name]).fetchall()


def counted(rows):
    return Counter(tuple(r) for r in rows)


# ------------------------------------------------------------ licenses --------

def brute_scan(text):
    plain = (text or "").translate(LOWER)
    word = re.compile("[0-9a-z\x80-\U0010FFFF]+")
    found = word.findall(plain)
    places = [(label, at) for phrase, label in licenses.PHRASES.items() for at in range(len(found))
              if found[at:at + len(phrase.split())] == phrase.split()]
    labels, best = set(), 0.0
    for part in re.split("[.!?][ \t-\r]+|[\n-\r]+", plain):
        own = word.findall(part)
        size, half = licenses.BLOCK_WORDS, licenses.BLOCK_WORDS // 2
        blocks = [own] if len(own) <= size else [own[s:s + size] for s in range(0, len(own) - half, half)]
        for block in blocks:
            for label, template in licenses.TEMPLATES:
                want = set(licenses._template_words(template))
                shared = len(want & set(block))
                if 10 * shared >= 9 * len(want):
                    labels.add(label)
                    best = max(best, shared / len(want))
    base = {label for label, _ in places}
    return (len(found), len(places), min((a for _, a in places), default=None),
            max((a for _, a in places), default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)),
            1.0 if places else best)


def test_license_scan_matches_brute_force_and_sql(spark, scan_folder):
    folder, docs = scan_folder
    got = counted(queries.op11_license_join(spark, folder).collect())
    assert got == counted((d[0], *brute_scan(d[1])) for d in docs)
    assert got == counted(sql(folder, "op11_license_join"))


def test_license_scan_finds_notices(spark, scan_folder):
    folder, _ = scan_folder
    rows = {r.doc_id: r for r in licenses.scan(spark.read.parquet(f"{folder}/documents.parquet"),
                                               keep=["doc_id"]).where("doc_id >= 1000 and doc_id < 1100").collect()}
    assert rows[1000].labels == ["cc-by", "cc-by-nc"] and rows[1000].score == 1.0
    assert rows[1001].base_labels == ["reserved"] and len(rows[1001].places) == 2
    assert "gpl" in rows[1002].labels and rows[1003].labels == []
    assert rows[1004].labels == [] and rows[1005].labels == ["mit"]
    assert [m.block for m in rows[1005].matches] == [0, 1]
    assert rows[1007].n_words == 6 and len(rows[1007].places) == 3
    assert [p.start for p in rows[1008].places] == [3]  # the Kelvin sign and é are letters of their own
    assert rows[1009].labels == ["unlicense"]  # in the middle of a long line
    assert rows[1011].labels == ["mit"] and 0.9 <= rows[1011].score < 1


def test_license_join_is_exact_for_other_templates(spark):
    """Random sets over a small vocabulary, every share: the filters lose no pair."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(14)]
    templates = [(f"t{k}", " ".join(rng.sample(words, rng.randint(1, 8)))) for k in range(12)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 10)))) for i in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for share in (0.5, 0.8, 1.0):
        got = {r.doc_id: [(m.template, round(m.containment, 9)) for m in r.matches] for r in licenses.scan(
            frame, templates=templates, phrases={"w0 w1": "x"}, share=share, keep=["doc_id"]).collect()}
        for i, text in docs:
            want = []
            for k, (_, t) in enumerate(templates):
                own = len(set(t.split()) & set(text.split())), len(set(t.split()))
                if own[0] >= math.ceil(round(share * own[1], 9)):
                    want.append((k, round(own[0] / own[1], 9)))
            assert got[i] == want, (share, i)


def test_license_scan_of_a_very_long_text(spark):
    text = "word " * 300_000 + "cc by. " + "Released under the MIT License. " * 1000
    frame = spark.createDataFrame([(1, text), (2, "x" * 2_000_000)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan(frame, keep=["doc_id"]).collect()}
    assert rows[1].n_words == 305_002 and [p.start for p in rows[1].places] == [300_000]
    assert rows[1].labels == ["cc-by", "mit"] and len(rows[1].matches) == 1000
    assert rows[2].n_words == 1 and rows[2].labels == []


# -------------------------------------------------------------- merkle --------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def built(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def proof(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at // 8 * 8
        out.append((nodes[run:at], nodes[at + 1:run + 8]))
        at //= 8
    return out


def brute_manifest(docs):
    """Rows of the contract's query for (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for i, text, lang, source, n in docs:
        head = [field(v) for v in (i, source, lang, n)]
        changed = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None
        now = H(*head, field(text.translate(LOWER) if changed else text))
        groups[lang].append((i is not None, i or 0, H(*head, field(text)), now))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort()
        trees.append(built([leaf for _, _, leaf, _ in groups[g]]))
    top = built([t[-1][0] for t in trees])
    for k, g in enumerate(order):
        for at, (known, i, leaf, now) in enumerate(groups[g]):
            path = proof(trees[k], at) + proof(top, k)
            for before, after in path:
                now = H(*before, now, *after)
            yield (i if known else None, leaf, trees[k][-1][0], top[-1][0],
                   H(*[d for pair in path for side in pair for d in side]), now, now == top[-1][0])


def test_manifest_matches_brute_force(spark, scan_folder):
    folder, docs = scan_folder
    got = counted(queries.op12_merkle_windows(spark, folder).collect())
    assert got == counted(brute_manifest(docs))


def test_manifest_matches_sql_where_ids_are_unique(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = counted(con.sql(queries.ORACLE_SQL["op12_merkle_windows"]).fetchall())
    assert counted(queries.op12_merkle_windows(spark, folder).collect()) == want


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 65], [513, 1, 7], [1] * 70])
def test_trees_of_any_shape(spark, sizes):
    docs = [(100_000 * g + i, f"T{i}", f"l{g:03d}", "s", 1) for g, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(docs, helpers.DOCS).repartition(3)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lower("text"))
    rows = merkle.manifest(frame, ["doc_id", "source", "lang", "n_chars", "text"],
                           tampered={"text": changed.otherwise(F.col("text"))}, keep=["source"]).drop("siblings")
    assert "source" in rows.columns
    assert counted(rows.drop("source").collect()) == counted(brute_manifest(docs))


# -------------------------------------------------------- collocations --------

def brute_phrases(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if c >= least and len(p) > 1}
        inner = Counter()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i:i + size]] = max(inner[p[i:i + size]], c)
        rows = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inner[p] < 80 * a:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, rest, n[lang], -s)
                for r, (s, a, p, left, rest) in enumerate(sorted(rows)[:top])]
    return counted(out)


def test_phrases_match_brute_force_and_sql(spark, scan_folder):
    folder, docs = scan_folder
    got = counted(queries.op13_quotient_phrases(spark, folder).collect())
    assert len(got) > 20 and got == brute_phrases(docs, 30, 2000)
    assert got == counted(sql(folder, "op13_quotient_phrases"))
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    assert counted(collocations.collocations(frame, least=5, top=7).collect()) == brute_phrases(docs, 5, 7)


def test_filters_are_lossless():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 4):
        lanes = rng.integers(0, 1 << 63, (5000, width), dtype=np.uint64)
        assert (collocations.restored(collocations.permuted(lanes)) == lanes).all()
        # keys that agree in the word the filter sorts by
        lanes[:2000, -1] = 7
        many = lanes[rng.integers(0, 5000, 40_000)]
        want = Counter(map(bytes, many))
        held = collocations.Filter(width)
        for part in np.array_split(many, 7):
            held.add(*collocations.summed(part, np.ones(len(part), np.int64)))
        keys, counts = collocations.unpacked(*collocations.packed(*held.merge()), width)
        assert dict(zip(map(bytes, keys), counts.tolist(), strict=True)) == dict(want)
        assert (np.diff(collocations.leading(keys, 16)) >= 0).all()
    big = np.array([3, 1 << 40])
    assert (collocations.unpacked(*collocations.packed(lanes[:2], big), width)[1] == big).all()


def test_small_filters_marks_and_memo_change_nothing(spark, scan_folder, monkeypatch):
    """Filters sent on at once, bins of their own and saturated marks give the same phrases."""
    _, docs = scan_folder
    monkeypatch.setattr(collocations, "MARK_BITS", 6)
    monkeypatch.setattr(collocations, "LEAST_BINS", 2)
    monkeypatch.setattr(collocations, "BIN_KEYS", 50)
    frame = spark.createDataFrame(docs, helpers.DOCS).repartition(6)
    assert counted(collocations.collocations(frame, least=30).collect()) == brute_phrases(docs, 30, 2000)


def test_phrases_of_a_very_long_text(spark):
    text = "one two three four five. " * 200_000
    rows = collocations.collocations(spark.createDataFrame([("en", text)], "lang string, text string")).collect()
    assert [(r.phrase, r.a, r.n) for r in rows] == [("one two three four", 200_000, 1_000_000),
                                                   ("two three four five", 200_000, 1_000_000)]


def test_empty_tables(spark, empty):
    for name in ("op11_license_join", "op12_merkle_windows", "op13_quotient_phrases"):
        out = queries.QUERIES[name](spark, empty)
        assert out.collect() == [] and len(out.columns) >= 7
