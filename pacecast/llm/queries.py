"""The registered queries of the training-data operators.

Each applies its operator, with production parameters, to a whole table and
derives the result columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix the sources to weights 3, 1, 2 over 150% of all words; how often each document is taken."""
    from .mixing import mix

    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found by inner product for every 20th vector, by a hash-prefix forest."""
    from .lsh_forest import approximate_nearest

    return approximate_nearest(table(spark, sf_dir, "embeddings"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; the digests of ids and decoded bytes."""
    import public_tokenizers as tokenizers

    from .bpe import encode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN,
                 keep=["doc_id"], decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-count and subword-lattice scores of every text; learned where crc32(doc_id) mod 10 is not 0."""
    import public_tokenizers as tokenizers

    from .lattice import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fold(F.col("doc_id"), 10) > 0, tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_naive_bayes_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and posterior of every text; learned where crc32(doc_id) mod 3 is 0 or 2."""
    from . import langid

    docs = table(spark, sf_dir, "documents")
    part = fold(F.col("doc_id"), 3)
    model = langid.train(docs, learn=part.isin(0, 2))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (~part.isin(0, 2)).alias("held_out"), "lang_pred", "score")


def op6_kd_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products for every 20th vector, exactly, by KD-trees."""
    from .kdtree import exact_nearest

    return exact_nearest(table(spark, sf_dir, "embeddings"))


def op7_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text; learned from labels where crc32(doc_id) mod 3 is 0 or 2."""
    from . import quality

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    part = fold(F.col("doc_id"), 3)
    model = quality.train(docs, labels, part.isin(0, 2))
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (~part.isin(0, 2)).alias("held_out"), "score", "predicted")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text: counts and digest of the base kinds, all spans."""
    from . import pii

    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"))


def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets are 80% alike."""
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op10_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; learned from labels where crc32(doc_id) mod 5 is not 0."""
    from . import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    part = fold(F.col("doc_id"), 5)
    model = toxicity.train(docs, labels, part > 0)
    out = toxicity.score(docs.select("doc_id", "text"), model)
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))))
    return out.select("doc_id", (part <= 0).alias("held_out"), "score", "predicted", spans.alias("spans"))


def op11_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every text."""
    from .licenses import scan

    found = scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    starts = F.col("places.start")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score")


def op12_merkle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle tree of every document; every third is checked with its letters lower-cased."""
    from . import merkle

    changed = F.when(fold(F.col("doc_id"), 3) == 0, F.translate("text", merkle.UPPER, merkle.LOWER))
    out = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                          tampered={"text": changed.otherwise(F.col("text"))})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_quotient_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 strongest phrases of two to four words."""
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_lsh_forest": op2_lsh_forest,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_lattice_lm": op4_lattice_lm,
    "op5_naive_bayes_lang": op5_naive_bayes_lang,
    "op6_kd_tree": op6_kd_tree,
    "op7_pairwise_quality": op7_pairwise_quality,
    "op8_pii": op8_pii,
    "op9_hyperminhash": op9_hyperminhash,
    "op10_crf_toxicity": op10_crf_toxicity,
    "op11_license_join": op11_license_join,
    "op12_merkle_windows": op12_merkle_windows,
    "op13_quotient_phrases": op13_quotient_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op6_kd_tree": """
        WITH whole AS (
            SELECT CAST(vec_id AS BIGINT) AS vec_id,
                   list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
        rows AS (SELECT vec_id, min(vec) AS vec FROM whole GROUP BY vec_id),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT)
                       AS score
            FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
            WHERE q.vec_id % 20 = 0)
        SELECT query_id,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 20""",
    "op9_hyperminhash": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+'), []) AS w
            FROM documents),
        sets AS (
            SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(
                range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
            FROM worded),
        classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
        inverted AS (SELECT rep, n, unnest(s) AS shingle FROM classes),
        links AS (
            SELECT a.rep AS a, b.rep AS b
            FROM inverted a JOIN inverted b ON a.shingle = b.shingle AND a.rep <> b.rep
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.rep, b.rep, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reached AS (
            SELECT rep AS node, rep AS root FROM classes
            UNION
            SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.node),
        rooted AS (SELECT node, min(root) AS component FROM reached GROUP BY node)
        SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles,
               coalesce(r.component, d.doc_id) AS component_id,
               d.doc_id = coalesce(r.component, d.doc_id) AS kept
        FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN rooted r ON r.node = c.rep""",
    "op12_merkle_windows": r"""
        WITH RECURSIVE fields AS (
            SELECT doc_id, lang, source, n_chars, text,
                   CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
                            list_prepend(4294967295::BIGINT, list_transform(
                                string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                            lambda crc, byte: list_reduce(
                                [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0
                        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        ELSE text END AS changed
            FROM documents),
        hashed AS (
            SELECT doc_id, lang, lead || coalesce(strlen(text) || ':' || text, '-') AS plain,
                   lead || coalesce(strlen(changed) || ':' || changed, '-') AS now
            FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                         || coalesce(strlen(source) || ':' || source, '-')
                         || coalesce(strlen(lang) || ':' || lang, '-')
                         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS lead FROM fields)),
        leaves AS (
            SELECT doc_id, coalesce('1' || lang, '0') AS grp, sha256(plain) AS leaf, sha256(now) AS now
            FROM hashed),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY grp) AS n
            FROM leaves),
        tree AS (
            SELECT grp, 0 AS lvl, pos, n, leaf AS node FROM placed
            UNION ALL
            SELECT grp, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
            FROM tree WHERE n > 1 GROUP BY grp, lvl, pos // 8, n),
        subroots AS (
            SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n
            FROM tree WHERE n = 1),
        top AS (
            SELECT 0 AS lvl, pos, n, subroot AS node FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
            FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n),
        sides AS (
            SELECT t.grp, t.lvl, t.pos, coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < t.pos), '') AS b,
                   coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > t.pos), '') AS a
            FROM tree t JOIN tree s ON s.grp = t.grp AND s.lvl = t.lvl AND s.pos // 8 = t.pos // 8
            WHERE t.n > 1 GROUP BY t.grp, t.lvl, t.pos),
        top_sides AS (
            SELECT t.lvl, t.pos, coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < t.pos), '') AS b,
                   coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > t.pos), '') AS a
            FROM top t JOIN top s ON s.lvl = t.lvl AND s.pos // 8 = t.pos // 8
            WHERE t.n > 1 GROUP BY t.lvl, t.pos),
        climbed AS (
            SELECT doc_id, leaf, grp, 0 AS lvl, pos, '' AS proof, now AS own FROM placed
            UNION ALL
            SELECT c.doc_id, c.leaf, c.grp, c.lvl + 1, c.pos // 8, c.proof || s.b || s.a,
                   sha256(s.b || c.own || s.a)
            FROM climbed c JOIN sides s ON s.grp = c.grp AND s.lvl = c.lvl AND s.pos = c.pos),
        grouped AS (
            SELECT c.*, r.subroot, r.pos AS spot FROM climbed c JOIN subroots r ON r.grp = c.grp
            QUALIFY c.lvl = max(c.lvl) OVER (PARTITION BY c.grp)),
        ended AS (
            SELECT doc_id, leaf, subroot, 0 AS lvl, spot AS pos, proof, own FROM grouped
            UNION ALL
            SELECT e.doc_id, e.leaf, e.subroot, e.lvl + 1, e.pos // 8, e.proof || s.b || s.a,
                   sha256(s.b || e.own || s.a)
            FROM ended e JOIN top_sides s ON s.lvl = e.lvl AND s.pos = e.pos)
        SELECT e.doc_id, e.leaf, e.subroot, t.node AS root, sha256(e.proof) AS proof_sha256, e.own AS folded_root,
               e.own = t.node AS verified
        FROM ended e, (SELECT lvl, node FROM top WHERE n = 1) t
        WHERE e.lvl = t.lvl""",
    "op13_quotient_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
        grams AS (
            SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS g
            FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size)),
        often AS (SELECT lang, size, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
        cuts AS (
            SELECT c.lang, c.g, c.size, c.f AS a, k, l.f AS l, r.f AS r,
                   CAST((2000000::HUGEINT * c.f) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1) c
            JOIN often l ON l.lang = c.lang AND l.size = k AND l.g = c.g[1:k]
            JOIN often r ON r.lang = c.lang AND r.size = c.size - k AND r.g = c.g[k + 1:c.size]),
        best AS (
            SELECT * FROM cuts
            QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
        inner_parts AS (
            SELECT lang, g[s:s + z - 1] AS g, f
            FROM (SELECT lang, g, f, z, unnest(range(1, size - z + 2)) AS s
                  FROM often, (SELECT unnest([2, 3]) AS z) WHERE size > z)),
        longer AS (SELECT lang, g, max(f) AS most FROM inner_parts GROUP BY lang, g)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC,
                                          array_to_string(b.g, ' ')) AS rank,
               array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, t.n, b.score
        FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN longer o ON o.lang = b.lang AND o.g = b.g
        WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * b.a
        QUALIFY rank <= 2000""",
}


def _license_sql() -> str:
    """Every block against every template, by the sets."""
    from . import licenses as li

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    templates = ", ".join(f"({k}, {quoted(label)}, [{', '.join(map(quoted, li._template_words(text)))}])"
                          for k, (label, text) in enumerate(li.TEMPLATES))
    phrases = ", ".join(f"({quoted(label)}, [{', '.join(map(quoted, phrase.split()))}])"
                        for phrase, label in li.PHRASES.items())
    pattern, half = li.WORD, li.BLOCK_WORDS // 2
    return rf"""
        WITH plain AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS text
            FROM documents),
        worded AS (SELECT r, doc_id, text, regexp_extract_all(text, '{pattern}') AS w FROM plain),
        phrases AS (SELECT * FROM (VALUES {phrases}) p(label, p)),
        starts AS (
            SELECT r, label, s - 1 AS start
            FROM (SELECT r, w, label, p, unnest(range(1, len(w) - len(p) + 2)) AS s
                  FROM worded, phrases WHERE list_has_all(w, p))
            WHERE w[s:s + len(p) - 1] = p),
        base AS (
            SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                   list_distinct(list(label)) AS labels
            FROM starts GROUP BY r),
        parts AS (
            SELECT r, regexp_extract_all(part, '{pattern}') AS w
            FROM (SELECT r, unnest(string_split_regex(text, '{li.BLOCK_END}')) AS part FROM plain)),
        blocks AS (
            SELECT r, w FROM parts WHERE len(w) <= {li.BLOCK_WORDS}
            UNION ALL
            SELECT r, w[s + 1:s + {li.BLOCK_WORDS}]
            FROM (SELECT r, w, unnest(range(0, len(w) - {half}, {half})) AS s FROM parts
                  WHERE len(w) > {li.BLOCK_WORDS})),
        templates AS (SELECT * FROM (VALUES {templates}) t(k, label, t)),
        block_words AS (
            SELECT r, b, unnest(list_distinct(w)) AS word FROM (SELECT *, row_number() OVER () AS b FROM blocks)),
        template_words AS (SELECT k, label, len(t) AS size, unnest(t) AS word FROM templates),
        matches AS (
            SELECT r, label, count(*) AS shared, size
            FROM block_words JOIN template_words USING (word) GROUP BY r, b, k, label, size
            HAVING 10 * count(*) >= {round(10 * li.SHARE)} * size),
        best AS (SELECT r, list_distinct(list(label)) AS labels, max(shared / size) AS score FROM matches GROUP BY r)
        SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base,
               b.first_word, b.last_word,
               coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))),
                               ',') AS labels,
               CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.score, 0.0::DOUBLE) END AS score
        FROM worded w LEFT JOIN base b ON b.r = w.r LEFT JOIN best m ON m.r = w.r"""


ORACLE_SQL["op11_license_join"] = _license_sql()
