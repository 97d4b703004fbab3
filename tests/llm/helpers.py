"""Small tables with every awkward case, written once per test that needs them."""
import os
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
EMBEDDINGS = "vec_id long, embedding array<float>, label int"
SYLLABLES = {"en": ["th", "on", "ea", "re", "ing", "st"], "fr": ["eau", "oi", "que", "tré", "ment", "ç"]}


def words(rng, n, lang="en"):
    return [("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))) for _ in range(n)]


def awkward_docs():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows."""
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lang = "fr" if i % 3 == 0 else "en"
        text = " ".join(words(rng, rng.randint(3, 60), lang))
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
    base = " ".join(words(rng, 80))
    near = base.split()
    near[40] = "changed"
    rows += [(200, base, "en", "src1", 1), (201, base, "en", "src1", 1), (202, " ".join(near), "en", "src2", 1),
             (203, base.upper(), "en", "src2", 1)]
    rows += [(300, None, "en", "src0", None), (301, "", "en", None, 0), (302, " \t\n ", None, None, 4),
             (303, "solo", "en", "src0", 4), (None, "with out id", "en", "src0", 11),
             (304, "1234 5678 +-*/", None, "src3", 14), (305, "x" * 30_000, "en", "src3", 30_000),
             (306, " ".join(words(rng, 6_000)), "en", "src3", None)]
    rows += [(307, "a repeated row here", "en", "src0", 19)] * 3
    return rows


def write(spark, folder, **tables):
    """Write tables (rows, schema) as <name>.parquet; the folder's path."""
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))
    return str(folder)
