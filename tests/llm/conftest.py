import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers  # noqa: E402


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Awkward documents and labels, random vectors."""
    import numpy as np

    docs = helpers.awkward_docs()
    labels = [(r[0], 0 if r[0] % 5 == 0 else 1, 1 if r[0] % 4 == 0 else 0) for r in docs[:124]]
    labels += [(None, 1, 1), (3, None, None), (5, 1, 0)]
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.standard_normal(8).astype("float32")], 0) for i in range(300)]
    same = vectors[7][1]
    vectors += [(i, same, 0) for i in range(300, 340)]
    vectors += [(400, None, 0), (401, [], 0), (402, [1.0, None] + [0.0] * 6, 0),
                (403, [float("nan")] + [0.0] * 7, 0), (404, [float("inf")] + [0.0] * 7, 0),
                (420, [0.0] * 8, None), (None, same, 0), (440, [1.0, 2.0], 0), (441, [2.0, 2.0], 0), vectors[0]]
    return helpers.write(spark, tmp_path_factory.mktemp("llm"), documents=(docs, helpers.DOCS),
                         labels=(labels, helpers.LABELS), embeddings=(vectors, helpers.EMBEDDINGS))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return helpers.write(spark, tmp_path_factory.mktemp("empty"), documents=([], helpers.DOCS),
                         labels=([], helpers.LABELS), embeddings=([], helpers.EMBEDDINGS))
