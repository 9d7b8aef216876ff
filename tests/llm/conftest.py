import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table with the columns of ``documents``, in several partitions."""

    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


WORDS = [a + b for a in ("ba", "ko", "li", "mu", "ne", "ro", "sa", "ti") for b in ("ra", "n", "so", "l", "mi")]


@pytest.fixture
def prose():
    """Seeded text of n different-looking words."""
    import random

    def make(seed, n):
        pick = random.Random(seed)
        return " ".join(pick.choice(WORDS) + pick.choice(WORDS) for _ in range(n))

    return make
