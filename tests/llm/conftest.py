import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words without much repetition, the same for the same seed."""
    import random

    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(1000)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Null and empty texts, repeated rows and ids, ties, a long text, short ones, odd characters."""
    base = prose(1, 300)
    near = " ".join(w if k != 100 else "changed" for k, w in enumerate(base.split()))
    long = prose(2, 30_000)
    rows = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, "One  TWO"),
        (9, "x" * 5000), (10, "é ñ 中文 ½ ² " * 40), (11, long), (11, long), (11, prose(3, 50)), (None, prose(4, 60)),
        (None, prose(4, 60)), (12, "Released under the MIT License."), (13, prose(5, 700) + " " + base),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Columns of other tables' names, and names the operators use themselves.
    return docs.withColumns(
        {"row_no": F.lit(7), "n": F.lit("n"), "key": F.lit(None).cast("string"), "score": F.lit(-1), "item_id": F.lit(3)}
    )


@pytest.fixture(scope="session")
def empty(corpus):
    return corpus.where("false")
