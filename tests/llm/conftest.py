import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 string, id string"


def make_texts(seed=7, n=60):
    """Prose with copies, near copies, shared passages, repeated lines and odd rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéioß") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = prose(70)
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not texts:
            texts.append("\n".join(prose(rng.randrange(5, 60)) for _ in range(rng.randrange(1, 6))))
        elif kind == 1:
            texts.append(texts[-1])
        elif kind == 2:
            texts.append(texts[-1].replace(" ", "  ", 1).upper() if i % 4 else texts[-1] + " " + prose(1))
        elif kind == 3:
            texts.append(prose(rng.randrange(0, 60)) + "\t" + passage + "\n" + prose(30))
        elif kind == 4:
            texts.append("\n".join([prose(9)] * 5 + [prose(40)]))
        else:
            texts.append(prose(rng.randrange(1, 4)))
    return [*texts, None, "", "  \n\t", None, "one", "x " * 3000, passage * 3, passage * 3]


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Ids in another order than rows, one row twice, a null id, a null language and clashing extra columns."""
    n = len(texts)
    rows = [((i * 37) % n, t, ["en", "de", None][i % 3], f"src{0 if i % 3 == 0 else i % 5}", len(t or ""), "extra", "clash") for i, t in enumerate(texts)]
    rows += [rows[2], (None, texts[0], "en", None, 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
