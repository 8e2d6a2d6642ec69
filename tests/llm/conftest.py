import random

import pytest

from pyspark import cloudpickle

TOKENIZERS = "/opt/tokenizers"


@pytest.fixture(scope="session", autouse=True)
def by_value():
    import millrace
    cloudpickle.register_pickle_by_value(millrace)


@pytest.fixture(scope="session")
def docs(spark):
    """A small corpus with nulls, ties, copies, near copies, periodic and long texts, clashing columns."""
    rng = random.Random(4)
    words = ["the", "of", "Wörter", "été", "and", "to", "x#", "Ünder", "ab", "cde", "is", "in", "mañana", "zz", "qrs"]
    line = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, passage = [line(rng.randrange(20, 120)) for _ in range(40)], line(60)
    texts = [None, "", "   \n\t ", "one", "two words", "a " * 400, "ab" * 700, "é" * 300, line(9000)]
    texts += base + base[:10] + base[:3]
    for text in base[:20]:
        parts = text.split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [f"{line(30)} {passage} {line(10)}" for _ in range(12)] + [f"{line(12)}\n" * 6 for _ in range(4)]
    texts += ["### !! *** " * 30, "the cat " + line(200) + " <|endoftext|>"]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{min(i % 7, 3)}", i % 5, "taken") for i, t in enumerate(texts)]
    rows.append(rows[12])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, node long, quality_report string"
                                 ).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.filter("false")
