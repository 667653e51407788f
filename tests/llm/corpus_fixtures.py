import random

import pytest

SYLLABLES = "ka lo mi ren tu sol va dri pe nox qua fi zem bor ul ti".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, copies, near copies, ties, and columns named like the operators' own."""
    base = prose(1, 200)
    near = base.replace(base.split()[50], "changed", 1)
    texts = {1: None, 2: "", 3: " \t\n ", 4: "one", 5: "One", 6: base, 7: base.replace(" ", "\n ", 3), 8: near, 9: near + " end",
             10: prose(2, 60_000), 11: "12 34 !!", 12: "Käse ÉTÉ naïve 中文 😀 “quoted”", 13: base, 14: prose(3, 5), 15: prose(4, 2100)}
    rows = [(i, t, "en" if i % 2 else None, "src", 0, True, 1.0, "x") for i, t in texts.items()]
    rows += [rows[5], (None, "no id", "en", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
                                       "score double, node string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
