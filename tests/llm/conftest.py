import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, f long, row string, lines int, score_ double, kept boolean, size int, shard string, head_ int, id_ int, fp string, anchor long"
EXTRA = ("k", 1, "r", 2, 0.5, True, 3, "s", 4, 5, "fp", 6)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubdglmnrst") for _ in range(rng.randint(1, 8))) for _ in range(n))


def document(i, text, lang="en", source="s1"):
    return (i, text, lang, source, None if text is None else len(text), *EXTRA)


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and blank texts, a very long text, ties, exact repeats, near copies, symbols, other scripts."""
    base = words(1, 300)
    shared = words(2, 30)
    out = [
        document(1, None), document(2, ""), document(3, " \t\n "), document(4, "Ä b\x1cc\x85 d\n\n x", None, None), document(None, base), document(None, None, None, None),
        document(5, base), document(6, base.replace(base.split()[150], "changed", 1)), document(7, base.upper()), document(8, base), document(8, base),
        document(9, words(3, 20_000), "de", "s2"), document(10, "a" * 200), document(11, "x" + "a" * 120 + "y"), document(12, "один два три " * 20, "ru", "s3"),
    ]
    for i in range(20, 45):
        out.append(document(i, words(i, 60) + f"\n  {shared.upper()} \n" + words(i + 100, 40 if i % 2 else 8) + ("\nonly here\nonly here" if i == 30 else ""), "fr" if i % 3 else "en", f"s{i % 4}"))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(found):
    return sorted(map(str, found))
