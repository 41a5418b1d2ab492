import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _row int, n_words string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def documents():
    """Documents with every awkward case; columns beyond the usual ones have names that operators use."""
    texts = {i: prose(i, 60 + i) for i in range(20)}
    base = texts[3].split(" ")
    texts[20] = texts[3]  # exact copy
    texts[21] = " ".join([*base[:60], "changed"])  # near copies
    texts[22] = " ".join(["CHANGED", *base[1:]])
    texts[23] = texts[4][:200] + " " + texts[5]
    texts[24] = None
    texts[25] = ""
    texts[26] = " \n\t "
    texts[27] = "one two"
    texts[28] = "one two"
    texts[29] = prose(29, 30000)  # long
    texts[30] = texts[29] + " tail"
    texts[31] = ("line of words here\n" * 40).strip()
    texts[32] = prose(32, 80).replace(" ", " ### ")
    texts[33] = prose(33, 50) + " " + prose(99, 20) + "\n\n" + prose(34, 50)
    texts[34] = prose(35, 30) + "\n" + prose(99, 20) + " " + prose(36, 30)
    texts[35] = "\u00e9\u00df \u0130 \u00a0x\u00a0\u00a0 y \x1c\x1d z <|endoftext|> w"
    texts[36] = texts[6] + " " + texts[6]
    return texts


def rows(texts):
    langs, sources = ("en", "de", None), ("a", "b", None, "a")
    return [
        (i, t, langs[i % 3], sources[i % 4], len(t or ""), i % 2 == 0, 7, "x") for i, t in texts.items()
    ]


@pytest.fixture(scope="session")
def texts():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """As `docs`, with repeated rows, rows without doc_id and one doc_id on two texts."""
    extra = [
        (None, texts[3], "en", "a", 1, True, 7, "x"),
        (None, None, None, None, None, None, None, None),
        (2, texts[2], "de", "b", 1, True, 7, "x"),
        (5, texts[7], "en", "a", 1, True, 7, "x"),
    ]
    return spark.createDataFrame(rows(texts) + extra, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
