import random

import pytest

#: Texts with every awkward case: null, empty, blank, copies, near copies, ties, long, odd characters.
WORDS = "sol hav vind berg skog snö regn sten väg hus båt katt hund fågel fisk träd blad rot gren frö".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def awkward_texts():
    rng = random.Random(11)
    base = sentence(rng, 120).split()
    texts = [None, "", "   \n\t", "ett", "ett två tre", "Ett Två Tre", "ÅÄÖ åäö", "A b c", "a\x0bb\x0cc", "\x00 nul", "hej <|endoftext|> DON'T 123", "𝔘nicode 👩‍👩‍👧 é é"]
    texts += [" ".join(base), " ".join(base).upper(), " ".join(base) + "\n" + " ".join(base)]
    for k in (1, 3, 6, 12, 20):
        near = list(base)
        for i in rng.sample(range(len(near)), k):
            near[i] = "nytt" + str(rng.randint(0, 999))
        texts.append(" ".join(near))
    texts += [sentence(rng, rng.randint(1, 80)) for _ in range(40)]
    texts += [sentence(rng, 30_000), "lång" * 20_000, "rad ett\nrad två\nrad ett\n\n\nrad ett", "### $$$ %%% " * 30]
    return texts


@pytest.fixture(scope="session")
def texts():
    return awkward_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with a repeated row, a null identifier and columns whose names clash with those of the operators."""
    rows = [(i, t, ["en", "de", None][i % 3], [None, "a", "b"][i % 3], "x", 1) for i, t in enumerate(texts)]
    rows += [rows[12], (None, "utan id", "en", "a", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, size int").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
