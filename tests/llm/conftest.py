import random

import pytest

VOCABULARY = [f"w{i}" for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def rows_of(seed=3, n=60):
    """Documents with exact and near copies, shared passages, nulls, empty and very long texts, repeated rows and odd white space."""
    rng, out = random.Random(seed), []
    passage = " ".join(words(rng, 30))
    for i in range(n):
        kind, text = i % 10, " ".join(words(rng, rng.randint(0, 120)))
        if kind == 1 and out[-1][1]:
            text = out[-1][1]
        elif kind == 2 and out[-2][1]:
            own = out[-2][1].split()
            own[len(own) // 2 : len(own) // 2 + 1] = ["changed"]
            text = " ".join(own)
        elif kind == 3:
            text = f"{text}\n{passage}\t{text[:20]}"
        elif kind == 4:
            text = rng.choice([None, "", " \n", "one two", "One  TWO three four", "É é ü ßtraße"])
        elif kind == 5:
            text = passage.upper() + "  " + text
        out.append((i * 3 - 9, text, "en", rng.choice(["b", "a", None, "ä", ""]), len(text or "")))
    out.append(out[7])
    out.append((None, passage, None, None, 5))
    out.append((1001, " ".join(words(rng, 30_000)), "en", "a", 0))
    out.append((1002, "x" * 300_000, "en", "a", 0))
    return out


@pytest.fixture(scope="session")
def rows():
    return rows_of()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows, over several partitions, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = ("n", "rep", "band", "h", "size", "grp", "label", "g", "hashes", "kept", "shard", "rank", "comp", "copies", "set", "sig", "doc", "id")
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(f"extra {c}") for c in extra}).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")


def thue_morse(n):
    """Two different words of n letters, n a power of two, over ab: polynomial hashes modulo a power of two don't tell them apart."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.fixture(params=[1024, 2048])
def alike_words(request):
    return thue_morse(request.param)
