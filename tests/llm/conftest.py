import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results or on the way.
        *[T.StructField(c, T.StringType()) for c in ("row", "kept", "keep_id", "_slot", "sig", "start", "n", "shard", "score", "paths")],
    ]
)


def awkward_rows(seed: int = 4) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(seed)
    vocabulary = [rng.choice(["", "é", "ß", "日"]) + "".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(400)]

    def prose(n: int) -> str:
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\n", "  ", "\t", ". ", ", "]) for _ in range(n))

    passage, boiler = prose(90), prose(8)
    bases = [prose(rng.randint(120, 260)) for _ in range(6)]
    texts: list[str | None] = [None, "", " \n\t ", "one", "One", "two words", "two words", None, "$$$ ### ***", "é", "a b"]
    texts += bases + [bases[0], bases[0], bases[1] + " end", boiler + bases[2]]
    for base in bases[:4]:
        words = base.split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [prose(60) + passage + prose(60) for _ in range(5)] + [passage, passage + passage]
    texts += ["la la la la la la la la la la la la", "x" * 3_000, ("ab " * 900).strip(), prose(4_000)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [(None, bases[0]), (None, prose(70)), (None, None), rows[12], rows[12], (rows[13][0], bases[4]), (rows[-1][0], "same id")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows_in():
    return awkward_rows()


@pytest.fixture(scope="session")
def awkward(spark, rows_in):
    return spark.createDataFrame([(i, t, "en", None, None, *["x"] * 10) for i, t in rows_in], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
