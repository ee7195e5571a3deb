import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that for it was on are with as be by at this not from river stone cloud green light paper table house sound field".split()


def prose(seed: int, n: int, ends: bool = True) -> str:
    """n words in a fixed, seeded order with sentences and lines."""
    import random

    r = random.Random(seed)
    words = [r.choice(WORDS) + (r.choice(["", "", "er", "ing", "al"]) if r.random() < 0.5 else "") for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w.capitalize() if i % 11 == 0 else w)
        if ends and i % 11 == 10:
            out[-1] += ".\n" if i % 33 == 32 else "."
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        if extra:  # columns whose names an operator might use itself
            for c in ("kept", "id", "key", "bands", "row", "label", "words", "text_", "start"):
                from pyspark.sql import functions as F

                df = df.withColumn(c, F.lit("x"))
        return df

    return make
