import pytest



@pytest.fixture(scope="session")
def texts(spark):
    """Nulls, empty and long texts, repeated rows, a null id and columns whose names clash with inner ones."""
    import random

    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("an", "er", "ou", "it")]

    def prose(n):
        return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))

    passage = prose(60)
    base = prose(300)
    near = base.split()
    near[150] = "changed"
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, prose(40) + " " + passage), (7, prose(30) + " " + passage + " " + prose(9)),
        (8, prose(20_000)), (9, "one"), (9, "one"), (None, prose(80)), (11, "!!! ..."), (12, passage), (13, "Ünï çödé, " + prose(70)), (14, "x" * 5000),
    ]
    return spark.createDataFrame(
        [(i, t, 0, 1, 2, "en", "s") for i, t in rows], "doc_id long, text string, row int, id int, key int, lang string, source string"
    )
