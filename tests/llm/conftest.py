import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for results or inside.
CLASHING = ("bits", "fingerprint", "component_id", "lang_pred", "score", "held_out", "has_letter", "recipe", "kept", "block", "rest", "body", "shard", "n_tokens", "n_bytes", "label", "id", "size")


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: plain, null, empty, blank, very long, repeated, with signs of all kinds."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abdeinorst") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(80))
    out += [f"first {passage} one", f"second {passage} two", passage * 3, out[0], out[0], out[1].replace(" ", "  ")]
    out += [None, "", None, "", " \n\t", "x", "x" * 30000, "ab" * 5000, " ".join(out[:40]) * 4]
    out += ["naïve café's 漢字 ١٢٣ don't we'll '", "a\x00b\x0bc  　 d", "<|endoftext|> a<|endoftext|>b", "!!! ??? 123"]
    return list(enumerate(out))


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With a repeated row, a null id, and columns whose names operators use."""
    from pyspark.sql import functions as F

    rows = [(i, x, "en", "s", None) for i, x in [*texts, texts[3]]] + [(None, "no id here", "en", "s", None)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({x: F.lit("clash") for x in CLASHING}).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)
