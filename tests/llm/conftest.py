import pytest

# Rows with nulls, empty and blank texts, ties, repeated rows and non-ASCII words.
LONG = " ".join(f"w{i * i % 997}x{i % 13}" for i in range(400))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today " + LONG[:1500]),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today " + LONG[:1500]),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b\x0c\r "),
    (6, "two words"),
    (7, "two words"),
    (7, "two words"),
    (8, "Étè ß 𝔘 card 4111 1111 1111 1111 mail a.b@c.example.org ip 10.0.0.1 phone +1 (555) 010-9999"),
    (9, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
    (None, "a row without an id 10.0.0.1"),
    (10, LONG + " tail"),
    (11, "head " + LONG),
    (11, "same id, other text"),
    (12, "word " * 700),
    (13, "　wide blank  double\r\nbreak"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents with extra columns whose names operators use inside."""
    rows = [(d, t, i, 0.5, "x", None) for i, (d, t) in enumerate(TEXTS)]
    schema = "doc_id long, text string, key int, score double, text_key string, row string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
