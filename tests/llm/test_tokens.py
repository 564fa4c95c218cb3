"""Ids are those of the plainly loaded tokenizer, whatever the tables hold."""

import pyarrow as pa
import pytest

from kedai.llm.tokens import Encoder, Table

TEXTS = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "x<|endoftext|>y z",
    "  <|endoftext|>  \n",
    "<|endoftext|",
    "plain text\nhere",
    " two  blanks \n\n and a break ",
    "long" * 300 + " tail",
    None,
    "",
]


@pytest.mark.parametrize("limit", [1 << 24, 2000, 0])
def test_ids_are_the_tokenizers(tokenizer, limit):
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(tokenizer), Encoder(tokenizer, limit)
    for _ in range(2):
        found = encoder.documents(pa.array(TEXTS, pa.string()))
        expected = [plain.encode(text or "", add_special_tokens=False).ids + [0] for text in TEXTS]
        assert [ids.tolist() for ids in found] == expected


def test_tables_are_bounded_by_bytes():
    table = Table(4000, {"": b""})
    for number in range(300):
        table.learn([f"unit{number}"], [b"\0" * 8])
        assert table.find(["", f"unit{number}"]) == [b"", b"\0" * 8]
        assert table.size() <= 4000
    table.learn(["kept", "x" * 1000], [b"\1", b"\0" * 8])
    assert table.find(["kept", "x" * 1000]) == [b"\1", None]
    table.learn([f"many{number}" for number in range(500)], [b"\0" * 8] * 500)
    assert table.size() <= 4000 and table.find(["many1", ""]) == [None, b""]
