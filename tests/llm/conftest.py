from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table out of (doc_id, text) pairs, or of whole rows."""

    def make(rows):
        whole = [
            row if len(row) == 5 else (*row, "en", "src", len(row[1] or "")) for row in rows
        ]
        return spark.createDataFrame(whole, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def tables():
    from pathlib import Path

    folder = Path("/root/testdata/sf0.01")
    if not folder.is_dir():
        pytest.skip("no test tables here")
    return str(folder)


def words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="session")
def odd_texts():
    """NULL, empty and white space, every kind of space and mark, special tokens, long words."""
    import random

    draw = random.Random(5)
    alphabet = (
        " \n\t\x0b\x0c\r\x1c\x85\xa0   　᠎​‍ab'sllTRE"
        "éÉßİΣςÅﬁǅ日本한١٣²½ⅷ_-.!|<>&%\\🙂़́̇"
    )
    texts = [None, "", " ", "\n\n", "a", "  a  ", "a b", "a  b", "it's we'll I'D they've",
             "<|endoftext|>", "a<|endoftext|>b <|endoftext", "<|startoftext|> x <|endoftext|>",
             "x" * 5000, "ab" * 3000, " ".join(["word"] * 4000), "क़.", "क़.", "İ.",
             "123 456abc 7,8", "日本語 テキスト", "a\x00b"]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 40))) for _ in range(600)]
    return texts
