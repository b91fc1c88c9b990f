"""The piece-wise encoder against the library, by random texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from lifespans.llm import tokens

PARTS = [
    *"   \n\t.,()_-½²٣éÉ×÷ßÿĀɏʯʰñ—’“…ªºµж", "  ", "\r\n", "\x0b", "\x1c", "\x00", "\x85", "\xa0", " ", " ", " ", " ", " ", "　", "᠎", "​", "́", "­",
    "a", "the", "don't", "'s", "'ll", "'", "''", "1", "23", "中文", "!!", "😀", "<|endoftext|>", "<|",
]


@pytest.mark.parametrize(("segment", "kept"), [(8 << 20, 800_000), (16, 50)])
def test_pieces_give_the_ids_of_whole_texts(monkeypatch, segment, kept):
    monkeypatch.setattr(tokens, "SEGMENT", segment)
    r = random.Random(segment)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(r.choice([4, 12, 60])))) for _ in range(6000)] + ["", "x" * 40_000, " " * 5000 + "y"]
    own, library = tokens.Encoder("byte_bpe_50k.json", kept), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(0, len(texts), 500):
        some = texts[k : k + 500]
        for text, ids in zip(some, own.encode([t.encode() for t in some])):
            assert np.frombuffer(ids, np.uint16).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("options", [{"add_prefix_space": True}, {"add_prefix_space": False, "use_regex": False}])
def test_another_preparation_goes_whole(tmp_path, options):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.pre_tokenizer = pre_tokenizers.ByteLevel(**options)
    library.save(str(tmp_path / "other.json"))
    own = tokens.Encoder(str(tmp_path / "other.json"))
    assert not own.by_piece
    for text in ("word and more", " a  b\nc", ""):
        assert np.frombuffer(own.encode([text.encode()])[0], np.uint16).tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows_of_one_id_are_spread_and_stay_in_order(spark):
    """A third of all rows share an id and another third a null one; ranges split both."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text {k % 5}") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(tokens.token_files(df, file_tokens=40).collect(), key=lambda r: r.start)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys) and len(got) == 900
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert df.select(F.count("*")).first()[0] == 900
