import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barlab.llm import bpe
from barlab.llm.queries import op6_bpe, table, tokenizer_path
from conftest import SF001
from llm_rows import awkward, docs, empty

LIBRARY = Tokenizer.from_file(tokenizer_path())
MODEL = bpe.loaded(open(tokenizer_path(), encoding="utf-8").read())


def same(text: str) -> None:
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    ids = MODEL.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert MODEL.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_as_the_library(text):
    same(text)


def test_repeats_spaces_and_special_tokens_as_the_library():
    rnd = random.Random(3)
    pool = ["a", "aa", " the", "  ", "\n", "\t", "\x85", " ", "é", "中", "😀", "'s", "'LL", "1", "٣", "<|endoftext|>", "<|endo", "\x00", "ing"]
    for _ in range(3000):
        same("".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))))
    same("ab" * 4000)


def test_pairs_are_compatible_exactly_if_the_library_keeps_them():
    rnd = random.Random(5)
    for _ in range(3000):
        a, b = rnd.randrange(50256), rnd.randrange(50256)
        try:
            (MODEL.token[a] + MODEL.token[b]).decode("ascii")
        except UnicodeDecodeError:
            continue
        text = (MODEL.token[a] + MODEL.token[b]).decode()
        if len(MODEL.pieces(text)) == 1:
            assert MODEL.compatible(a, b) == (LIBRARY.encode(text, add_special_tokens=False).ids == [a, b])


def test_table_matches_the_library(spark):
    import hashlib

    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    for r in op6_bpe(spark, SF001).collect():
        want = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_rows_and_separate_decoding(spark):
    rows = bpe.encode(docs(spark), tokenizer_path())
    back = bpe.decode(rows, tokenizer_path()).collect()
    assert len(back) == len(awkward())
    for r in back:
        assert r.decoded == (r.text or "") and r.n_tokens == len(r.ids) // 4 and r.kept == 1
    assert bpe.encode_and_decode(empty(spark), tokenizer_path()).count() == 0


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.ByteBPE(open(tokenizer_path().replace("byte_bpe_50k", "word_bpe_49k"), encoding="utf-8").read())
