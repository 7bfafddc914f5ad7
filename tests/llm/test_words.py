"""Words and tokens found on arrays against plain Python."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contentloom.llm.common import LETTERED, SPACED, Texts, Words, shingle_sets
from contentloom.llm.tokens import Encoder, Vocabulary

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
KINDS = {
    r"[^\x20\x09-\x0D]+": SPACED,
    r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+": LETTERED,
}
SIGNS = st.text(alphabet="abAB é\n\t\x0b'.,09漢ß", max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | SIGNS, max_size=6))
@pytest.mark.parametrize("pattern", list(KINDS))
def test_words_and_hashes(pattern, rows):
    texts = Texts(pa.array(rows, pa.string()))
    words = Words(texts, KINDS[pattern])
    found = [re.findall(pattern, (r or "").translate(LOWER)) for r in rows]
    assert np.diff(words.first).tolist() == [len(w) for w in found]
    names = {}
    for word, name in zip([w for f in found for w in f], words.hashes.tolist()):
        assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=30), max_size=4), st.integers(1, 4))
def test_shingles(rows, k):
    sets = list(shingle_sets(Words(Texts(pa.array(rows, pa.string())), SPACED), k))
    for row, found in zip(rows, sets):
        words = row.split()
        expected = {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()
        assert len(found) == len(expected)


@pytest.fixture(scope="module")
def encoder():
    path = public_tokenizers.path
    return Encoder(Vocabulary(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")), slots=1 << 10)


def encoded(encoder, rows):
    out = []
    for _, ids, bounds in encoder.batches([pa.RecordBatch.from_pydict({"text": pa.array(rows, pa.string())})], "text", 1):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def test_tokens_are_those_of_the_library(encoder):
    random.seed(3)
    signs = list("abTs'tremvlLd  \n\n\t\r,.!?09½²éÉßñ-—漢  \x85\x1c") + ["'s", "'re", "'ll", " 's", "  ", "<|endoftext|>"]
    rows = ["".join(random.choices(signs, k=random.randrange(30))) for _ in range(6000)]
    rows += [a + chr(i) + b for i in range(0x260) for a in ("", "a", " ") for b in ("", "a", " b")]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row, ids in zip(rows, encoded(encoder, rows)):
        assert ids == library.encode(row, add_special_tokens=False).ids + [1], row


def test_no_text_is_the_end_alone(encoder):
    assert encoded(encoder, [None, ""]) == [[1], [1]]
