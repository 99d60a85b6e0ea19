import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tabloom.llm import pieces
from tabloom.llm.queries import op8_agenda_pieces

from .common import CHECKED, ODD, documents, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_agenda_equals_the_library(library):
    draw = random.Random(1)
    parts = ["a", "b'", "'s", " ", "  ", "\n", "\t", "1", "é", "!", "字", "😀", "\xa0", "<s>", "\x00", "▁", "foo", " bar", "ﬁ", "ʘ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    texts += ["", "a" * 2000, "字" * 400, "ab" * 40 + " " + "x" * 33, prose(3, 800)]
    found = [np.frombuffer(x, "<u4").tolist() for x in pieces.PieceEncoder(PATH).encode(texts)]
    assert found == library.encode(texts, add_bos=True, add_eos=True)


def test_words_and_runs_have_the_same_agenda():
    encoder = pieces.PieceEncoder(PATH)
    words = ["▁" + w for w in prose(5, 300).split()] + ["▁", "▁▁▁", "\n", "é字", "▁ʘ!"]
    assert encoder.segment_words(words) == [encoder._ids(word) for word in words]


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text").collect()}
    for row in op8_agenda_pieces(spark, CHECKED).collect():
        ids = library.encode(texts[row.doc_id] or "", add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, library):
    docs = documents(spark, ODD)
    rows = pieces.encode(docs, PATH).collect()
    expected = [(key, library.encode(text or "", add_bos=True, add_eos=True)) for key, text in ODD]
    assert sorted(map(str, ((r.doc_id, r.ids) for r in rows))) == sorted(map(str, expected))
    assert {r.decoded for r in rows if r.doc_id in (1, 2)} == {""}
    assert pieces.encode(docs.limit(0), PATH).count() == 0
