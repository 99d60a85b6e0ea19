import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tabloom.llm import packing
from tabloom.llm.queries import op4_bounded_space_packing

from .common import CHECKED, ODD, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["a  b\n c\t\x0b", "<|endoftext|> x <|endoftext|>", "don't  we'll　字 😀\x1c\x85", " lead", "trail \n", "'s 's"]


def exact(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_encoder_equals_the_library():
    texts = [*TRICKY, prose(1, 500), ""]
    found = packing.ByteEncoder(PATH).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [exact(t)[:-1] for t in texts]


def test_long_runs_of_blanks_inside_a_text(spark):
    texts = [f"a word{run}and {prose(i, 20)}" for i, run in enumerate((" " * 2_000_000, "\n" * 2_000_000, " \n" * 1_000_000))]
    pieces = packing.pack(documents(spark, [*enumerate(texts), (9, "short")]), PATH).collect()
    for doc, text in [*enumerate(texts), (9, "short")]:
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == exact(text)


def test_the_compared_text_is_not_the_shortest_one():
    encoder = packing.ByteEncoder(PATH)
    library, seen = encoder.by_library, []
    encoder.by_library = lambda text: seen.append(text) or library(text)
    for i in range(20):
        encoder.encode(["", *[prose(100 * i + j, 30 + j) for j in range(10)]])
    assert len({len(text.split()) for text in seen}) > 3


def check_sequences(pieces, window):
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return 1 - sum(p.length for p in pieces) / window / len(sequences)


def test_query_covers_every_id_once_with_little_padding(spark):
    pieces = op4_bounded_space_packing(spark, CHECKED).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text").collect()}
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids, at = np.asarray(exact(texts[doc]), dtype="<u4"), 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    assert check_sequences(pieces, packing.WINDOW) < 0.02


def test_leftovers_of_many_tasks_are_merged(spark):
    docs = documents(spark, [(i, prose(i, 1 + i % 40)) for i in range(600)]).repartition(24)
    pieces = packing.pack(docs, PATH, window=256, open_windows=4).collect()
    assert sum(p.start == 0 for p in pieces) == 600
    assert check_sequences(pieces, 256) < 0.08


def test_open_windows_are_bounded_and_best_fit():
    windows = packing.OpenWindows(10, 2)
    assert [windows.place(n) for n in (6, 7, 3, 4, 9, 8)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    assert windows.place(5) == (4, 0)  # none fits: the fullest is emitted
    assert [room for room, _ in windows.rooms] == [2, 5]


def test_odd_rows(spark):
    docs = documents(spark, [*ODD, *enumerate(TRICKY, 100)])
    pieces = packing.pack(docs, PATH).collect()
    assert sum(p.start == 0 for p in pieces) == len(ODD) + len(TRICKY)
    assert [(p.length, p.ids) for p in pieces if p.doc_id == 1] == [(1, b"\0\0\0\0")]
    check_sequences(pieces, packing.WINDOW)
    assert packing.pack(docs.limit(0), PATH).count() == 0
