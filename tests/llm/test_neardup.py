import glob
import random
from collections import defaultdict

from tabloom.llm import neardup
from tabloom.llm.queries import op2_order_minhash
from tabloom.sources import shared
from tabloom.sources.passengers import table

from .common import CHECKED, ODD, WORDS, documents, prose
from .test_alignment import distance


def changed(text, seed, edits):
    draw = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        at = draw.randrange(len(words))
        words[at : at + draw.randint(0, 1)] = [draw.choice(WORDS)]
    return " ".join(words)


def classes(rows):
    found = defaultdict(set)
    for row in rows:
        found[row.component_id].add(row.doc_id)
    return found


def test_copies_near_copies_and_clean_documents(spark):
    rows = [(i, prose(i, 150)) for i in range(40)]
    rows += [(100 + i, prose(0, 150)) for i in range(30)]  # exact copies
    rows += [(200 + i, changed(prose(1, 150), i, 4)) for i in range(300)]  # near copies, a large group
    rows += [(600 + i, prose(2, 60) + "\n" + prose(900 + i, 150)) for i in range(60)]  # a common passage
    found = neardup.near_duplicates(documents(spark, rows), block_texts=32).collect()
    assert len(found) == len(rows)
    by_class = classes(found)
    assert by_class[0] == {0, *range(100, 130)}
    assert by_class[1] == {1, *range(200, 500)}
    assert all(len(members) == 1 for first, members in by_class.items() if first > 1)
    assert sum(row.kept for row in found) == len(by_class)
    assert all(row.kept == (row.doc_id == row.component_id) for row in found)


def test_neither_texts_nor_sketches_stay_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda spark: f"{tmp_path}")
    rows = [(i, prose(i % 50, 150)) for i in range(100)] + [(100 + i, changed(prose(i, 150), i, 3)) for i in range(50)]
    found = neardup.near_duplicates(documents(spark, rows))
    columns = [set(spark.read.parquet(path).columns) for path in glob.glob(f"{tmp_path}/tabloom-*/table-*")]
    assert columns and not any(names & {"sketch", "bags", "text"} for names in columns)
    assert sum(row.kept for row in found.collect()) == 50


def test_links_are_sensitive_to_order(spark):
    words = prose(1, 200).split()
    swapped = words[100:] + words[:100]
    found = neardup.near_duplicates(documents(spark, [(1, " ".join(words)), (2, " ".join(swapped))])).collect()
    assert {row.component_id for row in found} == {1, 2}


def test_recall_of_candidates_by_edit_similarity():
    sketcher = neardup.Sketcher(neardup.ENTRIES, neardup.WORDS)
    for similarity, least in ((0.9, 0.99), (0.85, 0.99), (0.82, 0.97), (0.8, 0.95)):
        found = 0
        for seed in range(200):
            draw = random.Random(seed)
            words = [f"w{i}" for i in range(300)]
            draw.shuffle(words)
            other = list(words)
            for at in draw.sample(range(300), round(300 * (1 - similarity))):
                other[at] = f"x{at}"
            if seed < 3:
                assert distance(words, other) <= 300 * (1 - similarity) + 1e-9
            found += bool(set(sketcher.sketch(" ".join(words))[0]) & set(sketcher.sketch(" ".join(other))[0]))
        assert found >= least * 200


def test_query_against_brute_force(spark):
    """Pairs with a shingle similarity of 0.8 share a class; classes hang together by edit similarity."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{CHECKED}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: r.component_id for r in op2_order_minhash(spark, CHECKED).collect()}
    assert set(found) == set(texts)
    words = {i: t.split() for i, t in texts.items()}
    shingles = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in words.items()}
    holders = defaultdict(list)
    for i, own in shingles.items():
        for shingle in own:
            holders[shingle].append(i)
    pairs = {(a, b) for ids in holders.values() for b in ids for a in ids if a < b}
    for a, b in pairs:
        common = len(shingles[a] & shingles[b])
        if common >= 0.8 * (len(shingles[a]) + len(shingles[b]) - common):
            assert found[a] == found[b]
    members = defaultdict(list)
    for i, first in found.items():
        members[first].append(i)
    for ids in members.values():
        if 1 < len(ids) <= 12 and max(len(words[i]) for i in ids) < 300:
            reached, rest = {ids[0]}, set(ids[1:])
            while rest:
                near = {
                    b for b in rest for a in reached
                    if distance(words[a], words[b]) <= 0.2 * max(len(words[a]), len(words[b]))
                }
                assert near
                reached |= near
                rest -= near


def test_odd_rows(spark):
    docs = documents(spark, [*ODD, (8, "two words"), (9, "two  words"), (None, None)])
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == len(ODD) + 3
    by_key = defaultdict(list)
    for row in found:
        by_key[row.doc_id].append((row.component_id, row.kept))
    assert by_key[1] == [(1, True)] and by_key[2] == [(1, False)]  # null and empty are equal
    assert sorted(by_key[4]) == [(4, False), (4, True)]  # repeated rows: exactly one stays
    assert by_key[9] == [(8, False)]
    assert sorted(by_key[None], key=str) == [(1, False), (None, True)]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_every_pair_of_edit_similarity_is_linked_and_no_other(spark):
    docs = table(spark, CHECKED, "documents").select("doc_id", "text").collect()
    known = {}
    texts = {row.doc_id: neardup.word_ids(row.text or "", known) for row in docs}
    by_length = sorted(texts, key=lambda key: len(texts[key]))
    label = {key: key for key in texts}

    def root(key):
        while label[key] != key:
            key = label[key]
        return key

    pairs = 0
    for at, one in enumerate(by_length):
        for other in by_length[at + 1 :]:
            longer = len(texts[other])
            if longer - len(texts[one]) > neardup.allowed(longer, 0.8):
                break
            if neardup.similar(texts[one], texts[other], 0.8, len(known) + 1):
                pairs += 1
                a, b = sorted((root(one), root(other)))
                label[b] = a
    assert pairs > 100
    for blocks in (neardup.BLOCK_TEXTS, 2):
        found = neardup.near_duplicates(table(spark, CHECKED, "documents"), block_texts=blocks)
        assert {r.doc_id: r.component_id for r in found.collect()} == {key: root(key) for key in texts}
