import random

from tabloom.llm import templates

from .common import ODD, documents, prose


def kept(spark, rows, **options):
    found = templates.drop_templates(documents(spark, rows), **options).collect()
    return {row.doc_id: row for row in found}


def test_recurring_lines_go_and_others_stay(spark):
    rows = [(i, prose(i, 60) + "\nRead more about it here\n" + prose(1000 + i, 30)) for i in range(8)]
    rows.append((50, "Read more about it elsewhere now\n" + prose(50, 40)))
    found = kept(spark, rows)
    for i in range(8):
        assert found[i].text == prose(i, 60) + "\n" + prose(1000 + i, 30)
        assert (found[i].n_dropped, found[i].n_lines) == (1, 9)
    assert found[50].n_dropped == 0


def test_variable_fields_with_and_without_digits(spark):
    names = ["anna", "berto", "carlo", "dana", "emil", "fina", "gero"]
    rows = [
        (i, f"Posted on the {i} of May by user{i}x at night\n{prose(i, 60)}\nWritten for the daily page by {name} in town")
        for i, name in enumerate(names)
    ]
    found = kept(spark, rows)
    assert all(found[i].text == prose(i, 60) and found[i].n_dropped == 2 for i in range(len(names)))
    # With too few texts nothing is a template.
    assert all(row.n_dropped == 0 for row in kept(spark, rows[:4]).values())


def test_lines_that_share_only_their_beginning_stay(spark):
    rows = [(i, f"In the town {' '.join(prose(i, 9, 99).split())}\n{prose(100 + i, 40)}") for i in range(9)]
    assert all(row.n_dropped == 0 for row in kept(spark, rows).values())


def test_copies_make_no_template_and_near_copies_stay_whole(spark):
    text = prose(1, 120)
    rows = [(i, text) for i in range(20)]
    assert all(row.n_dropped == 0 for row in kept(spark, rows).values())
    changed = [(i, text + f"\n{prose(200 + i, 10)}") for i in range(9)]
    assert all(row.n_dropped == 0 and row.text == dict(changed)[row.doc_id] for row in kept(spark, changed).values())


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    rows = templates.drop_templates(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, ODD))
    assert {(r["count"], r.n_dropped) for r in rows} == {("theirs", 0)}
    assert {r.n_lines for r in rows if r.text is None} == {0}
    assert templates.drop_templates(docs.limit(0)).count() == 0


def test_lines_of_numbers_stay(spark):
    draw = random.Random(9)
    lines = [[" ".join(f"{draw.uniform(0, 99):.1f}" for _ in range(3)) for _ in range(6)] for _ in range(10)]
    rows = [(i, "\n".join([prose(i, 40), *own])) for i, own in enumerate(lines)]
    rows += [(100 + i, f"{prose(500 + i, 60)}\nthis notice number {i} stands in every one of them") for i in range(8)]
    found = {r.doc_id: r for r in templates.drop_templates(documents(spark, rows)).collect()}
    for i, text in rows[:10]:
        assert found[i].text == text and found[i].n_dropped == 0
    for i, text in rows[10:]:
        assert found[i].n_dropped == 1 and "notice" not in found[i].text
