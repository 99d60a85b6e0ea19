import pytest

from tabloom.llm import sharding
from tabloom.llm.queries import op5_feistel_sharding

from .common import CHECKED, ODD, documents


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 16, 17, 500, 1001])
def test_permutation_is_a_bijection(spark, n):
    place = sharding.permuted(spark, sharding.F.col("id"), n, "seed")
    assert sorted(row.p for row in spark.range(n).select(place.alias("p")).collect()) == list(range(n))


def brute_permutation(value, n, seed):
    from hashlib import md5

    a, b = sharding.grid(n)
    draw = lambda half, i: int(md5(f"{seed}:{i}:{half}".encode()).hexdigest()[:13], 16)
    while True:
        left, right = value % a, value // a
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + draw(right, i)) % a
            else:
                right = (right + draw(left, i)) % b
        value = left + right * a
        if value < n:
            return value


def test_query_equals_brute_force(spark):
    rows = op5_feistel_sharding(spark, CHECKED).collect()
    order = sorted(rows, key=lambda r: (r.doc_id, r.size, r.text_crc32))
    for number, row in enumerate(order):
        place = brute_permutation(number, len(rows), "0")
        assert (row.shard, row.slot, row.law, row.grown_shard) == (place % 16, place // 16, "rows", None)


def test_odd_rows_keep_their_columns_and_fill_all_slots(spark):
    docs = documents(spark, ODD)
    rows = sharding.shard(docs, ["doc_id", "text"], 4).collect()
    assert len(rows) == len(ODD)
    assert {row["count"] for row in rows} == {"theirs"}
    for shard in range(4):
        slots = sorted(row.slot for row in rows if row.shard == shard)
        assert slots == list(range(len(slots)))
    assert sorted(row.row_number for row in rows) == list(range(len(ODD)))
    assert sharding.shard(docs.limit(0), ["doc_id"], 4).count() == 0


def test_result_does_not_depend_on_the_partitions(spark):
    docs = documents(spark, [(i, str(i)) for i in range(300)])
    found = [
        sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard(docs.repartition(n), ["doc_id"], 7).collect())
        for n in (2, 9)
    ]
    assert found[0] == found[1]
