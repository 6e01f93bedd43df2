import hashlib
from collections import Counter

import pytest

from tillwarden.llm import shards


def brute(names, slots):
    table, at = [None] * slots, dict.fromkeys(names, 0)
    while None in table:
        for n in names:
            offset, step = shards.preferences(n, slots)
            while True:
                slot = (offset + at[n] * step) % slots
                at[n] += 1
                if table[slot] is None:
                    table[slot] = n
                    break
            if None not in table:
                break
    return table


def test_table_is_that_of_a_plain_loop():
    names = ["a", "b", "c", "d"]
    assert [names[i] for i in shards.fill(names, 101)] == brute(names, 101)


def test_balance_weights_and_few_moves():
    names = [f"s{i}" for i in range(20)]
    table = shards.fill(names, 10_007)
    sizes = Counter(table.tolist())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    less = shards.fill(names[:-1], 10_007)
    stay = sum(a == b for a, b in zip(table, less, strict=True) if a != 19)
    assert stay > 0.85 * (10_007 - sizes[19])
    heavy = Counter(shards.fill({"a": 3, "b": 1}, 1009).tolist())
    assert heavy[0] == pytest.approx(3 * heavy[1], abs=4)
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8), ({"a": 0}, 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            shards.fill(*bad)


def test_rows_go_where_the_table_says(spark, documents, tmp_path):
    names = ["a", "b", "c"]
    docs = documents([(i, "t") for i in range(50)] + [(None, None), (7, "t")])
    found = shards.place(docs, "doc_id", names, 101).collect()
    assert len(found) == 52
    table = brute(names, 101)
    for r in found:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    shards.write_shards(docs, str(tmp_path / "out"), "doc_id", names, 101)
    again = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r.shard for r in again.collect()) == Counter(r.shard for r in found)
    assert shards.place(documents([]), "doc_id", names, 101).count() == 0
