from test_texts import plain_shingles

from tillwarden.llm import decontam


def brute(docs, items):
    whole = {}
    for i, t in items:
        whole.setdefault(i, set()).update(plain_shingles(t))
    held = {}
    for d, t in docs:
        held.setdefault(d, set()).update(plain_shingles(t))
    return {(d, i, len(s & h) / len(s)) for d, h in held.items() for i, s in whole.items() if s and len(s & h) / len(s) >= 0.8}


def test_items_in_long_documents(spark, documents, words):
    items = [(i, words(500 + i, 12 + 3 * i)) for i in range(12)] + [(20, None), (21, ""), (22, "just three words"), (1, words(501, 15))]
    docs = [(i, words(i, 400)) for i in range(10)]
    docs += [(50 + i, words(i, 3000) + " " + (items[i][1] or "") + "\n" + words(i, 50, 5000)) for i in range(12)]
    docs += [(80, words(511, 41)), (81, words(511, 30)), (82, "x just three words y"), (83, "Just Three WORDS"), (84, None), (85, ""), (86, words(505, 40).upper())]
    docs += [(50, docs[-1][1])]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS h", "'y' AS size")
    found = {(r.doc_id, r.item_id, r.containment) for r in decontam.contained(documents(docs), table).collect()}
    assert found == brute(docs, items)
    assert {d for d, _, _ in found} >= {50 + i for i in range(12)} | {83, 86}


def test_without_broadcast(monkeypatch, spark, documents, words):
    monkeypatch.setattr(decontam, "FEW", 0)
    table = spark.createDataFrame([(1, words(5, 30))], "item_id long, text string")
    found = decontam.contained(documents([(1, words(5, 100)), (2, words(6, 100))]), table).collect()
    assert [(r.doc_id, r.item_id, r.containment) for r in found] == [(1, 1, 1.0)]


def test_plans_hold_no_python(spark, documents, words):
    table = spark.createDataFrame([(1, words(5, 30))], "item_id long, text string")
    plan = decontam.contained(documents([(1, words(5, 100))]), table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clean_and_empty(spark, documents, words):
    table = spark.createDataFrame([(1, words(5, 30))], "item_id long, text string")
    docs = documents([(1, words(5, 100)), (2, words(6, 100)), (3, None), (None, words(5, 100))])
    left = decontam.clean(docs, table)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {2, 3, None}
    assert decontam.contained(docs, table.limit(0)).count() == 0
    assert decontam.contained(documents([]), table).count() == 0
