"""The pipeline on whole small tables: every stage against the stage's operator or brute force."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from scoutline.llm import quality_classifier, simhash
from scoutline.llm.queries import table
from scoutline.session import stored
from tests.llm.conftest import SF
from tests.llm.test_decontamination import least_edits
from tests.llm.test_passages import brute_force
from tests.llm.test_simhash import plain_components, plain_print


def test_stages_take_effect(spark, tables):
    docs = table(spark, SF, "documents")
    names, seen = docs.columns, [docs]
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == names
        seen.append(docs)
    rows = [{r.doc_id: r for r in d.collect()} for d in seen]
    first, good, single, cut, clean = rows

    model = quality_classifier.train(seen[0], table(spark, SF, "labels"))
    scores = {r.doc_id: r.predicted for r in quality_classifier.scored(seen[0], model).collect()}
    assert set(good) == {d for d, p in scores.items() if p == 1}
    quality = {x["doc_id"]: x["quality"] for x in tables("labels")}
    assert sum(quality.get(d) == 1 for d in good) >= 0.9 * sum(q == 1 and d in first for d, q in quality.items())

    groups = plain_components([(d, plain_print(r.text)) for d, r in good.items()])
    assert set(single) == {c for _, _, c in groups}

    assert not brute_force([(d, " ".join(r.text.split())) for d, r in cut.items()])
    assert all(r.n_chars == len(r.text) for d, r in cut.items() if r.text != single[d].text)

    items = [w for w in (b["text"].lower().split() for b in tables("benchmark")) if len(w) >= 8]
    leaked = {d for d, r in cut.items() if any(" ".join(w) in " ".join(r.text.lower().split()) for w in items)}
    assert leaked and not leaked & set(clean)
    for d in set(cut) - set(clean):
        text = cut[d].text.lower().split()
        assert any(least_edits(w, text) <= 0.2 * len(w) for w in items)

    packed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert {r.doc_id for r in P.run(spark, SF).collect()} == set(clean)


def test_extra_and_clashing_columns_and_empty_tables(spark):
    docs = table(spark, SF, "documents").selectExpr("*", "'s' as score", "1 as predicted", "'f' as fingerprint", "2 as bin_no")
    for _, stage in P.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns
        assert {(r.score, r.predicted, r.fingerprint, r.bin_no) for r in out.collect()} == {("s", 1, "f", 2)}
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert P.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_rows_with_nulls(spark):
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, None, None, None, None), (1, None, None, None, None), (2, "word " * 3000, "en", "s", 15000)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    kept = []
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        kept.append(docs)
    # None of these ids has a label, so there is nothing to learn from and nothing to reject.
    assert sorted(map(str, kept[0].collect())) == sorted(map(str, spark.createDataFrame(rows, kept[0].schema).collect()))
    # Rows of one id and text count once, rows without an id can't be told apart and stay.
    want = sorted([(None, None), (None, ""), (1, None), (2, rows[4][1])], key=str)
    assert all(sorted(((r.doc_id, r.text) for r in d.collect()), key=str) == want for d in kept[1:4])
    packed = kept[4].groupBy("doc_id").agg(F.sum("n_units").alias("n"), F.count("*").alias("pieces")).collect()
    assert {r.doc_id: r.n for r in packed} == {None: 0, 1: 0, 2: 3001}


def test_near_duplicates_use_the_operator(spark, monkeypatch):
    """The stage keeps what the operator says, with the shingle and distance of its contract."""
    asked = []
    real = simhash.near_duplicates
    monkeypatch.setattr(simhash, "near_duplicates", lambda docs, **more: asked.append(more) or real(docs, **more))
    text = " ".join(f"Word{i}" for i in range(400))
    rows = [(4, text, "en", "s", 1), (2, text + " x", "en", "s", 1), (9, "other words here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    assert sorted(r.doc_id for r in P.deduplicate(spark, docs, SF).collect()) == [2, 9]
    assert asked == [{"shingle": 3, "k": 3}]
