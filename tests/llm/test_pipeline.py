"""The pipeline's stages against plain versions, each on its own input."""

import pytest

import corpus_pipeline
from quadrille.llm import toxicity
from tests.llm.test_operators import plain_components, plain_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()} if i < 4 else docs.collect())
    start = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), toxicity.train_on_table(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)).collect()}
    assert kept[0].keys() == {i for i in start if scores[i] < 0.7} and len(kept[0]) > 0.7 * len(start)
    components, _ = plain_components(list(kept[0].items()), 5, 80)
    assert kept[1].keys() == set(components.values())
    for i, t in kept[1].items():
        n, hit, _ = plain_hits(t, items, 13)
        assert (i in kept[2]) == (not (hit and 20 * hit >= n))
    assert kept[3].keys() <= kept[2].keys()
    assert {r["doc_id"] for r in kept[4]} == kept[3].keys()


def test_long_spans_of_kept_documents_are_cut(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(90))
    short = " ".join(f"q{i}" for i in range(20))
    around = [" ".join(f"w{k}x{i}" for i in range(1000)) for k in range(4)]
    spark.createDataFrame([(1, passage), (2, short)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, f"{around[0]} {around[1]} {passage} {around[2]}", "en", "a", 0), (2, f"{around[0]} {short} end", "en", "a", 0), (3, f"{passage} {around[0]}", "en", "a", 0), (4, None, None, None, None), (5, " ".join(f"w{i}" for i in range(120)) + f" {short[: short.index(' q7')]}", "en", "a", 0), (6, " ".join(f"w{i}" for i in range(380)) + f" {short}", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()}
    # 90 of 1,090 words and 20 of 400 are a twentieth or more; spans of at most 50 words stay
    assert got.keys() == {1, 2, 4, 5}
    assert got[1]["text"].split() == " ".join(around[:3]).split() and got[1]["n_chars"] == len(got[1]["text"])
    assert [got[i]["text"] for i in (2, 4, 5)] == [rows[i - 1][1] for i in (2, 4, 5)]


def test_run_and_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "text of no id", "en", "a", 13), (2, "", "en", "a", 0), (3, "a b c d e f g", "en", "b", 13), (4, "a b c d e f g", "en", "b", 13)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "in" / "labels.parquet"))
    spark.createDataFrame([(1, "x y")], "item_id long, text string").write.parquet(str(tmp_path / "in" / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "in")).collect()
    assert {r["doc_id"] for r in out} == {None, 3} and all(r["n_tokens"] > 1 for r in out)


def test_rows_of_one_id_are_not_lost(spark):
    rows = [(1, "one text of this id", "en", "a", 1), (1, "quite another one", "en", "b", 2), (1, "one text of this id", "de", "a", 1), (1, "one text of this id", "en", "a", 1), (2, "quite another one", "en", "a", 0), (3, "third", None, None, None), (None, "third", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((tuple(r) for r in corpus_pipeline.one_of_near_copies(spark, docs.repartition(5), SF).collect()), key=repr)
    assert got == sorted([(1, "one text of this id", "de", "a", 1), rows[1], rows[5], rows[6]], key=repr)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_texts_stay_where_they_are_while_near_copies_are_left_out(spark, monkeypatch, limit):
    """However long the list of kept ids; texts are joined by shuffles only where the list of the others is too long to be sent."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_LIMIT_BYTES", limit)
    rows = [(i, f"text {i % 30} of this table", "en", "a", i) for i in range(40)] + [(5, "another text of an id", "en", "b", 1), (None, "text 1 of this table", "en", "a", 2), (35, "", "en", "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, label, kept=corpus_pipeline.stored: (kept(df, label), spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1"))[0])
    try:
        out = corpus_pipeline.one_of_near_copies(spark, docs, SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect()), key=repr) == sorted([r for r in rows if r[0] is None or r[0] < 30 or r[0] == 35], key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in plan) == (limit == 0)
