import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from dayrisk.llm.quality import judge_documents
from dayrisk.llm.toxicity import score_documents
from tests.llm.helpers import documents, near_classes, prose


def test_pipeline_equals_its_decisions_one_by_one(spark, tmp_path):
    texts = [prose(i, 90, 3000) for i in range(60)]
    texts += [t.upper() for t in texts[:5]] + [" ".join([*t.split()[:-1], "changed"]) for t in texts[5:10]]
    texts += [t + " stupid idiot" for t in texts[10:30]] + [" ".join(w + "###" for w in t.split()) for t in texts[30:50]] + [None, "", "short", prose(77, 4000, 9000)]
    n = len(texts)
    docs = documents(spark, texts).withColumn("kept", F.lit("clash"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = pd.DataFrame({"doc_id": range(n), "quality": [0 if t is None or "###" in t else 1 for t in texts], "toxic": [int("idiot" in (t or "")) for t in texts]})
    spark.createDataFrame(labels.astype({"quality": "int32", "toxic": "int32"})).write.parquet(str(tmp_path / "labels.parquet"))
    table, known = spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet"))

    left = {r.doc_id for r in score_documents(table, known).collect() if not r.predicted}
    assert not any("idiot" in (texts[i] or "") for i in left) and {60, 65} <= left
    left &= {r.doc_id for r in judge_documents(table.where(F.col("doc_id").isin(list(left))), known).collect() if r.kept}
    groups = {}
    for i in sorted(left):
        groups[(texts[i] or "").encode().lower()] = i
    ids = sorted(groups.values())
    classes = near_classes([texts[i] for i in ids])
    ids = [i for k, i in enumerate(ids) if classes[k] == k]

    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(packed.doc_id.unique()) == ids
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, str(tmp_path)).columns == table.columns, name
    empty = table.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_stages_read_what_the_stage_before_wrote_as_parquet(spark, tmp_path, monkeypatch):
    documents(spark, ["a", None, "b"]).write.parquet(str(tmp_path / "documents.parquet"))
    read = []

    def stage(spark, docs, sf_dir):
        read.append((sorted(docs.columns), docs.count(), len(docs.inputFiles()) > 0))
        return docs.where("text is not null") if len(read) == 1 else docs.where("text = 'c'")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage), ("second", stage), ("third", stage), ("last", lambda spark, docs, sf_dir: docs)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    columns = sorted(documents(spark, ["a"]).columns)
    assert read == [(columns, 3, True), (columns, 2, True), (columns, 0, True)]
