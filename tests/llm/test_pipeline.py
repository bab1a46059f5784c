"""The pipeline against what its stages' rules say of a small corpus with planted cases."""

import random

import corpus_pipeline

from firnlake.llm import common
from firnlake.llm.common import read_table


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = read_table(spark, sf, "documents")
    labels, benchmark = read_table(spark, sf, "labels"), [r.text for r in read_table(spark, sf, "benchmark").collect()]
    rng = random.Random(3)
    clean = [r.text for r in docs.join(labels.filter("quality = 1 AND toxic = 0"), "doc_id").filter("n_chars > 1000").orderBy("doc_id").collect()][:3]
    text = clean[0].split(" ")
    near = list(text)
    near[rng.randrange(len(near))] = "changed"
    planted = [(9001, clean[0] + " planted words here"), (9002, " ".join(near) + " planted words here"), (9003, clean[1] + "\n" + benchmark[0])]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in planted], docs.schema))
    columns, before = docs.columns, docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, before, sf).write.parquet(path)
        after = spark.read.parquet(path)
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        if k < 4:
            assert after.columns == columns
            assert set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        if k < 3:
            assert len(ids) == len(set(ids)) > 0
        if k == 1:
            assert not {9001, 9002} <= set(ids)
        if k == 2:
            assert 9003 not in ids
        if k == 4:
            assert after.count() == before.count()
        before = after


def test_stages_with_much_python_begin_with_collected_heaps(spark, monkeypatch):
    def collected():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before = collected()
    common.shrink(spark)
    assert collected() > before
    seen = []
    monkeypatch.setattr(corpus_pipeline, "shrink", seen.append)
    for name in ("keep_good", "one_of_each", "token_ids"):
        monkeypatch.setattr(corpus_pipeline, name, lambda *a, name=name, **kw: seen.append(name))
    for _, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[4:]:
        stage(spark, spark.range(1), "/root/testdata/sf0.001")
    assert seen == [spark, "keep_good", spark, "one_of_each", spark, "token_ids"]


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
