import corpus_pipeline
from icuqm.session import write_stage


def test_every_stage_takes_odd_and_no_documents(spark, odd, nothing):
    docs = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (odd, nothing):
        rows = frame.select(docs)
        for name, stage in corpus_pipeline.STAGES:
            out = write_stage(stage(spark, rows, ""), "test")
            if name != "packing":
                assert out.columns == docs
                assert out.count() <= rows.count()
                rows = out


def test_stages_in_turn(spark, sf):
    rows, sizes = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        rows = write_stage(stage(spark, rows, sf), "test")
        sizes.append(rows.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] <= sizes[4]
