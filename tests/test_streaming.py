import os

from dossier.plans.search import score_documents
from dossier.streaming.screening import start_screening
from samples import DOCS


def test_stream_scores_equal_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    rows = [(d, f"../data/{d}.txt", t) for d, t in DOCS]
    schema = "doc_id int, cv_path string, cv_text string"
    spark.createDataFrame(rows[:3], schema).write.parquet(os.path.join(src, "part1"))
    spark.createDataFrame(rows[3:], schema).write.parquet(os.path.join(src, "part2"))
    out = os.path.join(tmpdir_path, "out")
    q = start_screening(spark, src + "/*", schema, "analyst, excel, pythn", out,
                        os.path.join(tmpdir_path, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = sorted((r.doc_id, r.total_matches, r.match_priority, tuple(r.matched_keywords))
                 for r in spark.read.parquet(out).collect())
    batch = score_documents(spark.createDataFrame(rows, schema), "analyst, excel, pythn")
    want = sorted((r.doc_id, r.total_matches, r.match_priority, tuple(r.matched_keywords))
                  for r in batch.collect())
    assert got == want and len(got) > 0
