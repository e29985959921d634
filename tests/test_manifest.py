import os
import tracemalloc

from pyspark.sql import functions as F

from dossier.operators import assemble, manifest as Mf
from dossier.sources.tables import folder_source, list_folder_tree


def _tree(root, more=None):
    layout = {"ACCOUNTANT": ["b.pdf", "a.pdf", "10.pdf", "2.pdf"], "CHEF": ["z.txt"], "EMPTY": []}
    layout |= more or {}
    for role, files in layout.items():
        os.makedirs(os.path.join(root, role), exist_ok=True)
        for f in files:
            open(os.path.join(root, role, f), "w").write("x")
    os.makedirs(os.path.join(root, "CHEF", "nested"), exist_ok=True)
    open(os.path.join(root, "CHEF", "nested", "deep.pdf"), "w").write("x")
    open(os.path.join(root, "top.pdf"), "w").write("x")
    return layout


def test_folder_manifest(spark, tmpdir_path):
    _tree(tmpdir_path)
    listing = list_folder_tree(spark, tmpdir_path)
    m = Mf.manifest_top_per_role(listing, prefix="../data/", max_files=3).collect()
    got = sorted((r.application_role, r.applicant_id, r.cv_path) for r in m)
    assert got == [("ACCOUNTANT", 1, "../data/10.pdf"), ("ACCOUNTANT", 2, "../data/2.pdf"),
                   ("ACCOUNTANT", 3, "../data/a.pdf"), ("CHEF", 1, "../data/z.txt")]


def test_listing_keeps_every_name(spark, tmpdir_path):
    layout = _tree(tmpdir_path, {"_B": ["_x.pdf", ".h.pdf", "no extension", "ü ß.pdf"], ".hidden": ["y"]})
    got = sorted(tuple(r) for r in list_folder_tree(spark, tmpdir_path).collect())
    assert got == sorted((role, f) for role, files in layout.items() for f in files)
    empty = os.path.join(tmpdir_path, "EMPTY")
    assert list_folder_tree(spark, empty).count() == 0


def test_large_folder_is_listed_by_several_tasks(spark, tmpdir_path):
    n = 100_000
    os.makedirs(os.path.join(tmpdir_path, "BIG"))
    for i in range(n):
        os.close(os.open(os.path.join(tmpdir_path, "BIG", f"{i}.pdf"), os.O_CREAT | os.O_WRONLY))
    listing = list_folder_tree(spark, tmpdir_path, parts=4)
    shares = [r["count"] for r in listing.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == n and len(shares) == 4 and max(shares) < 0.3 * n
    assert listing.distinct().count() == n
    first = sorted(f"{i}.pdf" for i in range(n))[:20]
    short = list_folder_tree(spark, tmpdir_path, parts=4, max_files=20)
    assert short.count() == 80
    got = [r.cv_path for r in Mf.manifest_top_per_role(short, "", 20).orderBy("applicant_id").collect()]
    assert got == first

    reader = folder_source()({"path": tmpdir_path, "parts": "1", "max_files": "20"}).reader(None)
    [part] = reader.partitions()
    tracemalloc.start()
    names = [x for b in reader.read(part) for x in b.column(1).to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names == first and most < 1e6, most


def test_folders_are_put_together_in_tasks(spark, tmpdir_path):
    layout = _tree(tmpdir_path, {f"R{i}": ["a", "b"] for i in range(9)})
    listing = list_folder_tree(spark, tmpdir_path, tasks=3)
    assert listing.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, listing.collect())) == sorted((role, f) for role, files in layout.items() for f in files)


def test_hot_role_is_cut_in_parts(spark):
    df = spark.range(5000).select(F.lit("hot").alias("application_role"), F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("file_name"))
    got = [r.cv_path for r in Mf.manifest_top_per_role(df, "", 7).orderBy("applicant_id").collect()]
    assert got == sorted(f"{i}.pdf" for i in range(5000))[:7]


def test_top_per_role_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("application_role"),
                                  F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("file_name"))
    m = Mf.manifest_top_per_role(df, max_files=5)
    assert m.count() == 15
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_append_ids_consecutive(spark):
    existing = spark.createDataFrame([(7, 1, "R", "p")], "detail_id int, applicant_id int, application_role string, cv_path string")
    man = spark.range(50).select((F.col("id") % 4).cast("string").alias("application_role"),
                                 F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("file_name"))
    m = Mf.manifest_top_per_role(man, max_files=20)
    out = Mf.append_applications(existing, m).collect()
    rows = sorted(out, key=lambda r: r.detail_id)
    assert [r.detail_id for r in rows] == list(range(8, 8 + len(rows)))
    assert [(r.application_role, r.applicant_id) for r in rows] == \
        sorted((r.application_role, r.applicant_id) for r in rows)
    empty = existing.limit(0)
    assert min(r.detail_id for r in Mf.append_applications(empty, m).collect()) == 1


def test_preview(spark):
    man = spark.range(30).select((F.col("id") % 2).cast("string").alias("application_role"),
                                 F.concat(F.col("id").cast("string"), F.lit(".pdf")).alias("file_name"))
    p = Mf.manifest_preview(Mf.manifest_top_per_role(man)).collect()
    files = sorted([r for r in p if r.kind == "file"], key=lambda r: r.position)
    summary = [r for r in p if r.kind == "summary"][0]
    assert len(files) == 10 and [r.position for r in files] == list(range(1, 11))
    assert (summary.total_files, summary.not_shown) == (30, 20)


def test_assemble_in_order(spark):
    parts = [(1, i, f"p{i}") for i in range(2500)] + [(2, 1, "b"), (2, 0, "a"), (3, 0, None)]
    df = spark.createDataFrame(parts, "doc long, pos long, t string")
    got = {r.doc: r.text for r in assemble.assemble_documents(df, "doc", "pos", "t", parts_per_run=100).collect()}
    assert got[1] == "".join(f"p{i}" for i in range(2500))
    assert got[2] == "ab" and got[3] == ""


def test_append_ids_at_size(spark):
    existing = spark.createDataFrame([(900, 1, "R", "p")], "detail_id int, applicant_id int, application_role string, cv_path string")
    i = F.col("id")
    m = spark.range(0, 100_000, numPartitions=7).select(
        F.when(i % 5000 == 3, F.lit(None)).otherwise((i * 7919) % 100_003).cast("int").alias("applicant_id"),
        F.when(i % 3 > 0, F.concat(F.lit("role"), (i % 997).cast("string"))).when(i % 2 == 0, F.lit("hot")).alias("application_role"),
        F.concat(F.lit("../data/a-long-enough-path/"), i.cast("string"), F.lit(".pdf")).alias("cv_path"))
    rows = Mf.append_applications(existing, m).collect()
    rows.sort(key=lambda r: r.detail_id)
    assert [r.detail_id for r in rows] == list(range(901, 901 + 100_000 - 20))
    order = [(r.application_role is not None, r.application_role or "", r.applicant_id, r.cv_path) for r in rows]
    assert order == sorted(order)


def test_append_skips_and_counts(spark, tmpdir_path):
    from dossier.plans.seed import APPLICATION_SCHEMA
    from dossier.sources.sinks import append_applications_to, ensure_table
    table = os.path.join(tmpdir_path, "apps")
    ensure_table(spark, table, APPLICATION_SCHEMA)
    m = spark.createDataFrame([(1, "A", "p"), (None, "A", "q"), (2, "x" * 101, "r"), (3, None, "s"), (4, "y" * 100, "t")],
                              "applicant_id int, application_role string, cv_path string")
    for turn in range(2):
        assert append_applications_to(spark, m, table) == {"rows_inserted": 3, "rows_skipped": 2}
    got = spark.read.parquet(table).orderBy("detail_id").collect()
    assert [(r.detail_id, r.cv_path) for r in got] == [(1, "s"), (2, "p"), (3, "t"), (4, "s"), (5, "p"), (6, "t")]
    audit = Mf.append_audit(m).first()
    assert (audit.rows_inserted, audit.rows_skipped) == (3, 2)


def test_seed_twice_appends(spark, tmpdir_path):
    from dossier.plans.seed import seed_applications
    tree = os.path.join(tmpdir_path, "tree")
    os.makedirs(tree)
    _tree(tree)
    table = os.path.join(tmpdir_path, "apps")
    assert seed_applications(spark, tree, table, max_files=2) == {"manifest_rows": 3, "inserted": 3}
    assert seed_applications(spark, tree, table, max_files=2) == {"manifest_rows": 3, "inserted": 3}
    rows = spark.read.parquet(table).collect()
    assert sorted(r.detail_id for r in rows) == [1, 2, 3, 4, 5, 6]


def test_document_report(spark):
    from dossier.plans.report import document_report
    from samples import CV_A
    import pyref
    df = spark.createDataFrame([(1, CV_A)], "doc_id int, cv_text string")
    r = document_report(df, "view, analyst, exel", "Education").first()
    flat = pyref.flat_text(pyref.sections(CV_A))
    assert r.flat_text == flat
    assert r.section_text.startswith("Bachelor of Arts")
    got = {c.keyword: (c.exact, c.fuzzy_n, c.fuzzy_words) for c in r.counts}
    for k in ["view", "analyst", "exel"]:
        n, words = pyref.fuzzy(flat, k)
        assert got[k] == (pyref.overlap_count(flat, k), n, sorted(set(words)))


def test_one_role_with_all_rows(spark):
    n = 1_000_000
    i = F.col("id")
    m = spark.range(0, n, numPartitions=4).select(((i * 7919) % 1_000_003).cast("int").alias("applicant_id"), F.lit("R").alias("application_role"),
                                                  F.concat(F.lit("p"), i.cast("string")).alias("cv_path"))
    existing = spark.createDataFrame([], "detail_id int, applicant_id int, application_role string, cv_path string")
    out = Mf.append_applications(existing, m)
    got = out.agg(F.min("detail_id").alias("a"), F.max("detail_id").alias("z"), F.count_distinct("detail_id").alias("d"), F.count(F.lit(1)).alias("n")).first()
    assert tuple(got) == (1, n, n, n)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:  # rows of the numbering tasks
        shares = [r["n"] for r in 
                  out.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("detail_id").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(shares) == n and max(shares) <= 0.05 * n, max(shares)
    ranked = out.orderBy("detail_id").limit(1000).collect()
    assert [r.applicant_id for r in ranked] == sorted(r.applicant_id for r in ranked)
