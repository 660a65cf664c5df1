import corpus_pipeline as C
from tests.llm import brute, cases
from tilewright.llm import quality_rules, secrets


def stages(spark, docs, folder):
    out = []
    for name, stage in C.STAGES:
        docs.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = stage(spark, spark.read.parquet(f"{folder}/{name}"), folder)
        out.append(docs)
    return out


def documents():
    clean = [(i, " ".join(f"c{i}x{k}" for k in range(40 + i)), "en", f"s{i % 3}", None) for i in range(20)]
    passage = " ".join(f"bench{k}" for k in range(14))
    more = [
        (30, clean[0][1].replace("c0x7 ", "changed ", 1), "en", "s1", None), (31, clean[1][1], "en", "s2", None), (32, clean[2][1] + " " + passage, "en", "s0", None),
        (33, clean[3][1].replace("c3", "d3") + " token = abcDEF123", "en", "s0", None), (34, "too short", "en", "s0", None), (35, None, None, None, None), (36, "", "en", None, None),
    ]
    return [(*r[:4], None if r[1] is None else len(r[1])) for r in [*clean, *more]], passage


def test_against_brute_force(spark, tmp_path):
    rows, passage = documents()
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    quality, near, clean, safe, packed = stages(spark, docs, str(tmp_path))
    left = [r[:2] for r in rows if not brute.base_rules(r[1])[5]]
    assert {r.doc_id for r in quality.collect()} == {i for i, _ in left}
    roots = brute.near_classes(left)
    left = [r for r in left if roots[r[0]] == r[0]]
    assert {r.doc_id for r in near.collect()} == {i for i, _ in left}
    left = [r for r in left if not brute.contamination(r[1], [(1, passage)])[1]]
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in left}
    safe_rows = {r.doc_id: r for r in safe.collect()}
    assert set(safe_rows) == {i for i, _ in left} and "[SECRET]" in safe_rows[33].text
    assert all(r.n_chars == len(r.text) and not secrets.scan(r.text)[1] for r in safe_rows.values())
    words = {r.doc_id: r.piece_length for r in packed.collect()}
    assert words == {i: len(brute.WORD.findall(r.text)) for i, r in safe_rows.items()}
    for frame in (quality, near, clean, safe):
        assert frame.columns == docs.columns


def test_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, docs in enumerate((cases.frame(spark), cases.empty(spark))):
        docs.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        out = C.run(spark, f"{tmp_path}/{k}").collect()
        assert bool(out) == (k == 0)
    assert quality_rules.judge(cases.empty(spark)).count() == 0
