"""The pipeline's stages catch what is planted and keep the rest."""

import corpus_pipeline
from tests.llm.conftest import prose


def test_stages(spark, tmp_path):
    item, passage = prose(900, 40), prose(901, 51)
    clean = [(i, prose(i, 80), "en", f"s{i % 2}") for i in range(40)]
    base = prose(500, 100)
    toxic = [(100 + i, prose(600 + i, 50) + " idiot scum", "en", "s0") for i in range(20)]
    rows = [*clean, (50, base, "en", "s0"), (51, base, "en", "s1"), (52, base + " tail", "en", "s1"), (60, prose(700, 30) + " " + item, "en", "s0"), (70, prose(701, 60) + "\n" + passage, "en", "s0"), (71, prose(702, 60) + "\n" + passage, "en", None), *toxic]
    docs = spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i >= 100)) for i, *_ in rows if i < 30 or i >= 105], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in at.select("doc_id").collect()}
        at = corpus_pipeline.stage_table(stage(spark, at, str(tmp_path)), name)
        seen[name] = before - {r.doc_id for r in at.select("doc_id").collect()}
        if name != "source_mix":
            assert at.columns == docs.columns
        if name == "suffix_arrays":
            by = {r.doc_id: r for r in at.collect()}
            assert passage[2:-2] not in by[70].text and by[70].n_chars == len(by[70].text) and by[3].text == clean[3][1]
    assert seen["toxicity"] == {100 + i for i in range(20)} and seen["near_duplicates"] == {51, 52} and seen["suffix_arrays"] == set() and seen["decontamination"] == {60}
    assert at.select("doc_id").distinct().count() > 20


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, draw string, size string, mix_size long, is_toxic boolean, p_toxic double, gone boolean, `row` long, shard int, `odd name` string, rest string, id long"


def test_awkward_rows_and_clashing_columns(spark, tmp_path):
    """Null and repeated ids, null, empty and long texts, columns with the stages' own names."""
    item, long = prose(910, 40), prose(911, 20_000)
    rows = [(1, None), (2, ""), (None, "no id " + prose(912, 40)), (None, prose(913, 20) + " " + item), (4, prose(914, 50)), (4, prose(914, 50)), (4, prose(915, 50)), (5, long), (6, "ok"), (7, prose(916, 40) + " idiot scum")]
    rows += [(100 + i, prose(920 + i, 60)) for i in range(20)]
    table = [(i, t, "en", None if k % 3 else "s", len(t or ""), "d", "z", 3, True, 0.9, True, 1, 2, "o", "r", 8) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(table, EXTRA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(100 + i, i % 2, 0) for i in range(20)] + [(7, None, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.schema(docs.schema).parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.stage_table(stage(spark, at, str(tmp_path)), name)
        kept[name] = sorted((str(r.doc_id), r.text or "") for r in at.select("doc_id", "text").collect())
        if name != "source_mix":
            assert at.columns == docs.columns and at.where("is_toxic and p_toxic = 0.9 and gone and draw = 'd' and `odd name` = 'o' and rest = 'r' and id = 8").count() == len(kept[name])
    want = sorted({(str(i), t or "") for i, t in rows if i not in (2, None)}) + [(str(i), t) for i, t in rows if i is None]
    assert kept["toxicity"] == sorted((str(i), t or "") for i, t in rows)
    assert kept["near_duplicates"] == kept["suffix_arrays"] == sorted(want)
    assert kept["decontamination"] == sorted(x for x in want if item not in x[1])
    assert set(corpus_pipeline.MIX_COLUMNS) <= set(at.columns) and len(at.columns) == len(set(at.columns)) == 14 + 6
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(tmp_path / "empty" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
