import inspect
import re

import public_tokenizers
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from loanlake.llm import common, ftrl, hyperminhash, mixing, queries, weak_supervision
from text_fixtures import odd_rows  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def test_registry():
    names = contract.queries()
    for n in range(1, 14):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert [inspect.signature(f).parameters.keys() == {"spark", "docs", "sf_dir"} for _, f in corpus_pipeline.STAGES] == [True] * 5


def test_every_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scratch = common.Scratch(spark, "test")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(scratch.store(stage(spark, kept[-1], SMALL)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns
    ids = [[r["doc_id"] for r in k.select("doc_id").collect()] for k in kept]
    scores = ftrl.score(spark, kept[0], ftrl.fit(spark, kept[0], labels)).collect()
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in scores if r["score"] < 0.5)
    verdicts = weak_supervision.quality_verdicts(spark, kept[1]).collect()
    assert sorted(ids[2]) == sorted(r["doc_id"] for r in verdicts if r["kept"])
    groups = hyperminhash.near_duplicates(spark, kept[2], percent=80).collect()
    assert sorted(ids[3]) == sorted(r["id"] for r in groups if r["kept"])
    mixed = mixing.allocate(spark, kept[3]).collect()
    assert sorted(ids[4]) == sorted(r["doc_id"] for r in mixed for p in r["passes"] if 2 * p["words"] >= r["size"])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(docs.select("doc_id", "text").collect())
    assert all(r["n_tokens"] == len(library.encode(texts[r["doc_id"]])) for r in kept[5].collect())
    rerun = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(map(tuple, rerun)) == sorted(map(tuple, kept[5].collect()))


def test_queries_cover_their_tables(spark):
    """One row per row of the table, whatever the operator; op11 has rows for anchors only."""
    sizes = {t: spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("documents", "pages", "embeddings", "conversations")}
    table = {1: "embeddings", 2: "pages", 4: "conversations"}
    for name, query in queries.QUERIES.items():
        if name == "op11_slot_negatives":
            continue
        assert query(spark, SMALL).count() == sizes[table.get(int(name[2:].split("_")[0]), "documents")]


def test_pipeline_over_odd_rows(spark, tmp_path, odd_rows):
    """Nulls in any column, empty and very long texts, repeated rows; then no rows at all."""
    rows = [(d, t, lang, s, n) for (d, t, s), lang, n in zip(odd_rows, ["en", None] * 9, [1, None, 2] * 9, strict=False)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    columns = ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    for name, some, marks in (("odd", rows, [(1, 1, None), (None, None, 1), (4, 0, 1)]), ("none", [], [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert found.columns == columns
        assert {r["doc_id"] for r in found.collect()} <= {r[0] for r in some}


def test_stages_keep_clashing_columns(spark, odd_rows):
    """A table with columns named as the operators' results passes the filtering stages unchanged."""
    rows = [(d, t, "en", s, 1, "old", 2.0, True, -1, "k") for d, t, s in odd_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, score double, kept boolean, n_tokens long, row string"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert all((r["ids"], r["score"], r["kept"], r["n_tokens"], r["row"]) == ("old", 2.0, True, -1, "k") for r in docs.collect())
