import pathlib
import random

import brute
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from landroll.llm import common, queries


def test_stages_take_effect_and_keep_the_columns_of_documents(spark, tmp_path):
    rng = random.Random(1)

    def word():
        return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))

    prose = "plaina " + " ".join(word() for _ in range(200))
    near = prose.replace("plaina", "Plaina", 1)
    rows = [(1, prose), (2, prose), (3, near), (4, "too short"), (5, None),
            (6, " ".join(word() + (f" a{i}@x.org" if i % 20 == 7 else "") for i in range(100))),
            (7, " ".join(f"x{i}### | <&> $$$" for i in range(40)))]
    rows += [(10 + k, " ".join(word() for _ in range(90)) + " a1@x.org") for k in range(1, 12)]
    docs = brute.documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(10, 22)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    sf, now, seen = str(tmp_path), docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
        path = str(tmp_path / name)
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen[name] = now.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns and now.schema == docs.schema
    ids = {name: sorted(r.doc_id for r in rows) for name, rows in seen.items()}
    assert not {4, 5, 7} & set(ids["quality_rules"]) and {1, 2, 3, 6} <= set(ids["quality_rules"])
    assert {1, 2, 3} & set(ids["near_dedup"]) == {1} and ids["personal_data"] == ids["near_dedup"]
    masked = next(r for r in seen["personal_data"] if r.doc_id == 6)
    assert "@" not in masked.text and masked.text.count("<EMAIL>") == 5 and masked.n_chars == len(masked.text)
    tok = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    texts = sorted((r.doc_id, r.text) for r in seen["mix_sources"])
    coded = sorted((r.doc_id, r.decoded) for r in seen["bpe_codec"])
    assert texts == coded
    for r in seen["bpe_codec"]:
        assert list(r.ids) == tok.encode(r.decoded, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    scratch, before = pathlib.Path(common.fresh_path(spark, "x").removeprefix("file:")).parent, set()
    if scratch.exists():
        before = set(scratch.iterdir())
    assert sorted((r.doc_id, r.decoded) for r in corpus_pipeline.run(spark, sf).collect()) == coded
    # Of the whole run, only the table that the result reads is left.
    assert [p.name.rsplit("-", 1)[0] for p in set(scratch.iterdir()) - before] == ["pipeline-bpe_codec"]


def test_stages_keep_extra_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    words = "some plain words that say one thing after another and never twice the same again today"
    for rows in ([], [(1, words), (1, words), (None, words + " too"), (2, None)]):
        docs = brute.documents(spark, rows, extra=True).selectExpr("*", "'x' as kept", "'y' as n_words", "'z' as text_x")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            out.collect()
