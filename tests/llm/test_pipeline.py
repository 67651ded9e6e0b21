from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gradeloom.llm.common import stored
from gradeloom.llm.oracles import ORACLES
from gradeloom.runtime import TEXT_BATCH_ROWS, bound_text_batches, shared_dir
from tests.llm.test_bbit_minhash import brute as brute_groups
from tests.llm.test_decontaminate import brute as brute_leaks

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __drop string"
WORDS = {
    "en": "the quick brown fox jumps over lazy dogs while weather stays nice with them and others talk about things",
    "de": "der schnelle braune Fuchs springt über faule Hunde und das Wetter bleibt schön mit ihnen während andere reden",
}


def corpus():
    pick = np.random.default_rng(4)
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "de"
        words = pick.choice(WORDS[lang].split(), int(pick.choice([4, 12, 40, 120])))
        rows.append((i, " ".join(words), lang, f"s{i % 4}" if i % 5 else None, 0, "x"))
    rows += [(200 + i, rows[i + 3][1], "en", "copies", 0, "x") for i in range(10)]
    rows += [(300, None, "en", "s1", 0, "x"), (301, "", "en", "s1", 0, "x"), (302, "12 34 !", None, "s1", 0, None)]
    item = " ".join(pick.choice(WORDS["en"].split(), 15))
    rows += [(400, f"well {item} indeed", "en", "s2", 0, "x")]
    return rows, [(1, item), (2, None)]


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, outs = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        outs.append(docs)
    for out in outs[:-1]:
        assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    kept = [sorted(tuple(r) for r in out.collect()) for out in outs]
    by_id = {r[0]: r for r in rows}

    # Rows without letters go, all others stay.
    assert [r[0] for r in kept[0]] == [r[0] for r in rows if any(c.isalpha() for c in r[1] or "")]
    groups = brute_groups([by_id[r[0]] for r in kept[0]])
    assert [r[0] for r in kept[1]] == [g[0] for g in groups if g[3]]
    leaks = {doc for doc, *_ in brute_leaks([by_id[r[0]] for r in kept[1]], items)}
    assert 400 in leaks and [r[0] for r in kept[2]] == [r[0] for r in kept[1] if r[0] not in leaks]
    with duckdb.connect() as sql:
        table = outs[2].toArrow()
        sql.register("documents", table)
        mixed = sql.execute(f"SELECT doc_id, size, taken FROM ({ORACLES['op2_pareto_mix']}) ORDER BY doc_id").fetchall()
    want = [doc for doc, size, taken in mixed for _ in range(taken // size)]
    assert [r[0] for r in kept[3]] == want
    assert [r for r in set(kept[3])] and all(r == by_id[r[0]] for r in kept[3])

    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for doc_id, start, n, _ in sorted(kept[4], key=lambda r: r[1]):
        assert start == at and n == len(tokenizer.encode(by_id[doc_id][1], add_special_tokens=False).ids) + 1
        at += n
    assert sorted(r[0] for r in kept[4]) == want


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_without_id_and_repeated_ids_count_each(spark, tmp_path):
    """Every row is decided by its own text; of a group of copies one stays."""
    pick = np.random.default_rng(9)
    leak, *clean = [" ".join(f"{c}{n}" for n in pick.integers(0, 10**6, 30)) for c in "abcdef"]
    rows = [(None, f"x {leak} y", "en", "s", 0, "x"), (None, clean[0], "en", "s", 0, "x"), (7, f"z {leak}", "en", "s", 0, "x"), (7, clean[1], "en", "s", 0, "x")]
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == {(None, clean[0]), (7, clean[1])}

    rows = [(None, clean[2], "en", "s", 0, "x")] * 3 + [(5, clean[3], "en", "s", 0, "x")] * 3
    rows += [(9, clean[4], "en", "s", 0, "x"), (8, clean[4], "en", "s", 0, "x"), (None, clean[4], "en", "s", 0, "x"), (None, None, "en", "s", 0, "x"), (None, "", "en", "s", 0, "x")]
    left = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path))
    want = [(None, clean[2]), (5, clean[3]), (8, clean[4]), (None, None), (None, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(want, key=str)


def test_unlearned_languages_and_letter_junk_go(spark):
    pick = np.random.default_rng(10)
    more = {
        "en": WORDS["en"] + " because people often write long letters to their friends about work and home which they enjoy every day",
        "de": WORDS["de"] + " weil Leute oft lange Briefe an ihre Freunde schreiben und dabei von der Arbeit und dem Haus erzählen",
    }
    rows = [(i, " ".join(pick.choice(more[lang].split(), n)), lang, "s", 0, "x") for i in range(400) for lang, n in [("en" if i % 2 else "de", int(pick.choice([30, 60, 120, 300])))]]
    polish = "wczoraj wieczorem przyszedł do mnie sąsiad i powiedział że jutro będzie padać śnieg więc trzeba przygotować ciepłe ubrania oraz zrobić zakupy przed świętami"
    finnish = "eilen illalla naapurini tuli luokseni ja sanoi että huomenna sataa lunta joten täytyy valmistaa lämpimät vaatteet ja käydä kaupassa ennen juhlia"
    rows += [(1000 + i, " ".join(pick.choice(t.split(), 60)), None, "s", 0, "x") for i, t in enumerate([polish, finnish] * 3)]
    for i, n in enumerate([60, 300, 3000]):
        letters = pick.choice(list("abcdefghijklmnopqrstuvwxyz "), 6 * n)
        rows.append((1100 + i, "".join(letters), None, "s", 0, "x"))
    left = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert left == set(range(400))


def test_deciding_on_rows_leaves_one_copy_of_the_texts(spark, tmp_path):
    """Of the tables made on the way only those stay that the stage's rows are read from."""
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared, docs = Path(shared_dir(spark)), spark.createDataFrame(rows, SCHEMA)

    def left_by(stage):
        before = {p.name for p in shared.iterdir()}
        found = stage(spark, docs, str(tmp_path))
        made = [p for p in shared.iterdir() if p.name not in before]
        assert found.count() > 0
        return sorted(p.name.rsplit("-", 1)[0] for p in made)

    checkpoints = sum(1 for _ in shared.glob("*/rdd-*"))
    assert left_by(corpus_pipeline.near_dedup_stage) == ["dropped", "keyed"]
    assert sum(1 for _ in shared.glob("*/rdd-*")) <= checkpoints
    assert "keyed" not in left_by(corpus_pipeline.decontamination_stage)


@pytest.mark.parametrize("stage", [corpus_pipeline.language_stage, corpus_pipeline.near_dedup_stage, corpus_pipeline.token_stage])
def test_texts_reach_python_in_small_batches(spark, stage):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(i, f"the quick brown fox {i}", "en", "s", 0, "x") for i in range(40)], SCHEMA)
    many = spark.range(5 * TEXT_BATCH_ROWS, numPartitions=1)
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        stage(spark, docs, "")

        def sizes(batches):
            for batch in batches:
                yield batch.slice(0, 1) if batch.num_rows <= TEXT_BATCH_ROWS else batch

        assert many.mapInArrow(sizes, "id long").count() == 5
        spark.conf.set(key, "10")
        bound_text_batches(spark)
        assert spark.conf.get(key) == "10"
    finally:
        spark.conf.set(key, before)
