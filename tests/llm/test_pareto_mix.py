from collections import defaultdict

import pytest

from gradeloom.llm.pareto_mix import mix_sources, repeated, source_targets

SCHEMA = "doc_id long, text string, lang string, source string, size string"


def words(n):
    return " ".join(["w"] * n)


def rows_of(df):
    """Decisions with the columns of their rows, apart from clashing ones."""
    return [{**r["row"].asDict(), **r.asDict()} for r in df.collect()]


def test_targets_stop_at_the_limit_and_reshare(spark):
    sources = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 50)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in source_targets(sources, (1, 2, 3), 3).collect()}
    # Weights 1, 2, 3, 1: b stops at 30, then null at 150, a at 300, c takes the rest.
    assert found["b"] == 30 and found[None] == 150
    assert found["a"] + found["c"] == pytest.approx(1160 - 180)
    assert found["a"] == pytest.approx(min(300, 980 / 4))


def test_words_come_near_targets_and_reruns_agree(spark):
    rows = [(i, words(1 + i * 7 % 90), "en", f"s{i % 4}" if i % 3 else "hot", "x") for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    first = rows_of(mix_sources(docs))
    assert sorted(map(str, first)) == sorted(map(str, rows_of(mix_sources(docs.repartition(7)))))
    taken, target = defaultdict(int), {}
    for r in first:
        assert 0 <= r["copies"] <= 3
        assert r["size"] == len((r["text"] or "").split())
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    for source, want in target.items():
        assert abs(taken[source] - want) <= 90
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in first))


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(1, None, None, None, ""), (2, "", "en", None, ""), (None, words(9), "en", "a", ""), (3, words(400), None, "a", "")]
    rows += [(4, words(30), "en", "b", "")] * 3 + [(5, " x\ty", "en", "only blank source", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    mix = mix_sources(docs)
    mixed = rows_of(mix)
    assert len(mixed) == len(rows)
    assert {r["size"] for r in mixed if r["doc_id"] in (1, 2)} == {0}
    assert len({r["copies"] for r in mixed if r["doc_id"] == 4}) == 1
    out = repeated(mix)
    assert out.columns == docs.columns
    assert out.count() == sum(r["copies"] for r in mixed)


def test_empty_table(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_inclusion_follows_preference(spark):
    """Fragments are taken about half as often as long documents."""
    rows = [(i, words(10 if i % 2 else 100), "en", "ab"[i % 7 == 0], "") for i in range(4000)]
    mixed = rows_of(mix_sources(spark.createDataFrame(rows, SCHEMA)))
    mean = {s: sum(r["copies"] for r in mixed if r["size"] == s and r["source"] == "a") for s in (10, 100)}
    assert mean[10] / mean[100] == pytest.approx(0.5, abs=0.06)
