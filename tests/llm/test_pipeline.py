"""The corpus pipeline, stage by stage, against what plain Python says of a small corpus with odd rows."""

import itertools

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"en": list("etaoinshr"), "de": list("äöüßkwzvj")}


def prose(lang, n, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(LETTERS[lang], 6)) for _ in range(300)]
    return " ".join(rng.choice(words, n))


ITEM = prose("en", 30, 99)
BASE = prose("en", 200, 1)
TEXTS = [
    (1, BASE, "en"), (2, BASE.replace(" ", "  "), "en"), (3, " ".join(BASE.split()[:150] + ["other"] + BASE.split()[151:]), "en"), (4, None, "en"), (5, "", None), (6, " 12 34 ", "en"),
    (7, prose("de", 150, 2), "de"), (8, prose("de", 150, 2), "de"), (8, prose("de", 150, 2), "de"), (9, prose("en", 40, 3) + " " + ITEM + " " + prose("en", 40, 4), "en"), (None, prose("de", 60, 5), "de"), (10, prose("en", 3000, 6), None), (11, ITEM, "en"),
]


def test_stages(spark, tmp_path):
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, t, g, "src", len(t or "")) for i, t, g in TEXTS], SCHEMA)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, SCHEMA)
        kept.append(sorted((r.doc_id or 0 for r in rows)))
    assert kept[0] == [0, 1, 2, 3, 7, 8, 8, 9, 10, 11]  # without letters no language
    assert kept[1] == [0, 2, 3, 7, 9, 10, 11]  # of 1 and 2 the longer stays, of 7 and both rows of 8 one row
    sets = {r: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for r, w in ((i, t.lower().split()) for i, t, _ in TEXTS if i in kept[1])}
    alike = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert alike == [(2, 3)] and kept[2] == [0, 2, 7, 9, 10, 11]
    assert kept[3] == [0, 2, 7, 10]  # 9 holds the item, 11 is it
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    lengths = {i or 0: len(t.encode()) for i, t, _ in TEXTS if t}
    assert {i: sum(r.length for r in pieces if (r.doc_id or 0) == i) for i in kept[3]} == {i: lengths[i] for i in kept[3]}
    for _, group in itertools.groupby(sorted(pieces, key=lambda r: r.bin_id), key=lambda r: r.bin_id):
        assert len(list(group)) == 1  # one source: no two documents meet


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []
        docs = spark.createDataFrame([], SCHEMA)
