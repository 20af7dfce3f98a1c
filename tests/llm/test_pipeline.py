import random

import corpus_pipeline
from frameyard.llm.common import materialize

from tests.llm import brute


def test_stages(spark):
    """Each stage drops or masks just what its brute-force version says."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = materialize(stage(spark, docs, sf))
        after = {r["doc_id"]: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert docs.columns == cols
        if name == "ngram_jaccard_join":
            assert set(after) == {i for i, (_, c) in brute.jaccard(before.items(), 80, 5).items() if c == i}
        if name == "benchmark_decontamination":
            assert set(after) == {i for i, t in before.items() if not brute.contamination(t, items)[4]}
        if name == "secret_scan":
            for i, r in after.items():
                hit = any(brute.secrets(before[i])[:3])
                assert ("[SECRET]" in r["text"]) == hit and r["n_chars"] == len(r["text"]) and (hit or r["text"] == before[i])
        if name == "best_fit_packing":
            assert set(after) == set(before)


def rows_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_near_copies_odd_ids(spark):
    """Of each group one row stays, whether its rows repeat, have no id, or share an id with another text."""
    text = lambda c: " ".join(f"{c}{i}" for i in range(80))
    a, b, c, d = map(text, "abcd")
    rows = [(5, a), (5, b), (3, b), (None, c), (None, c), (7, d), (7, d), (7, d), (9, None), (9, ""), (None, None), (2, c + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert rows_of(got) == sorted([(5, a), (3, b), (7, d), (9, None), (9, ""), (None, None), (2, c + " end")], key=str)
    only = spark.createDataFrame([(None, c), (None, c), (None, d)], "doc_id long, text string")
    assert rows_of(corpus_pipeline.drop_near_copies(spark, only, "")) == sorted([(None, c), (None, d)], key=str)


def test_near_copies_five_words(spark):
    """Two words of a hundred changed: 86 of 106 five-word shingles agree, which is a near copy."""
    w = [f"w{i}" for i in range(100)]
    near = [*w[:30], "zz", *w[31:70], "yy", *w[71:]]
    apart = [x if i % 20 else f"z{i}" for i, x in enumerate(w)]
    docs = spark.createDataFrame([(3, " ".join(near)), (1, " ".join(w)), (2, " ".join(apart))], "doc_id long, text string")
    assert [i for i, _ in rows_of(corpus_pipeline.drop_near_copies(spark, docs, ""))] == [1, 2]


def test_stages_odd_tables(spark, tmp_path):
    """Empty tables, null texts, and columns named like the stages' own."""
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    cols = "doc_id long, text string, n_chars long, component_id long, _gone string, k long, label string, row int, _hash long, key string, order int"
    rows = [(i, t, n, *[7] * 2, *[None] * 6) for i, t, n in ((1, None, None), (1, "", 0), (None, "token=abcdefgh1", None), (2, "plain words", 11))]
    rows = [(*r[:4], "x", *r[5:]) for r in rows]
    for data in (rows, []):
        docs = spark.createDataFrame(data, cols)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = materialize(stage(spark, docs, str(tmp_path)))
            assert docs.columns == [c.split()[0] for c in cols.split(", ")] and docs.count() == before, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(data)
        if data:
            assert {(r["text"], r["n_chars"]) for r in docs.collect()} == {(None, None), ("", 0), ("[SECRET]", 8), ("plain words", 11)}


def test_rejected_by_text(spark, tmp_path):
    """A contaminated or toxic text takes no other text of its id along."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([("1", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "clean"), (1, f"x {item} y"), (None, item), (None, "clean"), (2, item), (2, item), (3, None)], "doc_id long, text string")
    assert rows_of(corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))) == sorted([(1, "clean"), (None, "clean"), (3, None)], key=str)

    rng = random.Random(8)
    rows = []
    for i in range(400):
        w = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(30)] + (["vilest", "grotty"] if i % 5 == 0 else [])
        rows.append((i, " ".join(w)))
    spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(1000, "vilest grotty"), (1000, "mild words"), (None, "vilest grotty"), (None, "mild words")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    got = rows_of(corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)))
    assert [r for r in got if r in odd] == [(1000, "mild words"), (None, "mild words")]
    assert [r for r in got if r not in odd] == sorted((r for r in rows if r[0] % 5), key=str)
