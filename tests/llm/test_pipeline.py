"""The pipeline on a small corpus with planted cases, stage by stage and as a whole."""

import random

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(21)
    words = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep", "ze", "et", "th") for b in ("ta", "pha", "mma", "lta", "on")]
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: " ".join(rnd.choice(common if rnd.random() < 0.4 else words) for _ in range(n))
    items = [text(20) for _ in range(5)]
    rows = [(i, text(120), "en", "s") for i in range(60)]
    plain = list(rows)
    near = plain[5][1].split()
    near[50] = "changed"
    rows += [(100, plain[5][1], "en", "copy"), (101, " ".join(near), "en", "near"), (102, text(60) + " " + items[2] + " " + text(60), "en", "leak"), (103, text(60) + " mail bob@example.com and 10.1.2.3 " + text(60), "en", "pii")]
    rows += [(104, "word " * 80, "en", "repeat"), (105, "too short", "en", "short"), (106, None, None, None), (107, "", "en", ""), (108, " ".join(w + "$$$" for w in text(120).split()), "en", "symbols"), (7, plain[7][1], "en", "s"), (None, text(120), "en", "s")]
    # of fewer than eight words: both are in 109, one in 110
    items += ["zulu yankee", "xray whiskey"]
    rows += [(109, text(60) + " zulu yankee " + text(60) + " xray whiskey", "en", "leak"), (110, text(60) + " zulu yankee " + text(60), "en", "s")]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(*r, len(r[1] or ""), "e") for r in rows], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), [r[0] for r in plain]


def test_stages(spark, corpus):
    folder, plain = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        kept[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.select("doc_id").collect())
    ids = {name: [i for null, i in v if not null] for name, v in kept.items()}
    assert ids["quality rules"] == sorted([*plain, 7, 100, 101, 102, 103, 109, 110])
    assert ids["MinHash near-dedup"] == sorted([*plain, 102, 103, 109, 110])
    assert ids["benchmark decontamination"] == ids["PII"] == sorted([*plain, 103, 110])
    assert len(kept["PII"]) == len(plain) + 3  # the row without an id stays
    text = spark.read.parquet(f"{folder}/stage3").filter("doc_id = 103").first()
    assert "mail [EMAIL] and [IP]" in text.text and text.n_chars == len(text.text)
    assert {tuple(r) for r in corpus_pipeline.run(spark, folder).collect()} == {tuple(r) for r in docs.collect()}


def test_empty_documents(spark, corpus, tmp_path):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
