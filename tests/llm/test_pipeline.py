from itertools import groupby

import corpus_pipeline
from tests.llm.test_decontaminate import slow as slow_hits
from tests.llm.test_packing import check
from tests.llm.test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"


def stage(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def slow_texts(rows, width=50):
    """The texts without their repeated bytes; characters that a cut leaves in part go whole."""
    first = {}
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(first.get(b[i : i + width], d), d)
    out = {}
    for d, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        parts = [bytes(b[i] for i, _ in run) for g, run in groupby(enumerate(gone), key=lambda x: x[1]) if not g]
        out[d] = "".join(x.decode("utf-8", "ignore") for x in parts)
    return out


def test_each_stage_against_brute_force_on_all_that_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = rows(docs)

    def written(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    docs = written("language", stage(spark, "language", docs))
    assert docs.columns == columns and rows(docs) == sorted((r for r in kept if any(c.isalpha() for c in r[1] or "")), key=str)

    kept = sorted(rows(docs), key=lambda r: r[0])
    roots = slow_components([r[0] for r in kept], [slow_fingerprint(r[1]) for r in kept])
    docs = written("copies", stage(spark, "near copies", docs))
    kept = [r for r, root in zip(kept, roots, strict=True) if r[0] == root]
    assert docs.columns == columns and sorted(rows(docs), key=lambda r: r[0]) == kept

    docs = written("repeats", stage(spark, "repeated passages", docs))
    after = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and len(after) == len(kept)
    want = slow_texts([r[:2] for r in kept])
    for doc_id, text, lang, source, n_chars in kept:
        r = after[doc_id]
        assert (r.text, r.lang, r.source) == (want[doc_id], lang, source)
        assert r.n_chars == (n_chars if r.text == text else len(r.text))

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    kept = rows(docs)
    hit = {d for d, _, n, *_ in slow_hits([r[:2] for r in kept], items) if n}
    docs = written("benchmark", stage(spark, "benchmark", docs))
    kept = [r for r in kept if r[0] not in hit]
    assert docs.columns == columns and rows(docs) == kept
    used, least = check(stage(spark, "packing", docs).collect(), [r[:2] for r in kept])
    assert used <= least + 1


def test_run_is_the_stages_one_after_the_other(spark, tmp_path):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(got.columns)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert rows(got) == rows(docs.select(got.columns)) and got.count() > 100


def test_odd_rows_pass_every_stage(spark):
    long_ = "some words that are said more than once in two of these texts, and go on for a while"
    rows_ = [
        (1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (3, "12 34 !", "en", None, 7, 1), (4, long_ + " one", "en", "s", 1, 1),
        (5, "Entirely new words first: " + long_, None, "s", None, 1), (5, "another text of the same id", "en", "s", 2, 1), (None, "no id here at all", "en", "s", 3, 1),
        (None, "no id here at all", "en", "s", 3, 1), (None, "also without, but different words", "en", "s", 3, 1), (6, "é " * 50_000, "fr", "s", 100_000, 1), (7, "no id here at all", "en", "s", 3, 1),
    ]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long, text_hash int")
    columns = docs.columns
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    docs = stage(spark, "language", docs)
    assert docs.columns == columns and ids(docs) == sorted(["4", "5", "5", "6", "7", "None", "None", "None"])
    docs = stage(spark, "near copies", docs)
    assert docs.columns == columns and ids(docs) == sorted(["4", "5", "5", "6", "7", "None"])
    docs = stage(spark, "repeated passages", docs)
    texts = {(r.doc_id, r.text[:12]): r.text for r in docs.collect()}
    assert docs.columns == columns and texts[5, "Entirely new"] == "Entirely new words first: " and texts[4, "some words t"] == long_ + " one"
    docs = stage(spark, "benchmark", docs)
    assert docs.columns == columns and len(ids(docs)) == 6
    packed = stage(spark, "packing", docs)
    assert set(ids(packed)) == {"4", "5", "6", "7", "None"}
    empty = docs.limit(0)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, FOLDER).collect() == [], name
