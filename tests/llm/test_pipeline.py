"""The pipeline stage by stage: each on what the one before kept, against what its operator is held to elsewhere."""

from pyspark.sql import functions as F

import corpus_pipeline
from cardsentry.llm import catalog, minhash_dedup, mixing, pii, quality
from cardsentry.llm.common import read, written
from tests.llm.test_dedup import brute_groups
from tests.llm.test_texts import plain_spans

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns, at = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        at.append(docs)
        if len(at) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
    good, single, clean, mixed, encoded = at
    start = read(spark, SF, "documents")

    model = catalog.learned(spark, SF, start)
    scores = {r.doc_id: r.predicted for r in quality.score(start, model).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in scores.items() if p}

    groups = brute_groups([(r.doc_id, r.text) for r in good.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in groups.items() if c == i)

    texts = {r.doc_id: r.text for r in single.collect()}
    found = pii.fit(single)
    for r in clean.collect():
        assert not plain_spans(r.text)
        assert r.n_chars == len(r.text)
        assert r.text == pii.redacted(texts.pop(r.doc_id), found)
    assert not texts

    kept = {r.doc_id for r in mixing.mix(clean, kept=corpus_pipeline.KEPT_TOKENS).collect() if r.kept}
    assert {r.doc_id for r in mixed.collect()} == kept
    assert 0 < len(kept) < clean.count()

    rows = encoded.collect()
    assert {r.doc_id for r in rows} == kept
    assert all(r.round_trip for r in rows)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(r.text == texts[r.doc_id] for r in rows)  # decoded from the ids


CLASHING = ["score", "predicted", "kept", "node", "label", "weight", "tokens", "topic", "component_id", "key", "quality_score"]


def odd_documents(spark):
    start = read(spark, SF, "documents").where("doc_id < 60").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in start]
    rows += [(1000, None, "en", "web", None), (1001, "", "en", "web", 0), (1002, " \n ", None, None, 3), (1003, "a" * 200_000, "en", "web", 200_000)]
    rows += [(1004, "word " * 60_000, "en", None, 300_000), (None, rows[3][1], "en", "web", 5), (None, None, None, None, None)]
    rows += [rows[5], rows[5], (1005, rows[5][1], "fr", "news", 1), (1006, "mail me at jane.doe@example.org or +49 30 1234567", "en", "web", 7)]
    rows += [(2000 + i, rows[8][1], "en", "web", 9) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def test_odd_documents_with_clashing_columns(spark):
    docs = odd_documents(spark)
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "stage")
        assert out.columns == columns, name
        for row in out.select(*CLASHING).distinct().collect():
            assert tuple(row) == tuple(f"own {c}" for c in CLASHING), name
        known = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
        kept = out.select("doc_id", "text").collect()
        if name != "PII":
            assert {tuple(r) for r in kept} <= known, name
        if name == "MinHash near-dedup":
            assert len({r.doc_id for r in kept if r.doc_id is not None}) == sum(r.doc_id is not None for r in kept)
            assert sum((r.doc_id or 0) >= 2000 for r in kept) == 0  # copies of an earlier one
        if name == "PII":
            assert len(kept) == docs.count() and not any("jane.doe@" in (r.text or "") for r in kept)
            assert {r.doc_id for r in kept if r.text is None} == {r.doc_id for r in docs.collect() if r.text is None}
        assert 0 < len(kept) <= n
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}
    assert all((r.doc_id, r.text) in texts for r in out if r.round_trip)


def test_empty_documents(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
    assert docs.count() == 0


def test_workers_give_back_what_their_tasks_took(spark, tmp_path, monkeypatch):
    """Idle workers of one stage stand beside those of the next: every Python task ends by letting go."""
    rows = [(k, f"tell {k} of the words, call +49 30 1234567{k % 7} or 10.0.0.{k}", k % 2) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    jobs = {
        minhash_dedup: [lambda: minhash_dedup.near_duplicates(docs)],
        pii: [lambda: pii.candidates(docs), lambda: pii.redact(docs, pii.PiiModel((None, None), {}))],
        quality: [lambda: quality.score(docs, quality.fit(docs, docs))],
    }
    for module, parts in jobs.items():
        for n, part in enumerate(parts):
            at = str(tmp_path / f"{module.__name__}-{n}")

            def noted(at=at):
                with open(at, "a") as f:
                    f.write("x")

            monkeypatch.setattr(module, "let_go", noted, raising=False)
            assert part().collect()
            with open(at) as f:
                assert f.read()
