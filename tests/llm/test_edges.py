"""Every operator and stage on nulls, empty, very long and repeated texts, clashing columns and empty tables."""
import collections
import re
import zlib

import cases
import pytest

import corpus_pipeline
from crmflow.llm import decontaminate, hpy_model, line_labels, mixing, ngram_join, pii, quality_model, sharding, token_files, toxicity

OPERATORS = {
    "mixing": lambda s, d: mixing.rated(d, mixing.labelled_domains(d, cases.labels(s))),
    "tokens": lambda s, d: token_files.encoded(d),
    "pii": lambda s, d: pii.found(d),
    "lines": lambda s, d: line_labels.judged(d, cases.labels(s)),
    "shards": lambda s, d: sharding.sharded(d),
    "quality": lambda s, d: quality_model.quality_scores(d, cases.labels(s)),
    "join": lambda s, d: ngram_join.jaccard_components(d),
    "model": lambda s, d: hpy_model.seventh_scores(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, cases.labels(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("extra", [False, True])
def test_one_row_for_each_row(spark, name, extra):
    got = OPERATORS[name](spark, cases.documents(spark, extra)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in cases.rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name](spark, cases.documents(spark).limit(0)).collect() == []


def test_no_labels(spark):
    docs, none = cases.documents(spark), cases.labels(spark).limit(0)
    assert not any(r["rejected"] for r in toxicity.toxicity(docs, none).collect())
    assert all(r["rate"] == 1 for r in mixing.rated(docs, mixing.labelled_domains(docs, none)).collect())
    assert len({r["score"] for r in quality_model.quality_scores(docs, none).collect()}) == 1
    assert all(r["n_boilerplate"] == 0 for r in line_labels.judged(docs, none).collect())


def test_model_keeps_no_finished_tables(spark):
    from collections import Counter
    from pathlib import Path
    from urllib.parse import urlparse

    from crmflow.llm.common import shared_folder

    folder = Path(urlparse(shared_folder(spark)).path)
    before = set(folder.iterdir()) if folder.exists() else set()
    got = hpy_model.seventh_scores(cases.documents(spark))
    left = Counter(x.name.split("-")[0] for x in set(folder.iterdir()) - before)
    assert left["seats"] == 1 and not left["parent"]
    assert got.count() == len(cases.rows())


def test_mixing_takes_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 10_000)
        docs = cases.documents(spark)
        mixing.rated(docs, mixing.labelled_domains(docs, cases.labels(spark)))
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)


def test_benchmark(spark):
    for docs in (cases.documents(spark), cases.documents(spark, True)):
        got = decontaminate.contaminated(docs, cases.benchmark(spark)).collect()
        # The very long text, of the same few words, may match too.
        assert (12, 0) in {(r["doc_id"], r["item_id"]) for r in got}
    assert decontaminate.contaminated(cases.documents(spark).limit(0), cases.benchmark(spark)).count() == 0
    assert decontaminate.contaminated(cases.documents(spark), cases.benchmark(spark).limit(0)).count() == 0


def test_stages(spark, tmp_path):
    cases.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    cases.benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (cases.documents(spark), cases.documents(spark, True), cases.documents(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == docs.columns, name
            got.collect()
    kept = corpus_pipeline.drop_near_copies(spark, cases.documents(spark), str(tmp_path)).collect()
    ids = [r["doc_id"] for r in kept]
    assert ids.count(1) == 1 and not {2, 3, 8} & set(ids) and {4, 5, 6, 7, None} <= set(ids)
    assert 12 not in [r["doc_id"] for r in corpus_pipeline.drop_benchmark(spark, cases.documents(spark), str(tmp_path)).collect()]
    mixed = [r["doc_id"] for r in corpus_pipeline.mix_domains(spark, cases.documents(spark), str(tmp_path)).collect()]
    assert set(mixed) == {r[0] for r in cases.rows()}
    cases.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 30


def test_join_against_all_pairs(spark):
    sets = {}
    for i, text, *_ in cases.rows():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = set(zip(words, words[1:], words[2:])) if len(words) > 2 else ({tuple(words)} if words else set())
    lowest = {i: i for i in sets if i is not None}
    for _ in range(len(lowest)):
        for a in lowest:
            for b in lowest:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                    lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(cases.documents(spark)).collect()}
    assert {i: x for i, x in got.items() if i is not None} == {i: (len(sets[i]), lowest[i]) for i in lowest}


def test_tokens_against_the_library(spark):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    start, want = 0, []
    for i, text in sorted(((r[0], r[1] or "") for r in cases.rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.encoded(cases.documents(spark)).orderBy("start").collect()
    assert [tuple(r)[:4] for r in got] == want
