"""The stages of the pipeline, each against what a plain program makes of the rows it was given."""

import hashlib
import os
from collections import Counter

import pytest
from test_models import labelled
from test_near import groups
from test_texts import expected_lines

import corpus_pipeline
from shelfsight.llm import mixing, toxicity

P = pytest.importorskip("public_tokenizers")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    """A table folder of the odd documents and of labelled ones, with other ids."""
    root = str(tmp_path_factory.mktemp("tables"))
    taught, labels = labelled()
    rows = [(None if i is None else i + 100_000, text, "xx", source, len(text or "")) for i, text, source in taught]
    made = spark.createDataFrame(rows, docs.schema)
    docs.unionByName(made).write.parquet(f"{root}/documents.parquet")
    marks = [(None if i is None else i + 100_000, toxic, quality) for i, toxic, quality in labels]
    spark.createDataFrame(marks, "doc_id long, toxic int, quality int").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """The rows before the first stage and after each one, as in a run."""
    root = tmp_path_factory.mktemp("steps")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        found.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return found


def keyed(rows):
    return Counter(tuple(r) for r in rows)


def test_toxic_documents_go(spark, folder, steps):
    before, after = steps[0], steps[1]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = toxicity.toxic_documents(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert keyed(after) == Counter(tuple(r[c] for c in COLUMNS) for r in found if not r.predicted)
    gone = keyed(before) - keyed(after)
    insulting = [r for r in gone.elements() if any(word in (r[1] or "").lower() for word in ("grobian", "schuft", "lowlife"))]
    assert len(insulting) >= 80 and len(insulting) >= 0.9 * sum(gone.values())


def test_shared_lines_go(steps):
    want = Counter((i, text, len(text)) for (i, text, _, _), n in expected_lines([tuple(r) for r in steps[1]]).items() for _ in range(n))
    assert Counter((r.doc_id, r.text, r.n_chars) for r in steps[2]) == want


def test_one_of_each_group_stays(steps):
    kept = Counter(i for i, _, smallest in groups([tuple(r) for r in steps[2]]) if i == smallest)
    assert Counter(r.doc_id for r in steps[3]) == kept
    assert not keyed(steps[3]) - keyed(steps[2])


def test_one_of_each_group_stays_where_ids_repeat(spark, docs):
    """Repeated rows, one id over two texts of a group, and an id that is the smallest of one group and in another."""
    a, b = "one two three four five six seven", "quite other words stand in this text here"
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, a, "en", "t", 1), (2, a, "en", "s", 1), (0, b, "en", "s", 1), (1, b, "en", "s", 1),
            (None, "no id but a text", "en", "s", 1), (None, "no id but a text", "en", "s", 1)]
    found = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, docs.schema).repartition(3), "").collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted([("1", a), ("0", b), ("None", "no id but a text")])
    once = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert keyed(corpus_pipeline.drop_near_copies(spark, docs.unionAll(docs), "").collect()) == keyed(once)


def test_mix(spark, steps):
    docs = spark.createDataFrame([tuple(r) for r in steps[3]], ",".join(f"{c} {t}" for c, t in zip(COLUMNS, ("long", "string", "string", "string", "int"))))
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in steps[4]) == +copies
    assert set(keyed(steps[4])) <= set(keyed(steps[3]))


def test_tokens(steps):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = Counter()
    for r in steps[4]:
        ids = library.encode(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in steps[5]) == want


def test_run(spark, folder, steps):
    assert keyed(corpus_pipeline.run(spark, folder).collect()) == keyed(steps[-1])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_given_tables(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and found.count() > 100


def test_without_documents(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
