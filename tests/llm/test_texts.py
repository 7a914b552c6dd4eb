import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsight.llm.line_dedup import LineRuns, drop_repeated_lines
from shelfsight.llm.piece_codec import PieceCodec, codec, digests, encode_pieces
from shelfsight.llm.token_files import Encoder, crc32, read_tokens, write_tokens

P = pytest.importorskip("public_tokenizers")
SPACE = " \t\n\x0b\x0c\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected_lines(rows, min_chars=40, min_docs=5):
    held, last = defaultdict(int), {}
    for i, text, *_ in rows:
        for key in {lowered(line.strip(SPACE)) for line in (text or "").split("\n")}:
            held[key] += 1
            last[key] = max((x for x in (last.get(key), i) if x is not None), default=None)
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(k := lowered(x.strip(SPACE))) < min_chars or held[k] < min_docs or last[k] == i]
        out[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def lines_of(frame, **how):
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(frame, **how).collect())


def test_lines(docs, rows, clashing, repeated, empty_docs):
    want = expected_lines(rows)
    assert sum(n for (*_, dropped), n in want.items() if dropped) > 20
    assert lines_of(docs) == want
    assert lines_of(docs, batches=1) == want
    assert lines_of(docs, batches=7) == want
    assert lines_of(clashing) == want
    assert set(drop_repeated_lines(clashing).columns) == set(clashing.columns)
    assert lines_of(repeated) == expected_lines(rows + rows)
    assert lines_of(docs, min_chars=3, min_docs=2) == expected_lines(rows, 3, 2)
    assert drop_repeated_lines(empty_docs).count() == 0


def test_runs_hold_each_key_once_and_are_merged(spark):
    runs, added = LineRuns(spark, fanout=2), Counter()
    rng = random.Random(4)
    for batch in range(7):
        keys = [(bytes([rng.randrange(40)]), batch * 100 + n) for n in range(30)]
        keys = list(dict.fromkeys(keys))
        added.update(k for k, _ in keys)
        runs.add(spark.createDataFrame([(bytearray(k), i) for k, i in keys], "key binary, doc_id long"))
        held = [bytes(r.key) for run in runs.runs for r in run.collect()]
        assert len(held) == len(set(held)) == len(added)
        assert [len(level) for level in runs.levels] == [int(b) for b in reversed(f"{batch + 1:b}")]
    assert {bytes(r.key): r.docs for r in runs.totals().collect()} == added


@pytest.fixture(scope="module")
def model():
    return P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def odd_texts(seed, n):
    rng = random.Random(seed)
    letters = "ab t▁ éßñ,.\n\t<0x>1梦\x00​😀ﬁÄeinungthe  \u0085'll"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]
    texts += [" " * k + "x" + " " * j for k in range(40) for j in range(3)] + ["", " ", "  ", "<|endoftext|>", "a <|endoftext|>b", "</s> <unk>"]
    texts += [chr(rng.randrange(1, 0xD7FF)) * rng.randrange(1, 4) + rng.choice(["", " x"]) for _ in range(n)]
    return texts


def test_pieces_equal_the_library(model, library):
    pieces = codec(model)
    texts = odd_texts(1, 3000)
    ids = [pieces.encode(t) for t in texts]
    assert ids == library.encode(texts)
    assert pieces.decode(ids) == [library.decode(i) for i in ids]


def test_compatible_pairs_are_those_that_merge_into_themselves(model):
    pieces = codec(model)
    rng = random.Random(2)
    names = [p for p in pieces.halves if not p.startswith("▁▁")]
    right = [p for p in names if not p.startswith("▁")]
    pairs = [(rng.choice(names), rng.choice(right)) for _ in range(4000)]
    pairs += [(a[:-k], a[-k:]) for a in rng.sample(names, 1500) for k in (1, 2) if a[:-k] in pieces.halves and a[-k:] in pieces.halves]
    for a, b in pairs:
        assert pieces._compatible(a, b) == (pieces._merge(a + b)[0] == [a, b]), (a, b)


def test_small_caches(model, library, monkeypatch):
    monkeypatch.setattr("shelfsight.llm.piece_codec.CACHE", 3)
    texts = odd_texts(5, 300)
    pieces = PieceCodec(model)
    assert [pieces.encode(t) for t in texts] == library.encode(texts)


def test_encode_pieces(docs, rows, clashing, repeated, empty_docs, model, library):
    def got(frame):
        return sorted(((r.doc_id, r.ids, r.decoded) for r in encode_pieces(frame, model).collect()), key=str)

    want = sorted(((i, ids := library.encode(t or ""), library.decode(ids)) for i, t, *_ in rows), key=str)
    assert got(docs) == want
    assert got(clashing) == want
    assert got(repeated) == sorted([*want, *want], key=str)
    assert got(empty_docs) == []
    assert set(encode_pieces(clashing, model).columns) == set(clashing.columns)
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    summed = {r.doc_id: r for r in encode_pieces(docs, model, digests, columns).collect()}
    for i, t, *_ in rows:
        ids = library.encode(t or "")
        assert summed[i].n_tokens == len(ids)
        assert summed[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert summed[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path(name))
    texts = odd_texts(3, 2000)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for cache in (500_000, 5):
        monkeypatch.setattr("shelfsight.llm.token_files.CACHE", cache)
        made = Encoder(P.path(name))
        for _ in range(2):
            assert [np.frombuffer(ids, made.type).tolist() for ids in made.encode(texts)] == want
    assert made.encode([]) == []


def token_rows(frame, folder, **how):
    manifest = write_tokens(frame, folder, P.path("byte_bpe_50k.json"))
    return manifest, read_tokens(manifest, folder, **how)


def test_token_files(spark, docs, rows, clashing, repeated, empty_docs, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))

    def expected(rows):
        start, out = 0, []
        for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = library.encode(text or "", add_special_tokens=False).ids + [2]
            out.append((i, start, len(ids), ids))
            start += len(ids)
        return out

    manifest, got = token_rows(docs, f"file://{tmp_path}/a")
    assert [tuple(r) for r in got.orderBy("start").collect()] == expected(rows)
    parts = manifest.orderBy("part").collect()
    assert sum(p.n_docs for p in parts) == len(rows) and all(p.width == 2 for p in parts)
    flat = b"".join((tmp_path / f"a/{p.file}.ids").read_bytes() for p in parts)
    assert np.frombuffer(flat, "<u2").tolist() == [i for *_, ids in expected(rows) for i in ids]
    assert {f.name for f in (tmp_path / "a").iterdir() if f.is_file()} == {f"{p.file}.{kind}" for p in parts for kind in ("ids", "offsets", "docs")}

    _, got = token_rows(clashing, str(tmp_path / "b"), summary=crc32, columns="ids_crc32 long")
    assert [tuple(r) for r in got.orderBy("start").collect()] == [(i, s, n, zlib.crc32(np.array(t, "<u4").tobytes())) for i, s, n, t in expected(rows)]
    _, got = token_rows(repeated, str(tmp_path / "c"))
    assert [tuple(r)[1:] for r in got.orderBy("start").collect()] == [x[1:] for x in expected(rows + rows)]
    _, got = token_rows(empty_docs, str(tmp_path / "d"))
    assert got.count() == 0


def test_large_ids_survive(spark, tmp_path):
    made = spark.createDataFrame([((1 << 53) + 1, "a"), (-5, "b"), (None, "c")], "doc_id long, text string")
    _, got = token_rows(made, str(tmp_path / "e"))
    assert [r.doc_id for r in got.orderBy("start").collect()] == [None, -5, (1 << 53) + 1]


def test_one_id_of_many_rows_is_cut(spark, tmp_path):
    """Rows without an id go to many parts, in the order of their texts; files of lost attempts are deleted."""
    texts = [f"{n % 977} text {n}" for n in range(4000)]
    made = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(6)
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "part-000000-77.ids").write_bytes(b"left by a lost attempt")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest, got = token_rows(made, str(tmp_path / "f"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = manifest.collect()
    assert len(parts) > 2 and max(p.n_docs for p in parts) < 2500 and not (tmp_path / "f" / "part-000000-77.ids").exists()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert [r.tokens[:-1] for r in got.orderBy("start").collect()] == [e.ids for e in library.encode_batch(sorted(texts), add_special_tokens=False)]


def test_a_column_more_does_no_harm(docs, model):
    more = docs.select("*", F.lit(1).alias("n_tokens"))
    assert encode_pieces(more, model, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string").columns.count("n_tokens") == 1
