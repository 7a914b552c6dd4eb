"""Token ids as flat binary files with document offsets, written and read in parallel."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table, whole_texts
from shelfsight.session import shared_folder, written

END = 2
CACHE = 1_000_000
TOGETHER = 4096
CUT = 64  # characters of a text that tell rows of one id apart when parts are cut
NO_ID = np.iinfo(np.int64).min  # stands for a null document id in the files


class Encoder:
    """Encodes whole texts with the tokenizers library, each different word once per worker while the cache lasts.

    A byte-level tokenizer never has a token that goes on after white space has followed other characters, so
    a text may be cut before each space that does not follow white space. New words go to the library
    together: only their first token begins with a space, which shows where each word's ids start. Texts
    that have white space before a space, and tokenizers of another kind, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        largest = max(self.library.get_vocab(with_added_tokens=True).values())
        self.type = np.dtype("<u2") if max(largest, END) < 1 << 16 else np.dtype("<u4")
        spaced = np.zeros(largest + 1, bool)
        spaced[[i for piece, i in self.library.get_vocab().items() if piece.startswith("Ġ")]] = True
        self.spaced = spaced
        kind = self.library.pre_tokenizer
        self.by_word = self.library.normalizer is None and type(kind).__name__ == "ByteLevel" and not kind.add_prefix_space
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.space_before_space = re.compile(r"\s ").search

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of each word with a space before it, which the cache gets as well."""
        made: dict[str, bytes] = {}
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            ids = np.array(self.library.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, self.type)
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(part):
                flat, cuts = ids.tobytes(), (starts * self.type.itemsize).tolist() + [ids.nbytes]
                made.update(zip(part, map(flat.__getitem__, map(slice, cuts, cuts[1:])), strict=True))
            else:
                made.update(zip(part, self._whole([" " + w for w in part]), strict=True))
        self._keep(made)
        return made

    def _keep(self, made: dict[str, bytes]) -> None:
        """Two halves of the cache: when the later one is full it becomes the earlier one, so words in use stay known."""
        if len(self.words) + len(made) > CACHE // 2:
            self.earlier, self.words = self.words, {}
        self.words.update(made)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers."""
        out: list[bytes | None] = [None] * len(texts)
        whole = [n for n, text in enumerate(texts) if not self.by_word or text.startswith(" ") or self.space_before_space(text)]
        cut = {n: text.split(" ") for n, text in enumerate(texts)}
        for n in whole:
            del cut[n]
        for n, ids in zip(whole, self._whole([texts[n] for n in whole]), strict=True):
            out[n] = ids
        firsts = self._whole([words[0] for words in cut.values()])
        get = self.words.get
        missing: list[tuple[list[str], list[bytes | None], list[int]]] = []
        for (n, words), first in zip(cut.items(), firsts, strict=True):
            out[n] = ids = list(map(get, words))
            ids[0] = first  # no space before it
            if None in ids:
                missing.append((words, ids, [k for k, i in enumerate(ids) if i is None]))
        if missing:
            new = {words[k] for words, _, holes in missing for k in holes}
            fresh = {w: self.earlier[w] for w in new if w in self.earlier}
            self._keep(fresh)
            fresh |= self._learn([w for w in new if w not in fresh])
            for words, ids, holes in missing:
                for k in holes:
                    ids[k] = fresh[words[k]]
        for n in cut:
            out[n] = b"".join(out[n])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _filesystem(folder: str):
    from pyarrow import fs

    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _store(folder: str, name: str, write) -> None:
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}") as out:
        write(out)


def _clean(folder: str, named: set[str]) -> None:
    """Delete the files of attempts that the manifest does not name, as those of lost or repeated tasks."""
    from pyarrow import fs

    files, root = _filesystem(folder)
    if files.get_file_info(root).type == fs.FileType.NotFound:
        return
    for info in files.get_file_info(fs.FileSelector(root)):
        if info.type == fs.FileType.File and info.base_name.startswith("part-") and info.base_name.rpartition(".")[0] not in named:
            files.delete_file(info.path)


def _load(folder: str, name: str, kind: np.dtype) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is a mounted one, else read from its store."""
    from pyarrow import fs

    files, root = _filesystem(folder)
    if files.get_file_info(f"{root}/{name}").size == 0:
        return np.empty(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(f"{root}/{name}", dtype=kind, mode="r")
    with files.open_input_file(f"{root}/{name}") as source:
        return np.frombuffer(source.read(), dtype=kind)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int = END) -> DataFrame:
    """Encode ``docs`` into token files in ``folder``; the manifest ``(part, file, n_docs, n_tokens, width, base)``.

    Documents are range-partitioned and sorted by ``doc_id`` (null first; ties by text), so parts are in order.
    For each part there are three flat little-endian files: ``.ids`` with the ids of all its documents, each
    ended by ``end``, as unsigned integers of ``width`` bytes (the least that holds the vocabulary), ``.offsets``
    with the n + 1 unsigned 64-bit places in it where documents start and end, and ``.docs`` with the
    64-bit document ids (the smallest integer for null). ``base`` is the number of ids in all earlier parts, a
    prefix sum over the manifest; it has a row for each part and is kept as a table beside the files. Each attempt at
    a part writes files of its own; ``file`` names those of the attempt that counts, and the others are deleted. Parts
    are cut within an id too, where many rows have the same or none, by how their texts begin.

    Null and empty texts are the end id alone. Repeated rows are written as often. An empty table gives no
    parts; other columns are not looked at.
    """
    spark = docs.sparkSession
    whole_texts(spark)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        part, file = task.partitionId(), f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encode = encoder(tokenizer)
        ending = np.array([end], encode.type).tobytes()
        lengths, ids = [np.zeros(1, np.uint64)], []

        def write(out) -> None:
            for batch in batches:
                texts = batch["text"].fillna("").tolist()
                for at in range(0, len(texts), 256):
                    rows = encode.encode(texts[at : at + 256])
                    out.write(b"".join([row + ending for row in rows]))
                    lengths.append(np.array([len(row) // encode.type.itemsize + 1 for row in rows], np.uint64))
                ids.append(batch["doc_id"].to_numpy(np.int64))

        _store(folder, f"{file}.ids", write)
        offsets = np.cumsum(np.concatenate(lengths), dtype=np.uint64).astype("<u8")
        _store(folder, f"{file}.offsets", lambda out: out.write(offsets.tobytes()))
        _store(folder, f"{file}.docs", lambda out: out.write(np.concatenate([np.empty(0, np.int64), *ids]).astype("<i8").tobytes()))
        yield pd.DataFrame({"part": [part], "file": [file], "n_docs": [len(offsets) - 1], "n_tokens": [int(offsets[-1])], "width": [encode.type.itemsize]})

    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(known.alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, CUT)).sortWithinPartitions("doc_id", "text")
    parts = written(ordered.mapInPandas(store, "part long, file string, n_docs long, n_tokens long, width int").where("n_docs > 0"), "token-parts")
    manifest = parts.withColumn("base", F.sum("n_tokens").over(W.orderBy("part")) - F.col("n_tokens"))
    path = f"{folder.rstrip('/')}/manifest"
    manifest.write.parquet(path)
    manifest = spark.read.schema(manifest.schema).parquet(path)
    _clean(folder, {row["file"] for row in manifest.select("file").collect()})
    return manifest


def read_tokens(manifest: DataFrame, folder: str, summary=None, columns: str = "tokens array<long>") -> DataFrame:
    """One row per document from the files: ``(doc_id, start, n_tokens)`` and what ``summary`` makes of its ids.

    ``start`` counts the ids of all documents before it. ``summary`` gets one document's ids as an array and
    returns the value of the single column that ``columns`` names; by default the ids themselves.
    """
    summary = summary or (lambda ids: ids.tolist())
    name = columns.split()[0]

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                file = row.file
                ids = _load(folder, f"{file}.ids", np.dtype(f"<u{row.width}"))
                offsets, docs = _load(folder, f"{file}.offsets", np.dtype("<u8")).astype(np.int64), _load(folder, f"{file}.docs", np.dtype("<i8"))
                for at in range(0, len(docs), 4096):
                    some, cuts = docs[at : at + 4096], offsets[at : at + 4097]
                    yield pd.DataFrame({
                        "doc_id": pd.array(some, dtype="Int64").copy(), "start": row.base + cuts[:-1], "n_tokens": np.diff(cuts),
                        name: [summary(ids[a:b]) for a, b in zip(cuts, cuts[1:])],
                    }).assign(doc_id=lambda d, s=some: d["doc_id"].mask(s == NO_ID))

    parts = max(1, manifest.count())
    return manifest.repartition(parts).mapInPandas(load, f"doc_id long, start long, n_tokens long, {columns}")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@query("op9_token_files")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = shared_folder(spark, "tokens")
    manifest = write_tokens(table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(manifest, files, crc32, "ids_crc32 long")
