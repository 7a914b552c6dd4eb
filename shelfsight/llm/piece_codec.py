"""SentencePiece encoding and decoding for merge-type (BPE) models, by backtracking over longest matches."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table, unused, whole_texts

SPACE = "▁"
CACHE = 200_000
LONGEST_PART = 64

_RUNS = re.compile(f"[{SPACE}\\w]+|[^{SPACE}\\w]+").findall
BATCH = 256


class PieceCodec:
    """Encodes as a merge-type model does, without running the merges.

    The pieces of a model and their order are read with the sentencepiece library, which also decodes.
    A sequence of pieces is what the merges give exactly if each piece is the result of merging its own
    characters and each two neighbours are compatible, which means that merging their characters gives the
    two again. So a word is covered from left to right with the longest match (found by an Aho-Corasick
    automaton over all pieces) that is compatible with the piece before; a shorter match, and then a step
    back, follows where none is. A bit field holds the positions from which no cover exists, so none is tried twice.

    Texts are cut before each space that does not follow a space; no piece has a space after another
    character, so merges never cross these cuts. Words are cut further between letters and signs that no piece
    has next to each other, and around characters outside the model, which become bytes. Runs of spaces have pieces of equal rank, whose merges depend on their place; words that
    follow such a run are merged step by step.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces with inner spaces are not supported")
        if model.normalize(" AÄ  ﬁ\t") != f"{SPACE * 2}AÄ{SPACE * 2}ﬁ\t":
            raise ValueError("only models that leave texts as they are, with a space before, are supported")
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        order = sorted(plain, key=lambda i: -model.get_score(i))
        self.rank, before, at = {}, None, -1
        for i in order:
            at += model.get_score(i) != before
            before = model.get_score(i)
            self.rank[model.id_to_piece(i)] = at
        self.characters = {p for p in self.pieces if len(p) == 1}
        # Halves of each piece in its last merge; pieces that their own characters do not merge into are left out.
        self.halves: dict[str, tuple[str, str] | None] = {}
        for piece in self.pieces:
            parts, last = self._merge(piece)
            if len(parts) == 1:
                self.halves[piece] = last
        self.shorter: dict[str, str | None] = {}
        automaton = ahocorasick.Automaton()
        for piece in self.halves:
            automaton.add_word(piece, piece)
            self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.halves), None)
        automaton.make_automaton()
        self.matches = automaton.iter
        self.joints = {piece[n : n + 2] for piece in self.pieces for n in range(len(piece) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.signs: dict[str, list[int]] = {}
        self.words: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _merge(self, word: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces that merging the characters of ``word`` step by step gives, and the halves of the last merge."""
        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue: list[tuple[int, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts):
                joined = parts[left] + parts[right]
                if joined in self.rank:
                    heapq.heappush(queue, (self.rank[joined], left, right, joined))

        for at in range(len(parts) - 1):
            offer(at, at + 1)
        last = None
        while queue:
            _, left, right, joined = heapq.heappop(queue)
            if parts[left] is None or parts[right] is None or after[left] != right or parts[left] + parts[right] != joined:
                continue
            last = (parts[left], parts[right])
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p is not None], last

    def _compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both gives the two pieces again.

        Takes back the merges next to the border, latest first. The two pieces that met there must never have
        been due to merge with each other before one of them merged the other way.
        """
        rank, halves = self.rank, self.halves
        due = len(rank) + 1  # pieces at the border that merge with each other before this would have done so
        while True:
            if rank.get(left + right, due) < due:
                return False
            a, b = halves[left], halves[right]
            if a is None and b is None:
                return True
            if b is None or (a is not None and rank[left] > rank[right]):
                due, left = rank[left], a[1]  # of equal merges the one further left comes first: the one taken back
            else:
                due, right = rank[right] + 1, b[0]  # here, the one at the border

    def _cover(self, word: str) -> list[str]:
        size, shorter, pairs = len(word), self.shorter, self.pairs
        longest: list[str | None] = [None] * size
        for end, piece in self.matches(word):  # by rising end, so the last one for a start is the longest
            longest[end + 1 - len(piece)] = piece
        open_ends = (1 << (size + 1)) - 1
        taken: list[str] = []
        at, piece, before = 0, longest[0], ""
        while at < size:
            while piece is not None:
                if open_ends >> (at + len(piece)) & 1:
                    if not at:
                        break
                    pair = (before, piece)
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= CACHE:
                            pairs.clear()
                        fits = pairs[pair] = self._compatible(before, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece is None:  # no cover goes on from here
                open_ends &= ~(1 << at)
                piece = taken.pop()
                at -= len(piece)
                before = taken[-1] if taken else ""
            else:
                taken.append(piece)
                before = piece
                at += len(piece)
                piece = longest[at] if at < size else None
        return taken

    def _part_ids(self, part: str) -> list[int]:
        if self.characters.issuperset(part):
            taken = self._merge(part)[0] if part.startswith(SPACE * 2) else self._cover(part)
            return [self.pieces[p] for p in taken]
        ids: list[int] = []
        for known, characters in groupby(part, self.characters.__contains__):
            run = "".join(characters)
            ids += self._part_ids(run) if known else [self.bytes[b] for b in run.encode()]
        return ids

    def word_ids(self, word: str) -> list[int]:
        """The ids of a word and the spaces inside it, cut where no piece has a letter and the sign next to it together."""
        runs = _RUNS(SPACE + word.replace(" ", SPACE))
        if len(runs) == 1:
            return self._known(word, runs[0])
        parts = runs[:1]
        for run in runs[1:]:
            if parts[-1][-1] + run[0] in self.joints:
                parts[-1] += run
            else:
                parts.append(run)
        ids = list(self._known(parts[0][1:].replace(SPACE, " "), parts[0]))
        for part in parts[1:]:
            signs = self.signs.get(part)
            if signs is None:
                signs = self._part_ids(part)
                if len(self.signs) < CACHE // 4 and len(part) <= LONGEST_PART:
                    self.signs[part] = signs
            ids += signs
        return ids

    def _known(self, word: str, part: str) -> list[int]:
        """The ids of a word without signs, from the newer or older half of the cache if it is there."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self._part_ids(part)
            if len(word) <= LONGEST_PART:
                if len(self.words) >= CACHE:
                    self.words, self.older = {}, self.words
                self.words[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; none for an empty one."""
        if not text:
            return []
        words = text.replace(SPACE, " ").split(" ")
        # Empty strings stand for spaces that follow a space (or begin the text); they belong to the next word.
        if "" in words:
            joined, run = [], 0
            for n, word in enumerate(words):
                if word or n == len(words) - 1:
                    joined.append(" " * run + word)
                    run = 0
                else:
                    run += 1
            words = joined
        found = list(map(self.words.get, words))
        if None in found:
            found = [self.word_ids(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        return list(chain.from_iterable(found))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids) if ids else []


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(
    docs: DataFrame, model: str, summary: Callable[[list[int], str], tuple] | None = None,
    columns: str = "ids array<int>, decoded string", text_col: str = "text",
) -> DataFrame:
    """``docs`` with the ids of each whole text and the text they decode to, all other columns kept.

    ``model`` is the path of a merge-type SentencePiece model that every worker can read; there are no begin
    or end ids. ``summary`` may turn ids and decoded text into other values in the task, so that the ids of
    long texts need not leave it; ``columns`` then names them. Equally named columns of ``docs`` are replaced.

    Null and empty texts have no ids and decode to an empty text. Texts are encoded word by word with a bounded
    cache, so very long ones only need room for their ids. Repeated rows give repeated rows; an empty table
    gives an empty result.
    """
    whole_texts(docs.sparkSession)
    summary = summary or (lambda ids, decoded: (ids, decoded))
    names = [c.split()[0] for c in columns.split(", ")]

    @F.pandas_udf(columns)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = codec(model)
        for batch in batches:
            texts, rows = batch.fillna("").tolist(), []
            for at in range(0, len(texts), BATCH):
                ids = [pieces.encode(text) for text in texts[at : at + BATCH]]
                rows += [summary(i, d) for i, d in zip(ids, pieces.decode(ids), strict=True)]
            yield pd.DataFrame(rows, columns=names)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    place = unused(docs, "_made")
    return docs.withColumn(place, coded(F.col(text_col))).select(*kept, *[F.col(f"{place}.`{n}`").alias(n) for n in names])


_TEXT = [str(i) for i in range(1 << 16)]


def digests(ids: list[int], decoded: str) -> tuple[int, str, str]:
    listed = ",".join([_TEXT[i] for i in ids]).encode()
    return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def coded_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(docs.select("doc_id", "text"), path, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string").drop("text")


@query("op7_sentencepiece")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return coded_documents(table(spark, folder, "documents"))
