"""Token counts under a unigram vocabulary: Viterbi that carries score and count only.

An Aho-Corasick automaton lists every vocabulary match of a word; dynamic programming
keeps, for each end position, the best score and its number of pieces. Nothing is
traced back. Ties follow the unigram tokenizer: a later match replaces an earlier one
only when its score is greater, and matches come in the order of their start, so the
longest last piece wins. A character without any single-character piece counts as
one unknown of score ``min - 10``; runs of unknowns count once.

A text is taken as one sentence: blanks become U+2581 and one is put in front. No
piece holds U+2581 behind another character, so a text splits before each run of it
and the words are independent; so are letters and other characters where no piece joins
them. Scores are multiples of 2^-10, whose sums are exact, so the split changes no
comparison.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mercantil.llm.common import Memo, file_bytes, sliced, texts

#: What the vocabulary writes for a blank.
SPACE = "▁"
CACHE = 400_000
UNKNOWN_PENALTY = 10.0
SCALE = 1024.0


def zipf_vocabulary(data: bytes) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece file in order, each with a log probability by its rank.

    The file ranks pieces, it has no probabilities: they are taken as 1/(rank + 10),
    rounded to 2^-10. Control, unknown and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / (r + 10) for r in range(len(pieces))))
    return [(p, round((-math.log(r + 10) - total) * SCALE) / SCALE) for r, p in enumerate(pieces)]


class UnigramCounter:
    """Counts pieces; equal to the unigram tokenizer over the same vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], cache: int = CACHE):
        if any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary):
            raise ValueError("a piece holds a blank behind another character")
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = Memo(self.count_word, cache)
        # Where no piece joins letters to other characters, they are settled apart.
        mixed = regex.compile(rf"\p{{L}}[^\p{{L}}]|[^{SPACE}\p{{L}}]\p{{L}}").search
        apart = not any(mixed(p) for p, _ in vocabulary)
        self.split = regex.compile(rf"{SPACE}*\p{{L}}+|{SPACE}*[^{SPACE}\p{{L}}]+|{SPACE}+" if apart
                                   else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def count_word(self, word: str) -> tuple[float, int, bool, bool]:
        """Best score, pieces, and whether the first and last piece are unknown."""
        # Of each settled prefix: score, and 4 * pieces + 2 * first unknown + last unknown.
        scores, packs, unknown = [0.0], [0], self.unknown
        score, pack, single, settled = -math.inf, 0, False, 0
        # Matches come by their end, the longest first; one behind the end settles the rest.
        for last, (size, own) in chain(self.automaton.iter(word), [(len(word), (1, 0.0))]):
            while settled < last:
                if not single and scores[settled] + unknown > score:
                    score, before = scores[settled] + unknown, packs[settled]
                    pack = before if before & 1 else before + 5 if settled else 7
                scores.append(score)
                packs.append(pack)
                score, single = -math.inf, False
                settled += 1
            start = last + 1 - size
            own += scores[start]
            if own > score:
                score, pack = own, (packs[start] & -2) + 4
            single = size == 1
        pack = packs[len(word)]
        return scores[len(word)], pack >> 2, bool(pack & 2), bool(pack & 1)

    def count(self, text: str) -> tuple[int, float]:
        """Pieces and total score of a text; nothing for an empty one."""
        if not text:
            return 0, 0.0
        pieces, total, open_unknown = 0, 0.0, False
        for score, n, first, last in map(self.words.__getitem__, self.split(SPACE + text.replace(" ", SPACE))):
            pieces += n - (open_unknown and first)
            total += score
            open_unknown = last
        return pieces, total


_BUILT: dict = {}


def _counter(data: bytes) -> UnigramCounter:
    key = hashlib.sha256(data).digest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = UnigramCounter(zipf_vocabulary(data))
    return _BUILT[key]


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score`` for every row.

    Null and empty texts count 0 with score 0. Repeated rows are each counted. Memory
    per task is one batch of texts plus a bounded cache of words.
    """
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(model_path))

    def run(batches):
        counter = _counter(shared.value)
        for batch in sliced(batches):
            found = [counter.count(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([n for n, _ in found], pa.int64()),
                                   pa.array([s for _, s in found], pa.float64())],
                                  names=["doc_id", "n_tokens", "score"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, score double")
