"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton of the vocabulary enumerates all pieces that occur in a text, by where they end. Dynamic
programming carries the best score and its number of pieces to each end. The tie rules are the tokenizer's: a later
candidate replaces an earlier one only with a strictly larger score, and candidates for one end come by their
begin, so the longest piece wins a tie. A character that is no piece itself may be unknown, at ten below the lowest
score; a run of unknown characters counts its bytes (byte fallback), or one.

If no piece has a word mark after another character and all scores are whole numbers, words do not influence each
other and sums are exact: each distinct word is counted once per worker and remembered. Otherwise whole texts are.

Defined cases. Null and empty texts have no tokens. Repeated rows are counted each. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
VOCABULARY = "piece_bpe_32k.model"
REMEMBERED = 500_000


class Counter(dict):
    """Number of tokens of texts; as a dict, those of single words."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True) -> None:
        import ahocorasick

        super().__init__()
        self.byte_fallback = byte_fallback
        self.pieces = {piece for piece, _ in pieces}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        joined = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.pieces)
        self.by_word = MARK in self.pieces and not joined and all(score == int(score) for _, score in pieces)
        self.words = re.compile(f"{MARK}+[^{MARK}]*")

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self[word] = self.best(word)
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        return sum([self[word] for word in self.words.findall(marked)]) if self.by_word else self.best(marked)

    def best(self, text: str) -> int:
        """Tokens of the best segmentation. Matches come by end, the longest first."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        run = list(range(n + 1))  # where the run of unknown characters that ends here begins
        end, best, shortest = 0, None, 0
        for last, (length, own) in self.automaton.iter(text):
            while end != last + 1:  # the end before is settled
                if shortest != 1 and end:
                    self._extend(text, end, best, score, count, run)
                elif end:
                    score[end] = best
                end, best, shortest = end + 1, None, 0
            total = score[end - length] + own
            if best is None or total > best:
                best, count[end] = total, count[end - length] + 1
            shortest = length
        while end <= n:
            if shortest != 1 and end:
                self._extend(text, end, best, score, count, run)
            end, best, shortest = end + 1, None, 0
        return count[n]

    def _extend(self, text: str, end: int, best: float | None, score: list, count: list, run: list) -> None:
        """Settle an end whose last character is no piece: it may be unknown."""
        total = score[end - 1] + self.unknown
        if best is None or total > best:
            run[end] = run[end - 1]
            count[end] = count[run[end]] + self._unknown(text[run[end] : end])
            best = total
        score[end] = best

    def _unknown(self, run: str) -> int:
        if run in self.pieces or not self.byte_fallback:
            return 1
        return len(run.encode("utf-8", "surrogatepass"))


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every row. ``path`` is a vocabulary file that every worker has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path or vocabulary_path()).count
        for batch in batches:
            counts = np.fromiter((count(x.as_py()) for x in batch.column("text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts)], ["doc_id", "n_tokens"])

    source = docs.select("doc_id", "text")
    doc_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {doc_type}, n_tokens long")
