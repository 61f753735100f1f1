"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton lists every vocabulary piece inside a run of text; dynamic programming
keeps, for each position, only the best score and the number of pieces that gave it. Spaces
become the mark U+2581, one more mark stands before the text, and no piece runs from another
character into a mark, so a text falls apart into runs whose counts add up; runs met before in a
task are looked up.

The rules, those of the unigram model in the tokenizers library: the larger sum of scores
wins; of equal sums, the one whose last piece starts further left; a character that no piece
covers alone may also stand for itself at the least score of the vocabulary minus 10, and
counts one token for each of its UTF-8 bytes if the vocabulary holds all byte pieces. Without
those, a stretch of such characters counts one.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import without

MARK = "▁"
#: Fixed value: what an unknown character costs below the least score.
UNKNOWN_PENALTY = 10.0
RUNS_KEPT = 1_000_000


def read_pieces(model_path: str) -> list[tuple[str, float]]:
    """(piece, score) by id from a sentencepiece model file; control pieces have an empty name."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [("" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts tokens of texts under one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        byte = re.compile("<0x[0-9A-F]{2}>")
        self.bytes = sum(bool(byte.fullmatch(p)) for p, _ in pieces) == 256
        self.lowest = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton, self.single, inner = ahocorasick.Automaton(), {}, set()
        held = False
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                held = True
                if len(piece) == 1:
                    self.single[piece] = score
                else:
                    inner |= set(piece)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} runs into a mark")
        if held:
            self.automaton.make_automaton()
        self.held = held
        # a line end that only stands alone also parts runs
        self.runs = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if "\n" not in inner else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known: dict[str, int] = {}

    def run(self, text: str) -> int:
        """Count for one run of text."""
        n = len(text)
        best, count, unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if self.held:
            for last, (size, score) in self.automaton.iter(text):
                ends[last + 1].append((size, score))
        lowest = self.lowest
        for at in range(1, n + 1):
            # longest first: of equal sums the piece that starts further left stays
            for size, score in ends[at]:
                s = best[at - size] + score
                if best[at] is None or s > best[at]:
                    best[at], count[at], unknown[at] = s, count[at - size] + 1, False
            char = text[at - 1]
            if char not in self.single and (best[at] is None or best[at - 1] + lowest > best[at]):
                best[at], unknown[at] = best[at - 1] + lowest, True
                if self.bytes:
                    count[at] = count[at - 1] + len(char.encode("utf-8", "surrogatepass"))
                else:
                    count[at] = count[at - 1] + (not unknown[at - 1])
        return count[n]

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; none for null and empty texts."""
        if not text:
            return 0
        runs = self.runs(MARK + text.replace(" ", MARK))
        known = self.known
        try:
            return sum(map(known.__getitem__, runs))
        except KeyError:
            if len(known) > RUNS_KEPT:
                known.clear()
            for r in set(runs).difference(known):
                known[r] = self.run(r)
            return sum(map(known.__getitem__, runs))


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Input columns without the text, plus n_tokens long.

    The model file must be readable on every worker under the given path. Null and empty texts
    have no tokens; repeated rows are each returned; an input column named n_tokens is replaced;
    texts of any length are counted whole.
    """
    kept = without(docs, text_col, "n_tokens")
    frame = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)], F.col(text_col).alias("text"))
    at = len(kept.columns)
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)], "n_tokens long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(read_pieces(model_path))
        for piece in tb.pieces(batches, at):
            n = np.fromiter(map(counter.count, piece.column(at).to_pylist()), np.int64, piece.num_rows)
            yield pa.RecordBatch.from_arrays([*[piece.column(i) for i in range(at)], pa.array(n)], names=[*[f"c{i}" for i in range(at)], "n_tokens"])

    return frame.mapInArrow(run, schema).toDF(*kept.columns, "n_tokens")
