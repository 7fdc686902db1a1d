"""Token counts under a unigram vocabulary: Aho-Corasick finds the pieces, Viterbi carries score and count."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import made_once, shared_data, table

FILE = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
WORDS_KEPT = 300_000
NORMAL = 1


def vocabulary(file: str) -> list[tuple[str, float]]:
    """(piece, score) of every ordinary piece of a tokenizer file; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    ordinary = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return [(model.id_to_piece(i), model.get_score(i)) for i in ordinary]


class Counter:
    """Counts the pieces of texts; words met lately are remembered."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def matches(self, word: str) -> Iterator[tuple[int, tuple[int, float]]]:
        """(place of the last character, (length, score)) of every piece in the word, by place, longer ones first."""
        return self.automaton.iter(word)

    def viterbi(self, word: str) -> int:
        """The number of pieces on the best way through a word.

        Scores are sums of doubles. At every place the best way that ends there is kept, and of equals the one whose last
        piece is longest: ways arrive in the order of that piece's start, and a later one must be better.
        A character that no piece of one character matches may be stepped over at the unknown score, as many pieces as its
        bytes.
        """
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.matches(word):
            ends[end].append(match)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        for end, found in enumerate(ends, 1):
            top, many, single = None, 0, False
            for length, score in found:
                single |= length == 1
                score += best[end - length]
                if top is None or score > top:
                    top, many = score, count[end - length] + 1
            if not single:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    top, many = score, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            best[end], count[end] = top, many
        return count[n]

    def count(self, text: str) -> int:
        """Pieces of a text: spaces are marked, a mark is put in front, and every mark starts a word of its own."""
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0]:
            del words[0]
        known, total = self.known, 0
        for word in words:
            many = known.get(word)
            if many is None:
                many = self.viterbi(SPACE + word)
                if len(known) >= WORDS_KEPT:
                    known.clear()
                if len(word) <= 64:
                    known[word] = many
            total += many
        return total


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, n_chars, n_tokens) per document row.

    The vocabulary is broadcast; its size is set by the tokenizer's file. Null and empty texts have no tokens, null
    ids are kept, repeated rows give repeated results, very long texts and words are read whole, an empty table gives no
    rows, other columns are ignored.
    """
    shared = shared_data(docs.sparkSession, pieces)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = made_once(shared, Counter)
        for batch in batches:
            texts = [text.as_py() or "" for text in batch["text"]]
            sizes, counts = pa.array([len(t) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], sizes, counts], ["doc_id", "n_chars", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, n_chars long, n_tokens long")


def op10_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(public_tokenizers.path(FILE)))
