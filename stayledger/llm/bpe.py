"""BPE encoding and decoding by an automaton over tokens, compiled from the merges."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import made_once, shared_data, table

FILE = "word_bpe_49k.json"
WORDS_KEPT = 300_000


@dataclass(frozen=True)
class Automaton:
    """States and arcs are classes of tokens; ``follows[state]`` has a bit for each class of arcs that may leave it."""

    ids: dict[str, int]
    labels: list[str]
    state: list[int]
    arc: list[int]
    follows: list[bytes]
    end: str
    longest: int
    split: str
    special: dict[str, int]


@lru_cache(maxsize=2)
def compiled(file: str) -> Automaton:
    """The automaton of a tokenizer file (BPE with word ends over bytes), by one merge gadget after another.

    An automaton of tokens accepts a sequence if every token may follow the one before. At first all
    symbols may follow one another, save that none follows a word's end. The gadget of a merge u v -> w adds the arc w: it
    leads where v leads, it leaves the states that u leaves, and the way from u on to v is closed. The order
    of these steps gives the leftmost pair precedence when u = v. What is accepted after the last merge is each text's only
    encoding. Tokens that lead to the same arcs become one state, tokens that leave the same states one class
    of arcs.
    """
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    ids: dict[str, int] = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    end = spec["model"]["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    made = {a + b for a, b in merges}
    symbols = [t for t in ids if t not in made and t not in special]
    order = symbols + [a + b for a, b in merges]
    place = {t: i for i, t in enumerate(order)}
    inner = [t for t in order if not t.endswith(end)]
    row = {t: i for i, t in enumerate(inner)}
    may = np.zeros((len(order), (len(inner) + 7) // 8), dtype=np.uint8)
    for t in symbols:
        if t in row:
            may[: len(symbols), row[t] >> 3] |= np.uint8(1 << (row[t] & 7))
    for k, (u, v) in enumerate(merges, len(symbols)):
        w = order[k]
        if w in row:
            bits = (may[:k, row[v] >> 3] >> (row[v] & 7)) & 1
            may[:k, row[w] >> 3] |= bits << (row[w] & 7)
        may[place[v], row[u] >> 3] &= np.uint8(~(1 << (row[u] & 7)) & 0xFF)
        may[k] |= may[place[u]]
    arcs, arc = np.unique(may, axis=0, return_inverse=True)
    leads = np.unpackbits(arcs, axis=1, bitorder="little")[:, : len(inner)].T
    states, state = np.unique(np.packbits(leads, axis=1, bitorder="little"), axis=0, return_inverse=True)
    arc, state = arc.ravel(), state.ravel()
    split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    labels = [""] * (max(max(ids.values()), *special.values()) + 1)
    state_of, arc_of = [0] * len(labels), [0] * len(labels)
    for t, i in (ids | special).items():
        labels[i] = t
        if t in place:
            arc_of[i] = int(arc[place[t]])
            state_of[i] = int(state[row[t]]) if t in row else -1
    return Automaton(
        {t: ids[t] for t in order}, labels, state_of, arc_of, [s.tobytes() for s in states], end, max(map(len, order)), split, special
    )


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Encoder:
    """Encodes texts by walking the automaton; words met lately are remembered."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.split = regex.compile(automaton.split)
        self.space = regex.compile(r"\p{White_Space}+")
        self.special = regex.compile("|".join(map(regex.escape, sorted(automaton.special, key=len, reverse=True)))) if automaton.special else None
        self.symbols = byte_symbols()
        end = automaton.end
        self.inner = {t: i for t, i in automaton.ids.items() if not t.endswith(end)}
        self.last = {t.removesuffix(end): i for t, i in automaton.ids.items() if t.endswith(end)}
        self.known: dict[str, tuple[bytes, str, int]] = {}

    def walk(self, word: str) -> list[int]:
        """The ids of one pre-split word: for every place the token that arrives there on the only accepted way.

        The arcs into a place are the tokens that end there; one is taken if the state at its other end has it. The work
        grows with the word's length times the longest token's, also for very long words.
        """
        a = self.automaton
        state, arc, follows, longest = a.state, a.arc, a.follows, a.longest
        symbols = self.symbols
        text = "".join([symbols[b] for b in word.encode("utf-8")])
        n = len(text)
        came = [-1] * (n + 1)
        start = [0] * (n + 1)
        for i in range(1, n + 1):
            arcs = self.inner if i < n else self.last
            for j in range(i - longest if i > longest else 0, i):
                token = arcs.get(text[j:i])
                if token is None:
                    continue
                if j:
                    before = came[j]
                    if before < 0 or not follows[state[before]][arc[token] >> 3] >> (arc[token] & 7) & 1:
                        continue
                came[i], start[i] = token, j
                break
        out = []
        while n:
            out.append(came[n])
            n = start[n]
        return out[::-1]

    def words(self, text: str) -> Iterator[tuple[bytes, str, int]]:
        """(ids as little-endian 32-bit integers, labels, number) of every pre-split word and special token in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at : m.start()])
            token = self.automaton.special[m[0]]
            yield token.to_bytes(4, "little"), self.automaton.labels[token], 1
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[tuple[bytes, str, int]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known = self.known
        for word in self.split.findall(self.space.sub(" ", text).lower()):
            found = known.get(word)
            if found is None:
                ids = self.walk(word)
                found = (np.array(ids, dtype="<u4").tobytes(), " ".join([self.automaton.labels[i] for i in ids]), len(ids))
                if len(known) >= WORDS_KEPT:
                    known.clear()
                if len(word) <= 64:
                    known[word] = found
            yield found


def encoded(docs: DataFrame, file: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document row; decoding emits the labels of the ids' arcs.

    The automaton is compiled once and broadcast; its size is set by the tokenizer's file. Null and empty texts give no
    tokens, null ids are kept, repeated rows give repeated results, very long texts and words are read whole, an empty
    table gives no rows, other columns are ignored.
    """
    shared = shared_data(docs.sparkSession, {f.name: getattr(compiled(file), f.name) for f in fields(Automaton)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = made_once(shared, lambda data: Encoder(Automaton(**data)))
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch["text"]:
                found = list(encoder.words(text.as_py() or ""))
                counts.append(sum([w[2] for w in found]))
                ids.append(hashlib.sha256(b"".join([w[0] for w in found])).hexdigest())
                texts.append(hashlib.sha256(" ".join([w[1] for w in found]).encode("utf-8")).hexdigest())
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op5_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(FILE))
