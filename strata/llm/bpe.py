"""Byte-pair encoding and decoding of whole texts by batched numpy merge rounds.

The ids are those of the ``tokenizers`` library with TOKENIZER (a lower-casing
vocabulary with word ends) and ``add_special_tokens=False``; special token strings
in a text are their ids. A text is normalised and cut into words; the distinct words
a task has not met yet are encoded together. Their symbols lie in one flat array.
The rank of each neighbouring pair is found by binary search over the sorted pair
keys, and each round merges, in every word at once, the pairs of the word's lowest
rank. Words of more than LONG symbols would need many rounds over long arrays; they
go by rank instead: positions wait in one bucket per rank, and a round takes the
lowest bucket, over all these words, and looks up only the pairs next to its merges.
Both are exact since a merge never makes a pair of a lower rank than its own (checked
when the vocabulary is loaded).

Decoding gathers the bytes of each id's token, joined as the library does for a
vocabulary without a decoder: by single spaces, word ends kept.

Normalising and Unicode classes: ASCII text is lower-cased as it is; other text is
normalised by the library's own normaliser, and cut by the library's own splitter when
it has characters outside the ranges in SAFE (Unicode versions differ there).

Cases: null or empty text has no ids and decodes to the empty string; a null id stays
null; repeated rows are encoded each; texts are encoded whole, however long; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import sliced

TOKENIZER = "word_bpe_49k.json"
LONG = 64  # symbols of a word above which it is merged by rank
KEPT_WORDS = 400_000  # distinct words a task remembers before it starts anew
SAFE = regex.compile("[\0-՗‐-⁯　-ヿ一-龿]*+")
NO_RANK = np.int32(2**31 - 1)

ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself
    where printable, else the next free one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Merge ranks as sorted pair keys, and the text of each id."""

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        path = public_tokenizers.path(name)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self.words = regex.compile(pattern).findall
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)

        symbols = byte_symbols()
        self.byte_ids = np.array([ids[s] for s in symbols], dtype=np.int64)
        self.last_ids = np.array([ids[s + end] for s in symbols], dtype=np.int64)
        size = max([*ids.values(), *self.special.values()]) + 1
        self.size = np.int64(size)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        made = np.full(size, -1)
        made[self.merged] = np.arange(len(merges))
        if len(np.unique(self.merged)) < len(merges) or (np.maximum(made[left], made[right]) >= np.arange(len(merges))).any():
            raise ValueError(f"{name}: a merge comes before the merges that make its parts")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)

        texts = {i: t.encode() for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pieces = [texts.get(i, b"") + b" " for i in range(size)]
        self.piece_at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.pieces = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where there is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def text_words(self, text: str) -> list[str]:
        """Words of a text as it is normalised; special strings are words of their own."""
        parts = [text]
        if self.cut_special and "<" in text:
            parts = [p for p in self.cut_special.split(text) if p]
        found: list[str] = []
        for part in parts:
            if part in self.special:
                found.append(part)
            elif part.isascii():
                found += self.words(part.lower())
            else:
                part = self.normalise(part)
                if SAFE.fullmatch(part):
                    found += self.words(part)
                else:
                    found += [w for w, _ in self.split.pre_tokenize_str(part)]
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts of the ids, with a space between two."""
        return gathered(self.pieces, self.piece_at, ids).tobytes()[:-1] if len(ids) else b""


@cache
def vocabulary(name: str = TOKENIZER) -> Vocabulary:
    """The vocabulary, loaded once a worker process."""
    return Vocabulary(name)


def gathered(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The segments ``which`` (segment i is flat[ends[i] : ends[i + 1]]) one after another."""
    first, size = ends[which], ends[which + 1] - ends[which]
    upto = np.cumsum(size)
    return flat[np.arange(upto[-1] if len(upto) else 0) + np.repeat(first - (upto - size), size)]


def first_of_runs(at: np.ndarray) -> np.ndarray:
    """Of ascending positions, every second one of each run of neighbours, the run's
    first included: overlapping pairs are merged from the left."""
    n = np.arange(len(at))
    start = np.ones(len(at), dtype=bool)
    start[1:] = at[1:] != at[:-1] + 1
    return at[(n - np.maximum.accumulate(np.where(start, n, 0))) % 2 == 0]


def merge_rounds(vocab: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word of each) after all merges; ``word`` ascends. A round merges the
    lowest-ranked pairs of every word; words without a pair leave."""
    done_symbols, done_words = [], []
    while len(symbols):
        rank = np.full(len(symbols), NO_RANK)  # of the pair that starts at a symbol
        rank[:-1] = np.where(word[1:] == word[:-1], vocab.rank_of(symbols[:-1], symbols[1:]), NO_RANK)
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(start, len(symbols)))
        lowest = np.minimum.reduceat(rank, start)
        ended = np.repeat(lowest == NO_RANK, size)
        if ended.any():
            done_symbols.append(symbols[ended])
            done_words.append(word[ended])
        at = first_of_runs(np.flatnonzero((rank == np.repeat(lowest, size)) & ~ended))
        symbols[at] = vocab.merged[rank[at]]
        stay = ~ended
        stay[at + 1] = False
        symbols, word = symbols[stay], word[stay]
    if not done_words:
        return symbols, word
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


def merge_by_rank(vocab: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As merge_rounds, for long words: a round takes the lowest rank of all words and
    touches only the pairs around its merges."""
    n = len(symbols)
    if not n:
        return symbols, word
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # neighbours of the same word, else n or -1
    after[np.append(word[1:] != word[:-1], True)] = n
    before[np.append(True, word[1:] != word[:-1])] = -1
    alive = np.ones(n, dtype=bool)
    buckets: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def add(at: np.ndarray) -> None:
        at = at[after[at] < n]
        rank = vocab.rank_of(symbols[at], symbols[after[at]])
        at, rank = at[rank < NO_RANK], rank[rank < NO_RANK]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1], [True]])) if len(at) else []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            r = int(rank[lo])
            if r not in buckets:
                buckets[r] = []
                heapq.heappush(ranks, r)
            buckets[r].append(at[lo:hi])

    add(np.arange(n))
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(buckets.pop(r)))
        at = at[alive[at] & (after[at] < n)]
        at = at[vocab.rank_of(symbols[at], symbols[after[at]]) == r]  # others have changed since
        if not len(at):
            continue
        # pairs that share a symbol follow one another: number the live pairs of this rank along the links
        linked = np.zeros(len(at), dtype=bool)
        linked[1:] = after[at[:-1]] == at[1:]
        k = np.arange(len(at))
        at = at[(k - np.maximum.accumulate(np.where(linked, 0, k))) % 2 == 0]
        gone = after[at]
        symbols[at] = vocab.merged[r]
        alive[gone] = False
        after[at] = after[gone]
        has = after[at] < n
        before[after[at][has]] = at[has]
        add(np.concatenate([at, before[at][before[at] >= 0]]))
    return symbols[alive], word[alive]


def word_ids(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, number of ids of each)."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = [w.encode() for w in words]
    size = np.array([len(r) for r in raw])
    word = np.repeat(np.arange(len(words)), size)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    symbols = vocab.byte_ids[data]
    last = np.cumsum(size) - 1
    symbols[last] = vocab.last_ids[data[last]]
    long = np.repeat(size > LONG, size)
    short_symbols, short_words = merge_rounds(vocab, symbols[~long], word[~long])
    long_symbols, long_words = merge_by_rank(vocab, symbols[long], word[long])
    symbols, word = np.concatenate([short_symbols, long_symbols]), np.concatenate([short_words, long_words])
    order = np.argsort(word, kind="stable")
    return symbols[order], np.bincount(word, minlength=len(words))


class Words:
    """Ids of the words met so far, as one flat array."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        special = self.vocab.special
        self.place = {w: i for i, w in enumerate(special)}
        self.ids = np.array(list(special.values()), dtype="<u4")
        self.ends = np.arange(len(special) + 1)

    def learn(self, words: list[str]) -> None:
        new = list(dict.fromkeys(w for w in words if w not in self.place))
        if len(self.place) + len(new) > KEPT_WORDS and len(self.place) > len(self.vocab.special):
            self.clear()
            new = list(dict.fromkeys(w for w in words if w not in self.place))
        ids, size = word_ids(self.vocab, new)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.ids = np.concatenate([self.ids, ids.astype("<u4")])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        words = [self.vocab.text_words(t) for t in texts]
        flat = [w for own in words for w in own]
        self.learn(flat)
        which = np.fromiter(map(self.place.__getitem__, flat), dtype=np.int64, count=len(flat))
        size = self.ends[which + 1] - self.ends[which]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, words)])]
        ids = gathered(self.ids, self.ends, which)
        return [ids[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def _coder(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(name)
        words = Words(vocab)
        for batch in batches:
            for lo, texts in sliced(batch.column(1)):
                ids = words.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary()),
                     pa.array([vocab.decode(x).decode() for x in ids], pa.string())],
                    schema=_ARROW,
                )

    return run


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit numbers,
    and the text they decode to."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_coder(tokenizer), ENCODED)


def round_trip_digests(docs: DataFrame) -> DataFrame:
    """``round_trips`` with digests in place of ids and decoded text."""
    return round_trips(docs).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
