"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word is a row of symbols.  The leaves of the tree hold the merge rank and the
place of each adjacent pair, every inner node the smaller of its children, so
the root is the leftmost lowest rank.  A merge changes three leaves, each updated along one path to the root:
n symbols take O(n log n) steps, however long a text without white space is.

Normalising and cutting into words follow the tokenizer file through the
tokenizers library's own components; ranks and ids come from its vocabulary.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces and words remembered by one Python worker, and the longest that is remembered.
REMEMBERED, LONGEST = 100_000, 40
NEVER = 1 << 62
#: Words up to this many symbols are merged side by side, one tree in each row of an array.
SIDE_BY_SIDE = 33
#: Characters of text taken from a batch at a time.
SLICE = 1_000_000
#: Characters whose composed lower-case form and class need no Unicode tables: printable ASCII and Latin-1 letters.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: The word pattern of the file for which PLAIN_WORDS stands in; any other file takes the library's components.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class PairTree:
    """Segment tree over adjacent pairs: the root is the leftmost lowest rank.

    A leaf holds ``rank * leaves + place``, so the smaller of two nodes is the
    lower rank and, among equal ranks, the one further left.
    """

    def __init__(self, ranks: list[int | None]):
        self.base = base = 1 << max(0, len(ranks) - 1).bit_length()
        self.low = low = [NEVER] * (2 * base)
        for place, rank in enumerate(ranks, base):
            if rank is not None:
                low[place] = rank * base + place - base
        for node in range(base - 1, 0, -1):
            left, right = low[2 * node], low[2 * node + 1]
            low[node] = left if left < right else right

    def root(self) -> tuple[int, int]:
        """(rank, place) of the next merge, or (-1, -1) when none is left."""
        return divmod(self.low[1], self.base) if self.low[1] != NEVER else (-1, -1)

    def put(self, place: int, rank: int | None) -> None:
        low, node = self.low, place + self.base
        value = NEVER if rank is None else rank * self.base + place
        if low[node] == value:
            return
        low[node] = value
        while node > 1:
            other = low[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if low[node] == value:
                return
            low[node] = value


class Vocabulary:
    """A tokenizers file of kind BPE with word ends: ids, merge ranks and special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # A pair of ids as one number -> its rank; rank -> id of the joined symbol.
        self.ranks = {self.ids[a] << 20 | self.ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.joined = [self.ids[a + b] for a, b in pairs]
        self.pairs = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[k] for k in self.pairs.tolist()], np.int64)
        self.joined_array = np.array(self.joined, np.int64)
        top = 1 + max(ord(t[0]) for t in self.ids if len(t) == 1)
        self.inner, self.last = np.zeros(top, np.int64), np.zeros(top, np.int64)
        for c in range(top):
            self.inner[c], self.last[c] = self.ids.get(chr(c), 0), self.ids.get(chr(c) + self.suffix, 0)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.words = {number: token for token, number in (self.ids | self.special).items()}
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        self.plain = json.dumps(KNOWN_PATTERN)[1:-1] in json.dumps(spec["pre_tokenizer"])
        self.bytes = {c: self.cutter.pre_tokenize_str(c)[0][0] for c in map(chr, [*range(33, 127), *range(192, 256)])} if self.plain else {}

    def merged(self, word: str) -> list[int]:
        """The ids of one word, given in byte characters, after all merges."""
        ids = [self.ids[c] for c in word[:-1]]
        ids.append(self.ids[word[-1] + self.suffix])
        end = len(ids)
        if end == 1:
            return ids
        rank_of, joined = self.ranks.get, self.joined
        tree = PairTree([rank_of(a << 20 | b) for a, b in zip(ids, ids[1:])])
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while True:
            rank, left = tree.root()
            if rank < 0:
                return [i for i in ids if i >= 0]
            right = after[left]
            ids[left], ids[right] = joined[rank], -1
            after[left] = following = after[right]
            if right < end - 1:
                tree.put(right, None)
            if following < end:
                before[following] = left
                tree.put(left, rank_of(ids[left] << 20 | ids[following]))
            else:
                tree.put(left, None)
            if (previous := before[left]) >= 0:
                tree.put(previous, rank_of(ids[previous] << 20 | ids[left]))

    def merged_rows(self, words: list[str]) -> list[list[int]]:
        """``merged`` for many short words at once: row r holds the tree of word r.

        Every step takes the roots of all words that still have a mergeable
        pair, merges there, and updates the three changed leaves level by level.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        base = 1 << max(0, int(lengths.max()) - 2).bit_length()
        bits, spare = base.bit_length() - 1, 2 * base
        rows = np.arange(len(words))
        ids = np.full((len(words), base + 2), -1, np.int64)
        at = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        row, col = np.repeat(rows, lengths), np.arange(len(at)) - np.repeat(first, lengths)
        ids[row, col] = np.where(col == lengths[row] - 1, self.last[at], self.inner[at])

        def values(left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
            pair = left << 20 | right
            k = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            known = (left >= 0) & (right >= 0) & (self.pairs[k] == pair)
            return np.where(known, self.pair_ranks[k] << bits | place, NEVER)

        low = np.full((len(words), spare + 1), NEVER, np.int64)  # the last column takes what has no leaf
        low[:, base:spare] = values(ids[:, :base], ids[:, 1:base + 1], np.arange(base))
        size = base
        while size > 1:
            size //= 2
            low[:, size:2 * size] = np.minimum(low[:, 2 * size:4 * size:2], low[:, 2 * size + 1:4 * size:2])
        after = np.tile(np.arange(1, base + 3), (len(words), 1))
        before = np.tile(np.arange(-1, base + 1), (len(words), 1))
        while len(rows := rows[low[rows, 1] != NEVER]):
            root = low[rows, 1]
            left = root & (base - 1)
            right, new = after[rows, left], self.joined_array[root >> bits]
            following, previous = after[rows, right], before[rows, left]
            ids[rows, left], ids[rows, right] = new, -1
            after[rows, left], before[rows, following] = following, left
            leaves = (np.where(right < base, right + base, spare), left + base, np.where(previous >= 0, previous + base, spare))
            low[rows, leaves[0]] = NEVER
            low[rows, leaves[1]] = values(new, ids[rows, following], left)
            low[rows, leaves[2]] = values(np.where(previous >= 0, ids[rows, previous], -1), new, previous)
            low[rows, spare] = NEVER
            for _ in range(bits):
                leaves = tuple(np.where(leaf == spare, spare, leaf >> 1) for leaf in leaves)
                for node in leaves:
                    two = np.minimum(2 * node, spare - 1)
                    low[rows, node] = np.where(node == spare, NEVER, np.minimum(low[rows, two], low[rows, np.minimum(two + 1, spare)]))
        return [[i for i in word if i >= 0] for word in ids.tolist()]

    def cut(self, piece: str) -> list[str]:
        """The words of text without special tokens, in byte characters."""
        if self.plain and PLAIN.fullmatch(piece):
            words = PLAIN_WORDS.findall(piece.lower())
            return words if piece.isascii() else ["".join(map(self.bytes.__getitem__, w)) for w in words]
        return [w for w, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(piece))]


class Encoder:
    """Encodes whole texts and remembers the pieces and words it has seen, up to a bound."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pieces: dict[str, tuple[int, str, str]] = {}
        self.known: dict[str, tuple[int, str, str]] = {}

    def learn(self, words: list[str]) -> None:
        """Merge words not seen before; short ones side by side, grouped by the size of their trees."""
        groups: dict[int, list[str]] = {}
        for word in words:
            groups.setdefault(max(0, len(word) - 2).bit_length() if len(word) <= SIDE_BY_SIDE else -1, []).append(word)
        for size, group in groups.items():
            merged = map(self.vocabulary.merged, group) if size < 0 else self.vocabulary.merged_rows(group)
            for word, ids in zip(group, merged):
                self.known[word] = (len(ids), " ".join(map(str, ids)), self.decoded(ids))

    def prepare(self, pieces: set[str]) -> None:
        """Encode the pieces that are not remembered."""
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cuts = {piece: self.vocabulary.cut(piece) for piece in pieces if piece not in self.pieces}
        known = self.known
        self.learn(list({w for words in cuts.values() for w in words if w not in known}))
        for piece, words in cuts.items():
            found = [known[w] for w in words]
            self.pieces[piece] = found[0] if len(found) == 1 else (
                sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found]))

    def decoded(self, ids: list[int]) -> str:
        """Text of ids; the file names no decoder, so tokens are joined by one space."""
        return " ".join([self.vocabulary.words[number] for number in ids])

    def split(self, text: str) -> list[list[str]]:
        """Pieces between white space, and between the special tokens that stand at odd places.

        No token spans white space, so pieces between it can be encoded alone.
        """
        marks = self.vocabulary.marks
        parts = marks.split(text) if marks else [text]
        return [[part] if k % 2 else part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                for k, part in enumerate(parts)]

    def texts(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text its number of tokens, decimal ids joined by one space, decoded text."""
        cut = [self.split(text) for text in texts]
        self.prepare({piece for parts in cut for part in parts[::2] for piece in part if piece})
        seen, rows = self.pieces, []
        for parts in cut:
            made = []
            for k, part in enumerate(parts):
                if k % 2:
                    number = self.vocabulary.special[part[0]]
                    made.append((1, str(number), self.vocabulary.words[number]))
                else:
                    made += [seen[piece] for piece in part if piece]
            made = [m for m in made if m[0]]
            rows.append((sum([m[0] for m in made]), " ".join([m[1] for m in made]), " ".join([m[2] for m in made])))
        for long in [piece for piece in self.pieces if len(piece) > LONGEST]:
            del self.pieces[long]
        return rows


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about SLICE characters; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > SLICE:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    yield run


#: Encoders of this Python worker by path, so that the tasks of one worker share what is remembered.
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``key, n_tokens, ids_sha256, decoded_sha256`` and, if asked, ``ids, decoded``.

    ``vocabulary`` is the path of a tokenizers BPE file that every executor can
    open (it belongs to the installed environment).  Null texts count as empty:
    0 tokens, the hashes of the empty string.  Repeated rows give repeated
    rows; other columns are ignored; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded string" if ids else "")

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            rows = [row for run in slices(texts) for row in known.texts(run)]
            made = {
                key: batch["key"].array,
                "n_tokens": [r[0] for r in rows],
                "ids_sha256": [hashlib.sha256(r[1].encode()).hexdigest() for r in rows],
                "decoded_sha256": [hashlib.sha256(r[2].encode()).hexdigest() for r in rows],
            }
            if ids:
                made |= {"ids": [[int(i) for i in r[1].split()] for r in rows], "decoded": [r[2] for r in rows]}
            yield pd.DataFrame(made)

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInPandas(encoded, schema)
