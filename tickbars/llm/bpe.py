"""Byte-pair encoding by speculation: propose by longest match, verify pairs, merge only what fails.

A word's tokens are proposed greedily, always the longest token that fits.  The
proposal is the encoding exactly if every adjacent pair of tokens is compatible,
that is, if merging the bytes of the two by the rules gives back the two.  All
distinct pairs are tested at once: a merge over the boundary can happen only between
a token at the right edge of the first and one at the left edge of the second while
both exist, so the ranks at which they are made, and used up, decide.  Words with a
pair that fails are merged exactly, rule by rule.  Words of any length take this way.

Only files of this kind are taken: byte-level BPE cut by PATTERN, whole words merged
by rank, added tokens found as they stand.  Any other file is an error on the driver.

Defined results: a null text counts as empty and has no ids.  Added tokens in a text
become their ids.  Decoding replaces bytes that are no UTF-8.  Rows with null or
repeated ids are encoded like any other; an empty table gives an empty result.  Texts
of any length are encoded whole.  A column of the input named like the ids is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm import units, words

# Fixed values of the format: the pattern that cuts texts into words, the bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

NEVER = 1 << 30
STEP_BYTES = 256  # words up to this length are walked side by side, longer ones each for itself
HELD_PAIRS = 1 << 22
# Fixed values of the format: what a tokenizer file of this kind says, and what it may leave out.
MODEL_FLAGS = {
    "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
    "byte_fallback": False, "ignore_merges": False,
}
TOKEN_FLAGS = ("single_word", "lstrip", "rstrip", "normalized")


def check_file(content: str) -> None:
    """Raise ValueError unless the tokenizer file is of the kind that this module encodes."""
    spec = json.loads(content)
    model, cut, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    wrong = []
    if model.get("type", "BPE") != "BPE":
        wrong.append(f"model {model['type']}")
    wrong += [name for name, want in MODEL_FLAGS.items() if (model.get(name) or want) != want]
    if spec.get("normalizer") is not None:
        wrong.append("normalizer")
    if cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space", True):
        wrong.append("pre_tokenizer")
    if decoder.get("type") != "ByteLevel":
        wrong.append("decoder")
    wrong += [f"{flag} of {t['content']}" for t in spec["added_tokens"] for flag in TOKEN_FLAGS if t.get(flag)]
    missing = [c for c in byte_alphabet() if c not in model["vocab"]]
    if missing:
        wrong.append(f"{len(missing)} bytes without a token")
    if wrong:
        raise ValueError("not a plain byte-level BPE file: " + ", ".join(wrong))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte; bytes without one of their own count on from U+0100."""
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and the tables made of them, from the content of a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {
            i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if t not in self.added
        }
        self.tokens |= {i: t.encode() for t, i in self.added.items()}
        self.size = max(self.tokens) + 1
        self.byte_ids = np.full(256, -1, np.int64)
        for character, byte in alphabet.items():
            if character in vocab:
                self.byte_ids[byte] = vocab[character]
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.born = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.merges[pair] = (rank, made)
            self.left[made], self.right[made], self.born[made] = *pair, rank
        pairs = np.array(list(self.merges), np.int64).reshape(-1, 2)
        pair_keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(pair_keys)
        self.pair_keys, self.pair_ranks = pair_keys[order], order
        # tokens the rules really give for their own bytes; only these are proposed
        added = set(self.added.values())
        self.proposed = {t: i for i, t in self.tokens.items() if i not in added and self.merge(t) == [i]}
        self._trie()
        self._tables()
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.tested = np.empty(0, np.int64)
        self.good = np.empty(0, bool)

    def _trie(self) -> None:
        """Edges of the trie of tokens as sorted numbers, state * 256 + byte, with the state they lead to."""
        states: dict[bytes, int] = {b"": 0}
        edges: dict[int, int] = {}
        for token in self.proposed:
            for n in range(1, len(token) + 1):
                if token[:n] not in states:
                    states[token[:n]] = len(states)
                    edges[states[token[: n - 1]] * 256 + token[n - 1]] = states[token[:n]]
        self.steps = edges
        self.edges = np.array(sorted(edges), np.int64)
        self.leads = np.array([edges[e] for e in self.edges.tolist()], np.int64)
        self.token_at = np.full(len(states), -1, np.int64)
        for token, i in self.proposed.items():
            self.token_at[states[token]] = i
        self.token_ids: list[int] = self.token_at.tolist()

    def _tables(self) -> None:
        sizes = np.array([len(self.tokens.get(i, b"")) for i in range(self.size)], np.int64)
        self.token_lengths = sizes
        self.token_starts = np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(self.size)), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """The encoding of a word, merge by merge: lowest rank first, leftmost first."""
        ids: list[int | None] = [int(self.byte_ids[b]) for b in word]
        if len(ids) < 2:
            return ids  # type: ignore[return-value]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        found = [self.merges.get(p) for p in zip(ids[:-1], ids[1:], strict=True)]
        heap = [(f[0], i, f[1]) for i, f in enumerate(found) if f]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j < 0 or self.merges.get((ids[i], ids[j]), (-1, -1)) != (rank, made):
                continue
            ids[i], ids[j] = made, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (found[0], a, found[1]))
        return [i for i in ids if i is not None]

    def propose(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy tokens of all words at once: (word, token) rows in the order of each word."""
        n = len(starts)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        state, at, best, best_end = np.zeros(n, np.int64), starts.copy(), np.full(n, -1), starts.copy()
        live = np.arange(n)
        out_words, out_tokens = [], []
        while len(live):
            byte = np.zeros(len(live), np.int64)
            more = at[live] < ends[live]
            byte[more] = flat[at[live[more]]]
            key = state[live] * 256 + byte
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            on = more & (self.edges[edge] == key)
            go = live[on]
            state[go] = self.leads[edge[on]]
            at[go] += 1
            token = self.token_at[state[go]]
            some = token >= 0
            best[go[some]], best_end[go[some]] = token[some], at[go[some]]
            stuck = live[~on]
            out_words.append(stuck)
            out_tokens.append(best[stuck])
            best_end[stuck] += best[stuck] < 0  # a byte without a token: step over it, exact merging decides
            at[stuck], state[stuck], best[stuck] = best_end[stuck], 0, -1
            live = live[on | (at[live] < ends[live])]
        word, token = np.concatenate(out_words), np.concatenate(out_tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def propose_one(self, word: bytes) -> list[int]:
        """Greedy tokens of one word."""
        out, at = [], 0
        while at < len(word):
            state, to, best, best_end = 0, at, -1, at + 1
            while to < len(word) and (after := self.steps.get(state * 256 + word[to])) is not None:
                state, to = after, to + 1
                if self.token_ids[state] >= 0:
                    best, best_end = self.token_ids[state], to
            out.append(best)
            at = best_end
        return out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key, self.pair_ranks[place], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the boundary, for all pairs at once."""
        good = np.ones(len(a), bool)
        x, x_until = a.copy(), np.full(len(a), NEVER)
        rows = np.arange(len(a))
        while len(rows):
            y, y_until, inner = b[rows].copy(), np.full(len(rows), NEVER), np.arange(len(rows))
            while len(inner):
                at = rows[inner]
                rank = self.rank_of(x[at], y[inner])
                # the left neighbour goes first at equal rank: x is used up by then, y is not yet
                crosses = (rank < x_until[at]) & (rank <= y_until[inner]) & (rank < NEVER)
                good[at[crosses]] = False
                y_until[inner] = self.born[y[inner]]
                y[inner] = self.left[y[inner]]
                inner = inner[(y[inner] >= 0) & ~crosses]
            x_until[rows] = self.born[x[rows]]
            x[rows] = self.right[x[rows]]
            rows = rows[(x[rows] >= 0) & good[rows]]
        return good

    def known_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` with the answers kept, of about HELD_PAIRS pairs; then they are found anew."""
        if len(self.tested) > HELD_PAIRS:
            self.tested, self.good = np.empty(0, np.int64), np.empty(0, bool)
        keys, which = np.unique(a * self.size + b, return_inverse=True)
        new = keys[~np.isin(keys, self.tested, assume_unique=True)]
        if len(new):
            good = self.compatible(new // self.size, new % self.size)
            order = np.argsort(np.concatenate([self.tested, new]))
            self.tested = np.concatenate([self.tested, new])[order]
            self.good = np.concatenate([self.good, good])[order]
        return self.good[np.searchsorted(self.tested, keys)][which]

    def encode_words(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        flat = np.frombuffer(b"".join(found), np.uint8)
        lengths = np.array([len(w) for w in found], np.int64)
        ends = np.cumsum(lengths)
        short, long = np.flatnonzero(lengths <= STEP_BYTES), np.flatnonzero(lengths > STEP_BYTES)
        word, token = self.propose(flat, (ends - lengths)[short], ends[short])
        alone = [np.array(self.propose_one(found[w]), np.int64) for w in long.tolist()]
        word = np.concatenate([short[word], np.repeat(long, [len(t) for t in alone])])
        token = np.concatenate([token, *alone])
        beside = np.flatnonzero(word[:-1] == word[1:])
        fine = np.ones(len(found), bool)
        if len(beside):
            good = self.known_compatible(token[beside], token[beside + 1])
            fine[word[beside[~good]]] = False
        fine[word[token < 0]] = False
        stays = fine[word]
        redone = [(w, self.merge(found[w])) for w in np.flatnonzero(~fine).tolist()]
        word = np.concatenate([word[stays], *([w] * len(ids) for w, ids in redone)]).astype(np.int64)
        token = np.concatenate([token[stays], *(ids for _, ids in redone)]).astype(np.int64)
        order = np.argsort(word, kind="stable")
        return token[order], np.bincount(word, minlength=len(found))

    def encode_pieces(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of text (added tokens and the pattern applied), and how many each has."""
        index: dict[bytes, int] = {}
        flat: list[int] = []
        counts = []
        for piece in found:
            n = len(flat)
            text = piece.decode()
            for part in self.cut.split(text) if self.cut and "<" in text else (text,):
                if part in self.added:
                    flat.append(-1 - self.added[part])
                else:
                    flat.extend(index.setdefault(w.encode(), len(index)) for w in self.pattern.findall(part))
            counts.append(len(flat) - n)
        if not flat:
            return np.empty(0, np.int64), np.zeros(len(found), np.int64)
        ids, lengths = self.encode_words(list(index)) if index else (np.empty(0, np.int64), np.empty(0, np.int64))
        # words first, then every added token as a word of one id
        word = np.array(flat)
        ids = np.concatenate([ids, np.arange(self.size)])
        starts = np.concatenate([np.cumsum(lengths) - lengths, len(ids) - self.size + np.arange(self.size)])
        lengths = np.concatenate([lengths, np.ones(self.size, np.int64)])
        word = np.where(word >= 0, word, len(index) - 1 - word)
        out = ids[units.spread(starts[word], lengths[word])]
        sums = np.concatenate([[0], np.cumsum(lengths[word])])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return out, np.diff(sums[edges])

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 of the text of *ids*."""
        data = self.token_bytes[units.spread(self.token_starts[ids], self.token_lengths[ids])].tobytes()
        try:
            data.decode()
            return data
        except UnicodeDecodeError:
            return data.decode(errors="replace").encode()


_LOADED: dict[str, tuple[Vocabulary, units.Encoder]] = {}


def loaded(content: str) -> tuple[Vocabulary, units.Encoder]:
    """The vocabulary and an encoder, made once in each worker."""
    name = hashlib.sha256(content.encode()).hexdigest()
    if name not in _LOADED:
        vocabulary = Vocabulary(content)
        _LOADED[name] = vocabulary, units.Encoder(vocabulary.encode_pieces)
    return _LOADED[name]


def file_content(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def checked_content(path: str) -> str:
    content = file_content(path)
    check_file(content)
    return content


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", keep_text: bool = False) -> DataFrame:
    """*docs* with the token ids of *text* as an array column, in place of the text unless *keep_text*.

    The tokenizer file at *path* is read and checked by the driver.
    """
    content = docs.sparkSession.sparkContext.broadcast(checked_content(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = loaded(content.value)
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(1))
            kept = batch.column(0).flatten()  # the columns of the struct
            for at, to, found, edges in encoder.texts(data, offsets):
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(found.astype(np.int32)))
                rest = [c.slice(at, to - at) for c in kept]
                yield pa.RecordBatch.from_arrays([*rest, lists], names=names)

    own = docs.select(*[c for c in docs.columns if c != ids and (keep_text or c != text)])
    names = [*own.columns, ids]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    pairs = docs.select(F.struct(*own.columns).alias("own"), F.col(text).alias("text"))
    return pairs.mapInArrow(work, f"{schema}, `{ids}` array<int>")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: n_tokens and the SHA-256 of its ids (32-bit, little-endian) and of the text decoded from them."""
    content = docs.sparkSession.sparkContext.broadcast(checked_content(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = loaded(content.value)
        for batch in batches:
            data, offsets = words.text_bytes(batch.column("text"))
            for at, to, found, edges in encoder.texts(data, offsets):
                cuts = edges.tolist()
                lists = [found[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, to - at),
                        pa.array(np.diff(edges)),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists]),
                        pa.array([hashlib.sha256(vocabulary.decode(x)).hexdigest() for x in lists]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
