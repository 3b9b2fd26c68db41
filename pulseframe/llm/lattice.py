"""All segmentations of words into the pieces of a fixed vocabulary, by the forward algorithm."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Marks the start of a word in the vocabulary's pieces.
MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

CODE_POINTS = 0x110000
# Characters worked on at once; a longer word is worked on alone.
BLOCK_CHARS = 200_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Pieces of a public vocabulary and their log probabilities.

    The file scores a piece by its rank, from 0 downwards. Zipf's law turns ranks into
    probabilities. Control and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(len(model)) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    weight = np.array([1.0 / (1.0 - model.get_score(i)) for i in ids])
    return [model.id_to_piece(i) for i in ids], np.log(weight / weight.sum())


class Lattice:
    """Trie of the pieces in one hash table, walked for many words at once.

    A character without a piece of its own is an edge of its own, the unknown piece, whose
    probability is shared out evenly over all code points. So every word has a segmentation.
    """

    def __init__(self, pieces: Sequence[str]) -> None:
        chars = sorted({c for p in pieces for c in p})
        self.n = len(pieces)
        self.unknown = len(pieces)
        self.width = np.uint64(len(chars) + 1)
        self.classes = np.zeros(CODE_POINTS, np.uint16 if len(chars) < 65_535 else np.uint32)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        nodes = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        self.piece = np.full(len(nodes), -1, np.int64)
        self.piece[[nodes[p] for p in pieces]] = np.arange(self.n)
        self.longest = max(map(len, pieces), default=1)
        bits = max(4, (len(nodes) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY, np.uint64)
        self.to = np.full(1 << bits, -1, np.int64)
        rank = {c: i for i, c in enumerate(chars, 1)}
        own = {s: node * int(self.width) for s, node in nodes.items()}
        for s, node in nodes.items():
            if s:
                key = own[s[:-1]] + rank[s[-1]]
                slot = (key * int(_SPREAD) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
                while self.keys[slot] != _EMPTY:
                    slot = (slot + 1) & int(self.mask)
                self.keys[slot], self.to[slot] = key, node

    def _step(self, node: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The child of each node by the character class, or -1."""
        key = node.astype(np.uint64) * self.width + cls.astype(np.uint64)
        slot = (key * _SPREAD) >> self.shift
        found = self.keys[slot]
        open_ = np.flatnonzero((found != key) & (found != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
            found[open_] = self.keys[slot[open_]]
            open_ = open_[(found[open_] != key[open_]) & (found[open_] != _EMPTY)]
        return np.where(found == key, self.to[slot], -1)

    def _edges(self, words: Sequence[str]):
        """Edges (state, state, piece, start, stop) of all words, and each word's first and last state.

        The states of a word of length L are L + 1 consecutive numbers.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) - begins[word]
        left = lengths[word] - place
        cls = self.classes[codes]
        cell, node, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        for size in range(1, self.longest + 1):
            keep = left[cell] >= size
            cell = cell[keep]
            node = self._step(node[keep], cls[cell + (size - 1)])
            piece = np.where(node >= 0, self.piece[node], -1)
            if size == 1:
                piece = np.where(piece < 0, self.unknown, piece)
            has = piece >= 0
            found.append((cell[has], np.full(int(has.sum()), size), piece[has]))
            keep = node >= 0
            cell, node = cell[keep], node[keep]
            if not len(cell):
                break
        cell, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        source = cell + word[cell]
        first = begins + np.arange(len(words))
        return source, source + size, piece, place[cell], place[cell] + size, first, first + lengths

    @staticmethod
    def _by(step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the edges by a place in the word, and where each place begins in that order."""
        order = np.argsort(step, kind="stable")
        return order, np.searchsorted(step[order], np.arange(int(step.max(initial=-1)) + 2))

    def _forward(self, edges, log_p: np.ndarray) -> np.ndarray:
        source, target, piece, start, _, first, last = edges
        alpha = np.full((int(last[-1]) + 1, log_p.shape[1]), -np.inf)
        alpha[first] = 0
        order, at = self._by(start)
        for a, b in zip(at[:-1], at[1:], strict=True):
            e = order[a:b]  # no two of them lead to the same state
            alpha[target[e]] = np.logaddexp(alpha[target[e]], alpha[source[e]] + log_p[piece[e]])
        return alpha

    def _blocks(self, words: Sequence[str]):
        begin, size = 0, 0
        for i, w in enumerate(words):
            if i > begin and size + len(w) > BLOCK_CHARS:
                yield begin, i
                begin, size = i, 0
            size += len(w)
        if begin < len(words):
            yield begin, len(words)

    def score(self, words: Sequence[str], log_p: np.ndarray) -> np.ndarray:
        """Log probability of each non-empty word, summed over all segmentations, by model (column)."""
        out = np.zeros((len(words), log_p.shape[1]))
        for a, b in self._blocks(words):
            edges = self._edges(words[a:b])
            out[a:b] = self._forward(edges, log_p)[edges[-1]]
        return out

    def expected(self, words: Sequence[str], weights: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Expected number of each piece (row) under one model, by column of the words' weights."""
        out = np.zeros((self.n + 1, weights.shape[1]))
        for a, b in self._blocks(words):
            edges = self._edges(words[a:b])
            source, target, piece, _, stop, first, last = edges
            alpha = self._forward(edges, log_p)[:, 0]
            beta = np.full(len(alpha), -np.inf)
            beta[last] = 0
            order, at = self._by(stop)
            for i, j in zip(at[-2::-1], at[:0:-1], strict=True):
                e = order[i:j]  # no two of them start in the same state
                beta[source[e]] = np.logaddexp(beta[source[e]], beta[target[e]] + log_p[piece[e], 0])
            states = np.repeat(np.arange(b - a), last - first + 1)
            word = states[source]
            share = np.exp(alpha[source] + log_p[piece, 0] + beta[target] - alpha[last][word])
            for g in range(weights.shape[1]):
                out[:, g] += np.bincount(piece, share * weights[a:b, g][word], self.n + 1)
        return out

    def log_p(self, counts: np.ndarray, add: float = 0.1) -> np.ndarray:
        """Smoothed log probabilities (pieces and the unknown piece) of each column of counts."""
        p = (counts + add) / (counts.sum(axis=0) + add * len(counts))
        return self.shared(np.log(p))

    def shared(self, log_p: np.ndarray) -> np.ndarray:
        """The unknown piece's probability shared out over all code points."""
        log_p = log_p.copy()
        log_p[self.unknown] -= np.log(CODE_POINTS)
        return log_p

    def start(self, scores: np.ndarray) -> np.ndarray:
        """One column of log probabilities from the vocabulary's own scores."""
        return self.log_p(np.append(np.exp(scores), 0)[:, None], add=1e-9)
