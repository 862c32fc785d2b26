"""Marginal log-probabilities of words over all segmentations into vocabulary pieces.

A word is its UTF-8 bytes after one space (the vocabulary's word mark). Pieces
sit in a byte trie; words of equal length are walked together, one array step
for each start and piece length, with a forward recursion in log space. The
backward recursion gives expected piece counts for re-estimating the weights.
"""

from __future__ import annotations

import numpy as np

from .tokens import LOWER, Words

LONG = 64  # longer words are walked one by one


class Vocabulary:
    """Pieces of a sentence-piece file as a byte trie, with first weights from the file's scores."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        best: dict[bytes, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i):
                continue
            if sp.is_byte(i):
                raw, score = bytes([int(sp.id_to_piece(i)[3:5], 16)]), -float(sp.get_piece_size())
            else:
                raw, score = sp.id_to_piece(i).replace("▁", " ").encode("utf-8"), sp.get_score(i)
            if b" " not in raw[1:]:
                best[raw] = max(score, best.get(raw, -np.inf))
        self.pieces = sorted(best)
        # the file's scores are ranks (0, -1, -2, ...): the weight of a rank falls as its inverse
        weight = np.array([1.0 / (10.0 - min(best[p], 0.0)) for p in self.pieces])
        self.first = np.log(weight / weight.sum())
        used = np.zeros(256, bool)
        for p in self.pieces:
            used[list(p)] = True
        self.cls = np.where(used, np.cumsum(used), 0)  # class 0: bytes of no piece
        nodes: list[dict[int, int]] = [{}, {}]  # node 0 is dead, node 1 the root
        piece_at: list[int] = [-1, -1]
        for n, p in enumerate(self.pieces):
            at = 1
            for b in p:
                to = nodes[at].get(b)
                if to is None:
                    to = nodes[at][b] = len(nodes)
                    nodes.append({})
                    piece_at.append(-1)
                at = to
            piece_at[at] = n
        self.go = np.zeros((len(nodes), int(used.sum()) + 1), np.int32)
        for at, out in enumerate(nodes):
            for b, to in out.items():
                self.go[at, self.cls[b]] = to
        self.piece_at = np.array(piece_at, np.int32)

    def walk(self, chars: np.ndarray):
        """All (start, length, words, pieces) of equally long words given as rows of byte classes."""
        n, size = chars.shape
        for i in range(size):
            rows, node, k = np.arange(n), np.ones(n, np.int32), i
            while k < size and len(rows):
                node = self.go[node, chars[rows, k]]
                alive = node > 0
                if not alive.all():
                    rows, node = rows[alive], node[alive]
                k += 1
                piece = self.piece_at[node]
                has = piece >= 0
                if has.any():
                    yield i, k, (rows, piece) if has.all() else (rows[has], piece[has])

    def forward(self, chars: np.ndarray, logp: np.ndarray, keep: list | None = None) -> np.ndarray:
        """log P of each row; ``keep`` gets the walk for a backward pass."""
        n, size = chars.shape
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0.0
        for i, k, (rows, piece) in self.walk(chars):
            alpha[k][rows] = np.logaddexp(alpha[k][rows], alpha[i][rows] + logp[piece])
            if keep is not None:
                keep.append((i, k, rows, piece))
        if keep is not None:
            keep.append(alpha)
        return alpha[size]

    def expected(self, chars: np.ndarray, logp: np.ndarray, times: np.ndarray, out: np.ndarray) -> None:
        """Add the expected piece counts of rows that occur ``times`` times."""
        keep: list = []
        total = self.forward(chars, logp, keep)
        alpha = keep.pop()
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0.0
        for i, k, rows, piece in reversed(keep):
            step = logp[piece] + beta[k][rows]
            out += np.bincount(piece, times[rows] * np.exp(alpha[i][rows] + step - total[rows]), len(out))
            beta[i][rows] = np.logaddexp(beta[i][rows], step)

    def groups(self, words: Words, which: np.ndarray):
        """Chosen words by byte length: (their places in ``which``, rows of byte classes)."""
        start, size = words.start[which], words.end[which] - words.start[which]
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cut) if len(order) else []:
            length = int(size[group[0]])
            step = max(1, 4_000_000 // (length * 16))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                raw = LOWER[words.data[start[part][:, None] + np.arange(length)]]
                yield part, np.c_[np.full(len(part), self.cls[32]), self.cls[raw]]

    def log10(self, words: Words, which: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """log10 P of the chosen words (lower-cased); bytes of no piece make a word impossible, which all-byte vocabularies rule out."""
        out = np.zeros(len(which))
        for part, chars in self.groups(words, which):
            if chars.shape[1] > LONG:
                out[part] = [self._long(c, logp) for c in chars]
            else:
                out[part] = self.forward(chars, logp)
        return out / np.log(10.0)

    def _long(self, chars: np.ndarray, logp: np.ndarray) -> float:
        """Forward recursion of one long word, a start at a time, in memory linear in its length."""
        return float(self._alphas(chars.tolist(), logp, {})[-1])

    def _alphas(self, chars: list[int], logp: np.ndarray, memo: dict[int, tuple]) -> np.ndarray:
        alpha = np.full(len(chars) + 1, -np.inf)
        alpha[0] = 0.0
        for i in range(len(chars)):
            base = alpha[i]
            for k, _, gain in self._from(chars, i, logp, memo):
                a, b = alpha[k], base + gain
                hi, lo = (a, b) if a > b else (b, a)
                alpha[k] = hi + np.log1p(np.exp(lo - hi)) if lo > -np.inf else hi
        return alpha

    def _from(self, chars: list[int], i: int, logp: np.ndarray, memo: dict[int, tuple]):
        """(end, piece, weight) of the pieces that start at one place."""
        node, size, go, piece_at = 1, len(chars), self.go, self.piece_at
        for k in range(i, size):
            key = node * 512 + chars[k]
            step = memo.get(key)
            if step is None:
                to = int(go[node, chars[k]])
                piece = int(piece_at[to]) if to else -1
                step = memo[key] = (to, piece, float(logp[piece]) if piece >= 0 else None)
            node, piece, gain = step
            if not node:
                return
            if gain is not None:
                yield k + 1, piece, gain

    def expected_long(self, chars: np.ndarray, logp: np.ndarray, times: float, out: np.ndarray) -> None:
        """``expected`` of one long word, in memory linear in its length."""
        chars, memo = chars.tolist(), {}
        alpha = self._alphas(chars, logp, memo)
        total, beta = alpha[-1], np.full(len(alpha), -np.inf)
        if total == -np.inf:
            return
        beta[-1] = 0.0
        for i in range(len(chars) - 1, -1, -1):
            for k, piece, gain in self._from(chars, i, logp, memo):
                step = gain + beta[k]
                if step > -np.inf:
                    out[piece] += times * np.exp(alpha[i] + step - total)
                    beta[i] = np.logaddexp(beta[i], step)


_held: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _held:
        _held[path] = Vocabulary(path)
    return _held[path]
