"""Shingle sets of documents, their count vectors and their pigeonhole keys.

A set is held as sorted 64-bit hashes of its shingles. ``groups`` hashes tokens
into m groups; a set's count vector has the number of its tokens in each group,
so two sets overlap in at most the sum of the coordinate minima, less one for each
group with equal counts and unequal content.

Two sets that are similar enough differ in at most D tokens (both ways). With
more than D groups some group holds the same tokens in both, so sets of one size
class are compared only where they have an equal group. The number of groups of a
class is fixed by its largest size; sets near the upper end of a class also take
part in the next one. An equal group that holds tokens exists unless all of them
lie in at most D groups; such sets add keys for their empty groups too.

A set whose tokens lie in g > D groups has at least g - D of them equal to those of
any similar set. So it can do without its g - D - 1 most frequent keys: the rarest
key that both hold (in one order of all keys) is among what is left of both.
"""

from __future__ import annotations

import numpy as np

from .tokens import U, Words, mix

RATIO = 1.6


def sets(words: Words, k: int) -> list[np.ndarray]:
    """Distinct k-word shingles of each text of a slice, sorted; a text of fewer words is one shingle."""
    start = words.window_starts(k)
    h = words.spans(start, start + k)
    first = words.first
    cut = np.searchsorted(start, first)
    out = []
    sizes = np.diff(first)
    for d in range(len(sizes)):
        if sizes[d] >= k:
            out.append(np.unique(h[cut[d] : cut[d + 1]]))
        elif sizes[d]:
            out.append(words.spans(first[d : d + 1], first[d + 1 : d + 2]))
        else:
            out.append(np.zeros(0, U))
    return out


def name(tokens: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets have equal names."""
    return int(mix(np.array([np.sum(mix(tokens ^ U(0x5851F42D4C957F2D)), dtype=U) + U(len(tokens))], U))[0])


def least(percent: int) -> int:
    """The least size of a set that can be similar to an unequal one: 100 * n >= percent * (n + 1)."""
    return -(-percent // (100 - percent)) if percent < 100 else 2**62


def upper(level: int, percent: int) -> int:
    """Sizes of a class are below this."""
    return int(np.ceil(least(percent) * RATIO ** (level + 1)))


def level(n: int, percent: int) -> int:
    out = max(0, int(np.log(n / least(percent)) / np.log(RATIO)) - 1)
    while n >= upper(out, percent):
        out += 1
    return out


def most_apart(a: int, b: int, percent: int) -> int:
    """The most tokens in which similar sets of sizes a and b can differ: percent * union <= 100 * overlap."""
    union = 100 * (a + b) // (100 + percent)
    return (100 - percent) * union // 100


def group_of(tokens: np.ndarray, m: int) -> np.ndarray:
    return ((mix(tokens ^ U(0x2545F4914F6CDD1D)) >> U(32)) * U(m) >> U(32)).astype(np.int64)


def groups(lv: int, percent: int) -> int:
    """The number of groups of a class."""
    m = most_apart(upper(lv, percent) - 1, upper(lv, percent) - 1, percent) + 1
    return m + m // 8 + 1  # room for groups without tokens


def levels(n: int, percent: int) -> list[tuple[int, int]]:
    """The classes that a set of n tokens takes part in, with their numbers of groups."""
    own = level(n, percent)
    return [(lv, groups(lv, percent)) for lv in ((own, own + 1) if 100 * upper(own, percent) * percent <= 100 * 100 * n else (own,))]


def group_keys(tokens: np.ndarray, lv: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups that hold tokens, the keys of their contents, and the tokens in each."""
    group = group_of(tokens, m)
    order = np.argsort(group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    part = np.add.reduceat(mix(tokens ^ U(0x9FB21C651E98DF25))[order], first)
    return group[first], mix(mix(part) + _tag(lv) + group[first].astype(U)), np.diff(np.r_[first, len(group)])


def _tag(lv: int) -> np.uint64:
    return U(lv + 1) << U(40)


def keyed(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, int]]:
    """Each level of a set, its keys there, and how many of the most frequent of them it can do without."""
    n, out = len(tokens), []
    for lv, m in levels(n, percent):
        group, found, _ = group_keys(tokens, lv, m)
        apart = most_apart(n, min(upper(lv, percent) - 1, 100 * n // percent), percent)
        if len(group) <= apart:
            empty = np.setdiff1d(np.arange(m), group).astype(U)
            found = np.concatenate([found, mix(_tag(lv) + empty + U(0xE0 << 48))])
        out.append((lv, found, max(0, len(group) - apart - 1)))
    return out


def keys(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """Keys of a set at each of its levels."""
    return [(lv, found) for lv, found, _ in keyed(tokens, percent)]


def vector(tokens: np.ndarray, lv: int, m: int) -> bytes:
    """The count of each group (32 bits), then 32 bits of the key of its content (0 where it is empty)."""
    group, key, count = group_keys(tokens, lv, m)
    counts, marks = np.zeros(m, np.uint32), np.zeros(m, np.uint32)
    counts[group] = count
    marks[group] = (key >> U(32)).astype(np.uint32) | np.uint32(1)
    return counts.tobytes() + marks.tobytes()


def read_vectors(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and marks of vectors of one level, a row each."""
    both = np.frombuffer(b"".join(raws), np.uint32).reshape(len(raws), -1)
    m = both.shape[1] // 2
    return both[:, :m], both[:, m:]
