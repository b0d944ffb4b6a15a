"""Sets of word shingles of Arrow batches, their MinHash samples and odd sketches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tickbars.llm.textbytes import NOT_SPACE, U64, mix, words

_PAIR = U64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class SketchSettings:
    """``bands`` times ``rows`` MinHash samples, folded into ``64 * sketch_words`` bits.

    30 bands of 5: a pair with a Jaccard similarity of 0.8 meets in no band with a
    probability of 7e-6, one of 0.85 with 2e-8.
    """

    bands: int = 30
    rows: int = 5
    sketch_words: int = 8
    shingle: int = 2
    #: Links are pairs with similarity * 100 >= this.
    percent: int = 80

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """XOR population count up to which a pair is confirmed on its full sets.

        Two sketches differ in about ``n / 2 * (1 - exp(-4 d / n))`` of n bits when d
        samples differ. d is taken five and a half deviations above its mean at the
        limit, and so is the count, so that no linked pair is judged by its sketch.
        """
        n = 64 * self.sketch_words
        p = 1 - self.percent / 100
        d = self.samples * p + 5.5 * (self.samples * p * (1 - p)) ** 0.5
        share = (1 - np.exp(-4 * d / n)) / 2
        return int(np.ceil(n * share + 2 * (n * share * (1 - share)) ** 0.5))


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``length`` words by row, and where each row's begin.

    A row of fewer words, but not none, has one shingle: all its words.
    """
    found = words(data, offsets, NOT_SPACE)
    n_words = np.diff(found.bounds)
    n = len(n_words)
    width = np.maximum(n_words - length + 1, np.minimum(n_words, 1))
    row = np.repeat(np.arange(n), width)
    ends = np.cumsum(width)
    first = np.arange(len(row)) - (ends - width)[row] + found.bounds[row]
    last = found.bounds[1:][row]
    value = mix(np.minimum(n_words, length).astype(U64) + U64(1))[row]
    for k in range(length):
        at = first + k
        inside = at < last
        value = np.where(
            inside, mix(value * _PAIR + found.hash[np.minimum(at, len(found.hash) - 1)]), value
        ) if len(row) else value
    return distinct_by_row(row, value, n)


def distinct_by_row(
    row: np.ndarray, value: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(row[new], np.arange(n + 1))


def set_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of hashes that stand for each row's set, whatever its order."""
    sums = []
    for salt in (U64(0), _PAIR):
        total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(mix(values ^ salt), out=total[1:])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    return sums[0], sums[1]


def min_hashes(values: np.ndarray, bounds: np.ndarray, samples: int) -> np.ndarray:
    """(rows with a set, samples) least values; row k is for ``factors[k]``."""
    filled = np.flatnonzero(np.diff(bounds))
    starts = bounds[:-1][filled]
    factors = mix(np.arange(1, samples + 1, dtype=U64) * _PAIR) | U64(1)
    least = np.empty((samples, len(filled)), dtype=np.uint32)
    if len(filled):
        for k, factor in enumerate(factors):
            scaled = ((values * factor) >> U64(32)).astype(np.uint32)
            least[k] = np.minimum.reduceat(scaled, starts)
    return least.T


def band_keys(least: np.ndarray, settings: SketchSettings) -> np.ndarray:
    """(rows, bands) hashes of each band's samples, different from band to band."""
    by_band = least.reshape(len(least), settings.bands, settings.rows).astype(U64)
    key = mix(np.arange(settings.bands, dtype=U64) + U64(99))[None, :]
    for k in range(settings.rows):
        key = mix(key * _PAIR + by_band[:, :, k])
    return np.broadcast_to(key, (len(least), settings.bands))


def odd_sketches(least: np.ndarray, words_64: int) -> np.ndarray:
    """(rows, words) parity bitmaps: each sample flips the bit its number and value name."""
    n, samples = least.shape
    flips = mix(least.astype(U64) + (np.arange(samples, dtype=U64) << U64(32)))
    place = (flips % U64(64 * words_64)).astype(np.int64)
    sketch = np.zeros((n, words_64), dtype=U64)
    bits = U64(1) << (place % 64).astype(U64)
    rows = np.broadcast_to(np.arange(n)[:, None], place.shape)
    np.bitwise_xor.at(sketch, (rows.ravel(), (place // 64).ravel()), bits.ravel())
    return sketch


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Population count of the XOR of sketches along the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def whole_sketch(values: np.ndarray) -> bytes:
    """Parity bitmap of a whole set, eight bits an element, a power of two of them.

    An element in one of two sets flips one bit of their XOR, so its population count
    never exceeds the size of the symmetric difference.
    """
    bits = max(64, 1 << int(8 * len(values) - 1).bit_length())
    at = (mix(values ^ U64(0x5851F42D4C957F2D)) & U64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


class Bucket:
    """Rows that share a band, and which of them their sketches cannot tell from linked."""

    def __init__(
        self,
        ids: np.ndarray,
        sizes: np.ndarray,
        sampled: np.ndarray,
        whole: list[bytes],
        settings: SketchSettings,
    ) -> None:
        self.ids, self.sizes, self.sampled = ids, sizes, sampled
        self.settings = settings
        self.level = np.array([len(x) for x in whole])
        self.own, self.half = {}, {}
        self.slot = np.zeros(len(ids), dtype=np.int64)
        for level in np.unique(self.level):
            at = np.flatnonzero(self.level == level)
            self.slot[at] = np.arange(len(at))
            matrix = np.frombuffer(b"".join(whole[i] for i in at), dtype=U64)
            matrix = matrix.reshape(len(at), -1)
            self.own[level] = matrix
            middle = matrix.shape[1] // 2
            if middle:
                self.half[level] = matrix[:, :middle] ^ matrix[:, middle:]

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that may be linked to ``one``, the likeliest first.

        Sizes, the odd sketches of the samples and those of the whole sets each rule
        out pairs that cannot be linked; the last rules out nearly all of them.
        """
        percent = self.settings.percent
        a, b = self.sizes[one], self.sizes[others]
        others = others[np.minimum(a, b) * 100 >= percent * np.maximum(a, b)]
        bits = differing_bits(self.sampled[others], self.sampled[one])
        others = others[bits <= self.settings.most_bits]
        count = np.full(len(others), np.inf)
        mine = self.level[one]
        for level in (mine // 2, mine, mine * 2):
            at = np.flatnonzero(self.level[others] == level)
            if len(at):
                rows = self.slot[others[at]]
                if level == mine:
                    left, right = self.own[level][rows], self.own[mine][self.slot[one]]
                elif level > mine:
                    left, right = self.half[level][rows], self.own[mine][self.slot[one]]
                else:
                    left, right = self.own[level][rows], self.half[mine][self.slot[one]]
                count[at] = differing_bits(left, right)
        # percent * union <= 100 * shared, in terms of the symmetric difference.
        share = count * (100 + percent) / ((a + self.sizes[others]) * (100 - percent))
        may = np.flatnonzero(share <= 1)
        return others[may[np.argsort(share[may], kind="stable")]]

    def forest(self, failed: list[set[int]] | None = None) -> list[tuple[int, int]]:
        """Pairs to confirm: a spanning forest of the pairs that may be linked.

        ``failed`` has for each row the ids that were found not linked to it. Such pairs
        are left out, and a row that has any gets four times as many pairs more, so that
        a row that is linked to nothing is through after a few rounds.
        """
        left = np.arange(len(self.ids))
        pairs: list[tuple[int, int]] = []
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                one = queue.pop()
                found = self._but(self.near(one, left), one, failed)
                if len(found):
                    queue += found.tolist()
                    pairs += [(one, x) for x in found.tolist()]
                    left = left[~np.isin(left, found, assume_unique=True)]
        for one, known in enumerate(failed or []):
            if known:
                others = np.delete(np.arange(len(self.ids)), one)
                found = self._but(self.near(one, others), one, failed)
                pairs += [(one, x) for x in found[: 4 * len(known)].tolist()]
        return pairs

    def components(self, sets: list[np.ndarray]) -> np.ndarray:
        """For each row, the first row that exact links over ``sets`` connect it with."""
        group = np.full(len(self.ids), -1)
        left = np.arange(len(self.ids))
        percent = self.settings.percent
        while len(left):
            root, queue = left[0], [left[0]]
            group[root] = root
            left = left[1:]
            while queue and len(left):
                one = queue.pop()
                for other in self.near(one, left).tolist():
                    n = len(sets[one]) + len(sets[other])
                    both = len(np.intersect1d(sets[one], sets[other], assume_unique=True))
                    if both * 100 >= percent * (n - both):
                        group[other] = root
                        queue.append(other)
                left = left[group[left] < 0]
        return group

    def _but(
        self, found: np.ndarray, one: int, failed: list[set[int]] | None
    ) -> np.ndarray:
        if not failed or not failed[one]:
            return found
        return found[[x not in failed[one] for x in self.ids[found].tolist()]]
