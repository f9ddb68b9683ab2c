"""Exact TF-IDF cosine over all words of the labelled examples, for neighbours above a bound.

An inverted index holds, per word, the examples that have it and the largest
weight among them. A text's words are taken rare ones first. Once the words
that are left cannot bring an example to the bound, neither by the largest
weights nor by the rest of the text's norm, only examples met so far can reach
it, and only those are scored in full. So nothing above the bound is missed,
and common words, whose lists are long, are hardly ever read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

NEAR = 0.9


def word_hash(word: str) -> int:
    """A word as 64 bits, the same in every worker; two words of a sample meet with a chance of some 1e-8."""
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def _weights(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(counts)) * idf


@dataclass
class ExampleIndex:
    """Words by hash, their postings one after another, and the same weights by example."""

    words: np.ndarray
    idf: np.ndarray
    unknown_idf: float
    starts: np.ndarray
    examples: np.ndarray
    largest: np.ndarray
    weights: np.ndarray
    ends: np.ndarray
    word_of: np.ndarray
    weight_of: np.ndarray

    def restricted(self, kept: np.ndarray) -> ExampleIndex:
        """The index of some examples only, numbered anew; words keep the weights of the whole sample."""
        sizes = np.diff(self.ends, prepend=0)[kept]
        own = np.arange(int(sizes.sum())) + np.repeat(self.ends[kept] - np.cumsum(sizes), sizes)
        weights = self.weight_of[own].astype(np.float32)
        return ExampleIndex._of(self.words, self.idf.astype(np.float32), self.unknown_idf, sizes, self.word_of[own], weights)

    @classmethod
    def _of(cls, words, idf, unknown_idf, sizes, word_of, weight_of) -> ExampleIndex:
        """From the words of the examples in a row, ascending within each."""
        order = np.argsort(word_of, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(word_of, minlength=len(words)))]).astype(np.int32)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        largest = np.zeros(len(words), np.float32)
        np.maximum.at(largest, word_of, (weight_of * 1.000001).astype(np.float32))
        return cls(words, idf, unknown_idf, starts, owner[order], largest, weight_of[order], np.cumsum(sizes), word_of, weight_of)

    @classmethod
    def build(cls, sizes: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> ExampleIndex:
        """From the distinct words of all examples in a row; ``sizes`` tells how many each has."""
        n = len(sizes)
        words, at = np.unique(hashes, return_inverse=True)
        at = at.astype(np.int32)
        df = np.bincount(at, minlength=len(words))
        idf = 1 + np.log((n + 1) / (df + 1))
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        weights = _weights(counts, idf[at])
        weights /= np.sqrt(np.bincount(owner, weights * weights, minlength=n))[owner]
        return cls._of(words, idf, 1 + float(np.log(n + 1)), sizes, at, weights)

    def telling_words(self, bound: float = NEAR) -> frozenset[int]:
        """Of each example the rarest words without which no text can reach the bound.

        What is left of an example's norm without them is below the bound, so a
        text that has none of them need not be looked up.
        """
        found: set[int] = set()
        for start, end in zip((self.ends - np.diff(self.ends, prepend=0)).tolist(), self.ends.tolist(), strict=True):
            words = self.word_of[start:end]
            order = np.argsort(-self.idf[words], kind="stable")
            weights = self.weight_of[start:end][order].astype(float)
            rest = np.sqrt(np.concatenate([np.cumsum((weights * weights)[::-1])[::-1], [0.0]]))
            found.update(self.words[words[order[: int(np.argmax(rest < bound - 1e-5))]]].tolist())
        return frozenset(found)

    def near(self, hashes: np.ndarray, counts: np.ndarray, bound: float = NEAR) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of all examples whose cosine with the text is at least ``bound``."""
        none = np.zeros(0, np.int32), np.zeros(0)
        if not len(hashes) or not len(self.words):
            return none
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        q = _weights(counts, np.where(known, self.idf[at], self.unknown_idf))
        q = q / np.sqrt(q @ q)
        lengths = np.where(known, self.starts[at + 1] - self.starts[at], 0)
        # Words without an example count for the norm alone.
        q, at, lengths = q[lengths > 0], at[lengths > 0], lengths[lengths > 0]
        by_word_at, by_word_q = at, q
        order = np.argsort(lengths, kind="stable")
        q, at = q[order], at[order]
        left = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
        rest = np.minimum(np.sqrt(left(q * q)), left(q * self.largest[at]))
        first = int(np.argmax(rest < bound - 1e-9))
        if not first:
            return none
        lists = [slice(self.starts[t], self.starts[t + 1]) for t in at[:first].tolist()]
        met, place = np.unique(np.concatenate([self.examples[s] for s in lists]), return_inverse=True)
        parts = np.concatenate([w * self.weights[s] for w, s in zip(q[:first].tolist(), lists, strict=True)])
        met = met[np.bincount(place, parts, minlength=len(met)) + rest[first] >= bound - 1e-9]
        if not len(met):
            return none
        # In full: all words of the examples that are left, looked up among those of the text.
        sizes = self.ends[met] - np.where(met > 0, self.ends[met - 1], 0)
        own = np.arange(int(sizes.sum())) + np.repeat(self.ends[met] - np.cumsum(sizes), sizes)
        words = self.word_of[own]
        place = np.minimum(np.searchsorted(by_word_at, words), len(by_word_at) - 1)
        products = np.where(by_word_at[place] == words, by_word_q[place] * self.weight_of[own], 0.0)
        sims = np.bincount(np.repeat(np.arange(len(met)), sizes), products, minlength=len(met))
        near = sims >= bound - 1e-9
        return met[near], np.minimum(sims[near], 1.0)
