"""The suffix tree in memory: dense for few symbols and two words of context, and plain dictionaries for any depth."""

import math
from collections import Counter, defaultdict

import numpy as np

from millrace.llm.suffix_tree import PENALTY


class Symbols:
    """Numbers of given words, the end of a text and the rest; codes of contexts."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words)
        self.size = len(words) + 1  # the last is "any other word"
        self.other = len(words)

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(h), self.other)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, self.other)


def _contexts(h: np.ndarray, doc: np.ndarray, symbols: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol of each token, and codes of the one and two symbols before it in its text (-1: there are not as many)."""
    s = symbols.of(h)
    one, two = np.full(len(s), -1), np.full(len(s), -1)
    inside = doc[1:] == doc[:-1]
    one[1:] = np.where(inside, s[:-1], -1)
    deep = inside[1:] & inside[:-1]
    two[2:] = np.where(deep, s[:-2] * symbols.size + s[1:-1], -1)
    return s, one, two


class Tree:
    """The same model in memory, for few symbols and two words of context: smoothed next-symbol distributions (log10), row 0 the root."""

    def __init__(self, symbols: Symbols, root: np.ndarray, n: int, one: tuple, two: tuple, penalty: float = PENALTY):
        """``one``, ``two``: (context, next, n) arrays; all of two's suffixes are contexts of one."""
        self.symbols = symbols
        k = symbols.size
        cost = penalty * np.log(max(n, 2))

        def dense(table):
            contexts, at = np.unique(table[0], return_inverse=True)
            counts = np.zeros((len(contexts), k))
            counts[at, table[1]] = table[2]
            return contexts, counts

        def smoothed(counts, parent):
            kinds = (counts > 0).sum(1, keepdims=True)
            return (counts + kinds * parent) / (counts.sum(1, keepdims=True) + kinds)

        def gain(counts, parent):
            own = counts / counts.sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(counts > 0, counts * np.log(own / parent), 0).sum(1) - cost * (counts > 0).sum(1)

        c1, n1 = dense(one)
        c2, n2 = dense(two)
        p1 = smoothed(n1, root[None, :])
        suffix = np.searchsorted(c1, c2 % k)
        p2 = smoothed(n2, p1[suffix]) if len(c2) else np.zeros((0, k))
        keep2 = gain(n2, p1[suffix]) > 0 if len(c2) else np.zeros(0, bool)
        keep1 = gain(n1, root[None, :]) > 0 if len(c1) else np.zeros(0, bool)
        keep1[np.unique(suffix[keep2])] = True  # a state's suffix is a state
        self.one, self.two = c1[keep1], c2[keep2]
        self.table = np.log10(np.concatenate([root[None, :], p1[keep1], p2[keep2]]))

    def score(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(symbol | longest suffix state) of each token, and which tokens are in the common symbol."""
        s, one, two = _contexts(h, doc, self.symbols)
        state = np.zeros(len(s), np.int64)
        for codes, known, base in ((one, self.one, 1), (two, self.two, 1 + len(self.one))):
            if len(known):
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                state = np.where(known[at] == codes, base + at, state)
        return self.table[state, s], s == self.symbols.other


def plain_scores(texts, held, depth=3, least=2, penalty=PENALTY):
    """log10 probability of each text (a list of words), from counts in dictionaries."""
    tokens = [[*t, None] for t in texts]
    train = [t for t, h in zip(tokens, held, strict=True) if not h]
    words = Counter(x for t in train for x in t)
    n = sum(words.values())
    size = n + 0.5 * (len(words) + 1)
    cost = penalty * math.log(max(n, 2))
    following = defaultdict(Counter)  # context to next tokens
    for t in train:
        for i, x in enumerate(t):
            for k in range(1, min(depth, i) + 1):
                following[tuple(t[i - k : i])][x] += 1
    known = {c: f for c, f in following.items() if sum(f.values()) >= least}

    def p(context, x):
        while context and context not in known:
            context = context[1:]
        if not context:
            return (words[x] + 0.5) / size
        f = known[context]
        return (f[x] + len(f) * p(context[1:], x)) / (sum(f.values()) + len(f))

    states = set()
    for c, f in known.items():
        total = sum(f.values())
        if sum(k * (math.log(k / total) - math.log(p(c[1:], x))) for x, k in f.items()) - cost * len(f) > 0:
            states |= {c[i:] for i in range(len(c))}
    out = []
    for t in tokens:
        total = 0.0
        for i, x in enumerate(t):
            longest = next((c for k in range(min(depth, i), 0, -1) if (c := tuple(t[i - k : i])) in states), ())
            total += math.log10(p(longest, x))
        out.append(total)
    return out
