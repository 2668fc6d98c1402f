"""Token counts by greedy longest match, with an automaton that never goes back.

The vocabulary is a trie of byte strings. Where no edge goes on from a node, the longest
match seen so far is complete: the failure link of the node leads to where the bytes
after the pieces that are then certain have come to, and the node knows how many such
pieces there are. A word is read once, each byte moves forward or pops pieces, and the
number of pieces is the sum of the popped counts; no piece is ever built.

Words are runs without ASCII white space, each with a blank before it, as the vocabulary
has them. All distinct words of a slice of texts go through the automaton side by side.

Null and empty texts have no words and no tokens. A word that the vocabulary cannot spell
counts as one token. Rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.llm.frames import per_text
from revtrail.llm.words import Words

COUNTED = "n_words long, n_tokens long"


def vocabulary(path: str) -> list[bytes]:
    """The byte strings of a rank file: one per line, base 64, then its rank."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


@dataclass
class Automaton:
    """Edges as sorted keys (node * 256 + byte) with their targets; per node its failure
    link (-1: no match can end here) and the pieces popped on the way."""

    edges: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    def move(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The node an edge leads to, or -1."""
        if not len(self.edges):
            return np.full(len(nodes), -1)
        keys = nodes * 256 + symbols
        at = np.searchsorted(self.edges, keys)
        at[at == len(self.edges)] = 0
        return np.where(self.edges[at] == keys, self.targets[at], -1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces per word."""
        total = np.zeros(len(words), dtype=np.int64)
        if not words:
            return total
        sizes = np.asarray([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        node = np.zeros(len(words), dtype=np.int64)
        lost = np.zeros(len(words), dtype=bool)
        by_size = np.argsort(-sizes, kind="stable")
        active = len(words)
        for place in range(int(sizes.max())):
            while active and sizes[by_size[active - 1]] <= place:
                active -= 1
            now = by_size[:active]
            now = now[~lost[now]]
            while len(now):
                to = self.move(node[now], data[starts[now] + place])
                went = to >= 0
                node[now[went]] = to[went]
                now = self._pop(now[~went], node, total, lost)
        left = np.flatnonzero((node > 0) & ~lost)
        while len(left):
            left = self._pop(left, node, total, lost)
            left = left[node[left] > 0]
        total[lost] = 1
        return total

    def _pop(self, which: np.ndarray, node: np.ndarray, total: np.ndarray, lost: np.ndarray) -> np.ndarray:
        """Pop the certain pieces of these words; gives back those that can go on."""
        total[which] += self.popped[node[which]]
        after = self.fail[node[which]]
        lost[which[after < 0]] = True
        node[which] = np.maximum(after, 0)
        return which[after >= 0]


def build(words: list[bytes]) -> Automaton:
    """Trie of the vocabulary with failure links and popped counts; node 0 is the root."""
    children: list[dict[int, int]] = [{}]
    ends = [False]
    for word in words:
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(False)
            node = children[node][byte]
        ends[node] = node > 0
    fail = [-1] * len(children)
    popped = [0] * len(children)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for byte, node in children[parent].items():
            queue.append(node)
            if ends[node]:
                fail[node], popped[node] = 0, 1
                continue
            link, count = fail[parent], popped[parent]
            while link >= 0 and byte not in children[link]:
                count += popped[link]
                link = fail[link]
            if link >= 0:
                fail[node], popped[node] = children[link][byte], count
    flat = sorted((node * 256 + byte, to) for node, edges in enumerate(children) for byte, to in edges.items())
    return Automaton(
        np.asarray([e[0] for e in flat], dtype=np.int64),
        np.asarray([e[1] for e in flat], dtype=np.int64),
        np.asarray(fail, dtype=np.int64),
        np.asarray(popped, dtype=np.int64),
    )


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return build(vocabulary(path))


def token_counts(text: Column, path: str) -> Column:
    """Struct of words and tokens of a text column."""

    def judge(texts: list[bytes | None]) -> list[pa.Array]:
        words = Words(texts)
        pieces = automaton(path).counts([b" " + w for w in words.vocabulary])
        sums = np.concatenate([[0], np.cumsum(pieces[words.numbers])]) if len(words.numbers) else np.zeros(1, np.int64)
        return [pa.array(words.counts), pa.array((sums[words.ends] - sums[words.starts]).astype(np.int64))]

    return per_text(judge, COUNTED)(text.cast("string"))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every document."""
    return docs.select("doc_id", token_counts(F.col("text"), path).alias("_t")).select("doc_id", "_t.*")
