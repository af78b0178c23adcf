"""Token counts by a unigram model, with dynamic programming shared in a trie.

The distinct pre-tokens of a task are inserted in one trie over bytes. A node
is a prefix; its best score is computed once, when it is made, from the nodes
above it: the best over all vocabulary pieces that end there. Pre-tokens that
begin alike share that work, and the node where one ends stores its count of
tokens. The trie lives as long as its task and starts anew beyond ``NODES``
nodes, which changes no result; nothing is shuffled.

Pieces are those of a public rank file; the unigram probability of a piece is
Zipf's, proportional to 1 / (rank + 1). Of equally good segmentations the one
with fewer pieces counts.

Defined results: a null or empty text has no pre-tokens and no tokens; null ids
and repeated rows are counted row by row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.bpe import load_ranks

NODES = 400_000


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {t: -math.log(r + 1) - total for t, r in ranks.items()}


class TrieCounts(dict):
    """Pre-token -> tokens; a missing one is walked into the trie."""

    def __init__(self, scores: dict[bytes, float], nodes: int = NODES):
        super().__init__()
        self.scores, self.most = scores, nodes
        self.ends = {t[i:] for t in scores for i in range(len(t))}  # every end of a piece
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]  # of the root, the empty prefix

    def __missing__(self, word: str) -> int:
        if len(self.best) > self.most:
            self.empty()
        w = word.encode()
        child, best, count, path, node = self.child, self.best, self.count, [0], 0
        scores, ends = self.scores, self.ends
        for d, byte in enumerate(w, 1):
            key = node << 8 | byte
            node = child.get(key, -1)
            if node < 0:
                node = child[key] = len(best)
                top, tokens = -math.inf, 0
                for a in range(d - 1, -1, -1):
                    piece = w[a:d]
                    if piece not in ends:
                        break
                    s = scores.get(piece)
                    if s is not None:
                        s += best[path[a]]
                        n = count[path[a]] + 1
                        if s > top or s == top and n < tokens:
                            top, tokens = s, n
                best.append(top)
                count.append(tokens)
            path.append(node)
        self[word] = count[node]
        return count[node]


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every row."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary has no piece for {len(missing)} of the 256 bytes")
    shared = docs.sparkSession.sparkContext.broadcast(zipf_scores(ranks))

    @F.pandas_udf("n_words long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find, known = regex.compile(pattern).findall, TrieCounts(shared.value)
        get = known.__getitem__
        for s in batches:
            words = (find(t or "") for t in s)
            rows = [(len(w), sum(map(get, w))) for w in words]
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), count(F.col(text).cast("string")).alias("c"))
    return rows.select("doc_id", "c.n_words", "c.n_tokens")


def public_counts(docs: DataFrame) -> DataFrame:
    """With the public 50k byte-level pieces (op2's parameter)."""
    import public_tokenizers

    return count_tokens(docs, load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
