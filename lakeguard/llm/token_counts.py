"""Token counts under a unigram vocabulary, with prefixes shared in a trie.

A text splits into pre-tokens (words behind a word-start mark).  Each task
inserts its distinct pre-tokens in a trie.  A node stands for a prefix and
keeps the forward score of that prefix, the best sum of piece scores that
spells it, with the number of pieces on that path; it is computed once,
however many pre-tokens share the prefix, from the ancestors within the
longest piece.  Terminal nodes thus hold the count of their pre-token.

A trie is dropped and begun anew beyond MAX_NODES nodes, and only the first
FILED_CHARS characters of a pre-token are filed: behind them a longer one is
scored in the same way, but its nodes are kept no longer than the longest piece
reaches.  Both bound memory and change no count.  Documents never leave their
task, so there is no shuffle and no hot key.

Defined cases: a null, empty or blank text has no pre-token and no token; a
character no piece covers costs one token per UTF-8 byte; of two paths with
equal scores the one with fewer tokens counts; an empty table gives an empty
result; repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeguard.llm.common import WORD, map_texts, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MAX_NODES = 1_000_000
FILED_CHARS = 64

_WORD = re.compile(WORD)


def load_pieces(path: str = MODEL) -> dict[str, float]:
    """Pieces of a public vocabulary file with unigram log-probabilities by Zipf's law of their rank.

    Control, unknown and byte pieces are left out, and so are pieces the file
    itself marks as unusable (a score of minus one thousand million).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and model.get_score(i) > -1e9]
    total = sum(1 / (r + 1) for r in range(len(usable)))
    return {p: -math.log((r + 1) * total) for r, p in enumerate(usable)}


class ForwardTrie:
    """Trie of pre-tokens whose nodes hold forward scores.

    A node is filed under the prefix it stands for, with the best score of that
    prefix and the number of pieces on the way.
    """

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        # Lengths of the pieces that end in given characters: the only ones worth looking up there.
        ending: dict[str, set[int]] = {}
        for piece in pieces:
            if len(piece) > 2:
                ending.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths = {chars: tuple(sorted(found)) for chars, found in ending.items()}
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.clear()

    def clear(self) -> None:
        self.nodes: dict[str, tuple[float, int]] = {"": (0.0, 0)}

    def tokens(self, word: str) -> int:
        """Tokens of a pre-token: goes back to its longest known prefix and scores the new nodes from there."""
        node = self.nodes.get(word) if len(word) <= FILED_CHARS else None
        if node is None:
            if len(self.nodes) + FILED_CHARS > MAX_NODES:
                self.clear()
            node = self._insert(word)
        return node[1]

    def _insert(self, word: str) -> tuple[float, int]:
        nodes, pieces, lengths = self.nodes, self.pieces, self.lengths
        beyond: deque = deque(maxlen=self.longest)      # the last nodes behind the filed ones
        known = min(len(word) - 1, FILED_CHARS)
        while (node := nodes.get(word[:known])) is None:
            known -= 1
        for end in range(known + 1, len(word) + 1):
            char = word[end - 1]
            score, count = node            # of the prefix one character shorter
            if (single := pieces.get(char)) is not None:
                best, tokens = score + single, count + 1
            else:
                n_bytes = len(char.encode("utf-8", "surrogatepass"))
                best, tokens = score + self.unknown * n_bytes, count + n_bytes
            for length in (2, *lengths.get(word[end - 3:end], ())) if end > 2 else range(2, end + 1):
                if length > end:
                    break
                piece = pieces.get(word[end - length:end])
                if piece is not None:
                    start = end - length
                    score, count = nodes[word[:start]] if start <= FILED_CHARS else beyond[-length]
                    score += piece
                    if score > best or score == best and count + 1 < tokens:
                        best, tokens = score, count + 1
            node = (best, tokens)
            if end <= FILED_CHARS:
                nodes[word[:end]] = node
            else:
                beyond.append(node)
        return node


def count_tokens(docs: DataFrame, keep: list[str], pieces: dict[str, float] | None = None,
                 model: str = MODEL) -> DataFrame:
    """Columns ``keep`` with n_pretokens and n_tokens of every whole text.

    The vocabulary (a fixed file, tens of thousands of pieces) is broadcast.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_pieces(model) if pieces is None else pieces)
    state: dict = {}

    def fn(texts):
        trie = state.get("trie")
        if trie is None:
            trie = state["trie"] = ForwardTrie(shared.value)
        words_of = [Counter(_WORD.findall(t)) if t else Counter() for t in texts]
        return {"n_pretokens": [c.total() for c in words_of],
                "n_tokens": [sum(n * trie.tokens(MARK + w) for w, n in c.items()) for c in words_of]}

    return map_texts(docs, keep, fn, {"n_pretokens": pa.int64(), "n_tokens": pa.int64()},
                     "n_pretokens long, n_tokens long")
