"""Cross-tokenizer alignment: where two tokenizers cut the same bytes alike.

Both tokenizers encode a space and the text.  The byte offsets where their
tokens end are put in a dictionary each, from offset to token number; the
intersection of the two key sets, sorted, slices both id lists into groups that
spell the same bytes.  Within a group no inner ends agree, so its link is the
pair of the two tokens that end with it.

A link's two tokens end at the same byte, so one's bytes are a suffix of the
other's.  ``Vocabularies`` numbers all such pairs: their count follows from the
two vocabulary files alone (some hundred thousand), which bounds the table of
pair counts at any size of the corpus, and with it what is sent to the driver
and the tasks, and what a long text can hold of distinct pairs.

Defined cases: a text that is null or empty, or whose tokens do not spell the
space and the text byte by byte (one that holds the word-start mark itself, for
example), has no tokens, no group and no link; special tokens' strings inside
texts are plain text; repeated rows are aligned and counted each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.llm.common import map_rows, materialise, quoted, small_batches

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one letter: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}


# Fixed value: how byte-level vocabularies of this family cut a text before merging.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizers:
    """The two tokenizers and the bytes of each of their ids.

    The byte-level file's own vocabulary is run by the faster of two libraries, which takes a merge's rank from its
    id; a file in which the two orders differ is refused.
    """

    def __init__(self, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE):
        import sentencepiece
        import tiktoken

        with open(byte_bpe, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if not set(letters) <= model["vocab"].keys():
            raise ValueError(f"single bytes are missing: {byte_bpe}")
        if ids != sorted(ids) or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"not a byte-level vocabulary in the order of its merges: {byte_bpe}")
        # Special tokens stay out, so their strings are plain text.
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in entry): i for entry, i in model["vocab"].items() if entry not in special}
        self.a = tiktoken.Encoding("byte_bpe", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        # An id that no text yields spells nothing.
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for spelt, i in ranks.items():
            self.a_bytes[i] = spelt
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])

    def _piece(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers per text, both empty unless each spells a space and the text."""
        nothing = np.zeros(0, np.int32)
        made = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            spelt = b" " + text.encode() if text else b""
            # All single bytes are in the byte-level vocabulary, so its tokens spell any text; pieces may not.
            if not text or b"".join(map(self.b_bytes.__getitem__, b)) != spelt:
                made.append((nothing, nothing))
            else:
                made.append((np.array(self.a.encode_ordinary(" " + text), np.int32), np.array(b, np.int32)))
        return made


class Vocabularies:
    """All id pairs that can be linked, numbered: one's bytes are a suffix of the other's."""

    def __init__(self, tokenizers: Tokenizers):
        self.n_b = len(tokenizers.b_bytes)
        ids_a: dict[bytes, list[int]] = {}
        ids_b: dict[bytes, list[int]] = {}
        for spelt, ids in ((tokenizers.a_bytes, ids_a), (tokenizers.b_bytes, ids_b)):
            for i, said in enumerate(spelt):
                if said:
                    ids.setdefault(said, []).append(i)
        keys = {a * self.n_b + b for said, found in ids_a.items() for cut in range(len(said))
                for b in ids_b.get(said[cut:], ()) for a in found}
        keys |= {a * self.n_b + b for said, found in ids_b.items() for cut in range(len(said))
                 for a in ids_a.get(said[cut:], ()) for b in found}
        self.keys = np.array(sorted(keys), np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the distinct pairs among the given ones, and how often each occurs."""
        keys, times = np.unique(a.astype(np.int64) * self.n_b + b, return_counts=True)
        return np.searchsorted(self.keys, keys).astype(np.int32), times.astype(np.int32)

    def b_of(self) -> np.ndarray:
        return self.keys % self.n_b


def slices_of(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """Per group, the number of the token behind it in each list (so groups are consecutive slices)."""
    ends_a = dict(zip(np.cumsum(a_lengths).tolist(), range(1, len(a_lengths) + 1)))
    ends_b = dict(zip(np.cumsum(b_lengths).tolist(), range(1, len(b_lengths) + 1)))
    # Ends rise along a dictionary, so the keys both hold come out sorted.
    common = [end for end in ends_a if end in ends_b]
    return list(map(ends_a.__getitem__, common)), list(map(ends_b.__getitem__, common))


_INTS = pa.list_(pa.int32())
_ALIGNED = {"a_ids": _INTS, "b_ids": _INTS, "a_cuts": _INTS, "b_cuts": _INTS}


def align(docs: DataFrame, keep: list[str], byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """``row`` (the columns ``keep``) with a_ids, b_ids, a_cuts and b_cuts of every whole text.

    Group i holds the ids from cut i-1 (0 for the first) up to cut i of each list; its link is the last id of both.
    """
    small_batches(docs.sparkSession)
    state: dict = {}

    def fn(texts):
        tokenizers = state.get("tokenizers")
        if tokenizers is None:
            tokenizers = state["tokenizers"] = Tokenizers(byte_bpe, piece_bpe)
        made: dict[str, list] = {k: [] for k in _ALIGNED}
        for a, b in tokenizers.encode(texts):
            for name, value in zip(_ALIGNED, (a, b, *slices_of(tokenizers.a_lengths[a], tokenizers.b_lengths[b]))):
                made[name].append(value)
        return made

    ddl = ", ".join(f"{k} array<int>" for k in _ALIGNED)
    return map_rows(docs, keep, fn, _ALIGNED, ddl)


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``, written from a table of all ids' digits."""

    def __init__(self, n_ids: int):
        said = [str(i).encode() for i in range(n_ids)]
        self.lengths = np.array([len(x) for x in said])
        width = int(self.lengths.max()) + 1      # one more for the separator
        self.digits = np.frombuffer(b"".join(x.ljust(width, b",") for x in said), np.uint8).reshape(n_ids, width)

    def text(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> bytes:
        # Token i of a stands behind i tokens of a and all tokens of b of earlier groups; b likewise.
        place_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], b_cuts[:-1]]), np.diff(a_cuts, prepend=0))
        place_b = np.arange(len(b)) + np.repeat(a_cuts, np.diff(b_cuts, prepend=0))
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a, b
        rows, lengths = self.digits[ids], self.lengths[ids]
        for places, mark in ((place_a[a_cuts - 1], b"|"), (place_b[b_cuts - 1], b";")):
            rows[places, lengths[places]] = mark[0]
        return rows[np.arange(rows.shape[1]) <= lengths[:, None]].tobytes()[:-1]


_DIGEST = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
           "pairs": _INTS, "times": _INTS}


def digest(aligned: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """``row`` with counts, the hash of the groups, and the numbers of the distinct linked pairs with how often each occurs."""
    ddl = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
    schema = T.StructType([aligned.schema["row"], *T.StructType.fromDDL(ddl).fields])

    def run(batches):
        tokenizers = Tokenizers(byte_bpe, piece_bpe)
        vocabularies = Vocabularies(tokenizers)
        writer = Writer(max(len(tokenizers.a_bytes), len(tokenizers.b_bytes)))

        def one(a, b, a_cuts, b_cuts):
            if not len(a):
                return 0, 0, 0, 0, "", [], []
            pairs, times = vocabularies.pairs(a[a_cuts - 1], b[b_cuts - 1])
            said = hashlib.sha256(writer.text(a, b, a_cuts, b_cuts)).hexdigest()
            return len(a), len(b), len(a_cuts), len(a_cuts), said, pairs, times

        for batch in batches:
            if batch.num_rows:
                made = [one(*lists) for lists in zip(*[[x.values.to_numpy() for x in batch.column(k)] for k in _ALIGNED])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row")] + [pa.array(list(m), t) for m, t in zip(zip(*made), _DIGEST.values())],
                    names=["row", *_DIGEST])

    return aligned.mapInArrow(run, schema)


def pair_counts(digested: DataFrame) -> DataFrame:
    """(pair, n): how often a pair is linked in all texts; no more rows than ``Vocabularies`` has keys."""
    return (digested.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
            .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").cast("long").alias("n")))


def score_links(digested: DataFrame, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """``digested`` with count_sum and n_best; ``counts`` and ``best`` go by pair number."""
    spark = digested.sparkSession
    sent = spark.sparkContext.broadcast((counts, best))
    kept = [f for f in digested.schema.fields if f.name not in ("pairs", "times")]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches):
        n, top = sent.value
        for batch in batches:
            sums, bests = [], []
            for pairs, times in zip(batch.column("pairs"), batch.column("times")):
                p, t = pairs.values.to_numpy(), times.values.to_numpy().astype(np.int64)
                sums.append(int((n[p] * t).sum()))
                bests.append(int(t[top[p]].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(bests, pa.int64()), pa.array(sums, pa.int64())], names=schema.names)

    return digested.mapInArrow(run, schema)


def alignment_summary(docs: DataFrame, keep: list[str], byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Columns ``keep`` with token, group and link counts, and how the links rank in the whole corpus."""
    digested = materialise(digest(align(docs, keep, byte_bpe, piece_bpe), byte_bpe, piece_bpe), "alignment")
    vocabularies = Vocabularies(Tokenizers(byte_bpe, piece_bpe))
    # One number per linkable id pair of the two vocabulary files, however large the corpus.
    counts = np.zeros(len(vocabularies.keys), np.int64)
    found = pair_counts(digested).toArrow()
    counts[found["pair"].to_numpy()] = found["n"].to_numpy()
    most = np.zeros(vocabularies.n_b, np.int64)
    np.maximum.at(most, vocabularies.b_of(), counts)
    scored = score_links(digested, counts, counts == most[vocabularies.b_of()])
    return scored.select(*[F.col(f"row.{quoted(k)}").alias(k) for k in keep], "n_a", "n_b", "n_groups", "n_links", "n_best",
                         "count_sum", "groups_sha256")
