"""Prefix trie, license scan and tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeguard.llm import alignment, licenses, prefix_trie, queries
from lakeguard.llm.running import running

SF = "/root/testdata/sf0.01"


# ---- prefix trie ------------------------------------------------------------

def rebuilt_by_hand(rows):
    """rows: (conv_id, turn, role, text)"""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def trie_by_hand(convs):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[0], r[1]))


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries.QUERIES["op11_prefix_trie"](spark, SF)
    assert [f.dataType.simpleString() for f in df.select(COLUMNS[:-1]).schema] == ["bigint"] * 7
    assert found(df) == trie_by_hand(rebuilt_by_hand(rows))


def made_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([None, 0, 5, 100, 101, 102, 103, 150, 199, 307, 308, 309, 1001, 2 ** 40])
        rows.append((c, rng.choice([None, 0, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None, "user", "a"]), rng.choice([None, "", "x", "yé", "long " * 9])))
    rows += [(200 + i % 50, t, "user", f"same {t}") for i in range(50) for t in range(9)]      # a hot group
    rows += [(400, t, "user", f"deep {t % 3}") for t in range(300)] * 2                        # a hot conversation, repeated
    rows += [(402, t, "user", f"deep {t % 3}") for t in range(300)]
    return rows


@pytest.mark.parametrize("shard_rows", [1, 3, 40, 50_000])
def test_trie_with_ties_nulls_hot_groups_and_heavy_nodes(spark, shard_rows):
    rows = made_rows(shard_rows, 400)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"a.b": F.lit(1), "depth": F.lit(2), "n": F.lit(3), "__part": F.lit(4)}).repartition(5)
    assert found(prefix_trie.conversation_trie(df, shard_rows)) == trie_by_hand(rebuilt_by_hand(rows))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(empty).collect() == []
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 100)}
    c = next(c for c in h if h[c] > 1)          # no first of its family, one turn of its own: nothing is left
    one = spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.conversation_trie(one)) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, 20_000))
    table = prefix_trie.SlotTable(keys, keys[::-1].copy())
    assert sorted(table.slots(keys, keys[::-1].copy())) == list(range(len(keys)))
    assert (table.slots(keys + 1, keys) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.array([5, 5]), np.array([6, 6]))


def test_running_numbers_span_partitions(spark):
    rows = [(7, i, i * 31 % 97) for i in range(500)] + [(k, 0, k) for k in range(40)] + [(90, 1, 5)] * 3
    df = spark.createDataFrame(rows, "k long, o long, x long").repartition(7)
    out = running(df, "k", [F.col("o")], ["o"], ["x"], "t").collect()
    by = defaultdict(list)
    for k, o, x in sorted(rows):
        by[k].append((o, x))
    want = []
    for k, items in by.items():
        total = 0
        for n, (o, x) in enumerate(items, 1):
            total ^= x
            want.append((k, o, total, n))
    assert sorted((r["k"], r["o"], r["x"], r["n"]) for r in out) == sorted(want)


# ---- license scan -----------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def base_by_hand(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = sorted((i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_license_scan_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.QUERIES["op12_license_scan"](spark, SF).collect()
    assert len(out) == len(texts) and any(r.n_base for r in out)
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_scan_cases(spark):
    texts = [None, "", "...", "UNDER the MIT-license under THE mit LICENSE cc by nc cc by nc", "ünder the mit license İ K cc_by[nc]",
             "under the mit licence", "cc by " * 5000 + "nc", "Apache License, Version 2.0 apache license version 20"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, `a.b` string, spans int")
    df = df.unionByName(df)
    out = licenses.summary(licenses.scan(df, ["doc_id", "a.b"]), ["doc_id"]).collect()
    assert len(out) == 2 * len(texts)
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(texts[r.doc_id])
    assert licenses.scan(df.limit(0), ["doc_id"]).collect() == []


def matches_by_hand(parts, words, at):
    """All ends of a template's matches from ``at`` on."""
    if not parts:
        return {at}
    head, rest = parts[0], parts[1:]
    if isinstance(head, bytes):
        return matches_by_hand(rest, words, at + 1) if words[at:at + 1] == [head] else set()
    if head[0] == "optional":
        return matches_by_hand(rest, words, at) | matches_by_hand(list(head[1]) + rest, words, at)
    _, least, most, pattern = head
    ends = set()
    for n in range(most + 1):
        taken = words[at:at + n]
        if len(taken) == n and n >= least and all(pattern is None or pattern.fullmatch(w) for w in taken):
            ends |= matches_by_hand(rest, words, at + n)
    return ends


def test_template_markup_against_backtracking():
    templates = [licenses.Template(str(i), t) for i, t in enumerate((
        "a b", 'a <<var;name="x";words="0-2">> b', "<<beginOptional>>c <<beginOptional>>a<<endOptional>><<endOptional>> b a",
        'b <<var;name="y";words="1-2";match="[0-9]+">> a', 'a <<beginOptional>>b <<var;words="1-3">><<endOptional>> c'))]
    machine = licenses.TokenAutomaton(templates)
    rng = random.Random(5)
    for _ in range(400):
        words = [rng.choice([b"a", b"b", b"c", b"7", b"zz"]) for _ in range(rng.randint(0, 14))]
        want = sorted((i, max(ends), n) for i in range(len(words)) for n, t in enumerate(templates)
                      if (ends := matches_by_hand(licenses.parse(t.text), words, i)))
        assert sorted(machine.matches(words)) == want


@pytest.mark.parametrize("text", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<what>> b", 'a <<var;words="3-1">>',
                                  '<<var;words="0-3">> a', "<<beginOptional>>a<<endOptional>>"])
def test_template_markup_that_makes_no_sense(text):
    with pytest.raises(ValueError):
        licenses.TokenAutomaton([licenses.Template("x", text)])


def test_license_templates_meet_their_own_wording():
    scanner = licenses.Scanner(licenses.BASE, licenses.ADDED)
    for t in licenses.ADDED:
        plain = re.sub(r"<<(begin|end)Optional>>", " ", t.text)
        plain = re.sub(r'<<var;[^>]*match="\[23\]">>', "3", plain)
        plain = re.sub(r'<<var;[^>]*match="\[0-9\]">>', "4 0", plain)
        plain = re.sub(r"<<var;.*?>>", "some", plain)
        assert t.label in {s[0] for s in scanner.scan("zz " + plain + " zz")[1]}, t.label


# ---- tokenizer alignment ----------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)


def align_by_hand(tokenizers, text):
    """(a ids, b ids, groups) by the libraries the contract names, token bytes from the entries."""
    a_tok, b_tok = tokenizers
    letters = alignment.byte_letters()
    if not text:
        return [], [], []
    a = a_tok.encode(" " + text, add_special_tokens=False).ids
    b = b_tok.encode(text)
    a_said = [bytes(letters[c] for c in a_tok.id_to_token(i)) for i in a]
    b_said = [bytes([int(p[3:-1], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()
              for i in b for p in [b_tok.id_to_piece(i)]]
    if b"".join(a_said) != (" " + text).encode() or b"".join(b_said) != (" " + text).encode():
        return [], [], []
    ends = [0, 0]
    groups, i, j, ga, gb = [], 0, 0, [], []
    while i < len(a) or j < len(b):
        if ends[0] <= ends[1]:
            ends[0] += len(a_said[i])
            ga.append(a[i])
            i += 1
        else:
            ends[1] += len(b_said[j])
            gb.append(b[j])
            j += 1
        if ends[0] == ends[1]:
            groups.append((ga, gb))
            ga, gb = [], []
    return a, b, groups


def rows_by_hand(tokenizers, texts):
    aligned = [align_by_hand(tokenizers, t) for t in texts]
    count = Counter((ga[-1], gb[-1]) for *_, groups in aligned for ga, gb in groups)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for a, b, groups in aligned:
        links = [(ga[-1], gb[-1]) for ga, gb in groups]
        said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return out


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_the_table(spark, tokenizers):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    out = queries.QUERIES["op13_tokenizer_alignment"](spark, SF).orderBy("doc_id").collect()
    want = rows_by_hand(tokenizers, [t for _, t in texts])
    assert [(r.doc_id, *[r[f] for f in FIELDS]) for r in out] == [(d, *w) for (d, _), w in zip(texts, want)]


def test_alignment_cases(spark, tokenizers):
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "the", "é", "😀", "\xa0", "\x1c", "'s", "12", ".", "▁", "<s>", "</s>", "<unk>", "<0x41>",
             "<|endoftext|>", "\x00", "word", "　", "ß" * 9]
    texts = [None, "", " ", "\n", "x" * 30_000, " " * 5000, "▁", "<|endoftext|>"] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += texts[:20]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(texts)], "doc_id long, text string, `a.b` int, row string")
    out = alignment.alignment_summary(df, ["doc_id", "a.b", "row"]).orderBy("doc_id").collect()
    assert [tuple(r[f] for f in FIELDS) for r in out] == rows_by_hand(tokenizers, texts)
    assert alignment.alignment_summary(df.limit(0), ["doc_id"]).collect() == []


def test_aligned_groups_spell_the_text(spark):
    df = spark.createDataFrame([(1, "Größe matters, 12 times."), (2, None)], "doc_id long, text string")
    made = {r.row.doc_id: r for r in alignment.align(df, ["doc_id"]).collect()}
    both = alignment.Tokenizers()
    r = made[1]
    assert made[2].a_ids == [] and r.a_cuts[-1] == len(r.a_ids) and r.b_cuts[-1] == len(r.b_ids)
    a0 = b0 = 0
    for a1, b1 in zip(r.a_cuts, r.b_cuts):
        assert b"".join(both.a_bytes[i] for i in r.a_ids[a0:a1]) == b"".join(both.b_bytes[i] for i in r.b_ids[b0:b1])
        a0, b0 = a1, b1
