"""Operators of the training-data package against brute force, and their defined cases."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakeguard.llm import (automaton, decontaminate, jaccard_join, line_runs, mixing, pu_classifier, quality_rules, secrets,
                           token_counts, url_rules, warc)
from lakeguard.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, copies int, __row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with outputs."""
    rows = [(i if ids is None else ids[i], t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, 1, 0.5, 9, "x")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \n\t", "one", "ein zwei", "x" * 50_000, "word " * 3000, "é ü 漢字 😀"]


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    base = [prose(rnd, 120) for _ in range(30)]
    texts = list(base) + ODD + ODD
    for b in base[:12]:
        words = b.split()
        words[rnd.randrange(len(words))] = "changed"
        texts += [b, " ".join(words), " ".join(words[:60])]
    shared = prose(rnd, 55)
    texts += [f"{prose(rnd, 30)}\n{shared}\n{prose(rnd, 40)}" for _ in range(4)]
    return texts


def test_quality_rules(spark, corpus):
    got = {r["doc_id"]: r for r in quality_rules.judge(frame(spark, corpus)).collect()}
    assert len(got) == len(corpus)
    for i, text in enumerate(corpus):
        words = WORD.findall(text or "")
        grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        counts = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if counts[g] > 1 for j in range(3)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    kept = quality_rules.filter_documents(frame(spark, corpus))
    assert kept.columns == frame(spark, corpus).columns
    assert kept.count() == sum(r["kept"] for r in got.values())
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_quality_rules_sketch_and_junk(spark):
    values = [0, 1, 63, 64, 100, 1000, 123456]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b")).collect()
    assert all(r["b"] <= r["v"] and (r["v"] - r["b"]) * 32 <= r["v"] for r in rows)
    rnd = random.Random(1)
    texts = [prose(rnd, 100) for _ in range(150)] + [" ".join(w + "###" for w in prose(rnd, 100).split()) for _ in range(5)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(frame(spark, texts)).collect()}
    assert all(got[i] for i in range(150)) and not any(got[i] for i in range(150, 155))


def test_warc_round_trip(spark):
    same = "<p>" + "漢" * 400 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://a/x\r\nInjected: 1", same), (7, None, same), (3, "http://b", same), (4, "u", None), (5, "u", "small"),
            (6, "u", "small"), (None, "u", "z" * 2000), (9, "u", "y" * 2000), (9, "u", "y" * 2000), (2, "u", "y" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    got = [r.asDict() for r in warc.resolve_revisits(warc.captures_of(pages)).collect()]
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        mine = [g for g in got if g["page_id"] == page_id]
        assert all((g["payload_bytes"], g["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest()) for g in mine)
    kinds = {g["page_id"]: (g["record_type"], g["refers_to"]) for g in got}
    assert kinds[7] == ("response", None) and kinds[1] == ("revisit", 7) and kinds[3] == ("revisit", 7)
    assert kinds[2] == ("revisit", 9) and kinds[9] == ("response", None) and kinds[5] == kinds[6] == ("response", None)
    captures = warc.captures_of(pages).collect()
    assert all(c["n_request"] == c["n_metadata"] == 1 for c in captures)
    assert warc.resolve_revisits(warc.captures_of(pages.limit(0))).count() == 0


def test_warc_records_are_members(spark, tmp_path):
    """Every record can be read from its offset; revisits name the record of their response; long records too."""
    rows = [(1, "http://a/", "y" * 1000), (2, "http://b/", "y" * 1000), (3, None, "z" * (17 << 20)), (None, "u", ""),
            (5, "u", "t" * 1500), (5, "u", "t" * 1500), (4, "u", "t" * 1500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    whole, heads = 0, {}
    for file in (tmp_path / "w").rglob("part-*"):
        data = file.read_bytes()
        whole += len(list(warc.parse(data, False)))
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 1
        while data:
            d = zlib.decompressobj(31)
            record = d.decompress(data)
            assert d.eof
            data = d.unused_data
            if record:                 # else the empty member behind a long record
                (one,) = warc.parse(gzip.compress(record), False)
                heads[one["record_id"]] = one
    assert whole == len(heads) == 3 * len(rows)
    got = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).select("main.*", F.col("metadata.page_id").alias("page_id")).collect()
    by_page = {r["page_id"]: r for r in got}
    assert by_page[1]["record_type"] == "revisit" and by_page[1]["refers_to"] == by_page[2]["record_id"]
    assert by_page[4]["record_type"] == "revisit" and by_page[4]["refers_to"] is None   # two rows are its response
    assert by_page[3]["payload_bytes"] == 17 << 20 and by_page[None]["payload_bytes"] == 0


BASE = [re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
        re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]


def brute_secrets(text):
    found = []
    for rule, regex in enumerate(BASE):
        for m in regex.finditer(text or ""):
            if (len(m[2]) >= 6) if rule == 0 else len(m[0]) >= (20, 24)[rule - 1]:
                found.append((m.start(), rule, m.end()))
    return sorted(found)


def test_secret_spans(spark):
    rnd = random.Random(3)
    bits = ["token", "ToKen", "api_key", "apikey", "passwd", "=", " = ", ":", '"', " ", "abc", "abcdef0123", "AKIA",
            "ABCDEFGHIJKLMNOPQR", "0123456789abcdef", "f" * 9, "é", "漢", "\n", "==", "-", "ſecret", "secret"]
    texts = ODD + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(800)]
    got = {r["doc_id"]: r for r in secrets.scan(frame(spark, texts), ["doc_id"]).collect()}
    kinds = [r.kind for r in secrets.BASE_RULES]
    for i, text in enumerate(texts):
        want = brute_secrets(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{kinds[r]}:{s}:{e}" for s, r, e in want).encode()).hexdigest()
        assert got[i]["n_hex"] == sum(r == 2 for _, r, _ in want)
        assert set(got[i]["spans"].split(",")) >= {f"{kinds[r]}:{s}:{e}" for s, r, e in want}
    assert secrets.scan(frame(spark, []), ["doc_id"]).count() == 0


def test_automaton_is_minimal():
    dfa = automaton.compile_rules([automaton.Regex("a(b|c)d|abd|acd").tree], anywhere=False)
    assert len(dfa.accepts) == 5  # four states of the word and the dead one


def test_token_counts(spark):
    pieces = {"▁a": -1.0, "▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "abc": -9.0, "bc": -4.5, "c": -5.0, "▁ab": -4.9}

    def brute(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] + n * (min(pieces.values()) - 10), -best[end - 1][1] - n)]
            options += [(best[b][0] + pieces[word[b:end]], -best[b][1] - 1) for b in range(end) if word[b:end] in pieces]
            score, tokens = max(options)
            best.append((score, -tokens))
        return best[-1][1]

    rnd = random.Random(2)
    texts = ODD[:5] + [" ".join("".join(rnd.choice("abc漢") for _ in range(rnd.randint(1, 9))) for _ in range(40)) for _ in range(20)]
    got = {r["doc_id"]: r for r in token_counts.count_tokens(frame(spark, texts), ["doc_id"], pieces=pieces).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        assert got[i]["n_pretokens"] == len(words)
        assert got[i]["n_tokens"] == sum(brute("▁" + w) for w in words)
    assert token_counts.count_tokens(frame(spark, []), ["doc_id"], pieces=pieces).count() == 0

    trie = token_counts.ForwardTrie(pieces)
    for length in (62, 63, 64, 65, 70, 200):
        word = "▁" + "".join(rnd.choice("abc漢") for _ in range(length))
        assert trie.tokens(word) == trie.tokens(word) == brute(word)
        assert trie.tokens(word[:-1] + "c") == brute(word[:-1] + "c")
    assert max(map(len, trie.nodes)) == token_counts.FILED_CHARS
    long_texts = ODD + ["abc" * 300_000]
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(frame(spark, long_texts), ["doc_id"], pieces={"a": -1.0, "bca": -1.0}).collect()}
    # The mark is three unknown bytes; behind the first "a" comes "bca" again and again, and at last "bc".
    assert rows[len(ODD)]["n_tokens"] == 3 + 1 + 299_999 + 2
    assert rows[5]["n_tokens"] == 3 + 50_000


def brute_join(texts):
    sets = []
    for t in texts:
        w = WORD.findall(t or "")
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent, links = list(range(len(texts))), Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [(root(i), links[i]) for i in range(len(texts))]


def test_jaccard_join(spark, corpus):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.join(frame(spark, corpus)).collect()}
    assert [got[i] for i in range(len(corpus))] == brute_join(corpus)
    kept = jaccard_join.one_per_class(frame(spark, corpus))
    assert kept.columns == frame(spark, corpus).columns
    empty = {i for i, t in enumerate(corpus) if not WORD.findall(t or "")}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for i, (c, _) in enumerate(brute_join(corpus)) if i not in empty} | empty)
    assert jaccard_join.join(frame(spark, [])).count() == 0


def test_jaccard_join_large_bucket(spark, monkeypatch):
    """A dense group and a passage shared by all go through pivots, splits and blocks."""
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(jaccard_join, "SKETCH_BLOCK", 8)
    rnd = random.Random(9)
    core, line = prose(rnd, 150).split(), prose(rnd, 12)
    texts = []
    for _ in range(30):
        words = list(core)
        words[rnd.randrange(150)] = prose(rnd, 1)
        texts.append(" ".join(words) + " " + line)
    texts += [prose(rnd, rnd.choice([3, 20, 60])) + " " + line for _ in range(40)] + texts[:5]
    rows = jaccard_join.join(frame(spark, texts)).collect()
    assert [(r["class_id"], r["n_links"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == brute_join(texts)


def test_jaccard_join_blocks_of_tokens(spark, monkeypatch):
    """Sets are hashed in blocks of shingles: paths and sketches do not depend on the block."""
    tokens = jaccard_join.shingle_set(prose(random.Random(3), 500), jaccard_join.WordHashes())
    nodes = jaccard_join.mix(jaccard_join.np.arange(1, 9, dtype="uint64"))
    children, parents = jaccard_join.choose(tokens, nodes, 0.8)
    whole = sorted(zip(children.tolist(), parents.tolist()))
    sketch = jaccard_join.sketch(tokens)
    monkeypatch.setattr(jaccard_join, "TOKEN_BLOCK", 7)
    children, parents = jaccard_join.choose(tokens, nodes, 0.8)
    assert sorted(zip(children.tolist(), parents.tolist())) == whole and whole
    assert jaccard_join.sketch(tokens) == sketch and len(sketch) == jaccard_join.SKETCH


def test_jaccard_join_null_and_repeated_ids(spark):
    text = prose(random.Random(4), 30)
    docs = frame(spark, [text, text, text, "", ""], ids=[None, 5, 5, None, None])
    rows = jaccard_join.join(docs).collect()
    assert sorted((r["doc_id"] or -1, r["class_id"] or -1, r["n_links"]) for r in rows) == [
        (-1, -1, 0), (-1, -1, 0), (-1, 5, 2), (5, 5, 2), (5, 5, 2)]
    assert sorted(r["text"] for r in jaccard_join.one_per_class(docs).collect()) == ["", "", text]


def test_jaccard_join_recall_on_the_table(spark):
    """Links of every document, against all rows by brute force."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    cache = jaccard_join.WordHashes()
    sets = {r["doc_id"]: frozenset(jaccard_join.shingle_set(r["text"], cache).tolist()) for r in rows}
    got = {r["doc_id"]: r for r in jaccard_join.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    true = found = 0
    for i, mine in sets.items():
        if mine:
            near = [j for j, other in sets.items() if j != i and other and 5 * len(mine & other) >= 4 * len(mine | other)]
            assert got[i]["n_links"] <= len(near)
            true, found = true + len(near), found + got[i]["n_links"]
            assert all(got[j]["class_id"] == got[i]["class_id"] for j in near) or got[i]["n_links"] < len(near)
    assert true > 100 and found >= 0.99 * true


def test_sketches_lose_no_more_than_stated():
    import numpy as np
    rng = np.random.default_rng(3)
    for similarity in (0.5, 0.8, 0.9):
        least = jaccard_join.sketch_least(similarity)
        agree = rng.binomial(jaccard_join.SKETCH, similarity + (1 - similarity) / 256, 200_000)
        assert (agree < least).mean() <= 5 * jaccard_join.SKETCH_LOSS and (agree < least + 8).mean() > jaccard_join.SKETCH_LOSS
    assert jaccard_join.sketch_least(0.8) == 36


def test_components(spark):
    rnd = random.Random(6)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def brute_runs(docs, least):
    first, gone = {}, defaultdict(set)
    for d, text in docs:
        lines = [(i, x.strip(" \t\n\v\f\r"), len(WORD.findall(x))) for i, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(x[2] for x in lines[a:b + 1]) >= least:
                    key = tuple(x[1] for x in lines[a:b + 1])
                    if key in first:
                        gone[d].update(x[0] for x in lines[a:b + 1])
                    else:
                        first[key] = (d, a)
    return gone


def test_line_runs(spark):
    rnd = random.Random(8)
    pool = [prose(rnd, rnd.randint(1, 6)) for _ in range(6)]
    texts = ODD[:6] + ["\n".join(rnd.choice(pool + ["", " "]) for _ in range(rnd.randint(0, 14))) for _ in range(60)]
    got = {r["doc_id"]: r for r in line_runs.removals(frame(spark, texts), 8).collect()}
    want = brute_runs(list(enumerate(texts)), 8)
    assert {d: r["removed"] for d, r in got.items()} == {d: sorted(want[d]) for d in range(len(texts))}
    out = line_runs.deduplicate(frame(spark, texts), 8)
    assert out.columns == frame(spark, texts).columns
    for r in out.collect():
        lines = (texts[r["doc_id"]] or "").split("\n")
        assert (r["text"] or "") == "\n".join(x for i, x in enumerate(lines) if i not in want[r["doc_id"]])
    assert line_runs.removals(frame(spark, [])).count() == 0


def test_suffix_array(spark):
    """Places in the sorted array, also where equal suffixes fill several partitions."""
    rnd = random.Random(9)
    docs = [[rnd.choice([0, 0, 0, 1, 2]) for _ in range(rnd.randint(1, 12))] for _ in range(60)] + [[0] * 70] * 3
    line, at, key = {}, 0, {}
    for d in docs:
        for i, x in enumerate(d):
            line[at + i] = x
            key[at + i] = (*d[i:i + 8], -1 - at - i) if len(d) - i < 8 else tuple(d[i:i + 8])
        at += len(d) + 1
    ids = spark.createDataFrame([(p, x) for p, x in line.items()], "p long, rank long")
    got = {r["p"]: r for r in line_runs.suffix_array(ids, 5).collect()}
    places = sorted(key.values())
    groups = Counter(places)
    assert set(got) == set(line)
    for p, r in got.items():
        assert r["rank"] == places.index(key[p]) and r["alone"] == (groups[key[p]] == 1)
    # with ten lines the next step sorts by sixteen
    assert line_runs.suffix_array(ids.limit(0), 10).count() == 0


def test_line_runs_across_partitions(spark):
    """One run that most documents hold, one-word lines, and a copy within one document."""
    rnd = random.Random(10)
    words = [prose(rnd, 1) for _ in range(12)]
    hot = "\n".join(words[:9])
    texts = [f"{hot}\n{prose(rnd, rnd.randint(1, 4))}" if rnd.random() < 0.7 else "\n".join(rnd.choices(words, k=12))
             for _ in range(150)] + [f"{hot}\n{hot}\nend", "\n".join(["w"] * 40), "\n".join(["w"] * 23)]
    got = {r["doc_id"]: r["removed"] for r in line_runs.removals(frame(spark, texts), 8).collect()}
    want = brute_runs(list(enumerate(texts)), 8)
    assert got == {d: sorted(want[d]) for d in range(len(texts))}


def test_line_runs_repeated_rows(spark):
    text = prose(random.Random(3), 60)
    rows = line_runs.removals(frame(spark, [text, text, text, text], ids=[2, 2, None, 1])).collect()
    assert sorted((r["doc_id"] or 99, len(r["removed"])) for r in rows) == [(1, 0), (2, 1), (2, 1), (99, 1)]


def test_pu_classifier(spark):
    rnd = random.Random(12)
    good = [prose(rnd, 80) for _ in range(400)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rnd, 20).split() * 4) for _ in range(100)]
    texts = good + bad + ODD
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i in range(500)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in pu_classifier.classify(docs, labels).collect()}
    held = [i for i in range(500) if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == int(i < 400) for i in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(texts)
    kept = pu_classifier.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got.values())
    assert pu_classifier.classify(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in pu_classifier.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_pu_trains_on_every_document(spark, monkeypatch):
    """One row for each id however often it occurs, held-out ids aside; edges and steps see all of them, in several shards."""
    rnd = random.Random(31)
    texts = [prose(rnd, 30) for _ in range(300)] + [prose(rnd, 30) for _ in range(200)]
    docs = frame(spark, texts, ids=[*range(300), *[7] * 200])
    rows = pu_classifier.training_rows(pu_classifier.featured(docs, ["doc_id"]))
    ids = [r["doc_id"] for r in rows.collect()]
    wanted = [r["id"] for r in spark.range(300).where(pu_classifier.fold("id") != 0).collect()]
    assert sorted(ids) == wanted
    monkeypatch.setattr(pu_classifier, "SHARD_DOCS", 40)
    # A kind of junk that one document in a hundred is made of.
    texts = [prose(rnd, 60) for _ in range(900)] + ["$$ ## " * 30 for _ in range(9)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 900, 3)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in pu_classifier.classify(docs, labels).collect()}
    assert max(got[i] for i in range(900, 909)) < min(got[i] for i in range(900))
    assert got == {r["doc_id"]: r["score"] for r in pu_classifier.classify(docs.repartition(9), labels).collect()}


CLASHES = "doc_id long, text string, lang string, source string, `a.b` int, __text string, __pu_score double, score int, row string, copies int, x string"


def test_stages_keep_columns_of_any_name(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 60), "en", f"s{i % 2}", 1, "t", 0.5, 3, "r", 9, "x") for i in range(60)] + [
        (None, None, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, CLASHES)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "no such item anywhere in these texts")], "item_id long, text string")
    for made in (pu_classifier.accepted(docs, labels), line_runs.deduplicate(docs), jaccard_join.one_per_class(docs),
                 decontaminate.decontaminate(docs, benchmark)):
        assert made.columns == docs.columns
        got = {r["doc_id"]: r for r in made.collect()}
        assert all(got[i]["a.b"] == 1 and got[i]["__text"] == "t" and got[i]["copies"] == 9 for i in got if i is not None)
        assert len(got) >= 50
    mixed = mixing.mixed_documents(docs)     # its own ``copies`` takes the place of the column
    assert set(mixed.columns) == set(docs.columns) and {r["copies"] for r in mixed.collect()} <= {1, 2}


@pytest.mark.parametrize("pattern", [r"\bkey", "^key", "key$", "a+?", "a*+", "(?=a)", "(?<n>a)", r"(a)\1", "a{,2}", "a{3,1}", "(a", "[a", "*a", r"\D", "a**"])
def test_automaton_refuses_what_it_cannot_read(pattern):
    with pytest.raises(ValueError):
        automaton.Regex(pattern)


@pytest.mark.parametrize("pattern", [r"\d+", r"[\d.]+x", r"\w{2,3}", r"a\sb", r"\x41[^\w]", r"\$\^\(", "[a-]+", r"(?i:key)\f?"])
def test_automaton_reads_named_classes(pattern):
    dfa = automaton.compile_rules([automaton.Regex(pattern).tree], anywhere=True)
    rnd = random.Random(4)
    for _ in range(300):
        text = "".join(rnd.choice("ab01.x AK-$^(\t_Key\f") for _ in range(rnd.randint(0, 12))).encode()
        states = automaton.run(dfa, __import__("numpy").frombuffer(text, "uint8")) if text else []
        ends = {i + 1 for i, s in enumerate(states) if dfa.accepts[s]}
        want = {i for i in range(1, len(text) + 1) if any(re.fullmatch(pattern.encode(), text[j:i], re.ASCII) for j in range(i))}
        assert ends == want, (pattern, text)


def test_quality_fences_follow_the_group(spark):
    """Equal languages, two sources of different habits: what is usual in one is too much in the other."""
    rnd = random.Random(6)

    def text(marks, n=80):
        words = prose(rnd, n).split()
        for _ in range(marks):
            words[rnd.randrange(n)] = "#$"
        return " ".join(words)

    rows = [(i, text(i % 10 == 0), "en", "plain") for i in range(300)] + [
        (1000 + i, text(rnd.randint(5, 20)), "en", "code") for i in range(300)] + [
        (2000 + i, text(60), "en", source) for i, source in enumerate(("plain", "code", "tiny"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert not kept[2000] and kept[2001]
    assert sum(kept[i] for i in range(300)) >= 290 and sum(kept[1000 + i] for i in range(300)) >= 290
    counts = quality_rules.rates(quality_rules.measure(docs, ["doc_id", "lang", "source"]))
    limits = {r["source"]: r["symbol_rate_max"] for r in quality_rules.fences(quality_rules.sketches(counts, ["lang", "source"])).collect()}
    assert limits["plain"] < limits["code"] and limits["plain"] < limits["tiny"]     # a thin group borrows from its language
    same = spark.createDataFrame([(i, prose(random.Random(1), 60), "en", "s") for i in range(120)], docs.schema)
    assert all(r["kept"] for r in quality_rules.judge(same).collect())              # no spread anywhere


def fair_by_hand(supply, demand, copies):
    """Max-min fair lowering of demands by trying all sets of sources (small cases)."""
    from fractions import Fraction
    from itertools import combinations
    capacity = {p: w * copies for p, w in supply.items()}
    met, open_ = {}, {s for s, t in demand.items() if t > 0}
    while open_:
        best = (Fraction(1), frozenset())
        for n in range(1, len(demand) + 1):
            for group in combinations(sorted(demand), n):
                want = sum(demand[s] for s in group if s in open_)
                if want:
                    held = sum(w for p, w in capacity.items() if set(group) & set(p)) - sum(met.get(s, 0) for s in group)
                    best = min(best, (Fraction(held, want), frozenset(group) & frozenset(open_)), key=lambda x: x[0])
        factor, tight = best
        if factor >= 1:
            return met | {s: demand[s] for s in open_}
        for s in tight:
            met[s] = demand[s] * factor
        open_ -= tight
    return met


def test_shared_words_are_dealt_fairly_and_cheaply():
    rnd = random.Random(9)
    for _ in range(120):
        names = "abcd"[:rnd.randint(2, 4)]
        patterns = {tuple(sorted(rnd.sample(names, rnd.randint(1, len(names))))) for _ in range(rnd.randint(1, 5))}
        supply = {p: rnd.randint(1, 30) * 12 for p in patterns}
        demand = {s: rnd.choice([0, rnd.randint(1, 40) * 12]) for s in names}
        copies = rnd.randint(1, 3)
        flow, met = mixing.route(supply, demand, copies)
        held = {s for p in patterns for s in p}
        want = fair_by_hand(supply, {s: t for s, t in demand.items() if s in held}, copies)
        for s in held:
            assert abs(met.get(s, 0) - want.get(s, 0)) <= len(names), (supply, demand, copies)
            assert sum(f for (p, to), f in flow.items() if to == s) == met.get(s, 0)
        for p, words in supply.items():
            assert sum(f for (q, _), f in flow.items() if q == p) <= words * copies


def cheapest_by_hand(supply, demand, copies):
    """Least repetition cost by trying how the demands are split over the patterns (tiny cases)."""
    from functools import lru_cache
    from itertools import product
    patterns, sources = list(supply), list(demand)

    def cost(p, used):
        return sum(max(0, min(used - supply[p] * c, supply[p])) * c for c in range(copies))

    @lru_cache(None)
    def best(i, left):
        if i == len(patterns):
            return 0 if not any(left) else float("inf")
        p, out = patterns[i], float("inf")
        for take in product(*[range(n + 1) if s in p else (0,) for s, n in zip(sources, left)]):
            if sum(take) <= supply[p] * copies:
                out = min(out, cost(p, sum(take)) + best(i + 1, tuple(a - b for a, b in zip(left, take))))
        return out

    return best(0, tuple(demand.values()))


def test_flow_costs_as_little_as_possible():
    rnd = random.Random(10)
    for _ in range(40):
        patterns = {tuple(sorted(rnd.sample("ab", rnd.randint(1, 2)))) for _ in range(3)}
        supply, copies = {p: rnd.randint(1, 4) for p in patterns}, 3
        _, met = mixing.route(supply, {s: rnd.randint(0, 9) for s in {x for p in patterns for x in p}}, copies)
        flow = mixing.min_cost_flow(supply, met, copies)
        cost = 0
        for p, w in supply.items():
            used = sum(f for (q, _), f in flow.items() if q == p)
            cost += sum(max(0, min(used - w * c, w)) * c for c in range(copies))
        assert cost == cheapest_by_hand(supply, met, copies)


def test_mix_of_overlapping_sources(spark):
    """Documents claimed by several sources; what cannot be reached lowers the targets alike, and each is then met."""
    rnd = random.Random(13)
    rows = [(i, prose(rnd, rnd.randint(20, 60)), rnd.choice([["a"], ["a", "b"], ["b", "c"], ["c"], [], ["a", "b", "c"]])) for i in range(600)]
    rows += [(9999, rows[0][1], ["a", "b"])] * 200            # a third of all rows are alike
    docs = spark.createDataFrame(rows, "doc_id long, text string, claims array<string>")
    got = mixing.mix(docs, targets_of=lambda sizes: {"a": 40_000, "b": 9_000, "c": 500}, members=F.col("claims")).collect()
    assert len(got) == len(rows)
    taken, targets = Counter(), {}
    for r in got:
        assert r["taken"] <= 2 * r["size"] and len(r["routes"]) * r["size"] == r["taken"]
        for s in r["routes"]:
            taken[s] += r["size"]
    supply = Counter()
    for _, text, claims in rows:
        supply[tuple(claims)] += len(text.split())
    _, met = mixing.route({p: w for p, w in supply.items() if p}, {"a": 40_000, "b": 9_000, "c": 500}, 2)
    largest = max(r["size"] for r in got)
    for s in "abc":
        assert abs(taken[s] - met[s]) <= 4 * largest, (s, taken[s], met[s])
    assert met["a"] < 40_000 and met["b"] < 9_000 and met["c"] == 500
    assert targets == {}


def test_flow_of_ten_thousand_sources_takes_seconds():
    import time
    supply = {(f"s{i}",): 100 + i for i in range(10_000)}
    began = time.time()
    flow, met = mixing.route(supply, {f"s{i}": 150 for i in range(10_000)}, 2)
    assert time.time() - began < 5 and met["s0"] == 150 and flow[(("s9",), "s9")] == 150


ALONE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
from lakeguard.llm import licenses, pu_classifier, secrets
docs = spark.createDataFrame([(i, f"password: hunter{{i}} under the mit license " + "word " * i, "en", "s") for i in range(30)],
                             "doc_id long, text string, lang string, source string")
labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")


def seen(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("lakeguard") is not None] * b.num_rows}})


print("worker has the package:", docs.mapInArrow(seen, "found boolean").distinct().collect()[0][0])
print("rows:", secrets.scan(docs, ["doc_id"]).where("n_assign = 1").count(), licenses.scan(docs, ["doc_id"]).count(),
      pu_classifier.classify(docs, labels).count(), pu_classifier.accepted(docs, labels).count() > 0)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The driver finds the package by its own path; workers start elsewhere and do not."""
    import os
    import subprocess
    import sys
    from pathlib import Path
    root = str(Path(__file__).resolve().parents[2])
    script = tmp_path / "alone.py"
    script.write_text(ALONE.format(root=root, scratch=str(tmp_path / "scratch")))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "worker has the package: False" in done.stdout and "rows: 30 30 30 True" in done.stdout, done.stdout


def test_weighted_targets_and_flow():
    sizes = {"b": 100, "a": 1000, None: 10}
    target = mixing.weighted_targets(sizes)
    assert sum(target.values()) == pytest.approx(1.5 * 1110)
    assert all(target[k] <= 2 * sizes[k] + 1e-9 for k in sizes)
    # Two sources share a pattern: the overlap serves the source that needs it, and no word repeats without need.
    supply = {("x",): 10, ("x", "y"): 10, ("y",): 0}
    flow = mixing.min_cost_flow(supply, {"x": 10, "y": 10}, 2)
    assert flow[(("x",), "x")] == 10 and flow[(("x", "y"), "y")] == 10 and flow[(("x", "y"), "x")] == 0


def test_mix(spark, corpus):
    docs = frame(spark, corpus * 3)
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(corpus) * 3
    by_target, largest = defaultdict(int), max(r["size"] for r in rows)
    for r in rows:
        by_target[r["source_size"], r["target"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(t - target) <= largest + 1 for (_, target), t in by_target.items())
    mixed = mixing.mixed_documents(docs)
    assert set(mixed.columns) == set(docs.columns) and mixed.count() == sum(r["taken"] > 0 for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_decontamination(spark):
    rnd = random.Random(21)
    items = [prose(rnd, n) for n in (5, 6, 9, 13, 26, 30, 49, 60, 80)] + [None, "", "too short"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts, want = list(ODD) + [prose(rnd, 200) for _ in range(20)], set()
    for i, item in enumerate(items[:9]):
        for lead in (0, 1, 7, 12, 33):
            want.add((len(texts), i))
            texts.append(f"{prose(rnd, lead)}, {item.upper()}! {prose(rnd, 25)}".strip(", "))
    words = items[7].split()
    words[30] = "edited"       # one word of sixty: 51 of 61 shingles are shared
    want.add((len(texts), 7))
    texts.append(f"{prose(rnd, 10)} {' '.join(words)} {prose(rnd, 9)}")
    texts.append(" ".join(items[7].split()[:30]))      # half an item is not the item
    docs = frame(spark, texts)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, benchmark).collect()}
    assert got == want
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.find(docs, benchmark.limit(0)).count() == 0 and decontaminate.find(docs.limit(0), benchmark).count() == 0


def best_window(text, item):
    """Similarity and start of the best item-sized window, by brute force (None if the text holds none)."""
    words, goal = (re.findall(r"[^\W_]+", (x or "").lower()) for x in (text, item))
    wanted, best = Counter(tuple(goal[k:k + 5]) for k in range(len(goal) - 4)), None
    for start in range(len(words) - 4):
        part = words[start:start + len(goal)]
        held = Counter(tuple(part[k:k + 5]) for k in range(len(part) - 4))
        shared = sum((held & wanted).values())
        found = shared / (held.total() + wanted.total() - shared)
        if best is None or found > best[0]:
            best = found, start
    return best


def test_decontamination_moved_blocks(spark):
    """Windows whose blocks stand in another order than the item's, against brute force at every start."""
    rnd = random.Random(22)
    x = prose(rnd, 4)
    items = [prose(rnd, n) for n in (59, 59, 59, 44, 95, 140)]
    items += [" ".join(f"{x} {prose(rnd, 1)}" for _ in range(9)) + f" {x}",       # every order of its parts has the same shingles
              " ".join(prose(rnd, 9) + " of the" for _ in range(5)), prose(rnd, 3) + " same" * 30]
    texts = []
    for item in items:
        words = item.split()
        for cut in (10, 20, 30, 40):
            for lead in (0, 3, 17, 90):
                texts.append(f"{prose(rnd, lead)} {' '.join(words[cut:] + words[:cut])} {prose(rnd, 30)}".strip())
        texts.append(f"{prose(rnd, 11)} {' '.join(words[40:] + words[20:40] + words[:20])} {prose(rnd, 5)}")
    parts = [items[6].split()[5 * k:5 * k + 5] for k in range(9)]
    for _ in range(4):
        rnd.shuffle(parts)
        texts.append(f"{prose(rnd, 13)} {' '.join(w for p in parts for w in p)} {x} {prose(rnd, 20)}")
    texts.append(" ".join(prose(rnd, 50) for _ in range(4)))
    docs, benchmark = frame(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i): best for d, text in enumerate(texts) for i, item in enumerate(items)
            if (best := best_window(text, item)) and best[0] >= 0.8}
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.find(docs, benchmark).collect()}
    assert len(want) > 40 and got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k][0]), want[k][1]) for k in want)


def test_url_rules(spark):
    urls = {"http://WWW.Example.com/en/1": ("www.example.com/en/", "allow"), "https://example.com/en/x?ref=1": ("example.com/en/", "block"),
            "http://a.net/es/": ("net/es/", "block"), "http://net/fr/1": ("net/fr/", "block"), "http://xnet/fr/1": (None, "allow"),
            "http://a.com": (None, "allow"), "http://a.com/EN/": ("com/", "allow"), "http://a.org/b?ref=2": (None, "block"),
            "x": (None, "allow"), None: (None, "allow"), "": (None, "allow"), "http://a.net/?u=http://b.net/es/": (None, "allow"),
            "http://a.org/p?utm_source=feed#x": (None, "block")}
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, ["page_id"]).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == list(urls.values())
    assert (got[0]["host"], got[0]["path"]) == ("www.example.com", "/en/1") and (got[8]["host"], got[8]["path"]) == ("", "")
    assert url_rules.judge(pages.limit(0), ["page_id"]).count() == 0


def test_url_index_uses_the_rarest_token():
    index = url_rules.build_index(url_rules.HOST_RULES, {"com": 90, "example": 50, "en": 7, "www": 3, "net": 20, "es": 5, "fr": 4})
    assert [r.name for r in index["www"]] == ["www.example.com/en/"] and [r.name for r in index["en"]] == ["example.com/en/"]


def test_url_rules_are_all_filed(spark):
    """Every rule has a token, so a URL without any of them runs no expression."""
    assert "" not in url_rules.build_index(url_rules.HOST_RULES + url_rules.PATTERN_RULES, {})
    urls = {"http://a.org/adult/x": "adult-path", "http://a.org/b/xxx/": "adult-path", "http://a.org/ad/": "advert", "http://a.org/?u=/ads/": "advert",
            "http://a.org/adult/ads/": "advert", "http://a.org/ADS/": None, "http://a.org/adults/": None, "http://a.org/ads": None}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_rules.judge(pages, ["page_id"]).collect()}
    assert [got[i]["pattern"] for i in range(len(urls))] == list(urls.values())
    assert got[6]["n_rules_run"] == 0


def test_pipeline_small(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert out.columns == [*docs.columns, "copies"] and len(ids) == len(set(ids)) and 0 < len(ids) <= docs.count()
