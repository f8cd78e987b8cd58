"""Secret scans with one combined deterministic automaton.

All rules are compiled together (see ``automaton``); a single pass over the
bytes of a batch of texts tells which rules match in which text.  Only there
are spans located: an automaton of the reversed rule marks where matches can
begin, and the rule's own automaton runs from the leftmost such byte to its
longest end, again and again behind the last end.  Leftmost-longest is what
the rules' regular expressions match here, since no rule has two ways on.

Defined cases: null and empty texts hold no secret; offsets count code points,
ends are exclusive; repeated rows are scanned each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeguard.llm import automaton
from lakeguard.llm.common import map_texts, shared, small_batches


@dataclass(frozen=True)
class SecretRule:
    kind: str
    regex: str
    min_chars: int = 0
    value: str | None = None       # regex whose group 1 holds the value within a match
    min_value: int = 0


# The base rules of the contract, in the order listed there.
# A run of 24 or more hex digits is the same as any such run that is long enough.
BASE_RULES = (
    SecretRule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
               value=r"""[A-Za-z_]+["']?\x20*[:=]\x20*["']?(.+)""", min_value=6),
    SecretRule("access", r"AKIA[A-Z0-9]+", min_chars=20),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", min_chars=40),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", min_chars=15),
    SecretRule("stripe", r"[rs]k_live_[A-Za-z0-9]+", min_chars=20),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", min_chars=40),
)


class Scanner:
    """Automata of a rule list; built once on the driver and sent with the task code."""

    def __init__(self, rules):
        self.rules = rules
        trees = [automaton.Regex(r.regex).tree for r in rules]
        self.all = automaton.compile_rules(trees, anywhere=True)
        self.backward = [automaton.compile_rules([automaton.reverse(t)], anywhere=True) for t in trees]
        self.forward = [automaton.compile_rules([t], anywhere=False) for t in trees]
        self.values = [re.compile(r.value, re.DOTALL) if r.value else None for r in rules]

    def hits(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(text, rule) pairs with a match, by one pass over all bytes."""
        sep = bytes([automaton.RESET])
        data = np.frombuffer(sep.join(texts) + sep, np.uint8)
        states = automaton.run(self.all, data)
        masks = self.all.accepts
        at = np.flatnonzero((masks != 0)[states])
        if not len(at):
            return []
        ends = np.cumsum([len(t) + 1 for t in texts])
        pairs = np.unique(np.column_stack([np.searchsorted(ends, at, side="right"), masks[states[at]]]), axis=0)
        return sorted({(int(i), r) for i, mask in pairs for r in range(len(self.rules)) if int(mask) >> r & 1})

    def spans(self, data: bytes, rule: int) -> list[tuple[int, int]]:
        """Leftmost-longest, non-overlapping matches of a rule, as byte offsets."""
        back = automaton.run(self.backward[rule], np.frombuffer(data[::-1], np.uint8))
        begins = len(data) - 1 - np.flatnonzero(self.backward[rule].accepts[back])[::-1]
        dfa = self.forward[rule]
        classes, k, table, accepts = dfa.classes.tolist(), dfa.n_classes, dfa.next.tolist(), dfa.accepts.tolist()
        dead = [not a and all(table[s * k + c] == s for c in range(k) if c != classes[automaton.RESET])
                for s, a in enumerate(accepts)]
        found, behind = [], 0
        for begin in begins.tolist():
            if begin < behind:
                continue
            state, end = 0, begin
            for i in range(begin, len(data)):
                state = table[state * k + classes[data[i]]]
                if accepts[state]:
                    end = i + 1
                elif dead[state]:
                    break
            found.append((begin, end))
            behind = end
        return found

    def keeps(self, rule: int, match: bytes) -> bool:
        r = self.rules[rule]
        text = match.decode("utf-8")
        value = self.values[rule]
        return len(text) >= r.min_chars and (value is None or len(value.fullmatch(text)[1]) >= r.min_value)

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule, end) in code points, sorted."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for i, rule in self.hits(raw):
            data = raw[i]
            for begin, end in self.spans(data, rule):
                if self.keeps(rule, data[begin:end]):
                    start = len(data[:begin].decode("utf-8", "surrogatepass"))
                    found[i].append((start, rule, start + len(data[begin:end].decode("utf-8"))))
        return [sorted(f) for f in found]


def scan(docs: DataFrame, keep: list[str], base=BASE_RULES, added=ADDED_RULES) -> DataFrame:
    """Columns ``keep`` with a count per base kind, the hash of the base spans and all spans as text."""
    small_batches(docs.sparkSession)
    scanner = shared(docs.sparkSession, Scanner((*base, *added)))
    kinds = [r.kind for r in (*base, *added)]
    n_base = len(base)
    counts = [f"n_{r.kind}" for r in base]

    def fn(texts):
        out = {c: [] for c in (*counts, "base_sha256", "spans")}
        for found in scanner().scan(texts):
            for rule, name in enumerate(counts):
                out[name].append(sum(r == rule for _, r, _ in found))
            said = [(f"{kinds[r]}:{s}:{e}", r < n_base) for s, r, e in found]
            out["base_sha256"].append(hashlib.sha256(",".join(x for x, b in said if b).encode()).hexdigest())
            out["spans"].append(",".join(x for x, _ in said))
        return out

    fields = {c: pa.int64() for c in counts} | {"base_sha256": pa.string(), "spans": pa.string()}
    ddl = ", ".join([f"{c} long" for c in counts] + ["base_sha256 string", "spans string"])
    return map_texts(docs, keep, fn, fields, ddl)
