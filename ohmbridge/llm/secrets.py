"""Secret scans: one automaton of all rules finds where matches start, anchored ones where they end.

The rules themselves are compiled, reversed, into one minimal deterministic
automaton that passes over every byte once, from a text's end to its start, and
tells at each byte which rules have a match that starts there. From the leftmost
start of a rule its own anchored automaton runs forward to the end of the longest
match; the next start counts from there. No other engine takes part. Time is
linear: one pass for all rules, and each match once more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.llm import common, textkernel as tk
from ohmbridge.llm.automaton import Automaton


@dataclass(frozen=True)
class Rule:
    """Leftmost, longest, non-overlapping matches of ``exact``; those with fewer than ``least`` bytes after what ``head`` matches are dropped.

    A dropped match is not looked into again. Findings of all rules are ASCII
    where they are counted, so bytes are characters.
    """

    kind: str
    exact: str
    head: str = ""
    least: int = 0


_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = (
    Rule("assign", _HEAD + "[A-Za-z0-9+/_.=-]+", _HEAD, 6),
    Rule("access", "AKIA[A-Z0-9]+", "", 20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Further formats with fixed beginnings.
MORE = (
    Rule("forge", "gh[opsur]_[A-Za-z0-9]+", "", 40),
    Rule("chat", "xox[abprs]-[0-9A-Za-z-]+", "", 15),
    Rule("maps", "AIza[0-9A-Za-z_-]{35}"),
    Rule("pay", "[sr]k_live_[0-9A-Za-z]+", "", 24),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE + MORE


class Scanner:
    """The automata of some rules: one backward for all starts, an anchored one for each rule's ends and head."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.starts = Automaton([r.exact for r in rules], backward=True)
        self.ends = [Automaton([r.exact], anchored=True) for r in rules]
        self.heads = [Automaton([r.head], anchored=True) if r.head else None for r in rules]

    def _matches(self, text: bytes, rule: int, starts: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of a rule's matches in bytes; ``starts``: wherever one could start, in order."""
        out, at = [], 0
        ends, head, least = self.ends[rule], self.heads[rule], self.rules[rule].least
        classes = text.translate(ends.class_of.tobytes())
        heads = text.translate(head.class_of.tobytes()) if head else b""
        while at < len(starts):
            start = int(starts[at])
            end = ends.longest(classes, start)
            if end - (head.longest(heads, start) if head else start) >= least:
                out.append((start, end))
            at = int(np.searchsorted(starts, end))
        return out

    def spans(self, buf: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """By text (start, rule, stop) of all findings in code points, sorted; texts without any are left out."""
        text, at, bits = self.starts.places(buf, offsets)
        found: dict[int, list[tuple[int, int, int]]] = {}
        cuts = np.flatnonzero(np.diff(text)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
            if a == b:
                continue
            i = int(text[a])
            whole = buf[offsets[i] : offsets[i + 1]]
            raw = whole.tobytes()
            rows = [(s, r, e) for r in range(len(self.rules)) if (here := at[a:b][(bits[a:b] >> r & 1) == 1]).size for s, e in self._matches(raw, r, here)]
            if rows:
                lead = np.concatenate(([0], np.cumsum((whole & 0xC0) != 0x80)))
                found[i] = sorted((int(lead[s]), r, int(lead[e])) for s, r, e in rows)
        return found


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, *keep: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns ``keep`` and ``secrets``: an array of (kind, start, stop), by start, then kind as listed.

    Positions are code points of the whole text, ``stop`` exclusive. A null or
    empty text has an empty array. Each row stands by itself.
    """
    common.tune(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    made = docs.sparkSession.sparkContext.broadcast(compiled(rules))
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        for batch in batches:
            found = made.value.spans(*tk.string_buffer(batch.column(len(keep))))
            rows = [[{"kind": rules[r].kind, "start": a, "stop": b} for a, r, b in found.get(i, ())] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(rows, pa.list_(item))], names=[*keep, "secrets"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "secrets array<struct<kind:string,start:bigint,stop:bigint>>"]))


def _joined(secrets):
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op4_secrets(spark, sf_dir) -> DataFrame:
    rows = find_secrets(common.documents(spark, sf_dir), "doc_id")
    base = F.filter("secrets", lambda s: s["kind"].isin(*(r.kind for r in BASE)))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))
