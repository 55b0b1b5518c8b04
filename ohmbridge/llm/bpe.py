"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

The last token of the encoding of a word's prefix depends on that prefix alone.
So the distinct words go into a trie, and one depth-first walk keeps the last
token of each node on the path: of the tokens that end at a node (an automaton
of all tokens lists them), the one holds
whose start is the root, or follows the last token of the node it starts at
without a merge across the boundary that byte-pair encoding would have made
earlier. Each prefix that several words share is computed once. A word's ids are
then read by stepping from its node to where each last token starts.

Texts are cut at the added tokens, then into pieces at single spaces. The
pre-tokenisation pattern looks across a space only where whitespace or the end
follows one that stands behind whitespace; texts with such a space are split by
the pattern itself. A piece's ids are kept in a bounded cache of the worker, which
changes no result.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ohmbridge.llm import common

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of each of a worker's caches. When a half is full, it becomes the old half: what is met again moves to the new one, the rest goes.
CACHE = 500_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + n)] = b
    return out


class TrieBpe:
    """Encoder and decoder of one byte-level BPE vocabulary file (tokenizers' JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()
        raw = lambda s: bytes(chars[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for b, i in self.ids.items():
            self.bytes_of[i] = b
        for s, i in self.added.items():
            self.bytes_of[i] = s.encode()
        # age: the order in which merges make tokens; single bytes are oldest
        self.age = {i: -1 for b, i in self.ids.items() if len(b) == 1}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.ids[raw(left)], self.ids[raw(right)]
            made = self.ids[raw(left) + raw(right)]
            self.merged[a, b] = rank
            if made not in self.halves:
                self.halves[made], self.age[made] = (a, b), rank
        self._suffix_automaton()
        self.joins: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.old_known: dict[str, bytes] = {}
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.blanks = regex.compile(r"\s \s|\s $")

    def stands(self, a: int, b: int) -> bool:
        """Whether byte-pair encoding leaves the boundary between tokens a and b.

        Undo merges on both sides, youngest first: the boundary falls if the two
        tokens that once touched it merge at a rank below that of the merge that
        took one of them away from it (of equal ranks the left one went first).
        """
        found = self.joins.get((a, b))
        if found is not None:
            return found
        key, age, halves = (a, b), self.age, self.halves
        # until: (rank, 1 if the token right of the boundary was used up) of the undone merge
        until = (1 << 60, 0)
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and (rank, 0) < until:
                ok = False
                break
            ra, rb = age[a], age[b]
            if ra < 0 and rb < 0:
                ok = True
                break
            if ra > rb:
                until, a = (ra, 0), halves[a][1]
            else:
                until, b = (rb, 1), halves[b][0]
        if len(self.joins) >= CACHE:
            self.joins.clear()
        self.joins[key] = ok
        return ok

    def _suffix_automaton(self) -> None:
        """States are prefixes of tokens; ``tails[state]``: (token, length) of each token that ends there."""
        goto, fail, tails = {}, [0], [()]
        depth_first = []
        for word, token in self.ids.items():
            if not self.whole(token):
                continue
            state = 0
            for byte in word:
                key = state << 8 | byte
                nxt = goto.get(key)
                if nxt is None:
                    nxt = goto[key] = len(fail)
                    fail.append(0)
                    tails.append(())
                    depth_first.append((len(fail) - 1, state, byte))
                state = nxt
            tails[state] = ((token, len(word)),)
        depth = [0] * len(fail)
        for state, parent, _ in depth_first:
            depth[state] = depth[parent] + 1
        for state, parent, byte in sorted(depth_first, key=lambda x: depth[x[0]]):
            if parent:
                at = fail[parent]
                while at and (at << 8 | byte) not in goto:
                    at = fail[at]
                fail[state] = goto.get(at << 8 | byte, 0)
            tails[state] += tails[fail[state]]
        self.goto, self.fail, self.tails, self.steps = goto, fail, tails, dict(goto)

    def _step(self, state: int, byte: int) -> int:
        """The next state, by failure links; kept for a while, so that most are followed once."""
        at = state
        while at and (at << 8 | byte) not in self.goto:
            at = self.fail[at]
        out = self.goto.get(at << 8 | byte, 0)
        if len(self.steps) > len(self.goto) + CACHE:
            self.steps.clear()
            self.steps.update(self.goto)
        self.steps[state << 8 | byte] = out
        return out

    def encode_words(self, found: list[bytes]) -> list[list[int]]:
        """The ids of each of the distinct words, over one trie of all of them.

        Inserted in sorted order, words are a depth-first walk of their trie: what
        a word shares with the one before is the path that stays, and the rest are
        new nodes. ``last`` and ``states`` hold the path's last tokens and states
        of the automaton that knows the tokens ending at a node.
        """
        out: list[list[int]] = [[] for _ in found]
        last, states = [-1], [0]
        steps, tails, joins, bytes_of = self.steps, self.tails, self.joins, self.bytes_of
        before = b""
        for n in sorted(range(len(found)), key=found.__getitem__):
            word = found[n]
            depth = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                depth += 1
            del last[depth + 1 :]
            del states[depth + 1 :]
            state = states[depth]
            for byte in word[depth:]:
                depth += 1
                nxt = steps.get(state << 8 | byte)
                state = self._step(state, byte) if nxt is None else nxt
                for token, size in tails[state]:
                    if size == depth:
                        break
                    pair = (last[depth - size], token)
                    ok = joins.get(pair)
                    if self.stands(*pair) if ok is None else ok:
                        break
                else:
                    raise ValueError("no token ends here; the vocabulary lacks a byte")
                last.append(token)
                states.append(state)
            before = word
            got, at = [], depth
            while at:
                token = last[at]
                got.append(token)
                at -= len(bytes_of[token])
            got.reverse()
            out[n] = got
        return out

    @lru_cache(maxsize=None)
    def whole(self, token: int) -> bool:
        """Whether the encoding of a token's own bytes is that token."""
        if self.age[token] < 0:
            return True
        a, b = self.halves[token]
        if not (self.whole(a) and self.whole(b)):
            return False
        rank, age, halves = self.age[token], self.age, self.halves
        until = (rank, 0)
        while True:
            made = self.merged.get((a, b))
            if made is not None and made != rank and (made, 0) < until:
                return False
            ra, rb = age[a], age[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                until, a = min(until, (ra, 0)), halves[a][1]
            else:
                until, b = min(until, (rb, 1)), halves[b][0]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces that the cache lacks into it."""
        old = self.old_pieces
        self.pieces.update({p: old[p] for p in pieces if p in old})
        new = {p: self.split.findall(p) for p in pieces if p not in self.pieces}
        words = {w for found in new.values() for w in found}
        if len(self.known) + len(words) > CACHE // 2:
            self.old_known, self.known = self.known, {}
        old = self.old_known
        self.known.update({w: old[w] for w in words if w in old})
        todo = list(words - self.known.keys())
        for w, got in zip(todo, self.encode_words([w.encode("utf-8", "surrogatepass") for w in todo]), strict=True):
            self.known[w] = np.array(got, "<u4").tobytes()
        known = self.known
        for p, found in new.items():
            self.pieces[p] = b"".join([known[w] for w in found])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        plans: list[list] = []
        need: set[str] = set()
        for text in texts:
            plan: list = []
            at = 0
            for m in self.cut.finditer(text) if self.cut and any(s in text for s in self.added) else ():
                plan += [text[at : m.start()], self.added[m.group()]]
                at = m.end()
            plan.append(text[at:] if at else text)
            plans.append(plan)
        out = []
        cut_plans = []
        for plan in plans:
            parts: list = []
            for seg in plan:
                if isinstance(seg, int):
                    parts.append(seg)
                elif seg:
                    if self.blanks.search(seg):
                        got = self.split.findall(seg)
                    else:
                        first, *rest = seg.split(" ")
                        got = [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
                    need.update(got)
                    parts.append(got)
            cut_plans.append(parts)
        missing = need - self.pieces.keys()
        if missing:
            if len(self.pieces) + len(missing) > CACHE // 2:
                # all pieces of this batch must be there at once
                self.old_pieces, self.pieces, missing = self.pieces, {}, need
            self.learn(missing)
        local = self.pieces
        for parts in cut_plans:
            out.append(b"".join([np.uint32(x).astype("<u4").tobytes() if isinstance(x, int) else b"".join([local[p] for p in x]) for x in parts]))
        return out

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieBpe:
    return TrieBpe(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Characters of texts that are encoded together; bounds the trie and the lists of one step.
STEP = 1 << 21


def encode_documents(docs: DataFrame, vocabulary: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode and decode every whole text.

    Columns: those of ``keep``, then n_tokens (long), ids (array of int), decoded
    (string), ids_sha256, decoded_sha256. A null or empty text has no ids and
    decodes to the empty text. Rows are independent: repeated rows, ties, null
    ids and other columns pass as they are. ``vocabulary`` is the path of the
    vocabulary file on every machine; None takes the installed one.
    """
    common.tune(docs.sparkSession)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{k}` {fields[k]}" for k in keep), "n_tokens bigint, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"])

    def run(batches):
        bpe = encoder(vocabulary or vocabulary_path())
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= STEP):
                    size += len(texts[to])
                    to += 1
                ids = bpe.encode_batch(texts[at:to])
                back = [bpe.decode(x) for x in ids]
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, to - at) for i in range(len(keep))), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(back, pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())],
                    names=[*keep, "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"],
                )
                at = to

    return docs.select(*keep, "text").mapInArrow(run, schema)


def op7_bpe(spark, sf_dir) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return encode_documents(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
