"""Token counts of byte-level BPE vocabularies by rank-synchronous array merging.

Texts are cut into pre-tokens; the distinct new pre-tokens of a batch are held as one ragged
numpy array of symbol ids. In each round every sequence applies its own lowest-rank pair,
all sequences at the same time; finished sequences leave with the number of symbols they
have left. Counts of pre-tokens are remembered in a bounded table per task.

When each merge makes a symbol of its own and ranks after the merges that make its parts
(checked when the vocabulary is read), a pair's occurrences can be applied together from
the left; otherwise only the leftmost is applied in a round.

Texts stream through Arrow batches (bounded in bytes), one partition after another, without
a shuffle. The vocabulary is read on the driver and shipped to the executors (its size is
that of the file). Very long texts are cut into runs of pre-tokens, so memory follows
``RUN`` and not the text.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings inside a
text count as one token each; repeated rows give repeated results; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The byte-level pre-tokenizer's pattern. Fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens handled at a time, those remembered per task, and the longest that is remembered.
RUN, REMEMBERED, LONGEST = 200_000, 1_000_000, 64
#: A space after a white space (\\s of ``re`` holds every white space of the pattern), and the
#: place before a space that follows something else.
SPACED, CUT = re.compile(r"\s "), re.compile(r"(?<=\S)(?= )")
#: Marks the first part of a text (a noncharacter; texts that hold it are not cut).
FIRST = "\uffff"
_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes are
    themselves, the others follow from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class RankMerger:
    """Counts the symbols that are left of byte strings after all merges."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte_id = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        left, right, made = (np.array(x, dtype=np.int64) for x in zip(
            *[(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], strict=True))
        self.base = max(vocab.values()) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        born = np.full(self.base, -1, dtype=np.int64)
        born[made] = np.arange(len(made))
        ranks = np.arange(len(made))
        self.together = len(np.unique(made)) == len(made) and bool(
            np.all(born[left] < ranks) and np.all(born[right] < ranks))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], _NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        out = sizes.copy()
        if not len(words) or not sizes.sum():
            return out
        rank_made = np.empty_like(self.made)
        rank_made[self.rank] = self.made
        sym = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(words)), sizes)
        # rank of the pair that starts at each symbol; none at the last symbol of a sequence
        rank = np.full(len(sym), _NONE)
        rank[:-1] = np.where(seq[1:] == seq[:-1], self._ranks(sym[:-1], sym[1:]), _NONE)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lengths = np.diff(np.r_[starts, len(seq)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            if done.any():
                out[seq[starts[done]]] = lengths[done]
                keep = np.repeat(~done, lengths)
                sym, seq, rank, lowest, lengths = sym[keep], seq[keep], rank[keep], lowest[~done], lengths[~done]
                continue
            hit = rank == np.repeat(lowest, lengths)
            at = np.flatnonzero(hit)
            if self.together:  # of a run of overlapping pairs every second one, from the left
                first = np.r_[True, (at[1:] != at[:-1] + 1) | (seq[at[1:]] != seq[at[:-1]])]
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[run % 2 == 0]
            else:
                at = at[np.r_[True, seq[at[1:]] != seq[at[:-1]]]]
            sym[at] = rank_made[rank[at]]
            rank[at] = _NONE
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # places after the second symbols have gone
            sym, seq, rank = sym[keep], seq[keep], rank[keep]
            for place in (new, new - 1):
                place = place[(place >= 0) & (place < len(sym) - 1)]
                inside = seq[place] == seq[place + 1]
                rank[place] = np.where(inside, self._ranks(sym[place], sym[place + 1]), _NONE)
            rank[new[new == len(sym) - 1]] = _NONE
        return out


class TokenCounter:
    """Token counts of texts. A text is cut before each space that follows a non-space: no
    pre-token crosses such a place, so what stands between two cuts is counted by itself and
    remembered."""

    def __init__(self, spec: dict):
        import regex
        self.merger = RankMerger(spec)
        self.find = regex.compile(PATTERN)
        marks = sorted(self.merger.special, key=len, reverse=True)
        # a special string with a space in it could lie across a cut
        self.cuts = not any(" " in m for m in marks)
        self.special = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self.known: dict[str, int] = {}

    def _parts(self, text: str) -> list[str]:
        """The parts of a text, each but the first without the space before it; the first is
        marked, so that equal parts count alike."""
        if not self.cuts or FIRST in text:
            return [FIRST + text]
        if SPACED.search(text):
            parts = [p[1:] if i else p for i, p in enumerate(CUT.split(text))]
        else:
            parts = text.split(" ")
        parts[0] = FIRST + parts[0]
        return parts

    def _pretokens(self, part: str):
        """Runs of (special tokens, pre-tokens) of a part, ``RUN`` pre-tokens at most."""
        text = part[1:] if part[:1] == FIRST else " " + part
        pieces = self.special.split(text) if self.special else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                yield 1, []
            elif len(piece) <= RUN:
                yield 0, self.find.findall(piece)
            else:
                found = (m.group() for m in self.find.finditer(piece))
                while run := list(itertools.islice(found, RUN)):
                    yield 0, run

    def _learn(self, parts: set[str]) -> dict[str, int]:
        out, held, size = dict.fromkeys(parts, 0), [], 0

        def settle():
            words = list(set(itertools.chain.from_iterable(run for _, run in held)))
            counts = dict(zip(words, self.merger.counts([w.encode() for w in words]).tolist(), strict=True))
            for part, run in held:
                out[part] += sum(map(counts.__getitem__, run))
            held.clear()

        for part in parts:
            for special, run in self._pretokens(part):
                out[part] += special
                held.append((part, run))
                size += len(run)
                if size >= RUN:
                    settle()
                    size = 0
        settle()
        return out

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        held: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            held.append(self._parts(text))
            size += len(held[-1])
            if size < RUN and i < len(texts) - 1:
                continue
            found = [list(map(self.known.get, parts)) for parts in held]
            new = self._learn({w for p, f in zip(held, found, strict=True) if None in f
                               for w, n in zip(p, f, strict=True) if n is None})
            out += [sum([new[w] if n is None else n for w, n in zip(p, f, strict=True)] if None in f else f)
                    for p, f in zip(held, found, strict=True)]
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
            self.known.update((w, n) for w, n in new.items() if len(w) <= LONGEST)
            held, size = [], 0
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs`` with the vocabulary at
    ``path`` (a tokenizer's JSON file with byte-level BPE)."""
    import pyarrow as pa

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    small = {"model": {k: spec["model"][k] for k in ("vocab", "merges")}, "added_tokens": spec.get("added_tokens", [])}
    shipped = docs.sparkSession.sparkContext.broadcast(small)

    def counted(batches):
        counter = TokenCounter(shipped.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = pa.array(counter.count(texts), pa.int64())
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, tokens], names=["doc_id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    made = docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
