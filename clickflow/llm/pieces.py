"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A segment's characters are symbols; an agenda holds the adjacent pairs whose joint piece is in the
vocabulary, ordered by score, then by place. The best pair is merged, and the pairs with its new
neighbours join the agenda. The new segments of a batch share one agenda, held as arrays: each round
takes every segment's best pair (segments do not touch each other, so the order among them is
free). Segments too long for that have an agenda of their own, a heap, where pairs of symbols that
have changed meanwhile are passed over. Symbols without a piece become byte pieces.

Texts are normalised by the library and cut where no piece can reach across: at word marks,
line breaks and, in long segments, between characters that no piece holds side by side (a vocabulary
whose pieces reach across marks or line breaks is encoded whole). The codec is built once per worker
process and kept for its later tasks, with a bounded table of the segments met.

Every segment is checked against the sentencepiece library when it is first met, in one
call per Arrow batch, and the first text of each batch is checked whole (every text, where
texts are not cut); a difference stops the job with the text that shows it.

Texts stream through Arrow batches (bounded in bytes) without a shuffle. The model file is
read on the driver and shipped (its size is that of the file).

Defined results: a null text counts as empty (begin and end ids only); repeated rows give
repeated results; a very long text is encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import sys
from array import array

import numpy as np
from pyspark.sql import DataFrame

MARK = "▁"
#: First characters of remembered keys that are not a word after a mark (noncharacters).
WHOLE, BARE = "\ufffe", "\uffff"
#: Segments remembered per worker process (twice so many for a while), and the longest that is
#: remembered and that shares the agenda of its batch.
REMEMBERED, LONGEST = 250_000, 64
#: Characters of text whose new segments are checked in one call.
CHECKED = 1 << 20
#: Rows whose ids and decoded texts are held at a time.
SLICE = 512
_NONE = np.iinfo(np.int32).max


class PieceCodec:
    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.ids = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        self.cost = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown, self.bos, self.eos = sp.unk_id(), sp.bos_id(), sp.eos_id()
        cut = all(MARK not in p.lstrip(MARK) and ("\n" not in p or p == "\n") for p in self.ids)
        cut = cut and "\n" in sp.normalize("a\nb")
        self.find = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+").findall if cut else lambda text: [text]
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cut = cut
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}   # the generation before
        self._tables()

    def _tables(self) -> None:
        """Symbols (pieces, and characters of pieces) as numbers, and the pairs that merge."""
        symbols = {x: i for i, x in enumerate(sorted({*self.ids, *itertools.chain.from_iterable(self.ids)}))}
        costs = sorted(set(self.cost.values()))
        rank = dict(zip(costs, range(len(costs)), strict=True))
        self.base = len(symbols)
        pairs = sorted((symbols[p[:i]] * self.base + symbols[p[i:]], rank[self.cost[p]], symbols[p])
                       for p in self.ids for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        self.pair_keys, ranks, made = np.array(pairs or [(-1, 0, 0)], dtype=np.int64).T.copy()
        self.pair_rank, self.pair_made = ranks.astype(np.int32), made.astype(np.int32)
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        self.piece_of = np.full(self.base, -1, dtype=np.int64)
        for x, i in symbols.items():
            if len(x) == 1:
                self.symbol_of[ord(x)] = i
            self.piece_of[i] = self.ids.get(x, -1)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; rank ``_NONE`` where the vocabulary has no such piece."""
        keys = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_rank[at], _NONE), self.pair_made[at]

    def merge_many(self, segments: list[str]) -> list[bytes | None]:
        """Ids of many short segments, as 32-bit integers; None for segments with a character that no
        piece has."""
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        text = "".join(segments).encode("utf-32-le", "surrogatepass")
        sym = self.symbol_of[np.frombuffer(text, dtype="<u4")]
        seq = np.repeat(np.arange(len(segments), dtype=np.int32), sizes)
        odd = np.zeros(len(segments), dtype=bool)
        odd[seq[sym < 0]] = True
        keep = ~odd[seq]
        sym, seq = sym[keep], seq[keep]
        # the agenda: rank and product of the pair that starts at each symbol; none at a segment's last one
        rank, made = np.full(len(sym), _NONE, dtype=np.int32), np.zeros(len(sym), dtype=np.int32)
        if len(sym) > 1:
            rank[:-1], made[:-1] = self._pairs(sym[:-1], sym[1:])
            rank[:-1][seq[1:] != seq[:-1]] = _NONE
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lengths = np.diff(np.r_[starts, len(seq)])
            best = np.minimum.reduceat(rank, starts)
            through = best == _NONE
            if through.any():
                out = np.repeat(through, lengths)
                ended.append((seq[out], sym[out]))
                sym, seq, rank, made = sym[~out], seq[~out], rank[~out], made[~out]
                continue
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            at = at[np.r_[True, seq[at[1:]] != seq[at[:-1]]]]   # the leftmost of equal scores
            sym[at] = made[at]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            sym, seq, rank, made = sym[stay], seq[stay], rank[stay], made[stay]
            new = at - np.arange(len(at))   # places after the second symbols have gone
            for place in (new, new - 1):
                inside = (place >= 0) & (place + 1 < len(sym))
                one = place[inside]
                r, m = self._pairs(sym[one], sym[one + 1])
                rank[one], made[one] = np.where(seq[one] == seq[one + 1], r, _NONE), m
            rank[new[new == len(sym) - 1]] = _NONE
        seq = np.concatenate([x for x, _ in ended]) if ended else np.zeros(0, dtype=np.int32)
        ids = self.piece_of[np.concatenate([x for _, x in ended])] if ended else np.zeros(0, dtype=np.int64)
        odd[seq[ids < 0]] = True
        order = np.argsort(seq, kind="stable")
        ends = np.cumsum(np.bincount(seq, minlength=len(segments))) * 4
        whole = ids[order].astype(np.uint32).tobytes()
        begins = [0, *ends.tolist()]
        return [None if o else whole[a:b] for o, a, b in zip(odd.tolist(), begins, begins[1:], strict=False)]

    def merge(self, segment: str) -> list[int]:
        """Ids of a normalised segment, by an agenda of its own."""
        out = []
        for s in self._merged(list(segment)):
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(self.unknown)
        return out

    def _merged(self, sym: list[str]) -> list[str]:
        """The agenda as a heap of (cost, place), for long segments."""
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        cost, agenda = self.cost, []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                piece = sym[left] + sym[right]
                c = cost.get(piece)
                if c is not None:
                    heapq.heappush(agenda, (c, left, right, piece))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if not sym[left] or after[left] != right or sym[left] + sym[right] != piece:
                continue
            sym[left], sym[right] = piece, ""
            follow = after[left] = after[right]
            after[right] = -1
            if follow >= 0:
                before[follow] = left
            offer(before[left], left)
            offer(left, follow)
        return [s for s in sym if s]

    def _learn(self, keys: list[str]) -> dict[str, bytes]:
        """Encode the segments of new keys and check them against the library."""
        segments = [self._segment(k) for k in keys]
        short = [i for i, s in enumerate(segments) if len(s) <= LONGEST]
        made: list[bytes | None] = [None] * len(keys)
        for i, ids in zip(short, self.merge_many([segments[i] for i in short]), strict=True):
            made[i] = ids
        out = [array("I", itertools.chain.from_iterable(map(self.merge, self._cut(s)))).tobytes() if m is None else m
               for s, m in zip(segments, made, strict=True)]
        if self.cut:  # after a line break, nothing else of the text touches the segment
            ahead = self.sp.encode("\n")
            theirs = self.sp.encode(["\n" + s.replace(MARK, " ") for s in segments], num_threads=1)
            sizes = np.fromiter(map(len, theirs), dtype=np.int64, count=len(theirs))
            flat = np.fromiter(itertools.chain.from_iterable(theirs), dtype=np.uint32, count=int(sizes.sum()))
            starts = (np.cumsum(sizes) - sizes)[:, None] + np.arange(len(ahead))
            same = np.array_equal(sizes - len(ahead), np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4) \
                and bool((flat[starts] == np.array(ahead, dtype=np.uint32)).all()) and np.delete(flat, starts).tobytes() == b"".join(out)
            if not same:
                for s, mine, all_ids in zip(segments, out, theirs, strict=True):
                    if ahead + self.native(mine) != all_ids:
                        raise ValueError(f"segment {s!r}: {self.native(mine)} differs from the library's {all_ids[len(ahead):]}")
        return dict(zip(keys, out, strict=True))

    def _cut(self, segment: str) -> list[str]:
        """Pieces of work of a segment: cut between characters that no piece holds side by side."""
        if not self.cut:
            return [segment] if segment else []
        at = [i for i in range(1, len(segment)) if segment[i - 1:i + 1] not in self.inside]
        return [segment[a:b] for a, b in zip([0, *at], [*at, len(segment)], strict=True) if b > a]

    def _keys(self, text: str) -> list[str]:
        """A text's segments. Where each mark starts a word, the words stand without it and
        word-initial parts of lines stand after ``BARE``; other texts give whole segments."""
        text = self.sp.normalize(text)
        if not self.cut:
            return [WHOLE + text] if text else []
        if MARK + MARK in text or BARE in text or WHOLE in text:
            return [WHOLE + s for s in self.find(text)]
        keys: list[str] = []
        for line in text.split("\n"):
            words = line.split(MARK)
            words[0] = BARE + words[0]
            keys += words
        keys[0] += BARE  # no line break before the first line
        return keys

    @staticmethod
    def _segment(key: str) -> str:
        """The normalised text that a key stands for."""
        if key[:1] == WHOLE:
            return key[1:]
        if key[:1] == BARE:
            return key[1:-1] if key[-1:] == BARE and len(key) > 1 else "\n" + key[1:]
        return MARK + key

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, begin and end ids included, as little-endian 32-bit integers."""
        out: list[bytes] = []
        first, last = array("I", [self.bos]).tobytes(), array("I", [self.eos]).tobytes()
        for at, held in self._portions(texts):
            parts = [self._keys(t) if t else [] for t in held]
            found = [list(map(self.known.get, p)) for p in parts]
            fresh = {k for p, f in zip(parts, found, strict=True) if None in f for k, ids in zip(p, f, strict=True) if ids is None}
            new = {k: self.before[k] for k in fresh if k in self.before}
            new.update(self._learn([k for k in fresh if k not in new]))
            for t, p, f in zip(held, parts, found, strict=True):
                ids = first + b"".join([new[k] if x is None else x for k, x in zip(p, f, strict=True)] if None in f else f) + last
                if (not self.cut or (at == 0 and len(out) == 0)) and self.native(ids) != self.sp.encode(t, add_bos=True, add_eos=True):
                    raise ValueError(f"text {t!r} differs from the library's ids")
                if sys.byteorder == "big":
                    swapped = array("I", ids)
                    swapped.byteswap()
                    ids = swapped.tobytes()
                out.append(ids)
            self.known.update((k, ids) for k, ids in new.items() if len(k) <= LONGEST)
            if len(self.known) > REMEMBERED:
                self.known, self.before = {}, self.known
        return out

    @staticmethod
    def _portions(texts: list[str]):
        held, size, at = [], 0, 0
        for i, t in enumerate(texts):
            held.append(t)
            size += len(t)
            if size >= CHECKED or i == len(texts) - 1:
                yield at, held
                at, held, size = i + 1, [], 0

    @staticmethod
    def native(ids: bytes) -> list[int]:
        return np.frombuffer(ids, dtype=np.uint32).tolist()

    @staticmethod
    def numbers(ids: bytes) -> list[int]:
        return np.frombuffer(ids, dtype="<u4").tolist()

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(self.numbers(ids))


#: The codec of this worker process, by the digest of its model.
_CODEC: dict[bytes, PieceCodec] = {}


def codec_of(model: bytes) -> PieceCodec:
    """The codec of a model, kept for the later tasks of the process (one at a time)."""
    digest = hashlib.sha256(model).digest()
    if digest not in _CODEC:
        _CODEC.clear()
        _CODEC[digest] = PieceCodec(model)
    return _CODEC[digest]


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode each text of ``docs`` with the model at ``path``, then decode its ids:
    (doc_id, n_tokens, ids_sha256, decoded_sha256), with ``ids`` (binary, little-endian
    32-bit) and ``decoded`` when ``with_ids`` is set."""
    import pyarrow as pa

    with open(path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def coded(batches):
        codec = codec_of(shipped.value)
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            rows = codec.encode([t or "" for t in batch.column(1).to_pylist()])
            digest, said, texts = [], [], []
            for ids in rows:
                text = codec.decode(ids)
                digest.append(hashlib.sha256(ids).hexdigest())
                said.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    texts.append(text)
            columns = [batch.column(0), pa.array([len(r) // 4 for r in rows], pa.int64()), pa.array(digest, pa.string()),
                       pa.array(said, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(rows, pa.binary()), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(docs.dtypes)["doc_id"]
    more = ", ids binary, decoded string" if with_ids else ""
    return docs.select("doc_id", "text").mapInArrow(
        coded, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
