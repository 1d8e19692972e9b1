"""SentencePiece encoding and decoding by a max-plus parallel scan.

The encoding of a text is the path of pieces with the greatest sum of scores (unigram decoding over the model's pieces;
ties go to the longer last piece at every position), after a blank is put before it and blanks become U+2581. A
character that no piece spells costs UNK_PENALTY below the least score and becomes its UTF-8 byte pieces.

A text is cut where no piece can span two neighbouring characters. There the boundary has one state, so the
runs between cuts are solved apart, in lockstep and once for each different run of a block. A run longer than LONGEST
is split in chunks of CHUNK characters whose boundary states are the places where the first piece after the cut may start:
each chunk yields a max-plus transfer matrix, the matrices are combined associatively by a parallel scan, and every
chunk is then solved again from its true entry scores and traced back on its own. A giant text (above GIANT bytes) is cut to
stretches of STRETCH characters that become rows of their own, whatever their content, and go through the same three
steps over all tasks. Results do not depend on the cuts.

Defined cases: null and empty texts have no pieces; decoding returns the very text, as a literal U+2581 or
any unknown character goes through byte pieces; repeated rows are encoded each; an empty table gives an empty result;
memory is a constant per character of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import map_batches, materialize, table
from touchline.llm.kernels import blocks, mix, text_buffers

UNK_PENALTY, LONGEST, CHUNK, BLOCK, BLANK = 10.0, 48, 64, 1 << 19, 0x2581
#: Symbols of a stretch of a giant text (a multiple of CHUNK), bytes that make a text giant, symbols that follow a stretch.
STRETCH, GIANT, OVERHANG = 1 << 16, 1 << 22, 32
#: Cells of the lockstep tables of short runs.
CELLS, SLOTS = 200_000, 3
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_RINV = np.uint64(pow(int(_R), -1, 1 << 64))
NEG = -np.inf


def default_model() -> bytes:
    """The installed public model; its path is a parameter of read_model."""
    import public_tokenizers

    return Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


def read_model(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id; kind: 0 ordinary, 1 byte, 2 not for encoding."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(sp.get_piece_size())
    return [(sp.id_to_piece(i), sp.get_score(i), 1 if sp.is_byte(i) else 2 if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else 0) for i in ids]


class Encoder:
    def __init__(self, pieces: list[tuple[str, float, int]]):
        ordinary = [(i, p, s) for i, (p, s, k) in enumerate(pieces) if k == 0 and p]
        self.byte_id = np.full(256, -1, np.int32)
        for i, (p, _, k) in enumerate(pieces):
            if k == 1:
                self.byte_id[int(p[3:5], 16)] = i
        chars = sorted({ord(c) for _, p, _ in ordinary for c in p})
        self.char = np.zeros(0x110000, np.uint16)
        self.char[chars] = np.arange(1, len(chars) + 1)
        self.hash_of = mix(np.arange(len(chars) + 1, dtype=np.uint64) + np.uint64(12345))
        self.longest = max((len(p) for _, p, _ in ordinary), default=1)
        self.unk = min((s for _, _, s in ordinary), default=0.0) - UNK_PENALTY
        coded = [self.char[[ord(c) for c in p]].astype(np.int64) for _, p, _ in ordinary]
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *[c[:-1] << 16 | c[1:] for c in coded if len(c) > 1]]))
        self.joined = np.zeros(1 << 22, bool)
        self.joined[self._pair_slot(pairs >> 16, pairs & 0xFFFF)] = True
        self._table([self._key(c) for c in coded], [i for i, _, _ in ordinary])
        self.score = np.array([s for _, s, _ in pieces])
        raw = [bytes([int(p[3:5], 16)]) if k == 1 else b"" if k == 2 else p.replace(chr(BLANK), " ").encode() for p, _, k in pieces]
        self.raw = raw

    @staticmethod
    def _pair_slot(a, b):
        return ((np.asarray(a, np.uint64) * np.uint64(0x9E3779B1) + np.asarray(b, np.uint64) * np.uint64(0x85EBCA77)) & np.uint64((1 << 22) - 1)).astype(np.int64)

    def _key(self, coded: np.ndarray) -> int:
        h = np.zeros(1, np.uint64)
        for c in coded:
            h = h * _R + self.hash_of[c]
        return int(h[0])

    def _table(self, keys: list[int], ids: list[int]) -> None:
        """Buckets of SLOTS, with a multiplier under which no bucket overflows."""
        own = np.array(keys, np.uint64)
        bits = max(8, int(len(own)).bit_length() + 1)
        for turn in range(1000):
            self.mult = np.uint64((0xD6E8FEB86659FD93 + 2 * turn * 0x9E3779B97F4A7C15) & ((1 << 64) - 1) | 1)
            self.shift = np.uint64(64 - bits)
            slot = ((own * self.mult) >> self.shift).astype(np.int64)
            if len(slot) == 0 or np.bincount(slot).max() <= SLOTS:
                break
            bits += turn % 32 == 31 and bits < 24
        self.keys, self.vals = np.zeros((SLOTS, 1 << bits), np.uint64), np.full((SLOTS, 1 << bits), -1, np.int32)
        used = np.zeros(1 << bits, np.int8)
        for s, k, i in zip(slot, own, ids, strict=True):
            self.keys[used[s], s], self.vals[used[s], s] = k, i
            used[s] += 1

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        slot = ((h * self.mult) >> self.shift).astype(np.int64)
        out = np.full(h.shape, -1, np.int32)
        for keys, vals in zip(self.keys, self.vals, strict=True):
            hit = keys[slot] == h
            out[hit] = vals[slot[hit]]
        return out

    def symbols(self, text: str) -> np.ndarray:
        """Code points after the leading blank; a literal U+2581 becomes an unknown sign apart (its high bit set)."""
        cp = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        literal = cp == BLANK
        cp[cp == 32] = BLANK
        cp[literal] |= np.uint32(1 << 30)
        return cp

    def _solve(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best path of each row of codes: pieces back to front (-1: unknown character), their lengths, and their number."""
        n, width = codes.shape
        best = np.full((n, width + 1), NEG)
        best[:, 0] = 0
        back, piece = np.zeros((n, width + 1), np.int8), np.full((n, width + 1), -1, np.int32)
        values = self.hash_of[codes]
        for i in range(width):
            h = np.zeros(n, np.uint64)
            for size in range(1, min(self.longest, width - i) + 1):
                h = h * _R + values[:, i + size - 1]
                pid = self.find(h)
                gain = np.where(pid >= 0, self.score[pid], self.unk if size == 1 else NEG)
                total = best[:, i] + gain
                better = total > best[:, i + size]
                best[better, i + size], back[better, i + size], piece[better, i + size] = total[better], size, pid[better]
        out, pos, count = np.full((n, width), -2, np.int32), lengths.copy(), np.zeros(n, np.int64)
        rows = np.arange(n)
        for step in range(width):
            live = pos > 0
            if not live.any():
                break
            out[live, step] = piece[rows[live], pos[live]]
            count += live
            pos = pos - np.where(live, back[rows, pos], 0)
        return out, best[rows, lengths], count

    def _chunk_scores(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores (chunks x start x size) of the pieces that start in each chunk; code -1 is past the end."""
        k = len(codes) // CHUNK
        padded = np.concatenate([codes, np.full(self.longest, -1, np.int64)])
        at = np.arange(k)[:, None] * CHUNK + np.arange(CHUNK)[None, :]
        ids, gains = np.full((k, CHUNK, self.longest), -1, np.int32), np.full((k, CHUNK, self.longest), NEG)
        h, valid = np.zeros((k, CHUNK), np.uint64), np.ones((k, CHUNK), bool)
        for size in range(1, self.longest + 1):
            c = padded[at + size - 1]
            valid = valid & (c >= 0)
            h = h * _R + self.hash_of[np.maximum(c, 0)]
            pid = np.where(valid, self.find(h), -1)
            ids[:, :, size - 1] = pid
            gains[:, :, size - 1] = np.where(pid >= 0, self.score[pid], np.where(c >= 0, self.unk, 0.0) if size == 1 else NEG)
        return ids, gains

    def _forward(self, gains: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores and last piece sizes (0: entry) at each place of a chunk and its overhang, given entry scores by state."""
        shape = entry.shape[:-1] + (CHUNK + self.longest,)
        best, back = np.full(shape, NEG), np.zeros(shape, np.int8)
        best[..., : self.longest] = entry
        for i in range(CHUNK):
            for size in range(1, self.longest + 1):
                total = best[..., i] + gains[:, i, size - 1].reshape((-1,) + (1,) * (entry.ndim - 2))
                better = total > best[..., i + size]
                best[..., i + size] = np.where(better, total, best[..., i + size])
                back[..., i + size] = np.where(better, size, back[..., i + size])
        return best, back

    @staticmethod
    def _scan(mats: np.ndarray) -> np.ndarray:
        """Inclusive prefix products in the max-plus semiring, by halving."""
        if len(mats) == 1:
            return mats
        times = lambda a, b: np.stack([(x[:, :, None] + y[None, :, :]).max(1) for x, y in zip(a, b, strict=True)])
        even = len(mats) // 2 * 2
        half = Encoder._scan(times(mats[0:even:2], mats[1:even:2]))
        out = np.empty_like(mats)
        out[0] = mats[0]
        out[1:even:2] = half
        if len(mats) > 2:
            rest = mats[2::2]
            out[2::2] = times(half[: len(rest)], rest)
        return out

    def _padded(self, codes: np.ndarray, n: int) -> np.ndarray:
        """The n codes of a stretch, those after it up to the longest piece, and -1 from the text's end on."""
        full = -(-n // CHUNK) * CHUNK + self.longest
        return np.concatenate([codes[:full].astype(np.int64), np.full(max(0, full - len(codes)), -1, np.int64)])

    def _chunks(self, padded: np.ndarray, group: int = 256):
        """(first chunk, ids, gains) of groups of chunks."""
        k = (len(padded) - self.longest) // CHUNK
        for g in range(0, k, group):
            part = padded[g * CHUNK : min(k, g + group) * CHUNK + self.longest]
            count = min(k, g + group) - g
            ids, gains = self._chunk_scores(np.concatenate([part, np.full((count + 1) * CHUNK - len(part), -1, np.int64)]))
            yield g, ids[:count], gains[:count]

    def _matrices(self, padded: np.ndarray) -> np.ndarray:
        """The max-plus transfer matrix of each chunk."""
        states = self.longest
        unit = np.full((states, states), NEG)
        np.fill_diagonal(unit, 0)
        return np.concatenate([self._forward(gains, np.broadcast_to(unit, (len(gains), states, states)))[0][:, :, CHUNK : CHUNK + states] for _, _, gains in self._chunks(padded)])

    def transfer(self, codes: np.ndarray, n: int) -> np.ndarray:
        """The transfer matrix of a stretch: best score from each entry state to each exit state."""
        mats = self._matrices(self._padded(codes, n))
        while len(mats) > 1:
            odd = mats[-1:] if len(mats) % 2 else mats[:0]
            pairs = [(x[:, :, None] + y[None, :, :]).max(1) for x, y in zip(mats[0 : len(mats) - len(odd) : 2], mats[1::2], strict=False)]
            mats = np.concatenate([np.stack(pairs), odd])
        return mats[0]

    def _traces(self, codes: np.ndarray, n: int, entry: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Back-to-front pieces of each chunk by exit state, and the entry state that each exit state leads to, given entry scores."""
        padded, states = self._padded(codes, n), self.longest
        prefix = self._scan(self._matrices(padded))
        entries = np.concatenate([entry[None, :], (entry[None, :, None] + prefix[:-1]).max(1)])
        traces, maps = [], []
        for g, ids, gains in self._chunks(padded):
            count = len(ids)
            _, back = self._forward(gains, entries[g : g + count])
            rows = np.repeat(np.arange(count), states)
            pos = np.tile(np.arange(CHUNK, CHUNK + states), count)
            steps = []
            while True:
                size = back[rows, pos].astype(np.int64)
                # an overhang place is left only by a piece of this chunk; an entry place ends the trace
                live = (size > 0) & (pos > 0)
                if not live.any():
                    break
                start = np.where(live, pos - size, 0)
                real = live & (start < CHUNK) & (padded[(g + rows) * CHUNK + np.minimum(start, CHUNK - 1)] >= 0)
                steps.append(np.where(real, ids[rows, np.minimum(start, CHUNK - 1), np.maximum(size, 1) - 1], -2))
                pos = np.where(live, start, pos)
            traces.append((np.stack(steps, 1) if steps else np.full((count * states, 0), -2)).reshape(count, states, -1))
            maps.append(np.minimum(pos, states - 1).reshape(count, states))
        return traces, np.concatenate(maps)

    def entry_of(self, codes: np.ndarray, n: int, entry: np.ndarray) -> np.ndarray:
        """The entry state of a stretch that each exit state leads to."""
        state = np.arange(self.longest)
        for m in self._traces(codes, n, entry)[1][::-1]:
            state = m[state]
        return state

    def stretch(self, codes: np.ndarray, n: int, entry: np.ndarray, state: int) -> np.ndarray:
        """Pieces that start in a stretch, front to back, with its entry scores and its exit state given."""
        traces, maps = self._traces(codes, n, entry)
        exits = np.zeros(len(maps), np.int64)
        for c in range(len(maps) - 1, -1, -1):  # the composed maps at the true end state
            exits[c] = state
            state = int(maps[c, state])
        out, at = [], 0
        for t in traces:
            own = t[np.arange(len(t)), exits[at : at + len(t)]][:, ::-1]
            out.append(own[own != -2])
            at += len(t)
        return np.concatenate(out)

    def at_start(self) -> np.ndarray:
        """Entry scores of a text's first stretch."""
        return np.concatenate([[0.0], np.full(self.longest - 1, NEG)])

    def solve_long(self, codes: np.ndarray) -> np.ndarray:
        """Pieces of one long run, front to back, by the scan over chunks."""
        return self.stretch(codes, len(codes), self.at_start(), 0)

    def codes(self, cp: np.ndarray) -> np.ndarray:
        return np.where(cp < 0x110000, self.char[np.minimum(cp, 0x10FFFF)], 0).astype(np.int64)

    def _bytes(self, cp: int) -> np.ndarray:
        return self.byte_id[list(chr(cp & 0x3FFFFFFF).encode("utf-8", "surrogatepass"))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids of each text."""
        out: list[np.ndarray] = []
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= BLOCK):
                size += len(texts[hi] or "")
                hi += 1
            out += self._encode_block([t or "" for t in texts[lo:hi]])
            lo = hi
        return out

    def _encode_block(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.symbols(t) if t else np.zeros(0, np.uint32) for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        cp = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        n = len(cp)
        if not n:
            return [np.zeros(0, np.int32) for _ in texts]
        code = self.codes(cp)
        new = np.ones(n, bool)
        new[1:] = ~self.joined[self._pair_slot(code[:-1], code[1:])] | (code[1:] == 0) | (code[:-1] == 0)
        new[bounds[:-1][bounds[:-1] < n]] = True
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, n))
        # a run's hash: unknown characters hash by code point
        values = np.where(code > 0, self.hash_of[code], mix(cp.astype(np.uint64) + np.uint64(1 << 40)))
        sums = np.zeros(n + 1, np.uint64)
        power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _R, np.uint64)]))
        np.cumsum(values * power[:n], out=sums[1:])
        inverse = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _RINV, np.uint64)]))
        key = mix((sums[start + length] - sums[start]) * inverse[start] + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        del sums, power, inverse
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        ustart, ulength = start[first], length[first]
        solved: list[np.ndarray | None] = [None] * len(first)
        small = np.flatnonzero(ulength <= LONGEST)
        small = small[np.argsort(ulength[small], kind="stable")]
        edges = [0, 1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, LONGEST]
        flat, counts = [], np.zeros(len(first), np.int64)
        order: list[np.ndarray] = []
        for a, b in zip(edges, edges[1:], strict=False):
            group = small[np.searchsorted(ulength[small], a, "right") : np.searchsorted(ulength[small], b, "right")]
            for at in range(0, len(group), CELLS // b):
                g = group[at : at + CELLS // b]
                where = ustart[g][:, None] + np.arange(b)[None, :]
                codes = np.where(np.arange(b)[None, :] < ulength[g][:, None], code[np.minimum(where, n - 1)], 0)
                rev, _, cnt = self._solve(codes, ulength[g])
                keep = np.arange(b)[None, :] < cnt[:, None]
                fwd = np.take_along_axis(rev, np.maximum(cnt[:, None] - 1 - np.arange(b)[None, :], 0), 1)
                flat.append(fwd[keep])
                counts[g] = cnt
                order.append(g)
        tokens = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        places = np.concatenate(order) if order else np.zeros(0, np.int64)
        offset = np.zeros(len(first), np.int64)
        offset[places] = np.concatenate([[0], np.cumsum(counts[places])])[:-1] if len(places) else 0
        # unknown characters are runs of their own: byte pieces; long runs: the scan
        extra, at = [], len(tokens)
        for u in np.flatnonzero((ulength > LONGEST) | (code[ustart] == 0)):
            if ulength[u] == 1:
                ids = self._bytes(int(cp[ustart[u]]))
            else:
                ids = self.solve_long(code[ustart[u] : ustart[u] + ulength[u]])
                ids = self._fill(ids, cp[ustart[u] : ustart[u] + ulength[u]])
            offset[u], counts[u] = at, len(ids)
            extra.append(ids)
            at += len(ids)
        tokens = np.concatenate([tokens, *extra]).astype(np.int32)
        per = counts[which]
        ends = np.cumsum(per)
        total = int(ends[-1])
        gather = np.arange(total) - np.repeat(ends - per, per) + np.repeat(offset[which], per)
        ids = tokens[gather]
        unit = np.searchsorted(start, bounds)  # first run of each text
        cut = np.concatenate([[0], ends])[unit]
        return [ids[cut[k] : cut[k + 1]] for k in range(len(texts))]

    def _fill(self, ids: np.ndarray, cp: np.ndarray) -> np.ndarray:
        """Byte pieces in place of characters that are no piece of their own."""
        if not (ids < 0).any():
            return ids
        out, at = [], 0
        for i in ids:
            if i < 0:
                out.append(self._bytes(int(cp[at])))
                at += 1
            else:
                out.append(np.array([i]))
                at += len(self.raw[i].decode("utf-8", "surrogatepass"))
        return np.concatenate(out)

    def decode(self, ids) -> str:
        """The text of piece ids."""
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


_KNOWN: dict[int, Encoder] = {}


def encoder(pieces: list[tuple[str, float, int]]) -> Encoder:
    """The encoder of a piece list, built once a worker process; it holds one list at a time."""
    key = hash(tuple(pieces))
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Encoder(pieces)
    return _KNOWN[key]


def stretches(data: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, end of what follows) in bytes of a UTF-8 text's stretches of size symbols, the leading blank included."""
    start, seen, wanted = 0, 0, size - 1
    for lo in range(0, len(data), 1 << 22):
        at = np.flatnonzero((data[lo : lo + (1 << 22)] & 0xC0) != 0x80) + lo
        while seen + len(at) > wanted:
            cut = int(at[wanted - seen])
            yield start, cut, min(len(data), cut + 4 * OVERHANG)
            start, wanted = cut, wanted + size
        seen += len(at)
    yield start, len(data), len(data)


def _encode_giants(docs: DataFrame, keep: list[str], pieces: list[tuple[str, float, int]]) -> DataFrame:
    """keep columns and ids of texts above GIANT bytes: stretches become rows that any task may take.

    Their transfer matrices are combined by text (2 kB for 65,536 characters, so that the longest text that Spark holds in
    a row has some 70 MB of them), which gives each stretch its entry scores; then each tells which entry state every exit
    state leads to, the maps are composed from the text's end, and each stretch is traced back on its own.
    """
    rows = materialize(docs.select(F.struct(*[F.col(f"`{k}`").alias(f"c{i}") for i, k in enumerate(keep)]).alias("kept"), "text", F.monotonically_increasing_id().alias("row")), "giants")

    size = STRETCH

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for no, (lo, hi, end) in enumerate(stretches(data, size)):
                    # what follows may end within a character: only whole ones count
                    after = data[hi:end].tobytes().decode("utf-8", "ignore")[:OVERHANG]
                    yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([no], pa.int32()), pa.array([data[lo:hi].tobytes().decode()]), pa.array([after])], names=["row", "no", "part", "after"])

    parts = materialize(rows.select("row", "text").mapInArrow(cut, "row long, no int, part string, after string").repartition("row", "no"), "stretches")

    def known(enc: Encoder, no: int, part: str, after: str) -> tuple[np.ndarray, np.ndarray, int]:
        cp = enc.symbols(part + after)[0 if no == 0 else 1 :]
        return enc.codes(cp), cp, len(part) + (no == 0)

    def matrices(no: pa.Array, part: pa.Array, after: pa.Array) -> dict[str, pa.Array]:
        enc = encoder(pieces)
        each = [known(enc, *x) for x in zip(no.to_pylist(), part.to_pylist(), after.to_pylist(), strict=True)]
        return {"matrix": pa.array([enc.transfer(codes, n).tobytes() for codes, _, n in each], pa.binary())}

    def entries(t: pa.Table) -> pa.Table:
        enc = encoder(pieces)
        t = t.sort_by("no")
        state, out = enc.at_start(), []
        for m in t.column("matrix").to_pylist():
            out.append(state.tobytes())
            state = (state[:, None] + np.frombuffer(m).reshape(enc.longest, enc.longest)).max(0)
        return pa.table({"row": t.column("row"), "no": t.column("no"), "entry": pa.array(out, pa.binary())})

    def maps(no: pa.Array, part: pa.Array, after: pa.Array, entry: pa.Array) -> dict[str, pa.Array]:
        enc = encoder(pieces)
        out = []
        for x, e in zip(zip(no.to_pylist(), part.to_pylist(), after.to_pylist(), strict=True), entry.to_pylist(), strict=True):
            codes, _, n = known(enc, *x)
            out.append(enc.entry_of(codes, n, np.frombuffer(e)).tolist())
        return {"leads": pa.array(out, pa.list_(pa.int32()))}

    def exits(t: pa.Table) -> pa.Table:
        t = t.sort_by("no")
        state, out = 0, []
        for m in t.column("leads").to_pylist()[::-1]:
            out.append(state)
            state = m[state]
        return pa.table({"row": t.column("row"), "no": t.column("no"), "state": pa.array(out[::-1], pa.int32())})

    def trace(no: pa.Array, part: pa.Array, after: pa.Array, entry: pa.Array, state: pa.Array) -> dict[str, pa.Array]:
        enc = encoder(pieces)
        out = []
        for x, e, s in zip(zip(no.to_pylist(), part.to_pylist(), after.to_pylist(), strict=True), entry.to_pylist(), state.to_pylist(), strict=True):
            codes, cp, n = known(enc, *x)
            start = int(enc.entry_of(codes, n, np.frombuffer(e))[s])
            out.append(enc._fill(enc.stretch(codes, n, np.frombuffer(e), s), cp[start:]).astype(np.int32).tolist())
        return {"ids": pa.array(out, pa.list_(pa.int32()))}

    at = ["row", "no"]
    made = map_batches(parts, matrices, "matrix binary", at, ["no", "part", "after"])
    parts = materialize(parts.join(made.groupBy("row").applyInArrow(entries, "row long, no int, entry binary"), at), "entries")
    made = map_batches(parts, maps, "leads array<int>", at, ["no", "part", "after", "entry"])
    parts = materialize(parts.join(made.groupBy("row").applyInArrow(exits, "row long, no int, state int"), at), "exits")
    made = map_batches(parts, trace, "ids array<int>", at, ["no", "part", "after", "entry", "state"])
    whole = made.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"])).alias("ids"))
    return rows.join(whole, "row").select(*[F.col(f"kept.c{i}").alias(k) for i, k in enumerate(keep)], "ids")


def encode_documents(docs: DataFrame, keep: list[str], model: bytes | None = None, check: bool = False) -> DataFrame:
    """keep columns with ids, n_tokens, n_bytes (byte pieces), score of the path and, if asked, whether decoding gives the text back.

    The pieces (one model file) go to the executors with the task. Texts above GIANT bytes are cut over tasks, the others encoded
    where they are; both ways give the same path.
    """
    pieces = read_model(model or default_model())
    is_byte = np.array([p[2] == 1 for p in pieces], np.int64)
    score = np.array([p[1] for p in pieces])

    def figures(ids: list[np.ndarray]) -> dict[str, pa.Array]:
        counts = np.array([len(i) for i in ids], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        sums = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[offsets])
        return {
            "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
            "n_tokens": pa.array(counts),
            "n_bytes": pa.array(sums(is_byte[flat]).astype(np.int64)),
            "score": pa.array(sums(score[flat]).astype(float)),
        }

    def run(column: pa.Array) -> dict[str, pa.Array]:
        enc, made = encoder(pieces), []
        sizes = np.diff(text_buffers(column)[1])
        for lo, hi in blocks(np.concatenate([[0], np.cumsum(sizes)]), BLOCK):
            texts = column.slice(lo, hi - lo).to_pylist()
            ids = enc.encode(texts)
            more = {"round_trip": pa.array([enc.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts, strict=True)], pa.bool_())} if check else {}
            made.append(figures(ids) | more)
        return {k: pa.concat_arrays([m[k] for m in made]) for k in made[0]} if made else figures([]) | ({"round_trip": pa.array([], pa.bool_())} if check else {})

    def finish(column: pa.Array, *texts: pa.Array) -> dict[str, pa.Array]:
        enc = encoder(pieces)
        ids = [np.array(i.as_py(), np.int32) for i in column]
        more = {"round_trip": pa.array([enc.decode(i.tolist()) == t.as_py() for i, t in zip(ids, texts[0], strict=True)], pa.bool_())} if check else {}
        return figures(ids) | more

    added = "ids array<int>, n_tokens long, n_bytes long, score double" + ", round_trip boolean" * check
    giant = F.octet_length("text") > GIANT
    out = map_batches(docs.where(F.coalesce(~giant, F.lit(True))), run, added, keep, ["text"])
    giants = docs.where(giant)
    if giants.limit(1).count() == 0:
        return out
    long = _encode_giants(giants, [*keep, "text"], pieces)
    names = [f"k{i}" for i in range(len(keep))]
    long = long.toDF(*names, "t", "found")
    return out.unionByName(map_batches(long, finish, added, names, ["found", "t"] if check else ["found"]).toDF(*out.columns))


def decode_documents(encoded: DataFrame, keep: list[str], model: bytes | None = None) -> DataFrame:
    """keep columns with the text of ids; null ids give null."""
    pieces = read_model(model or default_model())

    def run(column: pa.Array) -> dict[str, pa.Array]:
        enc = encoder(pieces)
        return {"text": pa.array([None if i is None else enc.decode(i) for i in column.to_pylist()], pa.string())}

    return map_batches(encoded, run, "text string", keep, ["ids"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents"), ["doc_id"], check=True)
    return out.select("doc_id", "n_tokens", "n_bytes", "round_trip", "ids")
