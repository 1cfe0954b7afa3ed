"""A file format for token ids: adaptive context mixing and a range coder, in independent checksummed blocks.

Three models predict the next id, and their mixture drives the coder. Order 0 gives every id of the file its share of the
file's ids (a table in the header). Orders 2 and 1 keep, for the hash of the last two ids or the last one, the id that
followed and a confidence, and predict that one id. Order 2 has a weight by how often it was right at its confidence,
order 1 its own of what is left, order 0 the rest; the weights and what orders 1 and 2 know are learnt anew in each block,
so that blocks can be read on their own. An id's probability is the sum over the three models, so one that several
predict has the shares of all. Ids stand in the coder's interval in their own order, with the shares of the two predicted
ids put in at their places. A file's blocks are coded side by side, one array lane each. The arithmetic is exact: every
machine decodes what any other has written.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TCM2"
#: Ids must be smaller than this.
MOST = 1 << 18
#: A block has at most so many ids; so many blocks are coded side by side, which bounds the memory.
BLOCK, LANES = 4096, 2048
SLOTS = 1 << 9
#: Order 0's shares are parts of 2**20, the weights of the models parts of 2**10: together the coder's 2**30.
PARTS, WEIGHT = 20, 10
TOTAL = PARTS + WEIGHT
#: How often a prediction was right, in parts of 2**16, to begin with, by confidence; and what it moves to
#: when a prediction was wrong or right, a 32nd of the way.
RIGHT = np.array([1500, 9000, 16000, 24000, 32000, 38000, 44000, 52000], np.int32)
RISE = np.int32(61440)
U = np.uint64
#: The coder's state has 63 bits, of which 32 are put out as soon as the span is under EDGE; a carry into words that
#: are already out is kept in their 33rd bit until the end.
EDGE, LOW31, WORD, HALF = U(1 << 31), U((1 << 31) - 1), U(32), U(31)
_HEAD = struct.Struct("<4sIQIII")  # magic, documents, ids, block size, bytes of the document table and of the id table
_BLOCK = np.dtype([("n", "<u4"), ("words", "<u4"), ("crc", "<u4")])


def shares(counts: np.ndarray) -> np.ndarray:
    """Shares of 2**PARTS in proportion to ``counts`` (all above 0), none of them 0; deterministic."""
    spare = (1 << PARTS) - len(counts)
    part = 1 + (counts.astype(np.int64) * spare // max(1, int(counts.sum())))
    part[np.argmax(counts)] += (1 << PARTS) - int(part.sum())
    return part


class Table:
    """Order 0 of a file: its distinct ids, ascending (known by their places from here on), and their shares."""

    def __init__(self, ids: np.ndarray, part: np.ndarray):
        self.ids, self.part = ids.astype(np.int32), part.astype(np.int32)
        self.below = np.cumsum(self.part, dtype=np.int32) - self.part
        self.at = None

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids) if len(ids) else np.ones(1, np.int64)
        found = np.flatnonzero(counts)
        return cls(found, shares(counts[found]))

    def places(self, ids: np.ndarray) -> np.ndarray:
        lookup = np.zeros(int(self.ids[-1]) + 1, np.int32)
        lookup[self.ids] = np.arange(len(self.ids), dtype=np.int32)
        return lookup.take(ids)

    def by_part(self) -> np.ndarray:
        """The place of the id that holds each part, in 16 bits if they hold every place."""
        if self.at is None:
            self.at = np.repeat(np.arange(len(self.ids), dtype=np.uint16 if len(self.ids) <= 1 << 16 else np.int32), self.part)
        return self.at

    def pack(self) -> bytes:
        gaps, part = np.diff(self.ids, prepend=0).astype("<u4"), self.part.astype("<u4")
        columns = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (gaps, part)]  # equal bytes side by side
        return zlib.compress(struct.pack("<I", len(gaps)) + b"".join(columns), 9)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        raw = zlib.decompress(data)
        n = struct.unpack_from("<I", raw)[0]
        gaps, part = (np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4 + i * 4 * n).reshape(4, n).T).view("<u4").reshape(-1) for i in (0, 1))
        return cls(np.cumsum(gaps, dtype=np.int64), part)


class _Model:
    """Orders 2 and 1 of all lanes, one row each. Every lane learns by itself: a block must not depend on its neighbours."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        # flat arrays, in each row order 2 of all lanes, then order 1; what most lanes use most stays close together
        self.row, self.lane = np.int32(2 * lanes), np.arange(2 * lanes, dtype=np.int32)
        # a row per slot: the place of the id that followed (0 to start with) and its confidence, as place * 8 + confidence
        self.seen = np.full(SLOTS * 2 * lanes, 0, np.int32)  # unlike zeros(), at once in memory, in large pages if there are any
        self.right = np.repeat(RIGHT, 2 * lanes)  # a row per confidence
        self.hash = np.zeros(2 * lanes, np.int32)  # slots need its low bits, so that it may overflow
        self.weight = np.zeros((2, lanes), np.int32)

    def _flat(self, row):
        row *= self.row
        row += self.lane
        return row.astype(np.intp)

    def predict(self):
        """The places that orders 2 and 1 predict and their weights, in rows; and the weight of order 0."""
        slot = self.hash >> 5
        slot &= SLOTS - 1
        self.slot = self._flat(slot)
        self.entry = self.seen.take(self.slot)
        self.level = self.entry & 7
        self.cell = self._flat(self.level.copy())
        self.rate = self.right.take(self.cell)
        w = self.weight
        np.right_shift(self.rate, 16 - WEIGHT, out=w.reshape(-1))
        rest = (1 << WEIGHT) - w[0]
        w[1] *= rest
        w[1] >>= WEIGHT
        return (self.entry >> 3).reshape(2, -1), w, rest - w[1]

    def update(self, x, hit):
        """Learn the places ``x``; ``hit``: what orders 2 and 1 had right."""
        hit = hit.reshape(-1).astype(np.int32)
        change = hit * RISE
        change -= self.rate
        change >>= 5
        change += self.rate
        self.right[self.cell] = change
        # right: one more, up to 7; wrong without any confidence: replaced; else one less
        fresh = self.level | hit
        fresh -= 1
        fresh >>= 31  # all bits where there was neither, none elsewhere
        hit <<= 1
        hit -= 1
        entry = np.minimum(hit, 7 - self.level)
        entry += self.entry
        other = entry.reshape(2, -1) ^ (x << 3)
        other &= fresh.reshape(2, -1)
        entry ^= other.reshape(-1)
        self.seen[self.slot] = entry
        two, one = self.hash[:self.lanes], self.hash[self.lanes:]
        np.multiply(one, 5, out=two)
        np.multiply(x, np.int32(40503), out=one)
        two += one


def _place(p, w, rest, below, part, x, hit):
    """Start and size, of 2**TOTAL, of the places ``x`` within the mixture; all of it fits 32 bits."""
    return [_add_shares(rest * of.take(x), w, here) for of, here in ((below, p < x), (part, hit))]


def _add_shares(out, w, here):
    """``out`` with the weights where ``here`` is true, in parts of 2**TOTAL."""
    extra = here.astype(np.int32)
    extra *= w
    two, one = extra
    two += one
    two <<= PARTS
    out += two
    return out


def _encode_lanes(x: np.ndarray, n: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Code blocks side by side: places of ids (block, lanes), n of them in each lane, in falling order of n. Returns
    words (lanes, width) and their number per lane."""
    steps, lanes = x.shape
    width = steps // 2 + 96
    out = np.zeros(width * lanes, U)  # a row per word, as the lanes move on at much the same pace
    pos = np.arange(lanes)
    low, span = np.zeros(lanes, U), np.full(lanes, 2**63 - 1, U)
    model, below, part = _Model(lanes), table.below, table.part
    for t in range(steps):
        now = x[t]
        p, w, rest = model.predict()
        hit = p == now
        start, size = _place(p, w, rest, below, part, now, hit)
        if t >= n[-1]:  # blocks that are through code nothing
            done = int(np.searchsorted(-n, -t))
            start[done:], size[done:] = 0, 1 << TOTAL
        span >>= U(TOTAL)
        low += span * start.astype(U)
        span *= size.astype(U)
        model.update(now, hit)
        small = np.flatnonzero(span < EDGE)
        if len(small):
            at = pos.take(small)
            a = low.take(small)
            out[at] = a >> HALF
            pos[small] = at + lanes
            low[small] = (a & LOW31) << WORD
            span[small] = span.take(small) << WORD
        if t >= steps // 2 and t % 64 == 0 and int(pos.max()) // lanes > width - 80:  # badly predicted ids need more room
            out = np.concatenate([out, np.zeros_like(out)])
            width *= 2
    out[pos] = (low + LOW31) >> HALF  # a number within the span that ends in zeros
    used = pos // lanes + 1
    words = out.reshape(width, lanes)[:int(used.max())]
    for i in range(len(words) - 1, 0, -1):
        words[i - 1] += words[i] >> WORD
    return np.ascontiguousarray(words.astype(np.uint32).T), used


def _decode_lanes(words: np.ndarray, n: np.ndarray, steps: int, table: Table) -> np.ndarray:
    """The ids (lanes, steps) of blocks coded side by side; lanes in falling order of n."""
    lanes = len(words)
    out = np.zeros((steps, lanes), np.int32)
    # the state's 63 bits end one bit before a word does
    words = words.T.astype(U, order="C")  # a row per word
    ahead = np.concatenate([words[1:], np.zeros((1, lanes), U)])
    code = words[0] << HALF | ahead[0] >> U(1)
    words = ((words & U(1)) << HALF | ahead >> U(1)).reshape(-1)
    pos = np.arange(lanes) + lanes
    span = np.full(lanes, 2**63 - 1, U)
    model, below, part, at = _Model(lanes), table.below, table.part, table.by_part()
    most = U((1 << TOTAL) - 1)
    for t in range(steps):
        p, w, rest = model.predict()
        span >>= U(TOTAL)
        v = np.minimum(code // span, most).astype(np.int32)
        # take the shares put in at the two predicted places out again, the one that stands first before the other
        lower, upper = np.minimum(p[0], p[1]), np.maximum(p[0], p[1])
        head = w[1] - w[0]
        head *= p[0] > p[1]
        head += w[0]
        for place, extra in ((lower, head), (upper, w[0] + w[1] - head)):
            over = rest * below.take(place)
            np.subtract(v, over, out=over)
            np.maximum(over, 0, out=over)
            extra <<= PARTS
            v -= np.minimum(over, extra, out=over)
        x = at.take((v / rest).astype(np.int64)).astype(np.int32)  # exact: both are whole numbers under 2**31
        hit = p == x
        start, size = _place(p, w, rest, below, part, x, hit)
        if t >= n[-1]:
            done = int(np.searchsorted(-n, -t))
            start[done:], size[done:] = 0, 1 << TOTAL
        out[t] = x
        code -= span * start.astype(U)
        span *= size.astype(U)
        model.update(x, hit)
        small = np.flatnonzero(span < EDGE)
        if len(small):
            here = pos.take(small)
            code[small] = code.take(small) << WORD | words.take(here, mode="clip")  # a damaged block may read on
            span[small] = span.take(small) << WORD
            pos[small] = here + lanes
    return table.ids.take(out.T)


def block_size(n: int) -> int:
    """Ids per block in a file of n ids: about 2048 blocks side by side, none longer than BLOCK or, but for the last, under 256."""
    return min(BLOCK, max(256, -(-n // 2048)))


def write_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file of whole documents: their ids (integers or None), their numbers of token ids, and the token ids."""
    if len(ids) and int(ids.max()) >= MOST:
        raise ValueError(f"ids must be under {MOST}")
    order0 = Table.of(ids)
    places, id_table = order0.places(ids), order0.pack()
    table = zlib.compress(np.array([i is None for i in doc_ids], np.uint8).tobytes() + np.array([i or 0 for i in doc_ids], "<i8").tobytes()
                          + np.asarray(lengths, "<i8").tobytes(), 1)
    size = block_size(len(ids))
    n_blocks = -(-len(ids) // size)
    index, payload = np.zeros(n_blocks, _BLOCK), []
    for a in range(0, n_blocks, LANES):
        b = min(n_blocks, a + LANES)
        n = np.minimum(size, len(ids) - np.arange(a, b) * size)
        block = np.zeros((b - a, size), np.int32)
        block.reshape(-1)[: int(n.sum())] = places[a * size:a * size + int(n.sum())]
        words, used = _encode_lanes(np.ascontiguousarray(block.T), n, order0)
        for i in range(b - a):
            own = words[i, :used[i]].astype("<u4").tobytes()
            at = (a + i) * size
            index[a + i] = (n[i], used[i], zlib.crc32(own, zlib.crc32(ids[at:at + n[i]].astype("<u4").tobytes())))
            payload.append(own)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), size, len(table), len(id_table)) + table + id_table + index.tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(payload)


def _head(data: bytes):
    """Documents, ids, block size, the packed document table, the id table, the blocks' index, where each starts."""
    magic, n_docs, n_ids, size, n_table, n_id_table = _HEAD.unpack_from(data)
    at = _HEAD.size + n_table + n_id_table
    n_blocks = -(-n_ids // size)
    end = at + n_blocks * _BLOCK.itemsize
    if magic != MAGIC or len(data) < end + 4 or struct.unpack_from("<I", data, end)[0] != zlib.crc32(data[:end]):
        raise ValueError("not a token file, or its header is damaged")
    index = np.frombuffer(data, _BLOCK, n_blocks, at)
    starts = end + 4 + 4 * np.concatenate([[0], np.cumsum(index["words"], dtype=np.int64)])
    return n_docs, n_ids, size, data[_HEAD.size:_HEAD.size + n_table], Table.unpack(data[_HEAD.size + n_table:at]), index, starts


def read_file(data: bytes):
    """(doc ids, lengths, token ids) of a file; raises ValueError if its header or a block fails its checksum."""
    n_docs, n_ids, size, docs, order0, index, starts = _head(data)
    docs = zlib.decompress(docs)
    null = np.frombuffer(docs, np.uint8, n_docs)
    doc_ids, lengths = np.frombuffer(docs, "<i8", 2 * n_docs, n_docs).reshape(2, -1)
    out = np.zeros((len(index), size), np.int32)
    for a in range(0, len(index), LANES):
        b = min(len(index), a + LANES)
        out[a:b] = _read_blocks(data, index[a:b], starts[a:b], size, order0)
    return [None if x else int(i) for x, i in zip(null, doc_ids)], lengths, out.reshape(-1)[:n_ids]


def _read_blocks(data, index, starts, size, order0):
    words = np.zeros((len(index), int(index["words"].max()) + 4), "<u4")
    for i, (row, at) in enumerate(zip(index, starts.tolist())):
        words[i, :row["words"]] = np.frombuffer(data, "<u4", row["words"], at)
    ids = _decode_lanes(words, index["n"].astype(np.int64), size, order0)
    for i, row in enumerate(index):
        own = ids[i, :row["n"]].astype("<u4").tobytes()
        if row["crc"] != zlib.crc32(data[starts[i]:starts[i] + 4 * int(row["words"])], zlib.crc32(own)):
            raise ValueError(f"block {i} is damaged")
    return ids


def read_block(data: bytes, block: int) -> np.ndarray:
    """The ids of one block, read without the others."""
    _, _, size, _, order0, index, starts = _head(data)
    return _read_blocks(data, index[block:block + 1], starts[block:block + 1], size, order0)[0, :index["n"][block]]
